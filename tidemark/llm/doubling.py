"""Substring dedup by level-wise doubling of repeated windows.

A window is ``size`` consecutive words of one text. A word is removed when a window that covers
it also begins in a document with a smaller doc_id.

*First level: half the length.* Every window holds windows of ``size // 2`` words; the one with
the smallest hash is its seed, so equal windows have equal seeds and a text has few (about
2 / (size / 2 + 2) of its places). A seed stands for a run of windows; the words that these cover
are its context. Only hashes of seeds and contexts are shuffled. Seeds that one document alone
has are out, and with them all their windows.

*Doubled.* Seeds that are left are extended to the full length. Where a whole context is found
in a smaller document too, all its windows are repeats, which settles the inside of long repeats
in one row per seed. Where a seed is met in several contexts (the ends of repeats), each distinct
context gives its windows of the full length once, from the first document that has it; they are
compared window by window. ``repeat_levels`` goes on doubling from there, on the survivors of each
level alone, until none survive, and tells the longest repeated level of each document.

Minima per hash are merged on the map side, so a passage that a third of all documents share is
a few rows per task; joins back can be split by adaptive execution. Texts move once to meet
their seeds and, where they have repeated ones, once more for the result; other texts are
finished at once.

Cases: null, empty and short texts have no window and stay whole; rows with the same doc_id are
not smaller than each other; rows without a doc_id neither lose words nor count as copies; a
passage repeated within one document alone stays. Extra columns are not looked at. Windows are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import SPACED, Rolling, Words, chunks, minimisers, mix, signed, text_bytes, whole_windows
from .shared import settle


class Seeds:
    """Seeds of the windows of some texts, with what they stand for."""

    def __init__(self, values: np.ndarray, first: np.ndarray, kind: str, size: int, seed: int):
        self.roll = Rolling(values, kind)
        self.size, self.seed, self.first = size, seed, first
        inside = np.flatnonzero(whole_windows(first, len(values), size))
        short = self.roll.windows(seed)
        at = minimisers(short, size - seed + 1)[inside]
        new = np.ones(len(inside), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)
        begin = np.flatnonzero(new)
        self.at = at[begin]  # place of the seed
        self.low = inside[begin]  # first and last window that it stands for
        self.high = inside[np.append(begin[1:], len(inside)) - 1] if len(begin) else inside[:0]
        self.row = np.searchsorted(first, self.low, "right") - 1
        self.hash = short[self.at]
        span = self.roll.of(self.low, self.high + size)
        self.context = mix(span ^ mix((self.at - self.low).astype(np.uint64)))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and hashes of all windows of the given seeds."""
        begin = between(self.low[which], self.high[which])
        return begin, self.roll.of(begin, begin + self.size)

    def runs(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows of the given seeds in runs: those with at least half of their other units
        before the seed, and the rest, with as many behind it. Per run its seed, its first and last
        window, and the hash of the seed with those units, which all its windows hold."""
        reach = (self.size - self.seed + 1) // 2
        turn = self.at[which] - reach  # the last window of the first kind
        left, right = self.low[which] <= turn, self.high[which] > turn
        a, b = which[left], which[right]
        before = mix(self.roll.of(self.at[a] - reach, self.at[a] + self.seed))
        behind = self.roll.of(self.at[b], self.at[b] + self.seed + reach)
        low = np.append(self.low[a], np.maximum(self.low[b], turn[right] + 1))
        high = np.append(np.minimum(self.high[a], turn[left]), self.high[b])
        return np.append(a, b), low, high, np.append(before, behind)


def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each low to its high, both included."""
    n = high - low + 1
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _word_seeds(raw, offsets, size):
    w = Words(raw, offsets, SPACED)
    return w, Seeds(w.hashes(), w.first, "word", size, size // 2)


def seed_rows(docs: DataFrame, size: int, seeds_of=_word_seeds) -> DataFrame:
    """(h, ctx, doc_id): seeds of each document and their contexts, once per document."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            raw, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                _, s = seeds_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                order = np.lexsort((s.context, s.row))
                row, ctx = s.row[order], s.context[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (ctx[1:] != ctx[:-1])
                pick = order[new]
                yield pa.record_batch(
                    [pa.array(signed(s.hash[pick])), pa.array(signed(s.context[pick])), ids.take(pa.array(s.row[pick] + a))],
                    ["h", "ctx", "doc_id"],
                )

    return docs.where("doc_id is not null").mapInArrow(run, "h long, ctx long, doc_id long")


def repeated_contexts(seeds: DataFrame) -> DataFrame:
    """(h, ctx, lo, alone) of seeds met in several documents: the context's first document and
    whether the seed has no other context."""
    each = seeds.groupBy("h", "ctx").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    met = each.groupBy("h").agg(
        F.min("lo").alias("first"), F.max("hi").alias("last"), (F.min("ctx") == F.max("ctx")).alias("alone")
    )
    return each.join(met.where("first < last").select("h", "alone"), "h").select("h", "ctx", "lo", "alone")


def verdicts(seeds: DataFrame, contexts: DataFrame) -> DataFrame:
    """(doc_id, whole, part): contexts of a document that are repeats as a whole, and those of
    which single windows may be."""
    both = seeds.join(contexts, ["h", "ctx"]).where((F.col("doc_id") > F.col("lo")) | ~F.col("alone"))
    whole = F.col("doc_id") > F.col("lo")
    return both.groupBy("doc_id").agg(
        F.collect_list(F.when(whole, F.col("ctx"))).alias("whole"), F.collect_list(F.when(~whole, F.col("ctx"))).alias("part")
    )


WORK = "doc_id long, n long, digest string, text string, whole array<long>, part array<long>"


def listed(column: pa.Array, i: int) -> np.ndarray:
    return np.asarray(column[i].as_py() or [], dtype=np.int64)


def _meet(docs: DataFrame, lists: DataFrame, size: int) -> DataFrame:
    """Documents with their lists; those without are finished and leave their text behind."""
    mine = lists.withColumnRenamed("doc_id", "k")
    joined = docs.join(mine, docs["doc_id"] == mine["k"], "left").select("doc_id", "text", "whole", "part")

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            done = np.asarray(batch.column("whole").is_null())
            n, digests = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for a, b in chunks(offsets):
                w = Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACED)
                n[a:b] = w.counts
                for i in np.flatnonzero(done[a:b]):
                    digests[a + i] = _digest(w, w.first[i], w.first[i + 1], None)
            texts = pa.array(np.where(done, None, batch.column("text").to_numpy(zero_copy_only=False)), pa.string())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n), pa.array(digests, pa.string()), texts, batch.column("whole"), batch.column("part")],
                ["doc_id", "n", "digest", "text", "whole", "part"],
            )

    return joined.mapInArrow(run, WORK)


def _digest(w: Words, a: int, b: int, gone: np.ndarray | None) -> str:
    raw = w.raw
    at = range(a, b) if gone is None else np.flatnonzero(~gone) + a
    return hashlib.sha256(b" ".join(raw[w.starts[i] : w.ends[i]].tobytes() for i in at)).hexdigest()


def _window_rows(work: DataFrame, size: int) -> DataFrame:
    """(w, doc_id): windows of the contexts that are to be compared window by window."""

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            part = batch.column("part")
            for i in range(batch.num_rows):
                want = listed(part, i)
                if not len(want):
                    continue
                piece = raw[offsets[i] : offsets[i + 1]]
                _, s = _word_seeds(piece, np.array([0, len(piece)]), size)
                _, h = s.windows(np.flatnonzero(np.isin(signed(s.context), want)))
                h = np.unique(h)
                yield pa.record_batch([pa.array(signed(h)), pa.array(np.full(len(h), batch.column("doc_id")[i].as_py()))], ["w", "doc_id"])

    return work.where("size(part) > 0").select("doc_id", "text", "part").mapInArrow(run, "w long, doc_id long")


def _later(rows: DataFrame) -> DataFrame:
    """(doc_id, windows): windows of each document that a smaller one has too."""
    first = rows.groupBy("w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    return rows.join(first, "w").where("doc_id > lo").groupBy("doc_id").agg(F.collect_list("w").alias("windows"))


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256."""
    seeds = seed_rows(docs, size)
    contexts = settle(repeated_contexts(seeds), "contexts")
    lists = verdicts(seeds, contexts)
    work = settle(_meet(docs, lists, size), "work")
    later = _later(_window_rows(work, size))
    open_ = work.where("whole is not null").select("doc_id", "n", "text", "whole", "part")
    mine = later.withColumnRenamed("doc_id", "k")
    joined = open_.join(mine, open_["doc_id"] == mine["k"], "left").select("doc_id", "n", "text", "whole", "windows")

    def finish(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            removed, digests = [], []
            for i in range(batch.num_rows):
                piece = raw[offsets[i] : offsets[i + 1]]
                w, s = _word_seeds(piece, np.array([0, len(piece)]), size)
                gone = covered(s, listed(batch.column("whole"), i), listed(batch.column("windows"), i), len(w.starts))
                removed.append(int(gone.sum()))
                digests.append(_digest(w, 0, len(w.starts), gone))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    out = joined.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    rest = work.where("whole is null").select(
        "doc_id", F.col("n").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256")
    )
    return out.unionByName(rest)


def covered(s: Seeds, whole: np.ndarray, windows: np.ndarray, n: int) -> np.ndarray:
    """Which of n units the repeats of one text cover."""
    edge = np.zeros(n + 1, dtype=np.int64)
    full = np.isin(signed(s.context), whole)
    np.add.at(edge, s.low[full], 1)
    np.add.at(edge, s.high[full] + s.size, -1)
    if len(windows):
        begin, h = s.windows(np.flatnonzero(~full))
        begin = begin[np.isin(signed(h), windows)]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + s.size, -1)
    return np.cumsum(edge[:n]) > 0


def repeat_levels(docs: DataFrame, size: int = 50) -> DataFrame:
    """(doc_id, level): the longest of size, 2 size, 4 size, ... words at which the document
    shares a window with another one. Each level reads only documents that survived the last."""
    docs = docs.where("doc_id is not null")
    levels, length, left = None, size, docs
    while True:
        seeds = seed_rows(left, length)
        contexts = settle(repeated_contexts(seeds), "contexts")
        pairs = seeds.join(contexts.select("h", "ctx").distinct(), ["h", "ctx"])
        # a context that two documents have, or windows of several contexts that agree
        near = pairs.select("doc_id").distinct()
        rows = _all_windows(left.join(near, "doc_id", "left_semi"), length)
        shared = rows.groupBy("w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        alive = settle(rows.join(shared, "w", "left_semi").select("doc_id").distinct().withColumn("level", F.lit(length)), "level")
        levels = alive if levels is None else levels.unionByName(alive)
        if not alive.limit(1).count():
            return levels.groupBy("doc_id").agg(F.max("level").alias("level"))
        left = docs.join(alive, "doc_id", "left_semi")
        length *= 2


def _all_windows(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for i in range(batch.num_rows):
                piece = raw[offsets[i] : offsets[i + 1]]
                h = np.unique(Rolling(Words(piece, np.array([0, len(piece)]), SPACED).hashes(), "word").windows(size))
                yield pa.record_batch([pa.array(signed(h)), pa.array(np.full(len(h), batch.column("doc_id")[i].as_py(), dtype=np.int64))], ["w", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "w long, doc_id long")
