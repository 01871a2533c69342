"""Suffix-array dedup with a logarithmic family of indexes.

Texts are bytes; a byte is removed when it is covered by a string of ``size`` bytes that also
begins in a document with a smaller doc_id. Documents come in batches of ascending doc_id. Each
batch gets a suffix array: its suffixes, cut at ``size`` bytes (no longer prefix matters for a
match of that length), in sorted order with the first document that has each. It is merge-scanned
against every level of the index, which hold smaller documents only, and against itself; equal
neighbours are long matches. Then it becomes a level; levels of equal size are merged, so there
are about log2 of the number of batches, and a suffix is rewritten as often.

Most suffixes of a corpus cannot match anything. Before they are sorted, each string of ``size``
bytes is represented by its seed, the half-sized substring with the smallest hash. Suffixes whose
seed one document alone has are left out, and where all strings around a seed are those of a
smaller document, they are repeats together. What enters the arrays are the suffixes around seeds
that documents have in different surroundings: the ends of repeats. Those are first told apart by a
longer piece, the seed with half of the other bytes on one side, which all suffixes of a run hold:
runs whose piece one document alone has stay out too.

Suffixes are compared by 64-bit hashes of their bytes, and are shuffled by them. Minima per
suffix are merged on the map side; no group of equal suffixes is gathered. Levels are tables in
the shared folder, so a lost executor costs a read.

Disk: seeds are first counted by their hash alone, and only those that several documents have are
kept with their surroundings; a table goes when nothing reads it any more, and levels are merged
when the next batch comes.

Cases: null and empty texts have no bytes; texts shorter than ``size`` have no suffix and stay;
rows with the same doc_id are not smaller than each other; rows without a doc_id neither lose
bytes nor count as copies; bytes left over by a removal may split a character. Extra columns are
not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .doubling import Seeds, between, repeated_contexts, seed_rows, verdicts
from .kernel import BYTE_VALUES, U, chunks, mix, signed, text_bytes
from .shared import drop, settle


def _byte_seeds(raw, offsets, size):
    return None, Seeds(BYTE_VALUES[raw], offsets, "byte", size, size // 2)


def _keyed(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A value of a row as one number."""
    return mix(value.astype(U) ^ mix(row.astype(U) + U(1)))


def _listed(column: pa.Array, a: int, b: int) -> np.ndarray:
    """The lists of the rows a to b as keyed values; rows count from a."""
    lists = column.slice(a, b - a)
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return _keyed(np.repeat(np.arange(b - a), n), values.view(U))


def _windows_of(s: Seeds, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, hashes and rows of all windows of the given seeds."""
    begin, h = s.windows(which)
    return begin, h, np.repeat(s.row[which], s.high[which] - s.low[which] + 1)


def suffix_runs(work: DataFrame, size: int) -> DataFrame:
    """(key, doc_id, suffixes): suffixes of the documents' undecided surroundings (``part``), once
    per document, in runs that hold the same longer piece (``key``)."""

    def run(batches):
        for batch in batches:
            ids, part = batch.column("doc_id"), batch.column("part")
            raw, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                _, s = _byte_seeds(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                seed, low, high, key = s.runs(np.flatnonzero(np.isin(_keyed(s.row, s.context), _listed(part, a, b))))
                begin = between(low, high)
                of = np.repeat(np.arange(len(seed)), high - low + 1)
                h, row = s.roll.of(begin, begin + size), s.row[seed]
                pick = np.sort(np.unique(_keyed(row[of], h), return_index=True)[1])
                n = np.bincount(of[pick], minlength=len(seed))
                some = np.flatnonzero(n)
                ends = np.append(0, np.cumsum(n[some])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(h[pick])))
                yield pa.record_batch(
                    [pa.array(signed(key[some])), ids.take(pa.array(row[some] + a)), lists], ["key", "doc_id", "suffixes"]
                )

    return work.select("doc_id", "text", "part").mapInArrow(run, "key long, doc_id long, suffixes array<long>")


def suffixes(work: DataFrame, size: int) -> DataFrame:
    """(suffix, doc_id): suffixes of the undecided surroundings that hold a piece of three quarters
    of ``size`` which several documents have there; the others have no equal in another one."""
    runs = settle(suffix_runs(work, size), "runs")
    ends = runs.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    met = runs.join(ends.where("lo < hi").select("key"), "key")
    rows = settle(met.select(F.explode("suffixes").alias("suffix"), "doc_id"), "suffixes")
    drop(runs)
    return rows


class SuffixIndex:
    """Levels of sorted suffixes with their first documents; batches come in doc_id order."""

    def __init__(self):
        self.levels: list[DataFrame | None] = []
        self.newest: DataFrame | None = None

    def scan(self, batch: DataFrame) -> DataFrame:
        """(doc_id, suffix) of the batch that a level or an earlier document of the batch has;
        the batch then joins the index."""
        self._merge()
        own = settle(batch.groupBy("suffix").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).sortWithinPartitions("suffix"), "array")
        known = own.where("lo < hi").select("suffix", "lo")
        for level in self.levels:
            if level is not None:
                known = known.unionByName(level.select("suffix", "lo").join(own.select("suffix"), "suffix"))
        known = known.groupBy("suffix").agg(F.min("lo").alias("lo"))
        found = batch.join(known, "suffix").where("doc_id > lo").select("doc_id", "suffix")
        found = settle(found, "matches")
        self.newest = own.select("suffix", "lo")
        return found

    def _merge(self) -> None:
        """The newest batch becomes a level; levels of equal size become one."""
        if self.newest is None:
            return
        carry, i = self.newest, 0
        while i < len(self.levels) and self.levels[i] is not None:
            both = carry, self.levels[i]
            merged = both[0].unionByName(both[1]).groupBy("suffix").agg(F.min("lo").alias("lo"))
            carry = settle(merged.sortWithinPartitions("suffix"), "level")
            drop(*both)
            self.levels[i] = None
            i += 1
        self.levels[i : i + 1] = [carry]
        self.newest = None

    def close(self) -> None:
        drop(*[level for level in [*self.levels, self.newest] if level is not None])
        self.levels, self.newest = [], None


def batches_of(docs: DataFrame, number: int) -> list[tuple[int | None, int | None]]:
    """Bounds of doc_id that cut ``docs`` into about equal batches, in order."""
    cuts = docs.stat.approxQuantile("doc_id", [i / number for i in range(1, number)], 0.01) if number > 1 else []
    cuts = sorted({int(c) for c in cuts})
    return list(zip([None, *cuts], [*cuts, None]))


def shared_seeds(docs: DataFrame, size: int) -> DataFrame:
    """(h, ctx, doc_id): the seeds that several documents have.

    Counted by the hash alone, so that the surroundings of a seed that one document has alone are
    shuffled once and written never."""
    seeds = seed_rows(docs, size, _byte_seeds)
    ends = seeds.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    met = settle(ends.where("first < last").select("h"), "met")
    # a sorted merge at every size: the repeated seeds may be as many as the seeds
    shared = settle(seeds.join(met.hint("merge"), "h"), "seeds")
    drop(met)
    return shared


def _gone(s: Seeds, whole: np.ndarray, part: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Which of the n bytes of some rows the repeats cover; lists are keyed by row. Repeated starts
    are looked for in the surroundings of ``part`` alone: no others hold them."""
    edge = np.zeros(n + 1, dtype=np.int64)
    context = _keyed(s.row, s.context)
    full = np.isin(context, whole)
    np.add.at(edge, s.low[full], 1)
    np.add.at(edge, s.high[full] + s.size, -1)
    if len(starts):
        begin, h, row = _windows_of(s, np.flatnonzero(np.isin(context, part)))
        begin = begin[np.isin(_keyed(row, h), starts)]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + s.size, -1)
    return np.cumsum(edge[:n]) > 0


def _cut(raw: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Per row: removed bytes, maximal removed runs, digest of the bytes that stay."""
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    first = offsets[:-1][offsets[1:] > offsets[:-1]]
    opens[first] = gone[first]
    count = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
    removed, digests = count(gone), []
    for i in range(len(offsets) - 1):
        piece, cut = raw[offsets[i] : offsets[i + 1]], gone[offsets[i] : offsets[i + 1]]
        digests.append(hashlib.sha256((piece[~cut] if removed[i] else piece).tobytes()).hexdigest())
    return removed, count(opens), digests


def remove_repeats(docs: DataFrame, size: int = 50, batches: int = 4) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    seeds = shared_seeds(docs, size)
    lists = settle(verdicts(seeds, repeated_contexts(seeds)), "lists")
    drop(seeds)
    undecided = lists.where("size(part) > 0").select(F.col("doc_id").alias("k"), "part")
    work = docs.join(undecided, docs["doc_id"] == undecided["k"]).select("doc_id", "text", "part")
    rows = suffixes(work, size)
    index, found = SuffixIndex(), None
    for low, high in batches_of(rows, batches):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("doc_id") >= low)
        if high is not None:
            batch = batch.where(F.col("doc_id") < high)
        got = index.scan(batch)
        found = got if found is None else found.unionByName(got)
    index.close()
    drop(rows)
    found = found.groupBy("doc_id").agg(F.collect_list("suffix").alias("starts"))
    mine = lists.join(found, "doc_id", "left").select(
        F.col("doc_id").alias("k"), "whole", F.when(F.col("starts").isNotNull(), F.col("part")).alias("part"), "starts"
    )
    mine = mine.where("size(whole) > 0 or starts is not null")
    joined = docs.join(mine, docs["doc_id"] == mine["k"], "left").select("doc_id", "text", "whole", "part", "starts")

    def finish(parts):
        for batch in parts:
            whole, part, starts = batch.column("whole"), batch.column("part"), batch.column("starts")
            raw, offsets = text_bytes(batch.column("text"))
            hit = whole.is_valid().to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets):
                piece, first = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                # texts without a repeat are only counted and digested
                cut = np.repeat(hit[a:b], np.diff(first))
                gone = np.zeros(len(piece), dtype=bool)
                if cut.any():
                    at = np.append(0, np.cumsum(np.where(hit[a:b], np.diff(first), 0)))
                    _, s = _byte_seeds(piece[cut], at, size)
                    gone[cut] = _gone(s, _listed(whole, a, b), _listed(part, a, b), _listed(starts, a, b), at[-1])
                removed, spans, digests = _cut(piece, first, gone)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(first)), pa.array(removed), pa.array(spans), pa.array(digests, pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return joined.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
