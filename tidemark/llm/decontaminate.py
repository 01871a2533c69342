"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``size`` consecutive words (an item of fewer words is
one window). A window is contained in a document where its words follow each other there. As
sets of shingles of ``shingle`` words, containment of a whole window needs *all* its shingles,
so by the prefix principle one shingle is enough to find every place: the rarest, by counts over
all documents. The join is on those prefix shingles alone; a place is then cut by the length
bound (the document must be long enough) and the positional bound (the shingle's place in the
window fixes where the window begins, and it must begin and end inside the document), and what is
left is verified word by word over the item-sized window.

Documents are read twice (counts, join) and never shuffled: the items are the small side. They
are taken in blocks whose size is bounded (``block_bytes``); each block is one pass over the
documents, so a benchmark of any size works and what is sent to tasks stays bounded.

Cases: null or wordless texts have no words and no hits; null or wordless items have no window;
repeated items and windows all count; a null item_id is an item of its own named ''. Input rows
with the same doc_id are judged separately. Extra columns of either table are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import ALNUM, LOWER, Rolling, Words, chunks, signed, text_bytes, whole_windows

SPANS = "doc_id long, n_words long, n_hit long, starts array<int>, ends array<int>, items array<string>"
BITS = 18


def _item_windows(rows, size: int, shingle: int):
    """Distinct windows of some items: their words as bytes, their items, and their shingles."""
    windows: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in rows:
        raw, at = text_bytes(pa.array([text], pa.string()))
        raw = LOWER[raw]
        w = Words(raw, at, ALNUM)
        words = [raw[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    return windows


class Prefixes:
    """Prefix shingles of a block of windows, by shingle length, ready to be looked up."""

    def __init__(self, windows: dict, shingle: int):
        self.windows = [list(k) for k in windows]
        self.items = [sorted(v) for v in windows.values()]
        self.shingles = []  # per window: its shingle length and the hash at each offset
        for words in self.windows:
            n = min(shingle, len(words))
            joined = b" ".join(words)
            raw, at = text_bytes(pa.array([joined], pa.binary()))
            self.shingles.append((n, Rolling(Words(raw, at, ALNUM).hashes(), "word").windows(n)))
        self.lengths = sorted({n for n, _ in self.shingles})

    def all_shingles(self, n: int) -> np.ndarray:
        mine = [h for m, h in self.shingles if m == n]
        return np.unique(np.concatenate(mine)) if mine else np.zeros(0, np.uint64)

    def order(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Keep of each window the rarest shingle (ties by hash) and its offset."""
        table: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, (n, hashes) in enumerate(self.shingles):
            keys, seen = counts[n]
            df = seen[np.searchsorted(keys, hashes)]
            best = int(np.lexsort((hashes, df))[0])
            if df[best]:  # else no document has it
                table.setdefault(n, {}).setdefault(int(hashes[best]), []).append((i, best))
        self.table = {n: (np.array(sorted(t), dtype=np.uint64), [t[k] for k in sorted(t)]) for n, t in table.items()}


class Lookup:
    """Which of many hashes are in a small sorted table, by a bitmap first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.maybe = np.zeros(1 << BITS, dtype=bool)
        self.maybe[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes that are keys, and the numbers of those keys."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[k] == hashes[at]
        return at[same], k[same]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    raw, offsets = text_bytes(batch.column("text"))
    for a, b in chunks(offsets):
        part = LOWER[raw[offsets[a] : offsets[b]]]
        yield a, b, Words(part, offsets[a : b + 1] - offsets[a], ALNUM)


def _shingle_counts(docs: DataFrame, block: Prefixes) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """How often each shingle of the block occurs in all documents."""
    keys = {n: block.all_shingles(n) for n in block.lengths}

    def count(batches):
        look = {n: Lookup(k) for n, k in keys.items()}
        seen = {n: np.zeros(len(k), dtype=np.int64) for n, k in keys.items()}
        for batch in batches:
            for _, _, w in _pieces(batch):
                roll = Rolling(w.hashes(), "word")
                for n in keys:
                    h = roll.windows(n)
                    at, k = look[n].find(h)
                    inside = w.row[at] == w.row[at + n - 1] if len(at) else at.astype(bool)
                    seen[n] += np.bincount(k[inside], minlength=len(keys[n]))
        for n, c in seen.items():
            used = np.flatnonzero(c)
            if len(used):
                yield pa.record_batch(
                    [pa.array(np.full(len(used), n, np.int32)), pa.array(signed(keys[n][used])), pa.array(c[used])],
                    ["n", "h", "c"],
                )

    got = docs.mapInArrow(count, "n int, h long, c long").groupBy("n", "h").agg(F.sum("c").alias("c"))
    out = {n: (k, np.zeros(len(k), dtype=np.int64)) for n, k in keys.items()}
    for row in got.toLocalIterator():  # bounded by the block's own shingles
        k, c = out[row["n"]]
        c[np.searchsorted(k, np.array([row["h"]], np.int64).view(np.uint64)[0])] = row["c"]
    return out


def _hits(w: Words, tables: dict, block: Prefixes) -> dict[int, list[tuple[int, int, int]]]:
    """Per row with any: (begin, end, number) of the verified windows in it."""
    roll = Rolling(w.hashes(), "word")
    hits: dict[int, list[tuple[int, int, int]]] = {}
    for n, (look, where) in tables.items():
        for place, key in zip(*look.find(roll.windows(n))):
            row = w.row[place]
            first, last = w.first[row], w.first[row + 1]
            for number, offset in where[key]:
                words = block.windows[number]
                begin = place - offset
                if last - first < len(words) or begin < first or begin + len(words) > last:
                    continue
                if all(w.raw[w.starts[begin + i] : w.ends[begin + i]].tobytes() == word for i, word in enumerate(words)):
                    hits.setdefault(int(row), []).append((int(begin - first), int(begin - first) + len(words), number))
    return hits


def _contained(docs: DataFrame, block: Prefixes) -> DataFrame:
    """Spans of words covered by the block's windows, and the items they come from."""

    def scan(batches):
        tables = {n: (Lookup(k), where) for n, (k, where) in block.table.items()}
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, w in _pieces(batch):
                hits = _hits(w, tables, block)
                starts, ends, items, n_hit = [], [], [], []
                for row in range(b - a):
                    mine = sorted(hits.get(row, ()))
                    s, e, names = [], [], set()
                    for x, y, number in mine:
                        names.update(block.items[number])
                        if e and x <= e[-1]:
                            e[-1] = max(e[-1], y)
                        else:
                            s.append(x)
                            e.append(y)
                    starts.append(s)
                    ends.append(e)
                    items.append(sorted(names))
                    n_hit.append(sum(e) - sum(s))
                yield pa.record_batch(
                    [ids.slice(a, b - a).cast(pa.int64()), pa.array(w.counts.astype(np.int64)), pa.array(n_hit, pa.int64()),
                     pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "n_words", "n_hit", "starts", "ends", "items"],
                )

    return docs.mapInArrow(scan, SPANS)


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    shingle: int = 4,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, the word spans ``starts`` / ``ends``
    covered by windows of ``items`` (item_id, text), and the ids of those items.

    With more items than one block holds, doc_id must be unique: the blocks' results are united
    per document.
    """
    out, blocks = None, 0
    for block in _blocks(docs, items, size, shingle, block_bytes):
        found = _contained(docs, block)
        out, blocks = found if out is None else out.unionByName(found), blocks + 1
    return out if blocks == 1 else _united(out)


def _blocks(docs: DataFrame, items: DataFrame, size: int, shingle: int, block_bytes: int) -> Iterator[Prefixes]:
    """The items' windows in blocks of bounded size, each with its rarest shingles."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for i in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in items.where(number == i).toLocalIterator()]
        block = Prefixes(_item_windows(rows, size, shingle), shingle)
        block.order(_shingle_counts(docs, block) if block.windows else {})
        yield block


def kept(docs: DataFrame, items: DataFrame, size: int = 10, shingle: int = 4, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns."""
    plain = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs
    for block in _blocks(plain, items, size, shingle, block_bytes):
        out = _clean(out, block)
    return out


def _clean(docs: DataFrame, block: Prefixes) -> DataFrame:
    def run(batches):
        tables = {n: (Lookup(k), where) for n, (k, where) in block.table.items()}
        for batch in batches:
            for a, b, w in _pieces(batch):
                clean = np.ones(b - a, dtype=bool)
                clean[list(_hits(w, tables, block))] = False
                yield batch.slice(a, b - a).filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def _united(found: DataFrame) -> DataFrame:
    """One row per document from the rows of several blocks: overlapping spans are merged."""
    parts = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    empty = F.array().cast("array<struct<starts:int,ends:int>>")
    merged = F.aggregate(
        "spans",
        empty,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["starts"] <= F.try_element_at(acc, F.greatest(F.size(acc), F.lit(1)))["ends"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(acc, F.greatest(F.size(acc), F.lit(1)))["starts"].alias("starts"),
                        F.greatest(F.try_element_at(acc, F.greatest(F.size(acc), F.lit(1)))["ends"], x["ends"]).alias("ends"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    out = parts.withColumn("spans", merged)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["ends"] - x["starts"]))
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items")


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Digest per document of :func:`contaminated_spans`."""
    found = contaminated_spans(docs, items, **options)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
