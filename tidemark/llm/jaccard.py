"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document is the set of its word n-grams, as 64-bit hashes; documents with the same set form a
class. Two classes link when their Jaccard similarity reaches ``percent`` per cent.

1. *Order.* n-grams are ordered rare first, by how often their cell of a fixed table of
   counters was met in all documents, then by hash. Any order gives the same links; a rare-first
   one gives few candidates.
2. *Prefix.* A set of n has to share one of its first n - ceil(t n) + 1 n-grams with each
   partner. Only those are shuffled, with their place and the set's size. n-grams of one class
   alone are dropped.
3. *Stars.* Each n-gram's classes are first compared with one of them, the class with the
   smallest place (in a group of near copies: the one with the fewest n-grams of its own). That
   is linear in the size of a group.
4. *Rest.* What those links have not connected is joined n-gram by n-gram, pairs of different
   components alone, so that a large group of copies is never spelt out as pairs. Pairs that
   the stars have tried are left out: a pair is verified once.

Each candidate passes the length filter and the positional filter (n-grams left after the places
still suffice) inside the join, then the suffix filter (the sets' histograms over ``BINS`` ranges
of n-grams differ by at most the allowed Hamming distance) and the exact intersection, both
inside the task that has the two texts. Texts are compressed one by one before they are shuffled,
and only those of candidates go on from there. Minima per n-gram are merged on the map side, all other
joins can be split by adaptive execution.

Cases: null, empty and wordless texts have no n-gram and no link; fewer than ``size`` words make
one n-gram; exact copies are one class and link with each other; a repeated doc_id counts as one
document with each of its texts; rows without a doc_id link nothing. Extra columns are not looked at. Hashing: a set is identified by
its size and a 64-bit hash of it, and n-grams by 64 bits.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counting import count_cells
from .graph import components
from .kernel import LOWER, SPACED, Rolling, Words, chunks, mix, signed, text_bytes, whole_windows
from .shared import settle

BINS = 64
CELLS = 1 << 20


def gram_sets(column: pa.Array, size: int):
    """Per chunk of rows: first row, distinct n-grams sorted within rows, and their row."""
    raw, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        w = Words(LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], SPACED)
        roll = Rolling(w.hashes(), "word")
        grams = roll.windows(size)
        inside = whole_windows(w.first, len(w.starts), size)
        row, grams = w.row[: len(grams)][inside], grams[inside]
        short = np.flatnonzero((w.counts > 0) & (w.counts < size))
        if len(short):  # the whole sequence, its length mixed in
            row = np.concatenate([row, short])
            grams = np.concatenate([grams, roll.of(w.first[short], w.first[short + 1])])
        order = np.lexsort((grams, row))
        row, grams = row[order], grams[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
        yield a, b, row[new], grams[new]


def _per_row(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the rows' sets and where each begins."""
    n = np.bincount(row, minlength=rows)
    return n, np.cumsum(n) - n


def _class_hash(row: np.ndarray, grams: np.ndarray, rows: int) -> np.ndarray:
    """An order-free hash of each set."""
    total = np.zeros(rows + 1, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams))])
    n, first = _per_row(row, rows)
    total = sums[first + n] - sums[first]
    return mix(total + n.astype(np.uint64))


def classes(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, version, n, class) of each document; class is null for an empty set."""

    def run(batches):
        for batch in batches:
            for a, b, row, grams in gram_sets(batch.column("text"), size):
                n, _ = _per_row(row, b - a)
                h = signed(_class_hash(row, grams, b - a))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), batch.column("version").slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(h, mask=n == 0)],
                    ["doc_id", "version", "n", "class"],
                )

    return docs.mapInArrow(run, "doc_id long, version long, n long, class long")


def _ceil(percent: Fraction, n: np.ndarray) -> np.ndarray:
    """ceil(percent * n), exactly."""
    return -((-percent.numerator * n) // percent.denominator)


def prefixes(docs: DataFrame, size: int, t: Fraction, counts: np.ndarray) -> DataFrame:
    """(gram, class, n, place) of the prefix n-grams of each document's set."""
    rarity = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))

    def run(batches):
        for batch in batches:
            for a, b, row, grams in gram_sets(batch.column("text"), size):
                n, first = _per_row(row, b - a)
                h = signed(_class_hash(row, grams, b - a))
                seen = rarity.value[(grams % np.uint64(CELLS)).astype(np.int64)]
                order = np.lexsort((grams, seen, row))
                place = np.arange(len(row)) - first[row]
                keep = place < (n - _ceil(t, n) + 1)[row]
                # copies within the chunk say the same
                _, one = np.unique(np.stack([h, n]), axis=1, return_index=True)
                fresh = np.zeros(b - a, dtype=bool)
                fresh[one] = True
                keep &= fresh[row]
                r = row[keep]
                yield pa.record_batch(
                    [pa.array(signed(grams[order][keep])), pa.array(h[r]), pa.array(n[r].astype(np.int32)), pa.array(place[keep].astype(np.int32))],
                    ["gram", "class", "n", "place"],
                )

    return docs.mapInArrow(run, "gram long, class long, n int, place int")


def _possible(t: Fraction, n: str, m: str, p: str, q: str):
    """Length and positional filter of two sets of n and m n-grams that share one at p and q."""
    up, down = t.numerator, t.denominator
    n, m, p, q = (F.col(c).cast("long") for c in (n, m, p, q))
    length = (F.lit(down) * F.least(n, m)) >= F.lit(up) * F.greatest(n, m)
    # overlap o of linked sets: o (up + down) >= up (n + m)
    place = F.lit(up + down) * F.least(n - p, m - q) >= F.lit(up) * (n + m)
    return length & place


PACKED = "doc_id long, version long, packed binary"


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, packed): texts compressed one by one, for the way through a shuffle."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            blobs = [press.compress(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("version"), pa.array(blobs, pa.binary())], ["doc_id", "version", "packed"])

    return docs.mapInArrow(run, PACKED)


def _opened(column: pa.Array) -> pa.Array:
    open_ = zstandard.ZstdDecompressor()
    return pa.array([open_.decompress(blob.as_buffer()) for blob in column], pa.large_binary())


def _verified(pairs: DataFrame, named: DataFrame, docs: DataFrame, size: int, t: Fraction) -> DataFrame:
    """The pairs (a, b) of classes that link, by suffix filter and exact intersection.

    ``named`` has a document of each class. All texts move once, packed, to meet the classes of
    the pairs; both ends of a pair are then read from that table."""
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(named, "class")
    held = _packed(docs.where("doc_id is not null"))
    # repeated rows of a document count once; the join has already dealt them by these keys
    held = wanted.join(held.hint("merge"), ["doc_id", "version"]).dropDuplicates(["doc_id", "version"])
    held = settle(held.select("class", "packed"), "held")
    both = pairs
    for k, text in (("a", "x"), ("b", "y")):
        both = both.join(held.select(F.col("class").alias(k), F.col("packed").alias(text)).hint("merge"), k)
    both = both.select("a", "b", "x", "y")
    up, down = t.numerator, t.denominator

    def check(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                got = []
                for name in ("x", "y"):
                    rows = []
                    for a, b, row, grams in gram_sets(_opened(part.column(name)), size):
                        n, first = _per_row(row, b - a)
                        rows += [grams[f : f + k] for f, k in zip(first, n)]
                    got.append(rows)
                good = np.zeros(part.num_rows, dtype=bool)
                for k, (x, y) in enumerate(zip(*got)):
                    n, m = len(x), len(y)
                    allowed = n + m - 2 * (-(-up * (n + m) // (up + down)))
                    bins = [np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=BINS) for s in (x, y)]
                    if np.abs(bins[0] - bins[1]).sum() > allowed:
                        continue
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good[k] = down * common >= up * (n + m - common)
                keep = pa.array(good)
                yield pa.record_batch([part.column("a"), part.column("b")], ["a", "b"]).filter(keep)

    return both.mapInArrow(check, "a long, b long")


def class_links(docs: DataFrame, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Classes of ``docs`` (doc_id, text), and (node, component) of the classes that link with
    another one; the two are joined by class."""
    t = Fraction(percent, 100)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    own = settle(classes(docs, size), "classes")

    def cells(batch):
        for _, _, _, grams in gram_sets(batch.column("text"), size):
            yield (grams % np.uint64(CELLS)).astype(np.int64)

    counts = count_cells(docs.select("text"), cells, CELLS)
    posts = prefixes(docs.select("text"), size, t, counts)
    ends = posts.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    posts = settle(posts.join(ends.where("low <> high").select("gram"), "gram"), "postings")
    # only n-grams of several classes get this far: their centres are few
    centres = posts.groupBy("gram").agg(F.min(F.struct("place", "n", "class")).alias("c"))
    # each class's document with the smallest id
    first = own.where("class is not null and doc_id is not null").groupBy("class").agg(F.min(F.struct("doc_id", "version")).alias("f"))
    named = settle(posts.select("class").distinct().join(first, "class").select("class", "f.*"), "named")

    stars = posts.join(centres.hint("merge"), "gram").select(
        F.col("class").alias("a"), F.col("c.class").alias("b"),
        F.col("n").alias("na"), F.col("c.n").alias("nb"), F.col("place").alias("pa"), F.col("c.place").alias("pb"),
    ).where("a <> b").where(_possible(t, "na", "nb", "pa", "pb"))
    tried = settle(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried")
    linked = settle(_verified(tried, named, docs, size, t), "linked")
    groups = components(linked)

    at = posts.select("gram", "class", "n", "place").join(groups.withColumnRenamed("node", "class"), "class", "left")
    at = at.withColumn("component", F.coalesce("component", "class"))
    mixed = at.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    at = settle(at.join(mixed.where("low <> high"), "gram").select("gram", "class", "n", "place", "component").distinct(), "rest")
    l = at.select("gram", F.col("class").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    r = at.select("gram", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    rest = l.join(r, "gram").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _possible(t, "na", "nb", "pa", "pb"))
    rest = settle(rest.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    more = _verified(rest, named, docs, size, t)
    return own, components(linked.unionByName(more))


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    own, groups = class_links(docs, size, percent)
    first = own.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"))
    tagged = first.join(groups.withColumnRenamed("node", "class"), "class", "left")
    tagged = tagged.withColumn("component", F.coalesce("component", "class"))
    least = tagged.groupBy("component").agg(F.min("first").alias("component_id"))
    to = tagged.join(least, "component").select("class", "component_id")
    out = own.join(to, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
