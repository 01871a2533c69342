"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Features of a text are its words and pairs of neighbouring words; a feature's bucket is the
CRC-32 of its bytes modulo ``buckets``. What a bucket is worth compares its share of the target's
features with its share of the corpus; a document's weight is the mean over its features, and
a draw without replacement takes the largest sums of weight and Gumbel noise.

The vocabulary has a head and a tail. The head is broadcast: the most frequent words (counted
exactly over all documents, no more than ``head_words`` of them and none longer than
``LONGEST`` bytes) with the CRC state that each leaves behind, and the buckets of the most
frequent pairs among the first ``PAIR_WORDS`` of them (``head_pairs`` at most), so its size is bounded whatever the
corpus. Features outside the head take their CRC directly: a tail word from its bytes, a tail
pair by going on from the state of its first word. Both ways give the same number, so where
the head ends decides nothing but time. Bucket totals are exact sums over all documents and
all target texts; only ``buckets`` of them reach the driver.

The order of the draw is not made by one sort: scores are whole numbers, rows are counted per
score, running sums over those counts say where each score's ranks begin, and only rows of one
score are ordered among themselves. Equal rows are merged before and dealt out again.

Cases: null, empty and wordless texts have no features, weight 0, and are never drawn; a null
doc_id is hashed as an empty one and comes last among equal scores; repeated rows each have
their own rank; an empty corpus gives an empty result, an empty target leaves every total at 0.
Extra columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .crc_sql import STEPS, crc32
from .kernel import ALNUM, LOWER, Words, chunks, text_bytes
from .shared import settle

#: Longest word, in bytes, that the head takes and that the vectorised CRC steps through.
LONGEST = 64
#: Pairs of this many most frequent words can be in the head.
PAIR_WORDS = 2048
ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()
BLANK = np.uint32(0x20)


def _crc(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges of ``data``, each going on from the CRC in ``state``."""
    out = np.empty(len(state), dtype=np.uint32)
    order = np.argsort(-np.minimum(sizes, LONGEST + 1), kind="stable")
    sorted_sizes = sizes[order]
    long = int(np.searchsorted(-sorted_sizes, -LONGEST, "left"))  # those come first
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(state[i]))
    order, sorted_sizes = order[long:], sorted_sizes[long:]
    register, at = state[order] ^ ONES, starts[order]
    for k in range(int(sorted_sizes[0]) if len(sorted_sizes) else 0):
        n = int(np.searchsorted(-sorted_sizes, -k, "left"))  # ranges longer than k
        part = register[:n]
        register[:n] = CRC[(part ^ data[at[:n] + k]) & 255] ^ (part >> 8)
    out[order] = register ^ ONES
    return out


@dataclass
class Chunk:
    """The words of some texts: different ones as an Arrow array, and where each occurs."""

    words: pa.Array
    code: np.ndarray
    row: np.ndarray
    counts: np.ndarray

    @property
    def pairs(self) -> np.ndarray:
        """Places whose next word belongs to the same text."""
        return np.flatnonzero(self.row[1:] == self.row[:-1])


def _chunks(column: pa.Array):
    """Row range and ``Chunk`` of about a megabyte of texts each."""
    raw, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        own = LOWER[raw[offsets[a] : offsets[b]]]
        words = Words(own, offsets[a : b + 1] - offsets[a], ALNUM)
        ends = np.zeros(len(words.starts) + 1, dtype=np.int64)
        np.cumsum(words.ends - words.starts, out=ends[1:])
        data = own[ALNUM[own]]  # the words without what is between them
        array = pa.Array.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = array.dictionary_encode()
        yield a, b, Chunk(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.row, words.counts)


@dataclass
class Head:
    """Frequent words with the CRC each leaves behind, and buckets of frequent pairs (by
    ``first * PAIR_WORDS + second``, sorted)."""

    words: list[bytes]
    states: np.ndarray
    pairs: np.ndarray
    pair_buckets: np.ndarray


class Featuriser:
    """Buckets of all features of a chunk; one per task."""

    def __init__(self, head: Head, buckets: int):
        self.head, self.buckets = head, buckets
        self.values = pa.array(head.words, pa.large_binary())
        self.table = None
        if len(head.pairs):
            self.table = np.full(PAIR_WORDS * PAIR_WORDS, -1, dtype=np.int32)
            self.table[head.pairs] = head.pair_buckets

    def head_of(self, words: pa.Array) -> np.ndarray:
        """The place of each word in the head, -1 for tail words."""
        if not len(self.values):
            return np.full(len(words), -1, dtype=np.int64)
        return pc.fill_null(pc.index_in(words, value_set=self.values), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def features(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Rows and buckets of all words and pairs."""
        starts, sizes, data = _layout(chunk.words)
        place = self.head_of(chunk.words)
        tail = np.flatnonzero(place < 0)
        states = np.zeros(len(place), dtype=np.uint32)
        known = place >= 0
        states[known] = self.head.states[place[known]]
        states[tail] = _crc(states[tail], data, starts[tail], sizes[tail])
        single = (states % np.uint32(self.buckets)).astype(np.int64)[chunk.code]
        at = chunk.pairs
        first, second = chunk.code[at], chunk.code[at + 1]
        pair = np.full(len(at), -1, dtype=np.int64)
        if self.table is not None:
            a, b = place[first], place[second]
            near = np.flatnonzero((a >= 0) & (b >= 0) & (a < PAIR_WORDS) & (b < PAIR_WORDS))
            pair[near] = self.table[a[near] * PAIR_WORDS + b[near]]
        rest = np.flatnonzero(pair < 0)
        # the CRC of the first word and a blank, then on over the second word
        left = states[first[rest]] ^ ONES
        left = (CRC[(left ^ BLANK) & 255] ^ (left >> 8)) ^ ONES
        crc = _crc(left, data, starts[second[rest]], sizes[second[rest]])
        pair[rest] = crc % np.uint32(self.buckets)
        return np.concatenate([chunk.row, chunk.row[at]]), np.concatenate([single, pair])


def _layout(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and the bytes of an Arrow array of words."""
    data, offsets = text_bytes(words)
    return offsets[:-1], np.diff(offsets), data


def _level(count: Column) -> Column:
    """Coarse classes of a count, eight to a doubling."""
    return F.floor(F.log2(count) * 8).cast("int")


def _most_frequent(counts: DataFrame, most: int) -> list:
    """Rows (with ``n``) of the largest counts: all of the highest classes of counts that hold no
    more than ``most`` rows together, in order. Nothing is sorted or gathered beyond those."""
    classes = counts.groupBy(_level(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    cut, held = None, 0
    for r in sorted(classes, key=lambda r: -r["level"]):  # some hundred classes
        held += r["rows"]
        if held > most:
            break
        cut = r["level"]
    if cut is None:
        return []
    name = next(c for c in counts.columns if c != "n")
    return sorted(counts.where(_level(F.col("n")) >= cut).collect(), key=lambda r: (-r["n"], r[name]))


def learn_head(docs: DataFrame, buckets: int, head_words: int = 1 << 16, head_pairs: int = 1 << 18) -> Head:
    """The head of the vocabulary of ``docs`` (text): two counts over all its texts."""

    def words(batches):
        for batch in batches:
            for _, _, chunk in _chunks(batch.column("text")):
                n = np.bincount(chunk.code, minlength=len(chunk.words))
                yield pa.record_batch([chunk.words.cast(pa.binary()), pa.array(n, pa.int64())], ["word", "n"])

    counted = docs.select("text").mapInArrow(words, "word binary, n long").where(F.octet_length("word") <= LONGEST)
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    found = [bytes(r["word"]) for r in _most_frequent(settle(counted, "words"), head_words)]
    head = Head(found, np.array([zlib.crc32(w) for w in found], dtype=np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32))
    if not found:
        return head
    sent = docs.sparkSession.sparkContext.broadcast(head)

    def pairs(batches):
        of = Featuriser(sent.value, buckets)
        for batch in batches:
            for _, _, chunk in _chunks(batch.column("text")):
                place = of.head_of(chunk.words)[chunk.code]
                at = chunk.pairs
                a, b = place[at], place[at + 1]
                near = (a >= 0) & (b >= 0) & (a < PAIR_WORDS) & (b < PAIR_WORDS)
                code, n = np.unique(a[near] * PAIR_WORDS + b[near], return_counts=True)
                yield pa.record_batch([pa.array(code, pa.int32()), pa.array(n, pa.int64())], ["pair", "n"])

    together = docs.select("text").mapInArrow(pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
    chosen = np.array(sorted(r["pair"] for r in _most_frequent(settle(together, "pairs"), head_pairs)), dtype=np.int64)
    head.pairs = chosen
    crc = [zlib.crc32(b" " + found[p % PAIR_WORDS], int(head.states[p // PAIR_WORDS])) % buckets for p in chosen.tolist()]
    head.pair_buckets = np.array(crc, dtype=np.int32)
    return head


def bucket_totals(texts: DataFrame, head, buckets: int) -> np.ndarray:
    """How many features of ``texts`` (text) fall in each bucket; ``head`` is a broadcast."""

    def run(batches):
        of = Featuriser(head.value, buckets)
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, chunk in _chunks(batch.column("text")):
                totals += np.bincount(of.features(chunk)[1], minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(totals[used], pa.int64())], ["bucket", "n"])

    got = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in got.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target and in the corpus."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum() + n), float(target.sum() + n)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
        dtype=np.int64,
    )


def weights(docs: DataFrame, head, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight) of every row of ``docs`` (doc_id, text)."""

    def run(batches):
        of = Featuriser(head.value, len(gain))
        for batch in batches:
            for a, b, chunk in _chunks(batch.column("text")):
                row, bucket = of.features(chunk)
                n = np.bincount(row, minlength=b - a)
                total = np.bincount(row, weights=gain[bucket], minlength=b - a).astype(np.int64)  # exact: below 2**53
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                    ["doc_id", "n_features", "weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by seed and key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


#: Scores of one class are ranked together; classes are few, since scores are bounded.
CLASS = 1024
#: Copies of a row dealt out at a time.
DEAL = 1 << 16


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (doc_id, n_features, weight, score) with ``rank``: 1, 2, ... by falling score and
    rising doc_id for the drawn ``percent`` of the eligible rows, null for all others."""
    scored = scored.withColumn("can", F.coalesce(eligible, F.lit(False)))
    mine = scored.where("can").drop("can")
    counts = mine.groupBy("score").agg(F.count(F.lit(1)).alias("rows")).withColumn("class", F.floor(F.col("score") / CLASS))
    counts = settle(counts, "scores")
    falling = Window.orderBy(F.col("class").desc())
    classes = counts.groupBy("class").agg(F.sum("rows").alias("rows"))
    classes = classes.select("class", (F.sum("rows").over(falling) - F.col("rows")).alias("above"))
    inside = Window.partitionBy("class").orderBy(F.col("score").desc())
    begins = counts.join(classes, "class").select("score", (F.col("above") + F.sum("rows").over(inside) - F.col("rows")).alias("before"))
    wanted = (counts.agg(F.sum("rows")).first()[0] or 0) * percent // 100
    placed = mine.join(begins, "score")
    columns = ["doc_id", "n_features", "weight", "score"]
    reached = placed.where(F.col("before") < wanted).groupBy(*columns, "before").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    reached = reached.withColumn("before", F.col("before") + F.sum("copies").over(order) - F.col("copies"))
    # copies of a row are dealt out again in bounded pieces
    reached = reached.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(DEAL).cast("long"))))
    upto = F.least(F.col("from") + DEAL, F.col("copies")) - 1
    reached = reached.withColumn("copy", F.explode(F.sequence(F.col("from"), upto)))
    rank = (F.col("before") + F.col("copy") + 1).alias("rank")
    drawn = reached.select(*columns, rank).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    others = placed.where(F.col("before") >= wanted).select(*columns).unionByName(scored.where("not can").select(*columns))
    return drawn.unionByName(others.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = 10000,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    head_words: int = 1 << 16,
    head_pairs: int = 1 << 18,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text), with
    ranks for the drawn ``percent`` of the documents of ``least_words`` words or more."""
    head = docs.sparkSession.sparkContext.broadcast(learn_head(docs, buckets, head_words, head_pairs))
    gain = gains(bucket_totals(docs, head, buckets), bucket_totals(target, head, buckets))
    scored = weights(docs, head, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(settle(scored, "weights"), F.col("n_features") >= max(1, 2 * least_words - 1), percent)


SQL = rf"""
WITH RECURSIVE {STEPS},
words AS (
  SELECT 'd' AS side, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), features AS (
  SELECT side, doc_id, unnest(w) AS f FROM words WHERE len(w) > 0
  UNION ALL SELECT side, doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words WHERE len(w) > 1
), counted AS (SELECT side, doc_id, f, count(*) AS n FROM features GROUP BY ALL),
named AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
dealt AS (SELECT f, {crc32('h')} % 10000 AS bucket FROM named, crc),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted JOIN dealt USING (f) GROUP BY bucket
), whole AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT bucket, CAST(s AS DOUBLE) AS s, CAST(t AS DOUBLE) AS t FROM totals), whole
), weighed AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM counted JOIN dealt USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weighed USING (doc_id)
), ranked AS (
  SELECT *, CASE WHEN n_features >= 39 THEN row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) END AS r,
    count(*) FILTER (n_features >= 39) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * able // 100 THEN r END AS rank FROM ranked
"""
