"""LM scoring by cross-entropy difference of two matched n-gram models.

A target model is counted over the chosen documents, a background model over all documents. Both
are bigram models over one shared vocabulary (the V different words of all documents, lower-cased)
with the same interpolation: p(w|v) = a c(v,w)/c(v) + (1-a) (c(w)+1)/(N+V). A document's score is
the mean over its words of the loss under the target less the loss under the background: the
lower, the more it is like the target.

Words, contexts and pairs are counted exactly, told apart by 64-bit hashes; what is gathered grows
with the corpus. Rows are dealt by their hash to chunks of about ``CHUNK`` bytes of text. A chunk sends each of
its different keys once, with its own counts, to the key's bucket (a range of hashes); buckets sum
them and send the sums back in the order in which they came, without the keys; then the chunk's
texts are read again and scored. A common word or pair is one row of a chunk like any other, so
nothing is dealt by it. Texts are shuffled twice, packed keys once, sums once.

Cases: null, empty and wordless texts have no words, losses and score 0; without any target
document the target model is uniform. Repeated rows count each; rows equal in doc_id and text lie in
one chunk, which holds them once with their number. Extra columns are not looked at.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import LOWER, SPACED, Words, chunks, mix, text_bytes
from .shared import settle

CHUNK, BUCKET, LEAST_BUCKETS = 8 << 20, 32 << 20, 256  # bytes of text; bytes of text; a power of two


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers of one length, byte by byte of equal weight."""
    body = b"".join(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return struct.pack("<I", len(arrays[0])) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes) -> np.ndarray:
    """One row per packed array."""
    n = struct.unpack_from("<I", blob)[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4:]), np.uint8).reshape(-1, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def _by_chunk(batches):
    """Per chunk of a sorted stream: its number, the rows of kind 0, those of kind 1 without
    repeats, and how often each of these was met."""
    chunk, parts, times, last = None, [], [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ids = np.stack([table[c].to_numpy() for c in ("chunk", "kind", "version")])
        if not ids.shape[1]:
            continue
        before = np.concatenate([ids[:, :1] if last is None else last, ids[:, :-1]], axis=1)
        fresh = (ids != before).any(axis=0)
        fresh[0] |= last is None
        last = ids[:, -1:]
        at = np.append(np.flatnonzero(fresh), ids.shape[1])
        if at[0] and times:
            times[-1][-1] += at[0]  # the row before goes on
        for number in np.unique(ids[0][at[:-1]]):
            mine = np.flatnonzero(ids[0][at[:-1]] == number)
            if number != chunk:
                if parts:
                    yield chunk, *_kinds(parts, times)
                chunk, parts, times = number, [], []
            parts.append(table.take(at[mine]))
            times.append(np.diff(at)[mine])
    if parts:
        yield chunk, *_kinds(parts, times)


def _kinds(parts, times):
    table, times = pa.concat_tables(parts), np.concatenate(times)
    second = table["kind"].to_numpy() == 1
    return table.filter(pa.array(~second)), table.filter(pa.array(second)), times[second]


def _words(texts: pa.Table):
    """Words of each row; hash, previous hash (0 at a text's start) and row of each word."""
    raw, offsets = text_bytes(texts["body"])
    counts, hashes, previous = [], [], []
    for a, b in chunks(offsets):
        w = Words(LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], SPACED)
        h = w.hashes()
        before = np.zeros_like(h)
        before[1:] = h[:-1]
        before[w.first[:-1][w.counts > 0]] = 0  # the beginning of a text is a word of its own
        counts.append(w.counts)
        hashes.append(h)
        previous.append(before)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint64)
    return n, join(hashes), join(previous), np.repeat(np.arange(len(n)), n)


def _keys(h: np.ndarray, before: np.ndarray):
    """Different keys in order and the key of each: pairs followed by contexts, and words."""
    pairs, contexts = mix(h ^ mix(before + np.uint64(1))), mix(before ^ np.uint64(0xA0761D6478BD642F))
    return [np.unique(x, return_inverse=True) for x in (np.concatenate([pairs, contexts]), mix(h))]


def _count(rows: DataFrame, buckets: int) -> DataFrame:
    """Sums for the keys of each chunk (chunk, bucket, body), and of the words of all chunks."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def send(batches):
        for chunk, chosen, texts, times in _by_chunk(batches):
            n, h, before, row = _words(texts)
            mine = np.isin(texts["doc_id"].to_numpy(), chosen["doc_id"].to_numpy()) & texts["doc_id"].is_valid().to_numpy()
            weight, found, bodies = times[row], [], []
            for side, (keys, at) in enumerate(_keys(h, before)):
                w = np.tile(weight, 2 - side)
                m = np.tile(weight * mine[row], 2 - side)
                every, target = (np.bincount(at, weights=x, minlength=len(keys)) for x in (w, m))
                cuts = np.searchsorted(keys >> shift, np.arange(buckets + 1, dtype=np.uint64))
                for b in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[b], cuts[b + 1])
                    found.append(side * buckets + int(b))
                    bodies.append(_pack(np.diff(keys[part], prepend=np.uint64(0)), every[part], target[part]))
            yield pa.record_batch(
                [pa.array(found, pa.int32()), pa.array([int(chunk)] * len(found), pa.int64()), pa.array(bodies, pa.binary())],
                ["bucket", "chunk", "body"],
            )

    def add(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        sent = [_unpack(x) for x in table["body"].to_pylist()]
        keys, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent]), return_inverse=True)
        sums = [np.bincount(at, weights=np.concatenate([x[i] for x in sent])) for i in (1, 2)]
        cuts = np.cumsum([0] + [x.shape[1] for x in sent])
        bodies = [_pack(*(s[at[a:b]] for s in sums)) for a, b in zip(cuts, cuts[1:])]
        whole = [len(keys), *(int(s.sum()) for s in sums)] if bucket >= buckets else [0, 0, 0]
        return pa.table(
            [table["chunk"], table["bucket"], pa.array(bodies, pa.binary()), *(pa.array([x] + [0] * (len(sent) - 1), pa.int64()) for x in whole)],
            ["chunk", "bucket", "body", "words", "every", "target"],
        )

    sent = rows.mapInArrow(send, "bucket int, chunk long, body binary")
    return sent.groupBy("bucket").applyInArrow(add, "chunk long, bucket int, body binary, words long, every long, target long")


def cross_entropy_difference(docs: DataFrame, chosen: DataFrame, share: float = 0.6) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, target_loss, background_loss and their
    difference per word; ``chosen`` (doc_id) names the target documents."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // CHUNK) or 1
    buckets = max(LEAST_BUCKETS, 1 << (size // BUCKET).bit_length())
    version = F.xxhash64("doc_id", "text")
    rows = docs.select(F.pmod(version, F.lit(parts)).alias("chunk"), F.lit(1).alias("kind"), version.alias("version"), "doc_id", F.col("text").cast("binary").alias("body"))
    marks = chosen.select(F.col("doc_id").alias("c")).distinct()
    # a sorted merge at every size: the chosen ids may be as many as the documents
    target = rows.select("chunk", "doc_id").join(marks.hint("merge"), F.col("doc_id") == F.col("c"), "left_semi")
    target = target.select("chunk", F.lit(0).alias("kind"), F.col("doc_id").alias("version"), "doc_id", F.lit(None).cast("binary").alias("body"))
    dealt = lambda df: df.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "version")
    sums = settle(_count(dealt(rows.unionByName(target)), buckets), "counts")
    total = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "every", "target")]).first()

    def run(batches):
        vocabulary, every, target = total
        for _, back, texts, times in _by_chunk(batches):
            n, h, before, row = _words(texts)
            (grams, at), (_, word) = _keys(h, before)
            got = [_unpack(x) for x in back["body"].to_pylist()]  # in the order of the keys
            counts = np.concatenate(got, axis=1).astype(np.float64) if got else np.zeros((2, 0))
            losses = []
            for c, size in ((counts[1], target), (counts[0], every)):
                one = (c[len(grams) + word] + 1) / (size + vocabulary)
                context = c[at[len(h) :]]
                two = c[at[: len(h)]] / np.maximum(context, 1)
                p = np.where(context > 0, share * two + (1 - share) * one, one)
                losses.append(np.bincount(row, weights=-np.log(p), minlength=len(n)) / np.maximum(n, 1))
            for i in range(0, int(times.max(initial=0)), 1 << 10):  # rows met more often go out again
                again = np.repeat(np.arange(len(n)), np.clip(times - i, 0, 1 << 10))
                yield pa.record_batch(
                    [texts["doc_id"].combine_chunks().take(pa.array(again)), *(pa.array(x[again]) for x in (n.astype(np.int64), *losses, losses[0] - losses[1]))],
                    ["doc_id", "n_words", "target_loss", "background_loss", "score"],
                )

    back = sums.select("chunk", F.lit(0).alias("kind"), F.col("bucket").cast("long").alias("version"), F.lit(None).cast("long").alias("doc_id"), "body")
    return dealt(rows.unionByName(back)).mapInArrow(run, "doc_id long, n_words long, target_loss double, background_loss double, score double")
