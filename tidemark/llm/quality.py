"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]): all pairwise
interactions of the features in time linear in their number. Features are the distinct words of
a text (hashed into ``cells``, together of length 1), bins of structure statistics (length, word
length, shares of capitals, digits, symbols and line breaks, repetition of words) and the bin of
the stored character count as metadata. Labels, lang, source and doc_id are no features.

Learning reads a bounded sample of the labelled rows (``sample_rows`` of each label by hash of
the key, held-out rows excluded), fits by AdaGrad on the driver and is set back to the labels'
own proportion; scoring reads every whole text once, without a shuffle.

Cases: null and empty texts have structure features only and get a score; without both labels
every score is the share of label 1 (0 without labels). Rows are judged one by one: copies get
equal scores. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import SPACED, Words, byte_class, chunks, text_bytes
from .shared import bounded_sample, held_out

STATS = ("words", "length", "capitals", "digits", "symbols", "breaks", "distinct", "stored")
BINS = 16
CAPITAL = byte_class(lambda b: 0x41 <= b <= 0x5A)
DIGIT = byte_class(lambda b: 0x30 <= b <= 0x39)
SYMBOL = byte_class(lambda b: 0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E)


@dataclass
class Model:
    base: float
    bias: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None
    cells: int = 0


def _bins(values: np.ndarray, top: float) -> np.ndarray:
    return np.clip((values / top * BINS).astype(np.int64), 0, BINS - 1)


def features(raw: np.ndarray, offsets: np.ndarray, stored: np.ndarray, cells: int):
    """Row, feature number and value of the features of each text, sorted by row."""
    rows = len(offsets) - 1
    w = Words(raw, offsets, SPACED)
    key = w.row.astype(np.int64) * cells + (w.hashes() % np.uint64(cells)).astype(np.int64)
    key = np.unique(key)
    row, cell = key // cells, key % cells
    n = np.bincount(row, minlength=rows)
    value = 1 / np.sqrt(np.maximum(n, 1))[row]
    size = np.diff(offsets)
    per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets]) / np.maximum(size, 1)
    stats = (
        _bins(np.log1p(w.counts), 12), _bins(size / np.maximum(w.counts, 1), 16), _bins(np.sqrt(per(CAPITAL[raw])), 1),
        _bins(np.sqrt(per(DIGIT[raw])), 1), _bins(np.sqrt(per(SYMBOL[raw])), 1), _bins(np.sqrt(per(raw == 10)), 0.5),
        _bins(n / np.maximum(w.counts, 1), 1.0001), _bins(np.log1p(np.maximum(stored, 0)), 14),
    )
    extra = np.stack([cells + i * BINS + s for i, s in enumerate(stats)], axis=1)
    row = np.concatenate([row, np.repeat(np.arange(rows), len(stats))])
    cell = np.concatenate([cell, extra.ravel()])
    value = np.concatenate([value, np.full(rows * len(stats), 0.5)])
    order = np.argsort(row, kind="stable")
    return row[order], cell[order], value[order]


def _raw_scores(m: Model, row, cell, value, rows: int) -> np.ndarray:
    out = m.bias + np.bincount(row, weights=m.linear[cell] * value, minlength=rows)
    for f in range(m.factors.shape[1]):
        vx = m.factors[cell, f] * value
        out += 0.5 * (np.bincount(row, weights=vx, minlength=rows) ** 2 - np.bincount(row, weights=vx * vx, minlength=rows))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(row, cell, value, y: np.ndarray, cells: int, rank: int = 8, epochs: int = 12, rate: float = 0.1, ridge: float = 1e-4, prior: float | None = None) -> Model:
    """AdaGrad over small batches in a fixed order."""
    base = prior if prior is not None else float(y.mean()) if len(y) else 0.0
    if len(y) < 8 or y.min() == y.max():
        return Model(base)
    rng = np.random.default_rng(7)
    size = cells + len(STATS) * BINS
    m = Model(base, 0.0, np.zeros(size), rng.normal(0, 0.05, (size, rank)), cells)
    g0, g1, g2 = 1e-6, np.full(size, 1e-6), np.full((size, rank), 1e-6)
    first = np.searchsorted(row, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 64):
            pick = order[i : i + 64]
            n = first[pick + 1] - first[pick]
            at = np.repeat(first[pick] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            r, c, x = np.repeat(np.arange(len(pick)), n), cell[at], value[at]
            vx = m.factors[c] * x[:, None]
            sums = np.stack([np.bincount(r, weights=vx[:, f], minlength=len(pick)) for f in range(rank)], axis=1)
            squares = np.bincount(r, weights=(vx * vx).sum(1), minlength=len(pick))
            s = m.bias + np.bincount(r, weights=m.linear[c] * x, minlength=len(pick)) + 0.5 * ((sums**2).sum(1) - squares)
            e = (_sigmoid(s) - y[pick]) / len(pick)
            g0 += e.sum() ** 2
            m.bias -= rate * e.sum() / np.sqrt(g0)
            d1, d2 = e[r] * x, (e[r] * x)[:, None] * (sums[r] - vx)
            keys, inv = np.unique(c, return_inverse=True)
            a1 = np.bincount(inv, weights=d1) + ridge * m.linear[keys]
            a2 = np.stack([np.bincount(inv, weights=d2[:, f]) for f in range(rank)], axis=1) + ridge * m.factors[keys]
            g1[keys] += a1**2
            g2[keys] += a2**2
            m.linear[keys] -= rate * a1 / np.sqrt(g1[keys])
            m.factors[keys] -= rate * a2 / np.sqrt(g2[keys])
    if prior is not None and 0 < prior < 1:
        m.bias += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return m


def _chunks(batch: pa.RecordBatch, cells: int):
    raw, offsets = text_bytes(batch.column("text"))
    stored = np.nan_to_num(batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False))
    for a, b in chunks(offsets):
        yield a, b, features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], stored[a:b], cells)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, cells: int = 1 << 16, seed: str = "quality", **options) -> Model:
    """A model from ``docs`` (doc_id, text, n_chars) and ``labels`` (doc_id, label)."""
    known = labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = bounded_sample(known, "doc_id", sample_rows, seed, "label").collect()  # 2 x sample_rows ids
    if not picked:
        return Model(0.0)
    share = float(known.agg(F.avg("label")).first()[0])
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in picked], "doc_id long, label int")

    def run(batches):
        for batch in batches:
            for a, b, (row, cell, value) in _chunks(batch, cells):
                cut = np.searchsorted(row, np.arange(1, b - a))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a),
                     pa.array([x.astype(np.int32).tobytes() for x in np.split(cell, cut)], pa.binary()),
                     pa.array([x.astype(np.float32).tobytes() for x in np.split(value, cut)], pa.binary())],
                    ["doc_id", "label", "cells", "values"],
                )

    sample = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "n_chars", "label")
    got = sample.mapInArrow(run, "doc_id long, label int, cells binary, values binary").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["cells"])))
    cell = [np.frombuffer(r["cells"], np.int32) for r in got]
    value = [np.frombuffer(r["values"], np.float32) for r in got]
    row = np.repeat(np.arange(len(got)), [len(c) for c in cell])
    if not got:
        return Model(share)
    y = np.array([r["label"] for r in got], dtype=float)
    return fit(row, np.concatenate(cell).astype(np.int64), np.concatenate(value).astype(float), y, cells, prior=share, **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of every row of ``docs`` (doc_id, text, n_chars)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            if m.linear is None:
                s = np.full(batch.num_rows, m.base)
                yield pa.record_batch([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])
                continue
            for a, b, (row, cell, value) in _chunks(batch, m.cells):
                s = _sigmoid(_raw_scores(m, row, cell, value, b - a))
                yield pa.record_batch([batch.column("doc_id").slice(a, b - a), pa.array(s)], ["doc_id", "score"])

    got = docs.select("doc_id", "text", "n_chars").mapInArrow(run, "doc_id long, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
