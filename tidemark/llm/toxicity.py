"""Toxicity by compression distance.

Two zstandard dictionaries are made: one of ordinary text, one of toxic text. A document is cut into
overlapping byte windows; each is compressed with both, and the difference of the two lengths
says which kind of text it resembles. A toxic document is mostly ordinary text, so what its
dictionary has besides an ordinary base are the marks of toxic text: stretches under byte
n-grams that a clearly larger share of toxic than of ordinary documents has, the most common
last. An n-gram counts once for all toxic documents that have it between the same bytes, so that passages which
copies of one document share are no marks. (Dictionaries of nothing but windows of either kind tell a toxic word from an
ordinary one no better than any two samples of text differ; README has the figures.)

Thresholds on the differences are quantiles over ordinary windows, and the share, number and size of
differences beyond them give a score by a logistic fit; its cut-off at 0.3 is put where most toxic
and most other documents fall on their own side. All of that is calibrated on documents that
the dictionaries in use have not seen: the learning rows are dealt to two folds, each is measured with
the dictionaries of the other, and only the final dictionaries are of both.

Learning reads a bounded sample of the labelled rows (``sample_rows`` of each label, by hash of the
key; one row of each key, the text with the smallest hash) and whole texts of it. Counts, windows
and features are made in tasks; the driver gets n-grams, some hundred windows, marks and a row of numbers per
document. Scoring reads every whole text in one pass without a shuffle; a model is some dozen kilobytes.

Cases: null and empty texts have no window and get the score of a text without toxic windows; a
label table without both labels gives the share of toxic labels (0 without any) as every score;
unlabelled, null-labelled and repeated labels are harmless. Rows are judged one by one, so
copies and ties get equal scores. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernel import BYTE_VALUES, LOWER, Rolling, chunks, signed, text_bytes
from .shared import bounded_sample, held_out, settle

LEVEL = 3
#: Lengths of the byte n-grams that can tell, and the number of counters for each.
GRAMS = (6, 8)
CELLS = 1 << 22
#: How far a telling n-gram's share must be beyond chance, in deviations, and beyond the other share.
DEVIATIONS, RATIO = 5.0, 4.0
#: Bytes on either side by which the surroundings of an n-gram are told apart.
AROUND = 16
#: Quantiles of ordinary windows at which thresholds are put.
QUANTILES = (0.9, 0.97, 0.99, 0.997, 0.999, 0.9997)
#: Windows that one text gives to a dictionary, marks in one, and the longest mark.
PER_TEXT, MARKS = 64, 3000
#: Documents scored this or more are called toxic.
CUT_OFF = 0.3


@dataclass
class Model:
    """Dictionaries, thresholds and weights; ``base`` alone where nothing could be learnt."""

    toxic: bytes | None
    plain: bytes | None
    steps: tuple[int, ...]
    weights: np.ndarray | None
    scale: np.ndarray | None
    base: float
    window: int
    step: int


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=params)


def _windows(offsets: np.ndarray, window: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, lengths and rows of the windows of each text; the last one ends with it."""
    sizes = np.diff(offsets)
    n = np.where(sizes > 0, np.maximum(1, -(-(sizes - window) // step) + 1), 0)
    row = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.minimum(k * step, np.maximum(sizes[row] - window, 0))
    return offsets[row] + begin, np.minimum(window, sizes[row]), row


def _lengths(raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray, compressor) -> np.ndarray:
    segments = np.stack([begins, sizes], axis=1).astype(np.uint64).tobytes()
    got = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(raw.tobytes(), segments), threads=0)
    return np.fromiter((len(x) for x in got), dtype=np.int64, count=len(begins))


class Scorer:
    """Features and scores of texts under a model; one per task."""

    def __init__(self, model: Model):
        self.model = model
        if model.toxic is not None:
            self.toxic, self.plain = _compressor(model.toxic), _compressor(model.plain)

    def gains(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all windows, and by how many bytes each is shorter with the toxic dictionary."""
        raw = LOWER[raw]
        begins, sizes, row = _windows(offsets, self.model.window, self.model.step)
        if not len(begins):
            return row, np.zeros(0, dtype=np.int64)
        return row, _lengths(raw, begins, sizes, self.plain) - _lengths(raw, begins, sizes, self.toxic)

    def features(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: what the windows' differences look like."""
        rows, steps = len(offsets) - 1, self.model.steps
        row, gain = self.gains(raw, offsets)
        out = np.zeros((rows, len(steps) + 3))
        if len(gain):
            count = np.bincount(row, minlength=rows)
            n = np.maximum(1, count)
            for i, s in enumerate(steps):
                out[:, i] = np.log1p(np.bincount(row, weights=gain >= s, minlength=rows))
            top = np.full(rows, -100)
            np.maximum.at(top, row, gain)
            out[:, -3] = np.where(count > 0, top, 0)
            out[:, -2] = np.bincount(row, weights=gain, minlength=rows) / n
            out[:, -1] = np.bincount(row, weights=gain >= steps[-1], minlength=rows) / n
        return out

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        m = self.model
        if m.weights is None:
            return np.full(len(offsets) - 1, m.base)
        return _sigmoid(_design(self.features(raw, offsets), m.scale) @ m.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _design(features: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(features), 1)), (features - scale[0]) / scale[1]])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        penalty = ridge * np.r_[0, np.ones(len(w) - 1)]
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _cells(text: np.ndarray, size: int) -> np.ndarray:
    """The counter of the n-gram at every place of a text."""
    return (Rolling(BYTE_VALUES[text], "byte").windows(size) % np.uint64(CELLS)).astype(np.int64)


def _texts(batches) -> Iterator[tuple[int, int, np.ndarray]]:
    """Fold, label and lower-cased bytes of each text of a sample."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for i, (fold, label) in enumerate(zip(batch.column("fold").to_pylist(), batch.column("label").to_pylist())):
            yield fold, label, LOWER[raw[offsets[i] : offsets[i + 1]]]


def _count_grams(batches):
    """Per n-gram length, counter, fold and label: in how many texts of the task it is met."""
    counts = {(size, fold, label): np.zeros(CELLS, dtype=np.uint16) for size in GRAMS for fold in (0, 1) for label in (0, 1)}
    for fold, label, text in _texts(batches):
        for size in GRAMS:
            counts[size, fold, label][np.unique(_cells(text, size))] += 1
    for (size, fold, label), c in counts.items():
        at = np.flatnonzero(c)
        n = len(at)
        yield pa.record_batch(
            [pa.array(np.full(n, size, np.int32)), pa.array(at.astype(np.int32)), pa.array(np.full(n, 2 * fold + label, np.int32)), pa.array(c[at].astype(np.int64))],
            ["size", "cell", "part", "n"],
        )


#: The builds: the folds on their own, and both; each a set of folds.
BUILDS = ((0,), (1,), (0, 1))


def _apart(toxic: Column, others: Column, n1: float, n0: float) -> Column:
    """Whether so many of n1 toxic and of n0 other texts tell the two apart; three toxic ones at least."""
    both = (toxic + others) / (n1 + n0)
    # the likelihood ratio against one common share, as deviations
    own = toxic * F.log(toxic / (both * n1))
    ratio = own + F.when(others > 0, others * F.log(others / (both * n0))).otherwise(0.0)
    apart = F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    return (toxic >= 3) & (apart > DEVIATIONS) & ((toxic + 0.5) / (n1 + 1) > RATIO * (others + 0.5) / (n0 + 1))


def _surroundings(sample: DataFrame, cells: dict[int, np.ndarray]) -> DataFrame:
    """(size, cell, s0, s1, ...): per build, in how many different surroundings toxic texts have each of
    the n-grams, before or behind it, whichever are fewer."""
    sent = sample.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        for fold, label, text in _texts(batches):
            if not label:
                continue
            roll = Rolling(BYTE_VALUES[text], "byte")
            for size, wanted in sent.value.items():
                found = _cells(text, size)
                at = np.flatnonzero(np.isin(found, wanted))
                around = (roll.of(np.maximum(at - AROUND, 0), at), roll.of(at + size, np.minimum(at + size + AROUND, len(text))))
                for side, h in enumerate(around):
                    n = len(at)
                    numbers = [pa.array(np.full(n, k, np.int32)) for k in (fold, side, size)]
                    yield pa.record_batch([*numbers, pa.array(found[at].astype(np.int32)), pa.array(signed(h))], ["fold", "side", "size", "cell", "h"])

    rows = sample.mapInArrow(run, "fold int, side int, size int, cell int, h long")
    once = rows.groupBy("size", "cell", "side", "h").agg(F.min("fold").alias("low"), F.max("fold").alias("high"))
    inside = [F.col("low").isin(*folds) | F.col("high").isin(*folds) for folds in BUILDS]
    sides = once.groupBy("size", "cell", "side").agg(*[F.count_if(c).cast("double").alias(f"s{i}") for i, c in enumerate(inside)])
    return sides.groupBy("size", "cell").agg(*[F.min(f"s{i}").alias(f"s{i}") for i in range(len(BUILDS))])


def _telling(sample: DataFrame, sizes: dict[tuple[int, int], int]) -> list[dict[int, np.ndarray]]:
    """Per build and n-gram length the counters that tell toxic texts from others, sorted.

    ``sizes``: texts by fold and label. Toxic texts that have an n-gram in the same surroundings, as
    copies of a passage do, count as one."""
    counted = sample.mapInArrow(_count_grams, "size int, cell int, part int, n long").groupBy("size", "cell").agg(
        *[F.coalesce(F.sum(F.when(F.col("part") == 2 * fold + label, F.col("n"))), F.lit(0)).cast("double").alias(f"n{fold}{label}") for fold in (0, 1) for label in (0, 1)]
    )

    def flagged(table: DataFrame, least: bool) -> DataFrame:
        flags = []
        for i, folds in enumerate(BUILDS):
            toxic, others = (reduce(lambda x, y: x + y, [F.col(f"n{f}{label}") for f in folds]) for label in (1, 0))
            n1, n0 = (float(sum(sizes.get((f, label), 0) for f in folds)) for label in (1, 0))
            flags.append(_apart(F.least(toxic, f"s{i}") if least else toxic, others, n1, n0).alias(f"f{i}"))
        return table.select("*", *flags).where(" or ".join(f"f{i}" for i in range(len(flags))))

    def cells(rows, flag=None):
        return {size: np.array(sorted(r["cell"] for r in rows if r["size"] == size and (flag is None or r[flag])), dtype=np.int64) for size in GRAMS}

    first = settle(flagged(counted, False).drop(*[f"f{i}" for i in range(len(BUILDS))]), "grams")
    around = _surroundings(sample, cells(first.select("size", "cell").collect()))
    rows = flagged(first.join(around, ["size", "cell"]), True).collect()
    return [cells(rows, f"f{i}") for i in range(len(BUILDS))]


def _marks(text: np.ndarray, telling: dict[int, np.ndarray], longest: int) -> set[bytes]:
    """The stretches of a text that lie under telling n-grams."""
    under = np.zeros(len(text) + 1, dtype=np.int32)
    for size, cells in telling.items():
        at = np.flatnonzero(np.isin(_cells(text, size), cells))
        np.add.at(under, at, 1)
        np.add.at(under, at + size, -1)
    inside = np.concatenate([[0], np.cumsum(under[:-1]) > 0, [0]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(inside))
    return {text[a:b][:longest].tobytes() for a, b in zip(edges[::2], edges[1::2])}


def _dictionaries(sample: DataFrame, telling: list[dict[int, np.ndarray]], window: int, plain_bytes: int) -> list[tuple[bytes, bytes]]:
    """Per build the ordinary and the toxic dictionary."""
    sent = sample.sparkSession.sparkContext.broadcast(telling)

    def parts(batches):
        for fold, label, text in _texts(batches):
            found: list[tuple[int, bytes]] = []
            if label:
                for build, folds in enumerate(BUILDS):
                    if fold in folds:
                        found += [(build, m) for m in _marks(text, sent.value[build], window)]
            else:
                cut = {text[i : i + window].tobytes() for i in range(0, len(text), window)}
                found += [(3 + fold, w) for w in sorted(cut, key=zlib.crc32)[:PER_TEXT]]
            yield pa.record_batch([pa.array([k for k, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], ["kind", "part"])

    counted = settle(sample.mapInArrow(parts, "kind int, part binary").groupBy("kind", "part").agg(F.count(F.lit(1)).alias("n")), "marks")
    out = []
    few = plain_bytes // window
    for build, folds in enumerate(BUILDS):
        windows = counted.where(F.col("kind").isin([3 + f for f in folds])).orderBy(F.crc32("part"), "part").limit(few).collect()
        marks = counted.where((F.col("kind") == build) & (F.col("n") >= 2)).orderBy(F.col("n").desc(), "part").limit(MARKS).collect()
        plain = b"".join(bytes(r["part"]) for r in windows) or b" " * 8
        # the nearer to the end, the cheaper to refer to
        out.append((plain, plain + b"".join(bytes(r["part"]) for r in reversed(marks))))
    return out


def _measured(sample: DataFrame, models: list[Model], steps: tuple[int, ...] | None):
    """With ``steps``: label and features per text; without: how often ordinary windows have each
    difference. Texts of a fold are measured with the model of the other."""
    sent = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        scorers = [Scorer(m) for m in sent.value[:2]]
        seen: dict[int, int] = {}
        for fold, label, text in _texts(batches):
            of = scorers[1 - fold]
            offsets = np.array([0, len(text)])
            if steps is None:
                if not label:
                    for g, n in zip(*np.unique(of.gains(text, offsets)[1], return_counts=True)):
                        seen[int(g)] = seen.get(int(g), 0) + int(n)
            else:
                yield pa.record_batch([pa.array([label], pa.int32()), pa.array([of.features(text, offsets)[0].tolist()], pa.list_(pa.float64()))], ["a", "b"])
        if steps is None:
            yield pa.record_batch([pa.array(list(seen), pa.int32()), pa.array([[float(n)] for n in seen.values()], pa.list_(pa.float64()))], ["a", "b"])

    return sample.mapInArrow(run, "a int, b array<double>").collect()


def fit(sample: DataFrame, sizes: dict[tuple[int, int], int], base: float, window: int = 48, step: int = 32, plain_bytes: int = 32 << 10) -> Model:
    """A model from a sample (doc_id, text, label, fold) with both labels in both folds."""
    found = _dictionaries(sample, _telling(sample, sizes), window, plain_bytes)
    models = [Model(toxic, plain, (0,), None, None, base, window, step) for plain, toxic in found]
    counts = sorted((r["a"], r["b"][0]) for r in _merged(_measured(sample, models, None)))
    upto = np.cumsum([n for _, n in counts])
    places = [counts[int(np.searchsorted(upto, q * upto[-1]))][0] + 1 for q in QUANTILES] if counts else [1]
    steps = tuple(sorted(set(places)))
    for m in models:
        m.steps = steps
    rows = sorted((r["a"], tuple(r["b"])) for r in _measured(sample, models, steps))
    x, y = np.array([f for _, f in rows]), np.array([label for label, _ in rows], dtype=float)
    model = models[2]
    model.scale = np.stack([x.mean(0), x.std(0) + 1e-6])
    design = _design(x, model.scale)
    model.weights = _logistic(design, y)
    model.weights[0] += np.log(CUT_OFF / (1 - CUT_OFF)) - _cut(design @ model.weights, y)
    return model


def _merged(rows) -> list[dict]:
    """Counts of all tasks by difference."""
    total: dict[int, float] = {}
    for r in rows:
        total[r["a"]] = total.get(r["a"], 0.0) + r["b"][0]
    return [{"a": g, "b": [n]} for g, n in total.items()]


def _cut(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin from which on most toxic documents and fewest others lie: midway to the next. Where
    no margin tells them apart, as where nothing could be learnt, probabilities stay as they are."""
    order = np.argsort(-margin, kind="stable")
    m, toxic = margin[order], y[order]
    gain = np.cumsum(toxic) / toxic.sum() - np.cumsum(1 - toxic) / (1 - toxic).sum()
    last = np.append(m[1:] < m[:-1], True)  # equal margins stay together
    k = int(np.argmax(np.where(last, gain, -np.inf)))
    if k + 1 == len(m) or gain[k] <= 0:
        return float(np.log(CUT_OFF / (1 - CUT_OFF)))
    return float((m[k] + m[k + 1]) / 2)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, seed: str = "toxic", **options) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label), without held-out rows."""
    known = labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    base = 0.0 if share is None else float(share)
    ids = bounded_sample(known, "doc_id", sample_rows, seed, "label")  # 2 x sample_rows ids
    joined = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = joined.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    fold = F.pmod(F.xxhash64(F.lit(f"{seed}-fold"), "doc_id"), F.lit(2)).cast("int")
    sample = settle(one.withColumn("fold", fold), "toxic-sample")
    sizes = {(r["fold"], r["label"]): r["count"] for r in sample.groupBy("fold", "label").count().collect()}
    if any(sizes.get((f, y), 0) < 2 for f in (0, 1) for y in (0, 1)):
        return Model(None, None, (0,), None, None, base, 48, 32)
    return fit(sample, sizes, base, **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) for every row of ``docs``."""

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, 1 << 20):
                s = scorer.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.record_batch([batch.column("doc_id").slice(a, b - a), pa.array(s, pa.float64())], ["doc_id", "score"])

    got = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def kept(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
            for a, b in chunks(offsets, 1 << 20):
                s = scorer.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield batch.slice(a, b - a).filter(pa.array(s < threshold))

    return docs.mapInArrow(run, docs.schema)
