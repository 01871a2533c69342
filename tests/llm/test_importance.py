"""Importance resampling against a plain Python count of every feature."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import zlib
from pyspark.sql import functions as F

from tidemark.llm import importance

DOCS = "doc_id long, text string"


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgé中z9") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    vocabulary += ["x" * 64, "y" * 65, "z" * 700, "ß" * 40]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(0, None), (1, ""), (2, " .,! "), (3, "One"), (4, "one ONE Éa"), (5, "a " * 19), (6, "a " * 20)]
    for i in range(7, 130):
        n = rng.randint(1, 90)
        rows.append((i, " ,-\n"[i % 4].join(rng.choices(vocabulary, weights, k=n)).upper() if i % 3 else "  ".join(rng.choices(vocabulary, weights, k=n))))
    rows += [(200, "w " * 30)] * 40 + [(None, "w v " * 15)] * 3 + [(130, rows[20][1]), (20, rows[50][1])]
    rows.append((131, " ".join(rng.choices(vocabulary, weights, k=30000))))
    return rows


TARGET = ["one a a a", None, "", "w w " * 9, "x" * 64 + " y"]


def answers(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


@pytest.mark.parametrize("head", [{}, {"head_words": 40, "head_pairs": 9}, {"head_words": 0}])
def test_resampling(spark, head):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    extra = docs.withColumns({"word": F.lit(1), "n": F.lit("x"), "rank": F.lit(2), "score": F.lit(3), "before": F.lit(4)})
    got = answers(importance.resample(extra, target, **head))
    assert got == brute.resampled(rows, TARGET)
    # both buckets that are few and a draw of all
    got = answers(importance.resample(docs, target, buckets=17, percent=100, least_words=0, seed=9, **head))
    assert got == brute.resampled(rows, TARGET, 17, 100, 1, 9)


def test_repeated_rows_are_dealt_out_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(importance, "DEAL", 7)
    rows = [(1, "a b " * 20)] * 50 + [(i, "c " * 25) for i in range(2, 9)]
    docs = spark.createDataFrame(rows, DOCS)
    target = spark.createDataFrame([("a",)], "text string")
    got = importance.resample(docs, target, percent=90)
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
    assert got.count() == 57 and ranks == list(range(1, 52))
    assert answers(got) == brute.resampled(rows, ["a"], percent=90)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a " * 30)], DOCS), spark.createDataFrame([], DOCS)
    assert importance.resample(none, docs).count() == 0
    assert answers(importance.resample(docs, none, percent=100)) == brute.resampled([(1, "a " * 30)], [], percent=100)


def test_crc_of_ranges():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    sizes = rng.choice([0, 1, 2, 5, 63, 64, 65, 400], 300)
    before = rng.integers(0, 2**32, 300).astype(np.uint32)
    want = [zlib.crc32(data[a : a + n].tobytes(), int(s)) for a, n, s in zip(starts, sizes, before)]
    assert importance._crc(before, data, starts, sizes).tolist() == want


def test_head_is_the_most_frequent_words(spark):
    docs = spark.createDataFrame([(1, "b b b a a c " + "l" * 65 + " " + "l" * 65), (2, "B a. d")], DOCS)
    assert importance.learn_head(docs, 100).words == [b"b", b"a"]
    assert importance.learn_head(docs, 100, head_words=1).words == [b"b"]
    head = importance.learn_head(docs, 100)
    of = importance.Featuriser(head, 100)
    chunk = next(importance._chunks(pa.array(["b a x", None, "b"])))[2]
    assert of.features(chunk)[0].tolist() == [0, 0, 0, 2, 0, 0]
    assert of.features(chunk)[1].tolist() == [zlib.crc32(x) % 100 for x in (b"b", b"a", b"x", b"b", b"b a", b"a x")]
