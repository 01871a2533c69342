"""The manifest against trees built in plain Python."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest, queries


@pytest.mark.parametrize("total", [1, 2, 7, 8, 9, 63, 64, 65, 100, 512, 513])
def test_closed_form_places(total):
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(total)]
    levels = manifest.levels_of(total)
    log = manifest.append_log(nodes, levels)
    want = brute.merkle_levels([n.hex() for n in nodes])
    assert len(want) == levels + 1 and len(log) == 32 * sum(map(len, want))
    for k, level in enumerate(want):
        at = manifest.position(k, np.arange(len(level)), total, levels)
        assert [log[32 * p : 32 * p + 32].hex() for p in at] == level
    assert log[-32:].hex() == want[-1][0]


def answers(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def rows_of(sizes):
    rng = random.Random(4)
    name = lambda x: hashlib.sha256(str(x).encode()).hexdigest()
    rows = []
    for group, n in sizes.items():
        for i in rng.sample(range(10 * n), n):
            leaf = name((group, i))
            rows.append((group, i, leaf, name(i) if i % 3 == 0 else leaf))
    return rows


@pytest.mark.parametrize("height", [1, 2, 4])
@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 9, None: 1},
        {"": 3, None: 65, "é": 8, "z": 64, "Z": 1, "=": 2},
        {"hot": 700, "b": 70, None: 12} | {f"g{i}": 1 + i % 3 for i in range(80)},
    ],
)
def test_manifest(spark, height, sizes):
    rows = rows_of(sizes)
    # rows without a key, a key with several leaves, equal rows
    rows += [("a", None, "0" * 64, "1" * 64), ("a", 5, "a" * 64, "a" * 64), ("a", 5, "b" * 64, "c" * 64)] + [("a", 5, "d" * 64, "d" * 64)] * 11
    df = spark.createDataFrame(rows, "group string, doc_id long, digest string, claimed string").repartition(4)
    df = df.withColumns({"digest": F.unhex("digest"), "claimed": F.unhex("claimed"), "tree": F.lit("x"), "place": F.lit(1), "log": F.lit(2)})
    got = manifest.verified(manifest.build(df, keep=("claimed",), height=height), "claimed")
    assert answers(got) == brute.manifest(rows)


def test_proofs_of_the_untouched_leaves_hold(spark):
    rows = rows_of({"a": 100, "b": 3})
    df = spark.createDataFrame(rows, "group string, doc_id long, digest string, claimed string").withColumn("digest", F.unhex("digest"))
    assert all(r["verified"] for r in manifest.verified(manifest.build(df)).collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "group string, doc_id long, digest binary")
    built = manifest.build(df)
    assert built.root is None and manifest.verified(built).count() == 0


def test_query_of_rows_with_nulls(spark, tmp_path):
    rows = [
        (1, "s", "en", 3, "A b"), (2, None, None, None, None), (3, "é", "de", 0, ""), (None, "s", "en", 3, "X"),
        (9, "s", "en", 1, "A" * 50000), (9, "s", "en", 1, "A" * 50000), (12, "s", "en", 2, "no"),
    ]
    rows += [(i, "s", "fr", i, f"Text {i}") for i in range(20, 40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.withColumns({"group": F.lit(1), "digest": F.lit(2)}).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for d, source, lang, n, text in rows:
        tampered = brute.lower(text) if text is not None and d is not None and brute.zlib.crc32(str(d).encode()) % 3 == 0 else text
        want.append((lang, d, brute.valued(d, source, lang, n, text), brute.valued(d, source, lang, n, tampered)))
    got = answers(queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)))
    assert got == brute.manifest(want) and not all(r[-1] for r in got)
