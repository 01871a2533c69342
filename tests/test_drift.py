"""Drift statistics against numpy and hand-made values, with the numeric laws."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import _upper_gamma, ks_p_value, psi_band
from tidemark.operators import cumulative as cum
from tidemark.operators import drift, validation

NAN = float("nan")


def frame(spark, values, name="x"):
    column = pa.array([None if v is None else float(v) for v in values], type=pa.float64())
    return spark.createDataFrame(pa.Table.from_arrays([column], names=[name]))


def numpy_psi(ref, cur, bins=10):
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, bins + 1)))
    if len(edges) < 2:
        return 0.0
    r, c = (np.histogram(a, bins=edges)[0] for a in (ref, cur))
    eps = 1e-8
    rp, cp = (r + eps) / (len(ref) + eps * bins), (c + eps) / (len(cur) + eps * bins)
    return max(0.0, float(np.sum((cp - rp) * np.log(cp / rp))))


def brute_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    grid = np.concatenate([a, b])
    return float(np.max(np.abs(
        np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b))))


def psi_of(spark, ref, cur, bins=10):
    pair = cum.two_samples(frame(spark, ref), frame(spark, cur), ["x"])
    return drift.psi(pair, ["x"], bins).first()["psi"]


RNG = np.random.default_rng(0)
NORMAL = RNG.normal(0, 1, 1000)
PAIRS = {
    "same": (NORMAL, NORMAL),
    "far": (NORMAL, RNG.normal(10, 1, 1000)),
    "shifted": (NORMAL, RNG.normal(1.5, 1, 700)),
    "exponential": (RNG.exponential(1, 500), RNG.exponential(2, 900)),
    "few values": (RNG.integers(0, 4, 1000).astype(float), RNG.integers(0, 5, 800).astype(float)),
    "mostly one value": (np.where(RNG.random(900) < 0.4, 7.0, RNG.normal(5, 3, 900)), RNG.normal(6, 2, 500)),
    "tiny": (np.array([1.0, 2.0, 3.0]), np.array([2.0, 2.5, 9.0, -4.0, 1.0])),
}


@pytest.mark.parametrize("name", PAIRS)
def test_numeric_statistics(spark, name):
    ref, cur = PAIRS[name]
    pair = cum.two_samples(frame(spark, ref), frame(spark, cur), ["x"])
    summaries = cum.summarize(pair, ["x"])
    found = drift.numeric_profile(pair, ["x"], summaries, distance=True)["x"]
    pruned = drift.numeric_profile(pair, ["x"], summaries)["x"]
    assert (pruned.statistic, pruned.edges) == (found.statistic, found.edges)
    assert found.statistic == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert list(found.edges) == pytest.approx(np.unique(np.percentile(ref, np.linspace(0, 100, 11))), abs=1e-12)
    grid = np.sort(np.concatenate([ref, cur]))
    gap = np.abs(np.searchsorted(np.sort(ref), grid[:-1], "right") / len(ref)
                 - np.searchsorted(np.sort(cur), grid[:-1], "right") / len(cur))
    assert found.distance == pytest.approx(float(np.sum(gap * np.diff(grid))), rel=1e-9, abs=1e-12)
    assert psi_of(spark, ref, cur) == pytest.approx(numpy_psi(ref, cur), rel=1e-9, abs=1e-12)
    s = summaries[0]
    assert (s.mean0, s.std1) == pytest.approx((float(np.mean(ref)), float(np.std(cur))))


def test_cut_points_do_not_change_the_counts(spark):
    ref, cur = PAIRS["exponential"]
    pair = cum.two_samples(frame(spark, ref), frame(spark, cur), ["x"])
    rows = []
    for buckets in (2, 7, 64):
        s = cum.summarize(pair, ["x"], buckets)
        rows.append(sorted(cum.cumulative_counts(pair, ["x"], s).collect()))
    assert rows[0] == rows[1] == rows[2]


def test_psi_laws(spark):
    assert psi_of(spark, NORMAL, NORMAL) < 0.01
    assert psi_of(spark, NORMAL, PAIRS["far"][1]) > 0.25
    assert psi_of(spark, NORMAL, PAIRS["shifted"][1]) > 0.1
    assert psi_of(spark, [5.0] * 100, [5.0] * 90) == 0.0
    assert psi_of(spark, [5.0] * 100, [9.0] * 90) == 0.0
    assert psi_of(spark, [], [1.0]) is None
    assert psi_of(spark, [1.0, 2.0], []) is None
    assert psi_of(spark, NORMAL, PAIRS["shifted"][1], bins=5) >= 0


def test_bands(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2499,), (0.25,), (None,)], "p double")
    assert [r[0] for r in df.select(psi_band(F.col("p"))).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", None]


def test_missing_and_nan_are_dropped(spark):
    ref = frame(spark, [1, 2, None, NAN, 3])
    cur = frame(spark, [None, 2, 2, NAN])
    pair = cum.two_samples(ref, cur, ["x"])
    row = drift.ks_test(cum.cumulative_counts(pair, ["x"])).first()
    assert (row["n_reference"], row["n_current"]) == (3, 2)
    assert row["statistic"] == pytest.approx(brute_ks([1, 2, 3], [2, 2]))


def test_infinite_values_count(spark):
    inf = float("inf")
    pair = cum.two_samples(frame(spark, [1, inf, -inf, 2]), frame(spark, [inf, inf, 1]), ["x"])
    row = drift.ks_test(cum.cumulative_counts(pair, ["x"])).first()
    assert row["statistic"] == pytest.approx(5 / 12)


def p_value(spark, d, n1, n2):
    df = spark.createDataFrame([(d, n1, n2)], "d double, n1 long, n2 long")
    return df.select(ks_p_value(F.col("d"), F.col("n1"), F.col("n2"))).first()[0]


def test_ks_p_value(spark):
    en = math.sqrt(100 * 80 / 180)
    z = (en + 0.12 + 0.11 / en) * 0.2
    want = 2 * sum((-1) ** (k + 1) * math.exp(-2 * k * k * z * z) for k in range(1, 20))
    assert p_value(spark, 0.2, 100, 80) == pytest.approx(want, abs=1e-12)
    assert p_value(spark, 0.0, 100, 80) == 1.0
    assert p_value(spark, 1.0, 1000, 1000) == pytest.approx(0.0, abs=1e-12)
    assert p_value(spark, 0.0, 0, 80) == 1.0


def test_job_rows_use_the_statistic(spark):
    ref, cur = PAIRS["shifted"]
    two = frame(spark, ref).withColumn("gone", F.lit(None).cast("double"))
    other = frame(spark, cur).withColumn("gone", F.lit(1.0))
    rows = {r["column"]: r for r in drift.distribution_drift(two, other, ["x", "gone"]).collect()}
    assert rows["x"]["ks_statistic"] == round(brute_ks(ref, cur), 6) and rows["x"]["drifted"]
    assert tuple(rows["gone"])[1:] == (0.0, 1.0, False)
    assert not any(r["drifted"] for r in drift.distribution_drift(two, two, ["x"]).collect())
    assert not any(r["drifted"] for r in drift.distribution_drift(two, other, ["x"], ks_threshold=1.0).collect())


@pytest.mark.parametrize(
    "dof, x, p",
    [  # fixed values: textbook upper tails
        (1, 3.841458820694124, 0.05),
        (2, 5.991464547107979, 0.05),
        (3, 7.814727903251179, 0.05),
        (10, 18.307038053275146, 0.05),
        (5, 0.0, 1.0),
    ],
)
def test_chi_squared_tail(dof, x, p):
    assert _upper_gamma(dof / 2, x / 2) == pytest.approx(p, abs=1e-12)


def test_chi_squared_test(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70 + [(None,)] * 5, "c string")
    cur = spark.createDataFrame([("a",)] * 50 + [("b",)] * 40 + [("new",)] * 10, "c string")
    row = drift.chi_squared_test(drift.category_counts(cum.two_samples(ref, cur, ["c"]), ["c"])).first()
    want = sum((o - e) ** 2 / e for o, e in ((30, 40), (50, 40), (70, 55), (40, 55), (0, 5), (10, 5)))
    assert row["statistic"] == pytest.approx(want) and row["dof"] == 2
    assert row["p_value"] == pytest.approx(math.exp(-want / 2))


def test_feature_rows_and_dataset(spark):
    rng = random.Random(1)
    ref = spark.createDataFrame(
        [(rng.gauss(100, 20), "RETAIL" if rng.random() < 0.5 else "PREMIUM", 1) for _ in range(200)],
        "avg_spend_7d double, customer_segment string, fixed int",
    )
    cur = spark.createDataFrame(
        [(rng.gauss(150, 30), "RETAIL" if rng.random() < 0.5 else "PREMIUM", 1) for _ in range(200)],
        "avg_spend_7d double, customer_segment string, fixed int",
    )
    rows = {r["feature_name"]: r for r in drift.feature_drift(ref, cur).collect()}
    assert rows["avg_spend_7d"]["drifted"] and rows["avg_spend_7d"]["psi_label"] == "HIGH"
    assert rows["avg_spend_7d"]["stattest_name"] == "ks"
    assert rows["customer_segment"]["stattest_name"] == "chi2"
    assert rows["customer_segment"]["psi"] is None and rows["customer_segment"]["reference_mean"] is None
    assert not rows["fixed"]["drifted"] and rows["fixed"]["psi"] == 0.0
    summary = drift.dataset_drift(drift.feature_drift(ref, cur)).first()
    assert summary["total_features"] == 3 and summary["drifted_features"] == 1
    assert summary["recommend_retrain"] and not summary["dataset_drifted"]
    for test in drift.NUMERIC_TESTS:
        one = drift.feature_drift(ref, cur, ["avg_spend_7d"], drift.DriftOptions(num_stattest=test)).first()
        assert one["stattest_name"] == test and one["drifted"]
    with pytest.raises(ValueError):
        drift.feature_drift(ref, cur, ["avg_spend_7d"], drift.DriftOptions(num_stattest="nope"))


def test_retrain_at_exactly_a_fifth(spark):
    rows = spark.createDataFrame([(i == 0, f"f{i}") for i in range(5)], "drifted boolean, feature_name string")
    assert drift.dataset_drift(rows).first()["recommend_retrain"]
    fewer = spark.createDataFrame([(i == 0, f"f{i}") for i in range(6)], "drifted boolean, feature_name string")
    assert not drift.dataset_drift(fewer).first()["recommend_retrain"]
    assert drift.dataset_drift(rows.limit(0)).first()["dataset_drift_ratio"] == 0.0


def test_prediction_drift(spark):
    zeros, ones = frame(spark, [0.0] * 100, "s"), frame(spark, [1.0] * 100, "s")
    row = drift.prediction_drift(zeros, ones, "s").first()
    assert row["feature_name"] == "__prediction__" and row["drifted"]
    assert (row["reference_mean"], row["current_mean"], row["reference_std"]) == (0.0, 1.0, 0.0)
    assert not drift.prediction_drift(zeros, zeros, "s").first()["drifted"]


def test_report_keeps_empty_fields(spark):
    ref = spark.createDataFrame([("a",), ("b",)], "c string")
    features = drift.feature_drift(ref, ref)
    text = drift.drift_report(features, drift.dataset_drift(features)).first()["report"]
    assert '"psi" : null' in text and '"total_features" : 1' in text


@pytest.mark.parametrize("buckets", [2, 16, 200])
def test_left_out_buckets_cannot_matter(spark, buckets):
    rng = np.random.default_rng(5)
    ref, cur = rng.normal(0, 1, 3000), rng.normal(0.2, 1.1, 2000)
    pair = cum.two_samples(frame(spark, ref), frame(spark, cur), ["x"])
    summaries = cum.summarize(pair, ["x"], buckets)
    totals = cum.bucket_totals(pair, ["x"], summaries)
    kept = cum.needed_buckets(totals)
    assert buckets == 2 or len(kept) < len(totals)
    found = drift.numeric_profile(pair, ["x"], summaries)["x"]
    assert found.statistic == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert list(found.edges) == pytest.approx(np.unique(np.percentile(ref, np.linspace(0, 100, 11))), abs=1e-12)


def test_validation_groups(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 500)], "a double, b int")
    rates = {r["column"]: r for r in validation.null_rates(df, ["a", "b"], 0.5).collect()}
    assert rates["a"]["null_rate"] == 0.5 and not rates["a"]["violated"]
    assert all(r["violated"] for r in validation.null_rates(df.limit(0), ["a"], 0.5).collect())
    ranges = {r["column"]: r for r in validation.range_counts(df, {"a": (1, 1), "b": (0, 10), "zz": (0, 1)}).collect()}
    assert ranges["a"]["out_of_range_count"] == 0 and ranges["b"]["out_of_range_count"] == 1 and len(ranges) == 2
    schema = validation.schema_check(df.withColumn("date", F.lit(1)), ["a", "c"]).first()
    assert tuple(schema) == ("fail", ["c"], ["b"], 3)
