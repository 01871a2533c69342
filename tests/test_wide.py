"""Many columns at once, exact small-sample tests, column roles: against numpy and enumeration."""

import itertools
import math
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_drift import PAIRS, brute_ks, frame

from tidemark.functions.stats import ks_exact_p_value
from tidemark.operators import cumulative as cum
from tidemark.operators import drift, wide


def percentiles(values, bins=10):
    return tuple(np.unique(np.percentile(values, np.linspace(0, 100, bins + 1))))


def profile(spark, ref, cur, width):
    pair = cum.two_samples(frame(spark, ref), frame(spark, cur), ["x"])
    long = wide.long_values(pair, ["x"])
    return wide.profile(long, wide.summaries_of(long, ["x"]), 10, width).get("x")


@pytest.mark.parametrize("width", [16, 256])
@pytest.mark.parametrize("name", ["exponential", "mostly one value", "tiny"])
def test_cells_are_exact(spark, name, width):
    ref, cur = PAIRS[name]
    gap, edges = profile(spark, ref, cur, width)
    assert gap == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert edges == pytest.approx(percentiles(ref), rel=1e-12)


@pytest.mark.parametrize("most_cells", [1 << 19, 8])
def test_values_are_read_again_and_not_kept(spark, monkeypatch, most_cells):
    ref, cur = PAIRS["exponential"]
    monkeypatch.setattr(wide, "KEPT_ROWS", 0, raising=False)
    monkeypatch.setattr(wide, "MOST_CELLS", most_cells, raising=False)
    kept, table = [], type(spark.range(1))
    persist = table.persist

    def counted(df, *args):
        if "value" in df.columns:
            kept.append(df.count())
        return persist(df, *args)

    monkeypatch.setattr(table, "persist", counted)
    gap, edges = profile(spark, ref, cur, 16)
    assert gap == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert edges == pytest.approx(percentiles(ref), rel=1e-12)
    assert max(kept, default=0) * 64 <= len(ref) + len(cur)


@pytest.mark.parametrize("first", [0, 8])
def test_levels_are_few_and_work_on_whole_columns(spark, monkeypatch, first):
    rng = np.random.default_rng(7)
    names = [f"c{i}" for i in range(70)]
    ref, cur = np.exp(rng.normal(0, 3, (2000, 70))), np.exp(rng.normal(0, 3, (1500, 70)))
    ref[:, 1], cur[:700, 1], ref[:900, 2], ref[:40, 3] = cur[0, 0], cur[0, 0], np.nan, -0.0
    cur[:, 4] = ref[:1500, 4]
    for name, value in (("KEPT_ROWS", 0), ("FIRST", first)):
        monkeypatch.setattr(wide, name, value, raising=False)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frames = [spark.createDataFrame(pa.Table.from_arrays(list(x.T), names=names)) for x in (ref, cur)]
    pair = cum.two_samples(*frames, names)
    long = wide.long_values(pair.mapInArrow(counted, pair.schema), names)
    assert long.count() == 3500  # a row of the table stays one row
    read.value = 0
    found = wide.profile(long, wide.summaries_of(long, names), 10, 8)
    assert read.value <= (5 if first else 9) * 3500
    for i, c in enumerate(names):
        a = ref[~np.isnan(ref[:, i]), i]
        assert found[c][0] == pytest.approx(brute_ks(a, cur[:, i]), abs=1e-12)
        assert found[c][1] == pytest.approx(percentiles(a), rel=1e-12)


def test_missing_values_of_groups_do_not_count(spark):
    ref, cur = [float(x) for x in range(62)], [20.0, 30.0]
    rows = [(0, 0, x) for x in [*ref, *[None] * 9, float("nan")]] + [(1, 0, x) for x in [*cur, None]] + [(1, None, 5.0)]
    long = spark.createDataFrame(rows, f"{cum.SIDE} int, no int, value double")
    row = drift.ks_by_group(long, ["x"]).first()
    assert (row["n_reference"], row["n_current"]) == (62, 2)
    assert row["statistic"] == pytest.approx(brute_ks(ref, cur), abs=1e-12)


def test_candidates_are_thinned_evenly(spark, monkeypatch):
    values = np.random.default_rng(3).permutation(20_000) / 7.0
    monkeypatch.setattr(wide, "CANDIDATES", 512, raising=False)
    pair = cum.two_samples(frame(spark, values[:12_000]), frame(spark, values[12_000:]), ["x"])
    found = wide.summaries_of(wide.long_values(pair, ["x"]), ["x"])[0]
    assert (found.n0, found.n1, found.low, found.high) == (12_000, 8_000, 0.0, 19_999 / 7.0)
    assert (found.mean0, found.mean1) == pytest.approx((values[:12_000].mean(), values[12_000:].mean()))
    assert (found.std0, found.std1) == pytest.approx((values[:12_000].std(), values[12_000:].std()))
    assert len(found.cuts) > 500 and np.diff(found.cuts).max() * 7 < 200


def test_cells_of_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    tails = [10.0**k for k in range(-300, 300, 7)]
    for ref, cur in [
        ([*tails, -1e308, 1e308, None, nan], [*tails[::2], 5.0]),
        ([5e-324, 0.0, 1e-323, -5e-324], [0.0, 5e-324]),
        ([3.0] * 20, [3.0] * 5),
        ([1.0, inf, 2.0, -inf, 5.0], [inf, inf, 2.0]),
    ]:
        gap, edges = profile(spark, ref, cur, 16)
        a, b = ([x for x in s if x is not None and not math.isnan(x)] for s in (ref, cur))
        assert gap == pytest.approx(brute_ks(a, b), abs=1e-12)
        if all(map(math.isfinite, a)):
            assert len(edges) == len(set(edges)) and edges[0] == min(a) and edges[-1] == max(a)
    assert profile(spark, [None, nan], [None], 16) is None
    gap, edges = profile(spark, [], [1.0, 2.0], 16)
    assert gap == 0.0 and edges == ()


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(2)
    names = [f"c{i}" for i in range(1000)]
    ref = rng.normal(0, 1, (60, 1000)) * np.exp(rng.normal(0, 5, 1000))
    cur = ref[:50] * 1.1 + rng.normal(0, 1, 1000)
    ref[:, 3] = 7.0
    frames = [spark.createDataFrame(pa.Table.from_arrays(list(x.T), names=names)).repartition(2) for x in (ref, cur)]
    rows = {r["feature_name"]: r for r in drift.feature_drift(*frames, options=drift.DriftOptions(exact_rows=100)).collect()}
    assert len(rows) == 1000
    pair = cum.two_samples(*frames, names)
    tested = {r["feature"]: r for r in drift.ks_columns(pair, names).collect()}
    for i, c in enumerate(names):
        assert tested[c]["statistic"] == pytest.approx(brute_ks(ref[:, i], cur[:, i]), abs=1e-12)
    few = names[:4]
    plain = {r["feature_name"]: r for r in drift.feature_drift(*frames, few, drift.DriftOptions(exact_rows=100)).collect()}
    for c in few:  # the same as by the form for few columns
        for k in ("drift_score", "drifted", "psi", "psi_label", "reference_mean", "current_std"):
            assert rows[c][k] == (pytest.approx(plain[c][k], rel=1e-9) if isinstance(plain[c][k], float) else plain[c][k]), (c, k)


@pytest.mark.parametrize("test", ["jensenshannon", "psi", "wasserstein"])
def test_wide_tests_agree_with_narrow_ones(spark, monkeypatch, test):
    ref, cur = PAIRS["exponential"]
    frames = frame(spark, ref), frame(spark, cur)
    options = drift.DriftOptions(num_stattest=test, buckets=32)
    narrow = drift.feature_drift(*frames, options=options).first()
    monkeypatch.setattr(wide, "WIDE_COLUMNS", 1)
    assert drift.feature_drift(*frames, options=options).first()["drift_score"] == pytest.approx(narrow["drift_score"], rel=1e-9)


def counted(a, b):
    """The share of orders of the pooled sample that come at least as far apart, ties broken at random."""
    n, m = len(a), len(b)
    seen = round(brute_ks(np.array(a), np.array(b)) * n * m)
    far = total = 0
    for places in itertools.combinations(range(n + m), n):
        x = y = worst = 0
        for k in range(n + m):
            x, y = (x + 1, y) if k in places else (x, y + 1)
            worst = max(worst, abs(x * m - y * n))
        far, total = far + (worst >= seen), total + 1
    return far / total


@pytest.mark.parametrize("a,b", [([1, 2, 3], [4, 5]), ([1, 5, 9, 9], [2, 3, 9]), ([1, 1, 1, 1, 1], [1, 1]), ([3], [1, 2, 3, 4, 5, 6]), ([1, 2, 3, 4, 5, 6], [1.5, 2.5, 7, 8, 9])])
def test_exact_ks(spark, a, b):
    pair = cum.two_samples(frame(spark, a), frame(spark, b), ["x"])
    assert drift.ks_columns(pair, ["x"], exact_rows=10).first()["p_value"] == pytest.approx(counted(a, b), abs=1e-12)
    rough = drift.ks_columns(pair, ["x"]).first()["p_value"]
    assert drift.ks_columns(pair, ["x"], exact_rows=2).first()["p_value"] == pytest.approx(rough)


def test_exact_ks_of_larger_samples(spark):
    df = spark.createDataFrame([(0.05, 2000, 3000), (0.03, 2000, 3000), (0.5, 0, 3), (0.0, 5, 5), (None, 1, 1)], "d double, n long, m long")
    got = [r["p"] for r in df.select(ks_exact_p_value("d", "n", "m").alias("p")).collect()]
    # between the asymptotic values of the statistics around
    assert 0.003 < got[0] < 0.006 and 0.2 < got[1] < 0.25
    assert got[2] == 1.0 and got[3] == 1.0 and got[4] is None


# --- every column has its row ----------------------------------------------------------


def test_no_column_is_lost(spark):
    at = datetime(2024, 1, 1)
    ref = spark.createDataFrame([(1.0, at, "a", [1])] * 4, "x double, t timestamp, k string, l array<int>")
    cur = spark.createDataFrame([(2.0, at, "b")] * 4, "x double, t timestamp, new string")
    rows = {r["feature_name"]: r for r in drift.feature_drift(ref, cur).collect()}
    assert {c: r["stattest_name"] for c, r in rows.items()} == {"x": "ks", "t": "none", "k": "none", "l": "none", "new": "none"}
    assert all(rows[c]["drifted"] is None and rows[c]["drift_score"] is None for c in "tkl")
    summary = drift.dataset_drift(drift.feature_drift(ref, cur)).first()
    assert (summary["total_features"], summary["drifted_features"], summary["dataset_drift_ratio"]) == (1, 1, 1.0)
    dates = ref.select("t")
    only = drift.feature_drift(dates, dates)
    assert [(r["feature_name"], r["stattest_name"]) for r in only.collect()] == [("t", "none")]
    assert drift.dataset_drift(only).first()["dataset_drift_ratio"] == 0.0
    assert drift.feature_drift(ref, cur, ["k"]).first()["stattest_name"] == "none"
    with pytest.raises(KeyError):
        drift.feature_drift(ref, cur, ["nope"])


def test_column_mapping(spark):
    ref = spark.createDataFrame([(i, i % 3, float(i), "a", i / 2, i % 2 == 0) for i in range(30)], "id long, kind int, x double, k string, p double, y boolean")
    cur = ref.withColumn("x", F.col("x") + 100)
    mapping = drift.ColumnMapping(numeric=("x",), category=("kind",), target="y", prediction="p", ids=("id",))
    rows = drift.feature_drift(ref, cur, options=drift.DriftOptions(mapping=mapping)).collect()
    assert {r["feature_name"]: r["stattest_name"] for r in rows} == {"x": "ks", "p": "ks", "kind": "chi2", "y": "chi2", "id": "none", "k": "none"}
    rows = drift.feature_drift(ref, cur, options=drift.DriftOptions(mapping=drift.ColumnMapping(category=("kind",)))).collect()
    assert {r["feature_name"]: r["stattest_name"] for r in rows} == {"x": "ks", "p": "ks", "id": "ks", "kind": "chi2", "y": "none", "k": "none"}


def test_report_names_model_and_time(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    features = drift.feature_drift(ref, ref)
    report = drift.drift_report(features, drift.dataset_drift(features), model_name="m", generated_at="2024-01-01T00:00:00").first()["report"]
    assert '"model_name" : "m"' in report and '"generated_at" : "2024-01-01T00:00:00"' in report
    assert '"generated_at" : "20' in drift.drift_report(features, drift.dataset_drift(features)).first()["report"]
