"""Point-in-time joins, training sets, latest tables and lookups on edge frames."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import latest, pit
from tidemark.sources.schemas import FeatureView, parse_refs

T0 = datetime(2024, 1, 1)
VIEW = FeatureView("v", ("k",), 7, {"x": "long"}, "s")
OTHER = FeatureView("w", ("k",), None, {"x": "long", "y": "string"}, "s", created_col=None)
OFFLINE = FeatureView("labels", ("k",), 7, {"z": "long"}, "s", online=False, created_col=None)
ROWS = "k string, event_timestamp timestamp, created_timestamp timestamp, x long"


def day(n, **more):
    return T0 + timedelta(days=n, **more)


def joined(spark, spine, rows, bucket, ttl=7 * 86_400):
    s = spark.createDataFrame(spine, "k string, event_timestamp timestamp, tag string")
    f = spark.createDataFrame(rows, ROWS)
    options = {"large_key_rows": bucket[1]} if isinstance(bucket, tuple) else {"bucket_seconds": bucket}
    out = pit.point_in_time_join(s, [pit.Lookup("v", f, {"x": "x"}, ttl)], ["k"], **options)
    return sorted((r["tag"], r["x"]) for r in out.collect())


BUCKETS = [None, 3_600, 86_400, "auto", ("heavy", 1), ("heavy", 3), ("heavy", 40)]


@pytest.mark.parametrize("bucket", BUCKETS)
def test_edges(spark, bucket):
    rows = [
        ("a", day(0), day(0), 1),
        ("a", day(3), day(3), 2),
        ("a", day(3), day(4), 3),  # same time, created later
        ("b", day(0), day(0), 9),
        (None, day(0), day(0), 77),
    ]
    spine = [
        ("a", day(-1), "before"),
        ("a", day(0), "same instant"),
        ("a", day(2), "carried"),
        ("a", day(3), "tie"),
        ("a", day(10), "at ttl"),
        ("a", day(10, seconds=1), "past ttl"),
        ("b", day(3), "other key"),
        ("b", day(3), "other key"),
        (None, day(3), "no key"),
        ("c", day(3), "unknown"),
    ]
    assert joined(spark, spine, rows, bucket) == sorted(
        [
            ("before", None), ("same instant", 1), ("carried", 1), ("tie", 3), ("at ttl", 3),
            ("past ttl", None), ("other key", 9), ("other key", 9), ("no key", None), ("unknown", None),
        ],
        key=lambda r: (r[0], r[1]),
    )


@pytest.mark.parametrize("bucket", BUCKETS)
def test_skewed_keys_match_brute_force(spark, bucket):
    rng = random.Random(3)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(8)}"
    at = lambda: T0 + timedelta(seconds=rng.randrange(40 * 86_400))
    rows = [(key(), t := at(), t, i) for i in range(300)]
    spine = [(key(), at(), str(i)) for i in range(400)]
    wanted = []
    for k, t, tag in spine:
        known = [r for r in rows if r[0] == k and t - timedelta(days=2) <= r[1] <= t]
        wanted.append((tag, max(known, key=lambda r: r[1])[3] if known else None))
    assert joined(spark, spine, rows, bucket, ttl=2 * 86_400) == sorted(wanted)


@pytest.mark.parametrize("rows_per_piece", [1, 7, 100])
def test_a_key_with_crowded_instants(spark, rows_per_piece):
    """A third of all rows at one second of one key; two tables; rows without key or time."""
    rng = random.Random(9)
    instant = lambda: T0 + timedelta(seconds=rng.choice([50, 50, 50, rng.randrange(100)]))
    key = lambda: rng.choice(["hot", "hot", None, *"abcdefgh"])
    left = [(key(), t := instant(), t + timedelta(seconds=i % 5), i) for i in range(400)]
    right = [(key(), instant(), i, str(i)) for i in range(60)]
    spine = [(key(), rng.choice([None, instant()]) if i % 20 == 0 else instant(), str(i)) for i in range(500)] + [("hot", T0 + timedelta(seconds=50), "same")] * 150
    s = spark.createDataFrame(spine, "k string, event_timestamp timestamp, tag string")
    v = spark.createDataFrame(left, ROWS)
    w = spark.createDataFrame(right, "k string, event_timestamp timestamp, x long, y string")
    lookups = [pit.Lookup("v", v, {"x": "x"}, 30), pit.Lookup("w", w, {"wx": "x", "y": "y"}, None, created_col=None)]
    got = pit.point_in_time_join(s, lookups, ["k"], large_key_rows=rows_per_piece)
    assert got.columns == ["k", "event_timestamp", "tag", "x", "wx", "y"]
    wanted = []
    for k, t, tag in spine:
        a = [r for r in left if k is not None and t is not None and r[0] == k and t - timedelta(seconds=30) <= r[1] <= t]
        b = [r for r in right if k is not None and t is not None and r[0] == k and r[1] <= t]
        newest, other = max(a, key=lambda r: r[1:], default=None), max(b, key=lambda r: r[1:], default=None)
        wanted.append((k, t, tag, newest and newest[3], other and other[2], other and other[3]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_pieces_of_a_heavy_key_are_even(spark):
    """20,000 rows of one key within a day, most of them within a minute: no piece is large."""
    rows = spark.range(20_000).select(
        F.lit("hot").alias("k"),
        F.timestamp_seconds(F.when(F.col("id") % 10 < 9, F.col("id") % 61).otherwise(F.col("id") * 4) + 1_700_000_000).alias("event_timestamp"),
    )
    at = F.unix_micros("event_timestamp")
    heavy = pit.heavy_keys([rows, rows], ["k"], 1_000)
    assert list(heavy.values()) == [40_000]
    assert pit.heavy_keys([rows, rows], ["k"], 40_000) == {}
    cuts = pit._cut_points(rows.select(F.xxhash64("k").alias("_h"), at.alias("_at")), heavy, 1_000).first()["_cuts"]
    assert cuts == sorted(set(cuts))
    # rows of an instant count once, as they do in the join
    placed = rows.distinct().crossJoin(spark.createDataFrame([(cuts,)], "_cuts array<long>"))
    pieces = placed.groupBy(pit._piece(at).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi")).collect()
    assert max(r["n"] for r in pieces) <= 1_000 and len(pieces) > 3
    for r in pieces:
        assert r["b"] == sum(c < r["lo"] for c in cuts) == sum(c < r["hi"] for c in cuts)


def test_cut_sequence_is_read_once(spark, tmp_path):
    spine, table = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([("a", day(1), "x")] * 50, "k string, event_timestamp timestamp, tag string").write.parquet(spine)
    spark.createDataFrame([("a", day(0), day(0), 1)] * 50, ROWS).write.parquet(table)
    out = pit.point_in_time_join(spark.read.parquet(spine), [pit.Lookup("v", spark.read.parquet(table), {"x": "x"})], ["k"], bucket_seconds=86_400)
    assert out.count() == 50
    assert {r["x"] for r in out.collect()} == {1}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") <= 2


def views(spark):
    v = spark.createDataFrame([("a", day(0), day(0), 1), ("b", day(0), day(0), 2)], ROWS)
    w = spark.createDataFrame(
        [("a", day(-100), 5, "old")], "k string, event_timestamp timestamp, x long, y string"
    )
    z = spark.createDataFrame([("a", day(0), 8)], "k string, event_timestamp timestamp, z long")
    return {"v": (VIEW, v), "w": (OTHER, w), "labels": (OFFLINE, z)}


def test_names_and_missing_ttl(spark):
    spine = spark.createDataFrame([("a", day(1))], "k string, event_timestamp timestamp")
    row = pit.historical_features(spine, ["v:x", "w:x", "w:y", "labels:z"], views(spark)).first()
    assert row.asDict() == {
        "k": "a", "event_timestamp": day(1), "x": 1, "w__x": 5, "y": "old", "z": 8,
    }


def test_label_travels_with_its_row(spark):
    spine = spark.createDataFrame(
        [("a", day(1), True), ("b", day(1), False)], "k string, event_timestamp timestamp, is_fraud boolean"
    )
    got = pit.training_set(spine, ["v:x"], views(spark), "is_fraud").collect()
    assert sorted((r["k"], r["x"], r["is_fraud"]) for r in got) == [("a", 1, True), ("b", 2, False)]


def test_absent_label_is_ignored(spark):
    spine = spark.createDataFrame([("a", day(1))], "k string, event_timestamp timestamp")
    assert pit.training_set(spine, ["v:x"], views(spark), "nope").columns == ["k", "event_timestamp", "x"]


def test_missing_time_and_bad_refs(spark):
    spine = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        pit.historical_features(spine, ["v:x"], views(spark))
    timed = spark.createDataFrame([("a", day(1))], "k string, event_timestamp timestamp")
    with pytest.raises(KeyError):
        pit.historical_features(timed, ["v:nope"], views(spark))
    with pytest.raises(KeyError):
        pit.historical_features(timed, ["nope:x"], views(spark))
    with pytest.raises(ValueError):
        parse_refs(["no_colon"])


def test_latest_ties_and_range(spark):
    rows = [
        ("a", day(0), day(0), 1), ("a", day(2), day(2), 2), ("a", day(2), day(3), 3),
        ("a", day(5), day(5), 4), ("b", day(9), day(9), 5),
    ]
    table = spark.createDataFrame(rows, ROWS)
    got = latest.latest_in_range(table, VIEW, day(0), day(2)).collect()
    assert [(r["k"], r["x"]) for r in got] == [("a", 3)]


def test_incremental_keeps_newer_rows(spark):
    stored = spark.createDataFrame([("a", day(5), day(5), 1), ("b", day(1), day(1), 2)], ROWS)
    arriving = spark.createDataFrame(
        [("a", day(4), day(9), 9), ("b", day(6), day(6), 3), ("c", day(6), day(6), 4)], ROWS
    )
    got = latest.materialize_incremental(stored, arriving, VIEW, day(3), day(7)).collect()
    assert sorted((r["k"], r["x"]) for r in got) == [("a", 1), ("b", 3), ("c", 4)]
    again = latest.materialize_incremental(spark.createDataFrame(got, ROWS), arriving, VIEW, day(3), day(7))
    assert sorted(again.collect()) == sorted(got)


def test_materialize_picks_online_views(spark):
    all_views = views(spark)
    assert set(latest.materialize(all_views, day(-200), day(9))) == {"v", "w"}
    assert set(latest.materialize(all_views, day(-200), day(9), [])) == {"v", "w"}
    assert set(latest.materialize(all_views, day(-200), day(9), ["w"])) == {"w"}
    with pytest.raises(ValueError):
        latest.materialize(all_views, day(0), day(1), ["labels"])


def test_lookup(spark):
    tables = latest.materialize(views(spark), day(-200), day(9))
    known = {n: (views(spark)[n][0], t) for n, t in tables.items()}
    requests = spark.createDataFrame([("b",), ("zz",), ("b",)], "k string")
    got = latest.lookup_features(requests, ["v:x", "w:y"], known).collect()
    assert sorted((r["k"], r["x"]) for r in got if r["x"]) == [("b", 2), ("b", 2)]
    assert [tuple(r) for r in got if r["x"] is None] == [("zz", None, None)]
    with pytest.raises(ValueError):
        latest.lookup_features(requests.limit(0), ["v:x"], known)
    with pytest.raises(ValueError):
        latest.lookup_features(requests, ["labels:z"], {"labels": views(spark)["labels"]})


def test_latest_aggregates_before_the_shuffle(spark):
    table = spark.createDataFrame([("a", day(0), day(0), 1)], ROWS)
    plan = latest.latest_per_key(table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max" in plan and "Window" not in plan
