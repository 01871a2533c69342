"""Stores and jobs that go run by run: marks, buckets, kept state, gates."""

import glob
import os
import random
from datetime import date, datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import publish, rolling, validation
from tidemark.operators.rolling_state import RollingState, closing_day, incremental_feature_table, usable
from tidemark.sources import io
from tidemark.sources.latest_store import LatestStore
from tidemark.sources.schemas import FeatureView
from tidemark.streaming.incremental import feature_stream, materialize_stream

VIEW = FeatureView("v", ("k",), 7, {"x": "long"}, "s")
OTHER = FeatureView("w", ("k",), None, {"y": "string"}, "s", created_col=None)
OFFLINE = FeatureView("o", ("k",), 7, {"x": "long"}, "s", online=False)
ROWS = "k string, event_timestamp timestamp, created_timestamp timestamp, x long"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def table(spark, rows):
    return spark.createDataFrame([(k, t, c, x) for k, t, c, x in rows], ROWS)


def answers(store, view=VIEW):
    found = store.read(view)
    return {} if found is None else {r["k"]: r["x"] for r in found.collect()}


# --- latest store ----------------------------------------------------------------------


def test_incremental_runs_start_at_their_marks(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "s"), buckets=4)
    rows = [
        ("old", at(1), at(1), 1),  # before the first run's time to live
        ("a", at(4), at(4), 2), ("a", at(10), at(10), 3), ("a", at(10), at(11), 4),  # the last created wins
        ("b", at(10), at(10), 5), ("b", at(12), at(12), 6), ("c", at(20), at(20), 7), (None, at(5), at(5), 8),
    ]
    views = {"v": (VIEW, table(spark, rows)), "w": (OTHER, table(spark, rows).withColumn("y", F.col("x").cast("string"))), "o": (OFFLINE, None)}
    store.materialize_incremental(views, "2024-01-10")
    assert answers(store) == {"a": 4, "b": 5, None: 8}
    assert store.marks()["v"].upto == at(10) and set(store.marks()) == {"v", "w"}
    assert {r["k"]: r["y"] for r in store.read(OTHER).collect()} == {"old": "1", "a": "4", "b": "5", None: "8"}
    store.materialize_incremental(views, "2024-01-12", ["v"])
    assert answers(store) == {"a": 4, "b": 6, None: 8}
    assert store.marks()["v"].upto == at(12) and store.marks()["w"].upto == at(10)
    # a run up to an earlier time changes nothing and does not take the mark back
    store.materialize_incremental(views, "2024-01-11", ["v"])
    assert answers(store) == {"a": 4, "b": 6, None: 8} and store.marks()["v"].upto == at(12)
    # a row that comes late, but not before the mark, is seen; an older one does not win
    late = table(spark, [("d", at(12), at(13), 9), ("b", at(3), at(13), 1)])
    store.materialize_incremental({"v": (VIEW, late)}, "2024-01-21")
    assert answers(store) == {"a": 4, "b": 6, "d": 9, None: 8}
    with pytest.raises(ValueError):
        store.materialize_incremental(views, "2024-01-22", ["o"])


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "s")
    store = LatestStore(spark, root, buckets=8)
    many = table(spark, [(f"k{i}", at(1), at(1), i) for i in range(200)])
    assert store.merge(VIEW, many, at(1)) == {"entities": 200, "buckets": 8}
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/v/bucket=*/run=*/*.parquet")}
    assert store.merge(VIEW, table(spark, [("k7", at(2), at(2), 1000)]), at(2)) == {"entities": 1, "buckets": 1}
    after = glob.glob(f"{root}/v/bucket=*/run=*/*.parquet")
    assert {p: os.path.getmtime(p) for p in after if p in before} == before
    assert len({p.split("/run=")[0] for p in after if p not in before}) == 1
    assert answers(store) == {f"k{i}": i for i in range(200)} | {"k7": 1000}
    assert store.merge(VIEW, many.limit(0), at(3)) == {"entities": 0, "buckets": 0}
    assert store.marks()["v"].upto == at(3) and len(answers(store)) == 200


def test_a_crash_before_the_mark_changes_no_answer(spark, tmp_path, monkeypatch):
    store = LatestStore(spark, str(tmp_path / "s"), buckets=4)
    store.merge(VIEW, table(spark, [("a", at(1), at(1), 1), ("b", at(1), at(1), 2)]), at(1))
    more = table(spark, [("a", at(2), at(2), 3), ("c", at(2), at(2), 4)])

    def crash(self, mark):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(LatestStore, "set_mark", crash)
        with pytest.raises(RuntimeError):
            store.merge(VIEW, more, at(2))
    assert answers(store) == {"a": 1, "b": 2} and store.marks()["v"].upto == at(1)
    # a mark that was begun and not finished does not count either
    os.makedirs(f"{store.root}/marks/step=9/_temporary")
    assert answers(store) == {"a": 1, "b": 2}
    store.merge(VIEW, more, at(2))
    assert answers(store) == {"a": 3, "b": 2, "c": 4}


def test_unread_folders_are_removed(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "s"), buckets=2)
    for i in range(1, 6):
        store.merge(VIEW, table(spark, [(f"k{j}", at(i), at(i), i) for j in range(20)]), at(i))
    assert store.remove_unread(keep_steps=2) == 3 + 3 * 2
    assert set(answers(store).values()) == {5} and store.remove_unread(keep_steps=2) == 0
    assert len(glob.glob(f"{store.root}/v/bucket=*/run=*")) == 4


def test_a_run_stops_at_the_first_failure(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "s"), buckets=2)
    good = table(spark, [("a", at(1, 23), at(1), 1), ("a", at(2), at(1), 2), ("b", at(1), at(1), 3)])
    burst = good.withColumn("x", F.raise_error(F.lit("no")).cast("long"))
    view = lambda n: FeatureView(n, ("k",), 7, {"x": "long"}, "s")
    views = {"p": (view("p"), good), "q": (view("q"), burst), "r": (view("r"), good), "o": (OFFLINE, good)}
    rows = [tuple(r) for r in store.materialize_run(views, "2024-01-01", "2024-01-01").collect()]
    days = ("2024-01-01 00:00:00", "2024-01-01 23:59:59")
    assert [(r[0], r[1], r[4]) for r in rows] == [("p", 2, "success"), ("q", None, "failed"), ("r", None, "skipped")]
    assert all(r[2:4] == days for r in rows) and rows[1][5] and rows[2][5] is None
    assert answers(store, view("p")) == {"a": 1, "b": 3} and store.read(view("q")) is None
    again = store.materialize_run({**views, "q": (view("q"), good)}, "2024-01-01", "2024-01-02", ["q", "r"]).collect()
    assert [(r["feature_view"], r["entities"], r["status"]) for r in again] == [("q", 2, "success"), ("r", 2, "success")]


def test_stream_merges_into_the_store(spark, tmp_path):
    view = FeatureView("v", ("k",), 7, {"x": "long"}, "s", created_col=None)
    schema = "k string, event_timestamp timestamp, x long"
    folder, kept, mark = (str(tmp_path / n) for n in ("in", "kept", "mark"))
    store = LatestStore(spark, kept, buckets=4)

    def arrive(rows, checkpoint=mark):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = feature_stream(spark, folder, spark.createDataFrame([], schema))
        materialize_stream(stream, view, store, checkpoint).awaitTermination()
        return answers(store)

    assert arrive([("a", at(5), 1), ("b", at(1), 2)]) == {"a": 1, "b": 2}
    # An older row that comes late does not win.
    assert arrive([("a", at(4), 9), ("b", at(3), 3)]) == {"a": 1, "b": 3}
    assert store.marks()["v"].batch == 1
    with pytest.raises(ValueError, match="another checkpoint"):
        arrive([("c", at(1), 1)], str(tmp_path / "fresh"))
    assert arrive([("d", at(1), 1)]) == {"a": 1, "b": 3, "c": 1, "d": 1}


# --- rolling state ---------------------------------------------------------------------

EVENTS = (
    "event_id string, user_id string, event_timestamp timestamp, transaction_amount double, "
    "merchant_category string, is_fraud boolean"
)


def random_events(n=1500):
    rng = random.Random(6)
    out = []
    for i in range(n):
        moment = datetime(2023, 9, 1) + timedelta(days=rng.randint(0, 140), seconds=rng.choice([0, 0, 1, 43200, 86399]))
        moment += timedelta(microseconds=rng.choice([0, 0, 1, 500000, 999999]))
        out.append((
            str(i), rng.choice([None, "a", "b", "c", "d"]) if i % 50 else "rare", moment, rng.choice([None, 0.0, -1.0, 5.0, 900.0, rng.random() * 100]),
            rng.choice([None, "x", "y", "z", "w"]), rng.choice([None, True, False]),
        ))
    return out


def compared(df):
    return {
        r["user_id"]: tuple(round(v, 6) if isinstance(v, float) else v for k, v in sorted(r.asDict().items())) for r in df.collect()
    }


def test_state_gives_what_the_whole_lookback_gives(spark, tmp_path):
    events = spark.createDataFrame(random_events(), EVENTS).cache()
    came = F.col("event_timestamp") + F.when(F.col("event_id").cast("int") % 7 == 0, F.expr("INTERVAL 12 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    events = events.withColumn("came", came)
    state, before = RollingState(spark, str(tmp_path / "state")), datetime(2000, 1, 1)
    for day in ("2023-11-20", "2023-12-01", "2023-12-02", "2024-01-10"):
        upto = datetime.fromisoformat(day)
        known = events.where(F.col("came") <= upto).drop("came")
        fresh = events.where((F.col("came") <= upto) & (F.col("came") > before)).drop("came")
        got = compared(incremental_feature_table(state, fresh, known, day))
        assert got == compared(rolling.latest_feature_table(known, day)), day
        before = upto
    # a short lookback, whose opening instant closes the day before
    for days in (8, 31, 60):
        assert compared(state.latest("2024-01-10", days).drop("x")) == compared(
            rolling.rolling_latest(usable(rolling.clean_events(known, "2024-01-10", lookback_days=days)), rolling.TRANSACTION_FEATURES)
        )


def test_refreshing_days_again_changes_nothing(spark, tmp_path):
    events = usable(spark.createDataFrame(random_events(300), EVENTS))
    state = RollingState(spark, str(tmp_path / "state"))
    state.refresh(events, state.touched_days(events))
    want = compared(state.latest("2024-01-10"))
    state.refresh(events, [date(2024, 1, 2), date(2024, 1, 4)])
    assert compared(state.latest("2024-01-10")) == want
    # a day whose rows have gone leaves nothing behind
    gone = events.where(closing_day(F.col("event_timestamp")) != "2024-01-02")
    state.refresh(gone, [date(2024, 1, 2)])
    assert compared(state.latest("2024-01-10")) == compared(
        rolling.rolling_latest(rolling.clean_events(gone, "2024-01-10"), rolling.TRANSACTION_FEATURES)
    )


def test_a_run_reads_new_days_and_no_others(spark, tmp_path):
    events = spark.createDataFrame(random_events(), EVENTS)
    state = RollingState(spark, str(tmp_path / "state"))
    state.refresh(usable(events), state.touched_days(events))
    seconds = str(tmp_path / "state" / "seconds")
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{seconds}/day=*/*.parquet")}
    state.refresh(usable(events), [date(2024, 1, 5)])
    changed = [p for p in glob.glob(f"{seconds}/day=*/*.parquet") if before.get(p) != os.path.getmtime(p)]
    assert changed and all("day=2024-01-05" in p for p in changed)
    plan = state.latest("2024-01-10")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert scans and all("PartitionFilters: []" not in x for x in scans)


# --- jobs and gate ---------------------------------------------------------------------


def read(spark, root, day):
    return sorted((r["user_id"], r["x"]) for r in io.read_partition(spark, root, day).collect())


def test_gate_keeps_what_was_published(spark, tmp_path):
    root = str(tmp_path / "features")
    checks = partial(validation.check_statuses, required=["user_id", "x"], columns=["x"], ranges={"x": (0, 10)})
    rows = lambda *xs: spark.createDataFrame([(f"u{i}", x) for i, x in enumerate(xs)], "user_id string, x double")
    good = publish.gated_publish(rows(1.0, 2.0), root, "2024-01-01", "user_id", checks, files=2).collect()
    assert {(r["check"], r["status"]) for r in good} == {("schema", "pass"), ("null_rates", "pass"), ("ranges", "pass")}
    assert all(r["published"] and r["staged_rows"] == 2 and r["date"] == date(2024, 1, 1) for r in good)
    publish.gated_publish(rows(3.0), root, "2024-01-02", "user_id", checks, files=2)
    for bad in (rows(11.0), rows(None, 1.0), rows(1.0).drop("x"), rows().limit(0)):
        found = publish.gated_publish(bad, root, "2024-01-01", "user_id", checks, files=2).collect()
        assert not any(r["published"] for r in found) and any(r["status"] == "fail" for r in found)
        assert read(spark, root, "2024-01-01") == [("u0", 1.0), ("u1", 2.0)] and read(spark, root, "2024-01-02") == [("u0", 3.0)]
    drifted = lambda df: checks(df, drift=spark.createDataFrame([(True,)], "drifted boolean"))
    assert all(r["published"] for r in publish.gated_publish(rows(4.0), root, "2024-01-01", "user_id", drifted).collect())
    assert read(spark, root, "2024-01-01") == [("u0", 4.0)]


def test_job_days():
    assert jobs.reference_day("2024-03-01") == "2024-01-31"
    assert jobs.materialised_days("2024-03-01") == ("2024-02-29", "2024-03-01")


def test_jobs_from_paths(spark, tmp_path):
    events, features, reports = (str(tmp_path / n) for n in ("events", "features", "reports"))
    raw = spark.createDataFrame(random_events(), EVENTS).withColumns({"transaction_type": F.lit("T"), "country_code": F.lit("C")})
    raw.write.parquet(events)
    for day in ("2023-12-11", "2024-01-10"):
        found = jobs.feature_job(spark, events, features, day, files=2)
        assert compared(found.drop("date")) == compared(rolling.latest_feature_table(raw, day))
    report = jobs.validation_job(spark, features, "2024-01-10", reports).first()
    assert '"reference_date" : "2023-12-11"' in report["report"] and report["overall_status"] in ("pass", "fail")
    assert glob.glob(f"{reports}/validation_2024-01-10.json/*.txt")
    before = compared(io.read_partition(spark, features, "2024-01-10"))
    jobs.feature_job(spark, events, features, "2024-01-10", gated=True, checks=partial(validation.check_statuses, ranges={"tx_count_7d": (-2, -1)}))
    assert compared(io.read_partition(spark, features, "2024-01-10")) == before
