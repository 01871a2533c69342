"""Rolling features against a brute-force count on edge frames and a skewed key."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest

from tidemark.operators import rolling
from tidemark.operators.rolling import TRANSACTION_FEATURES
from tidemark.sources.schemas import RAW_EVENTS

BASE = datetime(2024, 3, 1, 12, 0, 0)


def event(i, user, at, amount=1.0, merchant="a", fraud=False):
    return (str(i), user, at, amount, "PURCHASE", merchant, "C0", fraud)


def brute(rows):
    """Feature values per event id."""
    out = {}
    for r in rows:
        sec = int(r[2].timestamp() // 1)

        def frame(days, user=r[1], sec=sec):
            return [
                x for x in rows
                if x[1] == user and sec - days * 86_400 <= int(x[2].timestamp() // 1) <= sec
            ]

        values = {}
        for f in TRANSACTION_FEATURES:
            inside = frame(f.days)
            column = {
                "event_id": [x[0] for x in inside],
                "transaction_amount": [x[3] for x in inside if x[3] is not None],
                "fraud_hit": [1 if x[7] else 0 for x in inside],
                "merchant_category": [x[5] for x in inside if x[5] is not None],
            }[f.value]
            n = len(column)
            if f.agg == "count":
                v = n
            elif f.agg == "nunique":
                v = len(set(column))
            elif f.agg == "sum":
                v = sum(column) if n else None
            elif f.agg == "mean":
                v = sum(column) / n if n else None
            elif f.agg == "max":
                v = max(column) if n else None
            else:
                m = sum(column) / n if n else 0
                v = math.sqrt(sum((x - m) ** 2 for x in column) / (n - 1)) if n > 1 else None
            values[f.name] = v
        out[r[0]] = values
    return out


def same(got, wanted):
    for name, v in wanted.items():
        g = got[name]
        if v is None or g is None:
            assert g is None and v is None, (name, g, v)
        else:
            assert g == pytest.approx(v, rel=1e-9, abs=1e-6), (name, g, v)


EDGES = [
    event(1, "tie", BASE, 10.0, "a"),
    event(2, "tie", BASE + timedelta(milliseconds=900), 20.0, "b", True),
    event(3, "edge", BASE, 5.0, "a"),
    event(4, "edge", BASE + timedelta(days=7), 7.0, "b"),
    event(5, "edge", BASE + timedelta(days=7, seconds=1), 9.0, "a"),
    event(6, "edge", BASE + timedelta(days=30), 1.0, "c"),
    event(7, "edge", BASE + timedelta(days=30, seconds=1), 1.5, "a"),
    event(8, "edge", BASE + timedelta(days=90), 2.5, None, None),
    event(9, "single", BASE, 3.0),
    event(10, "nulls", BASE, None, None, None),
    event(11, "nulls", BASE + timedelta(hours=2), None, "z", True),
    event(12, "nulls", BASE + timedelta(hours=3), 4.0, "z", False),
    event(13, "late", BASE - timedelta(days=89, hours=23, minutes=59), 600.0, "q"),
    event(14, "late", BASE + timedelta(seconds=30), 700.0, "q"),
]


def skewed(n=900):
    """A third of the rows under one key, many of them in one hour."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(60)}"
        spread = 3_600 if user == "hot" and rng.random() < 0.5 else 100 * 86_400
        at = BASE + timedelta(seconds=rng.randrange(spread), milliseconds=rng.randrange(1000))
        rows.append(event(1000 + i, user, at, round(1e6 + rng.random(), 2), f"m{rng.randrange(9)}", rng.random() < 0.1))
    return rows


FORMS = {
    "windows": rolling.rolling_windows,
    "split by hour": rolling.rolling_split,
    "split by day": lambda d, f: rolling.rolling_split(d, f, bucket_seconds=86_400),
    "mixed": lambda d, f: rolling.rolling_features(d, f, dense_rows=40),
    "all split": lambda d, f: rolling.rolling_features(d, f, dense_rows=2, most_broadcast=0),
    "auto": rolling.rolling_features,
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("rows", [EDGES, skewed()], ids=["edges", "skewed"])
def test_forms_match_brute_force(spark, form, rows):
    df = rolling.with_fraud_hit(spark.createDataFrame(rows, RAW_EVENTS))
    got = {r["event_id"]: r for r in FORMS[form](df, TRANSACTION_FEATURES).collect()}
    wanted = brute(rows)
    assert got.keys() == wanted.keys()
    for i, values in wanted.items():
        same(got[i], values)


@pytest.mark.parametrize("rows", [EDGES, skewed()], ids=["edges", "skewed"])
def test_latest_matches_brute_force(spark, rows):
    df = rolling.with_fraud_hit(spark.createDataFrame(rows, RAW_EVENTS))
    got = {r["user_id"]: r for r in rolling.rolling_latest(df, TRANSACTION_FEATURES).collect()}
    wanted = brute(rows)
    newest = {}
    for r in rows:
        if r[1] not in newest or r[2] > newest[r[1]][2]:
            newest[r[1]] = r
    assert got.keys() == newest.keys()
    for user, r in newest.items():
        assert got[user]["event_timestamp"] == r[2]
        same(got[user], wanted[r[0]])


def test_null_keys_are_one_group(spark):
    rows = [(str(i), None, BASE + timedelta(days=i), 1.0 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_timestamp timestamp, transaction_amount double")
    features = [rolling.Rolling("n", "count", "event_id", 3), rolling.Rolling("s", "sum", "transaction_amount", 3)]
    plain = rolling.rolling_windows(df, features).select("event_id", "n", "s").collect()
    split = rolling.rolling_split(df, features).select("event_id", "n", "s").collect()
    assert sorted(plain) == sorted(split)


def test_ratios_and_flag(spark):
    df = spark.createDataFrame(
        [(0, 0, 0.0, 0.0, 500.0), (1, 2, 5.0, 20.0, 500.1), (1, 1, 5.0, None, None)],
        "tx_count_7d long, tx_count_30d long, tx_amount_sum_7d double, tx_amount_sum_30d double, tx_amount_mean_90d double",
    )
    got = [tuple(r)[5:] for r in rolling.with_ratios(df).collect()]
    assert got == [(None, None, False), (0.25, 0.5, True), (None, 1.0, None)]


def test_clean_events_bounds(spark):
    day = datetime(2024, 6, 30)
    rows = [
        event(1, "u", day), event(2, "u", day + timedelta(microseconds=1)),
        event(3, "u", day - timedelta(days=95)), event(4, "u", day - timedelta(days=95, microseconds=1)),
        event(5, "u", day, 0.0), event(6, "u", day, None), event(7, "u", day, -1.0),
    ]
    nullable = "event_id string, user_id string, event_timestamp timestamp, transaction_amount double"
    df = spark.createDataFrame([r[:4] for r in rows] + [("8", None, day, 1.0)], nullable)
    kept = {r["event_id"] for r in rolling.clean_events(df, "2024-06-30").collect()}
    assert kept == {"1", "3"}


def test_as_of_uses_run_date(spark):
    rows = [event(1, "u", BASE), event(2, "gone", BASE - timedelta(days=200))]
    df = rolling.with_fraud_hit(spark.createDataFrame(rows, RAW_EVENTS))
    got = rolling.rolling_as_of(df, TRANSACTION_FEATURES, "2024-03-20").collect()
    assert [(r["user_id"], r["tx_count_7d"], r["tx_count_30d"]) for r in got] == [("u", 0, 1)]


def test_three_frames_share_one_shuffle(spark):
    df = rolling.with_fraud_hit(spark.createDataFrame(EDGES, RAW_EVENTS))
    plan = rolling.rolling_windows(df, TRANSACTION_FEATURES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort") == 1
    assert plan.count("Window [") == 1


def test_split_never_shuffles_raw_rows_by_key_alone(spark):
    df = rolling.with_fraud_hit(spark.createDataFrame(EDGES, RAW_EVENTS))
    plan = rolling.rolling_split(df, TRANSACTION_FEATURES)._jdf.queryExecution().executedPlan().toString()
    by_key = [x for x in plan.splitlines() if re.search(r"hashpartitioning\(\w+#\d+, 8\)", x)]
    # Only the bucket totals are gathered by key.
    assert len(by_key) == 1 and not re.search(r"hashpartitioning\(user_id#\d+, 8\)", by_key[0])


def test_split_merges_each_bucket_once_and_drops_what_no_row_meets(spark):
    random.seed(8)
    rows = []
    for i in range(160):  # over four frames of 90 days, some seconds and hours shared
        at = BASE + timedelta(days=random.choice([0, 6, 7, 8, 29, 30, 31, 89, 90, 91, 180, 360]), seconds=random.choice([0, 1, 3599, 3600, 7000]))
        rows.append(event(i, random.choice("uvw"), at, random.choice([0.5, 3.0, 70.0, None]), random.choice("abc"), i % 5 == 0))
    df = rolling.with_fraud_hit(spark.createDataFrame(rows, RAW_EVENTS))
    split = rolling.rolling_split(df, TRANSACTION_FEATURES)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    # the frames of 7, 30 and 90 days of hours share no bucket
    frames = set(re.findall(r"specifiedwindowframe\(RangeFrame, (-\d+), (-\d+)\)", plan))
    assert frames == {("-167", "-1"), ("-719", "-168"), ("-2159", "-720")}
    # moved rows and steps without a row in their bucket are in no aggregate but the one that tells
    assert re.search(r"Filter .*_met#", plan) and re.search(r"Filter .*held#", plan)
    want = brute(rows)
    for r in split.collect():
        for f in TRANSACTION_FEATURES:
            v = want[r["event_id"]][f.name]
            assert r[f.name] == v if v is None or r[f.name] is None else math.isclose(r[f.name], v, rel_tol=1e-9, abs_tol=1e-9)


def _answers(df, features):
    return sorted((r["event_id"], *[r[f.name] for f in features]) for r in df.collect())


def test_forms_agree_on_null_times_and_two_distinct_counts(spark):
    features = [
        rolling.Rolling("n", "count", "event_id", 7),
        rolling.Rolling("s", "sum", "transaction_amount", 7),
        rolling.Rolling("d", "nunique", "merchant_category", 7),
        rolling.Rolling("e", "nunique", "country_code", 30),
    ]
    random.seed(3)
    rows = []
    for i in range(300):
        at = None if random.random() < 0.1 else BASE + timedelta(hours=random.randrange(900))
        user = random.choice(["hot"] * 6 + ["u", None])
        rows.append((str(i), user, at, float(random.randrange(5)), "P", random.choice(["a", "b", "c", None]), random.choice("xyz"), False))
    schema = (
        "event_id string, user_id string, event_timestamp timestamp, transaction_amount double, "
        "transaction_type string, merchant_category string, country_code string, is_fraud boolean"
    )
    df = spark.createDataFrame(rows, schema)
    want = _answers(rolling.rolling_windows(df, features), features)
    assert _answers(rolling.rolling_split(df, features), features) == want
    assert _answers(rolling.rolling_features(df, features, dense_rows=50), features) == want
    # the newest row of a key has the answers of the latest table
    newest = {}
    for r in rolling.rolling_windows(df.where("event_timestamp is not null"), features).collect():
        k = newest.get(r["user_id"])
        if k is None or r["event_timestamp"] > k["event_timestamp"]:
            newest[r["user_id"]] = r
    got = {r["user_id"]: r for r in rolling.rolling_latest(df, features).collect()}
    assert {k: [r[f.name] for f in features] for k, r in got.items()} == {
        k: [r[f.name] for f in features] for k, r in newest.items()
    }


def test_spend_rate_uses_resolved_labels_only(spark):
    tx = spark.createDataFrame(
        [("t1", "c", BASE, 1.0, "m", True), ("t2", "c", BASE + timedelta(days=1), 1.0, "m", None)],
        "transaction_id string, customer_id string, event_timestamp timestamp, amount double, merchant_id string, is_international boolean",
    )
    labels = spark.createDataFrame([("t1", True)], "transaction_id string, is_fraud boolean")
    rows = rolling.labelled_transactions(tx, labels)
    got = {
        r["transaction_id"]: r
        for r in rolling.rolling_features(rows, rolling.SPEND_FEATURES, key="customer_id").collect()
    }
    assert got["t2"]["fraud_rate_90d"] == 1.0 and got["t2"]["fraud_count_90d"] == 1
    assert got["t2"]["international_txn_ratio_30d"] == 1.0
    assert got["t1"]["std_spend_30d"] is None
