"""Quality suites, monitoring tables, files, streaming and training helpers."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import expectations as ex
from tidemark.operators import monitor, train, validation
from tidemark.operators.rolling import clean_events
from tidemark.plans.registry import scratch
from tidemark.sources import io
from tidemark.sources.schemas import RAW_EVENTS, FeatureView, Source

AT = datetime(2024, 5, 1, 6)


def results(df):
    return {(r["check"], r["column"]): r for r in df.collect()}


TX = "transaction_id string, customer_id string, amount double, event_timestamp timestamp, transaction_type string"


def test_transaction_suite(spark):
    good = [(str(i), "c", 10.0, AT, "PURCHASE") for i in range(3)]
    rows = ex.check_transactions(spark.createDataFrame(good, TX))
    assert rows.count() == 12 and ex.suite_summary(rows).first()["success_percent"] == 100.0
    bad = [*good, ("0", None, 0.0, AT, "GIFT"), ("9", "c", None, AT, None)]
    found = results(ex.check_transactions(spark.createDataFrame(bad, TX), now="2024-04-30 00:00:00"))
    assert found["unique", "transaction_id"]["unexpected"] == 2
    assert found["not_null", "customer_id"]["unexpected"] == 1
    assert found["between", "amount"]["unexpected"] == 1 and found["between", "amount"]["evaluated"] == 4
    assert not found["not_null", "amount"]["success"]
    assert found["in_set", "transaction_type"]["unexpected"] == 1
    assert not found["not_in_future", "event_timestamp"]["success"]


def test_missing_columns_fail(spark):
    found = results(ex.check_transactions(spark.createDataFrame([("1",)], "transaction_id string")))
    assert not found["column_exists", "amount"]["success"]
    assert not found["between", "amount"]["success"]
    assert found["column_exists", "transaction_id"]["success"]


def test_credit_suite_size(spark):
    assert len(ex.credit_suite()) == 18


def test_feature_output_suite(spark):
    none = ex.check_feature_output(spark.createDataFrame([(1,)], "z int"))
    assert none.count() == 0
    assert ex.suite_summary(none, by=[]).first()["success_percent"] == 100.0
    rows = [("RETAIL",)] * 99 + [("ODD",)]
    assert ex.check_feature_output(spark.createDataFrame(rows, "customer_segment string")).first()["success"]
    rows += [("ODD",)]
    assert not ex.check_feature_output(spark.createDataFrame(rows, "customer_segment string")).first()["success"]


def test_training_suite(spark):
    rows = [(str(i), AT, None if i < 50 else 1.0, True) for i in range(1000)]
    schema = "customer_id string, event_timestamp timestamp, avg_spend_7d double, is_fraud boolean"
    assert all(r["success"] for r in ex.check_training_set(spark.createDataFrame(rows, schema)).collect())
    worse = [*rows[:-1], rows[0]]
    found = results(ex.check_training_set(spark.createDataFrame(worse, schema)))
    assert not found["rows_distinct", ""]["success"] and not found["not_null", "avg_spend_7d"]["success"]
    small = results(ex.check_training_set(spark.createDataFrame(rows[:999], schema)))
    assert not small["rows_at_least", ""]["success"]


def test_summary_percent(spark):
    df = spark.createDataFrame([("s", i < 7) for i in range(10)], "suite string, success boolean")
    row = ex.suite_summary(df).first()
    assert (row["success_percent"], row["failed_checks"], row["success"]) == (70.0, 3, False)


def test_status_rules(spark):
    cases = [
        ("m1", False, 100.0, 0.0, "HEALTHY"), ("m2", True, 100.0, 0.0, "CRITICAL"),
        ("m3", False, 79.9, 0.0, "CRITICAL"), ("m4", False, 80.0, 0.0, "DEGRADED"),
        ("m5", False, 94.9, 0.1, "DEGRADED"), ("m6", False, 95.0, 0.1, "HEALTHY"),
        ("m7", False, 100.0, 0.11, "DEGRADED"),
    ]
    df = spark.createDataFrame(cases, "m string, r boolean, p double, d double, want string")
    status = monitor.health_status(F.col("r"), F.col("p"), F.col("d"))
    assert df.where(status != F.col("want")).count() == 0


DRIFT_LOG = "model_name string, version string, checked_at timestamp, drift_ratio double, drifted_names array<string>, recommend_retrain boolean"
QUALITY_LOG = "model_name string, version string, checked_at timestamp, success_percent double, suite string"
PERFORMANCE_LOG = "model_name string, version string, checked_at timestamp, auc_roc double, precision double, recall double, f1 double"


def test_health_and_platform(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    health = monitor.model_health(
        spark.createDataFrame([("a", "v1", early, 0.5, ["x"], True), ("a", "unknown", late, 0.0, [], False)], DRIFT_LOG),
        spark.createDataFrame([("b", "v2", early, 70.0, "s")], QUALITY_LOG),
        spark.createDataFrame([("c", "v3", early, 0.9, 0.5, None, None), ("c", "unknown", late, None, 0.6, None, None)], PERFORMANCE_LOG),
    )
    rows = {r["model_name"]: r for r in health.collect()}
    assert rows["a"]["health_status"] == "HEALTHY" and rows["a"]["model_version"] == "v1"
    assert rows["b"]["health_status"] == "CRITICAL" and rows["b"]["drift_ratio"] == 0.0
    assert (rows["c"]["auc_roc"], rows["c"]["precision"], rows["c"]["recall"]) == (0.9, 0.6, None)
    assert rows["c"]["pass_rate"] == 100.0
    platform = monitor.platform_health(health).first()
    assert tuple(platform) == ("CRITICAL", 3, 2, 0, 1)
    assert monitor.platform_health(health.limit(0)).first()["platform_status"] == "HEALTHY"
    lines = [r["line"] for r in monitor.health_metrics(health).collect()]
    assert 'model_health_status{model="b",status="CRITICAL"} 1' in lines
    assert 'model_auc_roc{model="c"} 0.900000' in lines and len(lines) == 3 * 5 + 1
    assert [r[0] for r in monitor.critical_models(health).select("model_name").collect()] == ["b"]


def test_alert_names_are_shortened(spark):
    names = [f"f{i:02d}" for i in range(12)]
    df = spark.createDataFrame([(names,), (names[:10],), ([],)], "n array<string>")
    got = [r[0] for r in df.select(monitor.shortened_names(F.col("n"))).collect()]
    assert got == [", ".join(names[:10]) + " ...", ", ".join(names[:10]), ""]


def test_quality_alert_severity(spark):
    df = spark.createDataFrame(
        [("s", 10, 7, 3, 70.0, False), ("t", 10, 8, 2, 80.0, False), ("u", 1, 1, 0, 100.0, True)],
        "suite string, evaluated_checks long, successful_checks long, failed_checks long, success_percent double, success boolean",
    ).withColumn("checked_at", F.lit(AT))
    alerts = {r["title"][-1]: r for r in monitor.quality_alerts(df, "p").collect()}
    assert {k: r["severity"] for k, r in alerts.items()} == {"s": "critical", "t": "warning"}
    assert "success_percent: 70.0000\nevaluated_expectations: 10\n" in alerts["s"]["message"]
    assert alerts["s"]["metadata"]["failed_expectations"] == "3"


ALERTS = "title string, message string, severity string, source string, model_name string, timestamp timestamp"


def test_routing_and_dedup(spark):
    df = spark.createDataFrame(
        [("t1", "m", "info", "s", "a", AT), ("t2", "m", "warning", "s", "a", AT), ("t3", "m", "critical", "s", None, AT)], ALERTS
    )
    routed = sorted((r["title"], r["channel"]) for r in monitor.route_alerts(df).collect())
    assert routed == [("t2", "email"), ("t2", "slack"), ("t3", "email"), ("t3", "pagerduty"), ("t3", "slack")]
    assert monitor.route_alerts(df, []).count() == 0
    kept = {r["dedup_key"]: r["title"] for r in monitor.deduplicate_alerts(df).collect()}
    assert kept == {"s-a-2024-05-01": "t1", "s-None-2024-05-01": "t3"}


def test_branch_outcomes(spark):
    reports = [
        ("fail", '{"checks":{"drift":{"status":"fail","drifted_columns":["a"]}}}'),
        ("columns", '{"checks":{"drift":{"status":"pass","drifted_columns":["a"]}}}'),
        ("pass", '{"checks":{"drift":{"status":"pass","drifted_columns":[]}}}'),
        ("no drift part", '{"checks":{}}'), ("garbage", "{oops"), ("none", None),
    ]
    df = io.drift_of_report(spark.createDataFrame(reports, "k string, report string"), "report")
    got = {r["k"]: r["decision"] for r in monitor.retrain_decision(df).collect()}
    assert {k for k, d in got.items() if d == "trigger_retraining"} == {"fail", "columns"}


def test_promotion(spark):
    df = spark.createDataFrame([(0.82,), (0.8199,), (None,)], "auc double")
    got = [tuple(r) for r in monitor.promotion_gate(df).collect()]
    assert got[0] == (0.82, "promote", None)
    assert got[1] == (0.8199, "reject", "AUC 0.8199 < threshold 0.82") and got[2][1] == "reject"


def test_partitions_are_replaced_and_pruned(spark, tmp_path):
    root = str(tmp_path / "features")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "user_id string, x int")
    io.write_partition(df, root, "2024-01-01", "user_id", files=2)
    io.write_partition(df, root, "2024-01-02", "user_id", files=2)
    io.write_partition(df.where("x = 2"), root, "2024-01-02", "user_id", files=2)
    assert io.read_partition(spark, root, "2024-01-01").count() == 2
    second = io.read_partition(spark, root, "2024-01-02")
    assert second.count() == 1
    assert "PartitionFilters: [isnotnull(date" in second._jdf.queryExecution().executedPlan().toString()


def test_event_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [("1", "u", AT, 5.0, "T", "m", "C", False)]
    spark.createDataFrame(rows, RAW_EVENTS).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = clean_events(io.read_events(spark, path), "2024-05-02").select("user_id")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(transaction_amount,0.0)" in plan and "GreaterThanOrEqual(event_timestamp" in plan
    assert "merchant_category" not in plan.split("ReadSchema")[1]


def test_source_projection(spark, tmp_path):
    path = str(tmp_path / "src")
    view = FeatureView("v", ("k",), 7, {"x": "long"}, "s")
    spark.createDataFrame([("a", AT, AT, 1, 2)], "k string, event_timestamp timestamp, created_timestamp timestamp, x long, y long").write.parquet(path)
    assert io.read_source(spark, Source("s", path), view).columns == ["k", "event_timestamp", "created_timestamp", "x"]


def test_report_round_trip(spark, tmp_path):
    columns = {"a": (0, 10)}
    df = spark.createDataFrame([(1.0, "u"), (2.0, "v")], "a double, user_id string")
    far = spark.createDataFrame([(9.0, "u"), (8.0, "v")], "a double, user_id string")
    for blocks, overall in ((True, "fail"), (False, "pass")):
        report = validation.validation_report(
            df, far, "2024-01-01", "2024-01-31", ["a"], ["a", "user_id"], columns, drift_blocks=blocks
        )
        assert report.first()["overall_status"] == overall
    path = str(tmp_path / "report")
    io.write_report(report, path)
    row = io.read_report_drift(spark, path).first()
    assert (row["drift_status"], row["drifted_columns"]) == ("fail", ["a"])


def test_spine(spark):
    rows = io.entity_spine(spark, 50, "2024-01-02").orderBy("user_id").collect()
    assert rows[0]["event_timestamp"] == datetime(2024, 1, 2) and rows[0]["user_id"] == 1
    assert rows[25]["event_timestamp"] == datetime(2024, 1, 1, 23) and len(rows) == 50


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).alias("label"))
    one = train.stratified_split(df, "label", "id").collect()
    assert sum(r["is_holdout"] for r in one if r["label"]) == 20
    assert sum(r["is_holdout"] for r in one if not r["label"]) == 180
    two = train.stratified_split(df.repartition(5), "label", "id").collect()
    assert sorted(one) == sorted(two)
    other = train.stratified_split(df, "label", "id", seed=1).collect()
    assert sorted(other) != sorted(one)


def test_ranking_scores_match_definition(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.4, 0)]
    got = train.ranking_scores(spark.createDataFrame(rows, "s double, y int"), "y", ["s"]).first()
    pairs = [(p > n) + (p == n) / 2 for p, a in rows if a for n, b in rows if not b]
    assert got["roc_auc"] == pytest.approx(sum(pairs) / len(pairs))
    points, before = 0.0, 0
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(1 for s, y in rows if s >= t and y)
        points += (tp - before) / 3 * tp / sum(1 for s, _ in rows if s >= t)
        before = tp
    assert got["average_precision"] == pytest.approx(points)


def test_filled_features(spark):
    df = spark.createDataFrame([(None, True), (2, None)], "a int, b boolean")
    assert [tuple(r) for r in train.filled_features(df, ["a", "b"]).collect()] == [(0.0, 1.0), (2.0, 0.0)]


def test_scratch_follows_the_session(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_validation_reports_a_failed_schema(spark):
    import json

    from tidemark.operators import validation

    df = spark.createDataFrame([("u", 1.0), ("v", None)], "user_id string, other double")
    statuses = {r["check"]: r["status"] for r in validation.check_statuses(df).collect()}
    assert statuses == {"schema": "fail", "null_rates": "fail", "ranges": "pass"}
    row = validation.validation_report(df, df, "2024-01-01", "2024-01-31").collect()[0]
    report = json.loads(row["report"])
    assert row["overall_status"] == "fail"
    assert "tx_count_7d" in report["checks"]["schema"]["missing_columns"]
    assert report["checks"]["schema"]["extra_columns"] == ["other"]
    assert report["checks"]["drift"]["status"] == "pass"


def test_split_holds_out_rows_without_a_label(spark):
    from tidemark.operators import train

    df = spark.range(100).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'a' END AS label")
    held = train.stratified_split(df, "label", "id").where("is_holdout").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in held} == {"a": 10, None: 10}


def test_alert_deduplication_keeps_all_columns(spark):
    from tidemark.operators import monitor

    df = spark.sql(
        "SELECT timestamp'2024-01-01 10:00:00' AS timestamp, 't' AS title, 'HIGH' AS severity, 'm' AS message, "
        "'s' AS source, 'x' AS model_name, map('a', 1) AS metadata UNION ALL "
        "SELECT timestamp'2024-01-01 09:00:00', 'u', 'LOW', 'm', 's', 'x', map('b', 2)"
    )
    rows = monitor.deduplicate_alerts(df).collect()
    assert [(r["title"], r["metadata"]) for r in rows] == [("u", {"b": 2})]
