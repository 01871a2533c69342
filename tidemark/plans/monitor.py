"""Queries: decisions, alerts, health and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import drift, expectations, monitor, validation
from tidemark.operators.validation import NUMERIC_FEATURES
from tidemark.plans import drift as drift_plans
from tidemark.plans import inputs
from tidemark.plans import quality as quality_plans
from tidemark.plans.quality import CURRENT_DAY, REFERENCE_DAY, feature_tables
from tidemark.plans.registry import fixed, query, scratch, sql_fixed, sql_stamp, stamp, table
from tidemark.sources import io
from tidemark.streaming.ledger import read_ledger, send_new

CHECKED = "1998-09-01 06:00:00"


def _at(df):
    return df.withColumn("checked_at", F.lit(CHECKED).cast("timestamp"))


# --- gates -----------------------------------------------------------------------------


@query(
    "retrain_branch",
    f"""{drift_plans.JOB_SQL}, verdict AS (SELECT bool_or(statistic > 0.05) AS drifted FROM ks)
SELECT 'written' AS report_kind, CASE WHEN drifted THEN 'trigger_retraining' ELSE 'no_retraining' END AS decision FROM verdict
UNION ALL SELECT 'missing', 'no_retraining' FROM verdict
UNION ALL SELECT 'unreadable', 'no_retraining' FROM verdict""",
)
def retrain_branch(spark, folder):
    """Branch on the drift part of a report; no or bad reports never trigger."""
    report = validation.validation_report(*feature_tables(spark, folder), REFERENCE_DAY, CURRENT_DAY)
    kinds = report.select(
        F.inline(
            F.array(
                F.struct(F.lit("written").alias("report_kind"), F.col("report").alias("report")),
                F.struct(
                    F.lit("missing").alias("report_kind"), F.lit(None).cast("string").alias("report")
                ),
                F.struct(
                    F.lit("unreadable").alias("report_kind"),
                    F.substring("report", 1, 40).alias("report"),
                ),
            )
        )
    )
    return monitor.retrain_decision(io.drift_of_report(kinds, "report")).select(
        "report_kind", "decision"
    )


@query(
    "quality_gate",
    f"""{drift_plans.JOB_SQL}, {drift_plans._STATUSES}
SELECT bool_and(status = 'pass') AS may_publish, count(*) FILTER (WHERE status <> 'pass') AS failed_groups
FROM statuses WHERE "check" <> 'drift'""",
)
def quality_gate(spark, folder):
    """Schema, nulls and ranges block publishing; drift does not."""
    return monitor.quality_gate(drift_plans.statuses(spark, folder))


def runs(spark, folder):
    """One training run per order: model, version and a score."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        F.concat(F.lit("m"), (F.col("o_custkey") % 50).cast("string")).alias("model_name"),
        key.cast("string").alias("version"),
        ((70 + key % 30) / 100.0).alias("auc"),
        F.col("o_orderdate").cast("timestamp").alias("decided_at"),
    )


SQL_RUNS = """runs AS (
  SELECT 'm' || CAST(o_custkey % 50 AS VARCHAR) AS model_name, CAST(o_orderkey AS VARCHAR) AS version,
         (70 + o_orderkey % 30) / 100.0 AS auc, o_orderdate AS decided_at FROM orders
)"""


@query(
    "promotion_gate",
    f"""WITH {SQL_RUNS} SELECT model_name, version, {sql_fixed('auc')} AS auc,
       CASE WHEN auc >= 0.82 THEN 'promote' ELSE 'reject' END AS decision,
       CASE WHEN auc < 0.82 THEN printf('AUC %.4f < threshold 0.82', auc) END AS reason FROM runs""",
)
def promotion_gate(spark, folder):
    """Promote at 0.82 or above, else reject with a reason."""
    gated = monitor.promotion_gate(runs(spark, folder))
    return gated.drop("decided_at").withColumn("auc", fixed("auc"))


# --- alerts ----------------------------------------------------------------------------

ALERT_COLUMNS = ("title", "message", "severity", "source", "model_name", "timestamp")


def alert_shown(alerts, *more):
    return alerts.select(*ALERT_COLUMNS[:-1], stamp("timestamp").alias("timestamp"), *more)


def with_metadata(alerts):
    """Alerts with their metadata as text: keys and values in the order of the keys."""
    entries = F.array_sort(F.map_entries("metadata"))
    return alert_shown(alerts, F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("metadata"))


def drifted_models(spark, folder):
    """Feature rows of two models: three order columns, sixteen features."""
    orders = drift.feature_drift(*drift_plans.order_samples(spark, folder))
    table_rows = drift.distribution_drift(*feature_tables(spark, folder), NUMERIC_FEATURES)
    return orders.select(F.lit("orders").alias("model_name"), "feature_name", "drifted").unionByName(
        table_rows.select(
            F.lit("feature_table").alias("model_name"), F.col("column").alias("feature_name"), "drifted"
        )
    )


def _renamed(sql: str, prefix: str, names) -> str:
    for n in names:
        for before, after in ((f"{n} AS (", f"{prefix}{n} AS ("), (f"FROM {n}\n", f"FROM {prefix}{n}\n"),
                              (f"FROM {n} ", f"FROM {prefix}{n} "), (f"FROM {n})", f"FROM {prefix}{n})")):
            sql = sql.replace(before, after)
    return sql


SQL_MODELS = (
    f"{drift_plans.JOB_SQL}, job AS (SELECT feature AS feature_name, statistic > 0.05 AS drifted FROM ks), "
    + _renamed(
        ", ".join(
            [
                drift_plans.sql_counts(drift_plans.ORDER_NUMBERS),
                drift_plans.SQL_KS,
            ]
        ),
        "o_",
        ("long", "vc", "cu", "ks0", "ks"),
    )
    + ", "
    + drift_plans.sql_category_counts(drift_plans.ORDER_TEXTS)
    + f""", {drift_plans.SQL_CHI2}, models AS (
  SELECT 'orders' AS model_name, feature AS feature_name, p_value < 0.05 AS drifted FROM o_ks
  UNION ALL SELECT 'orders', feature, p_value < 0.05 FROM chi
  UNION ALL SELECT 'feature_table', feature_name, drifted FROM job
), summary AS (
  SELECT model_name, count(*) AS total, count(*) FILTER (WHERE drifted) AS bad,
         avg(CAST(drifted AS INTEGER)) AS ratio, avg(CAST(drifted AS INTEGER)) >= 0.2 AS retrain,
         list_sort(coalesce(list(feature_name) FILTER (WHERE drifted), [])) AS names
  FROM models GROUP BY model_name
)"""
)


@query(
    "drift_alerts",
    f"""{SQL_MODELS} SELECT 'drift_detector: ' || model_name AS title,
       'dataset_drift_ratio: ' || CAST(CAST(round(ratio, 4) AS DECIMAL(10,4)) AS VARCHAR) || chr(10) || 'total_features: ' || total || chr(10)
         || 'drifted_features: ' || array_to_string(names[1:10], ', ') || CASE WHEN len(names) > 10 THEN ' ...' ELSE '' END || chr(10)
         || 'recommend_retrain: ' || CAST(retrain AS VARCHAR) AS message,
       CASE WHEN retrain THEN 'critical' ELSE 'warning' END AS severity, 'drift_detector' AS source, model_name,
       '{CHECKED}.000000' AS timestamp, 'dataset_drift_ratio=' || CAST(CAST(round(ratio, 4) AS DECIMAL(10,4)) AS VARCHAR)
         || ';drifted_features=' || array_to_string(names[1:10], ', ') || CASE WHEN len(names) > 10 THEN ' ...' ELSE '' END
         || ';recommend_retrain=' || CAST(retrain AS VARCHAR) || ';total_features=' || total AS metadata FROM summary""",
)
def drift_alerts(spark, folder):
    """Alerts from real drift results, the first ten names listed."""
    summary = drift.dataset_drift(drifted_models(spark, folder), by=["model_name"])
    return with_metadata(monitor.drift_alerts(_at(summary)))


@query(
    "quality_alerts",
    f"""WITH {quality_plans.SQL_SUITE_EVENTS}, {inputs.CREDIT_ROWS},
summary AS ({quality_plans._sql_summary(quality_plans.SQL_SUITES)})
SELECT 'data_quality: ' || suite AS title,
       'suite_name: ' || suite || chr(10) || 'success_percent: ' || CAST(CAST(round(success_percent, 4) AS DECIMAL(10,4)) AS VARCHAR) || chr(10)
         || 'evaluated_expectations: ' || evaluated_checks || chr(10) || 'failed_expectations: ' || failed_checks || chr(10)
         || 'pipeline: feature_pipeline' AS message,
       CASE WHEN success_percent < 80 THEN 'critical' ELSE 'warning' END AS severity, 'data_quality' AS source,
       CAST(NULL AS VARCHAR) AS model_name, '{CHECKED}.000000' AS timestamp,
       'evaluated_expectations=' || evaluated_checks || ';failed_expectations=' || failed_checks || ';pipeline=feature_pipeline;success_percent='
         || CAST(CAST(round(success_percent, 4) AS DECIMAL(10,4)) AS VARCHAR) || ';suite_name=' || suite AS metadata
FROM summary WHERE NOT success""",
)
def quality_alerts(spark, folder):
    """Alerts of the failed suites."""
    summary = expectations.suite_summary(quality_plans.two_suites(spark, folder))
    return with_metadata(monitor.quality_alerts(_at(summary), "feature_pipeline"))


SQL_PROMOTED = f"""WITH {SQL_RUNS}, alerts AS (
  SELECT 'model_registry: ' || model_name AS title, 'version: ' || version || chr(10) || 'stage: Production' AS message,
         'info' AS severity, 'model_registry' AS source, model_name, decided_at AS timestamp,
         'stage=Production;version=' || version AS metadata
  FROM runs WHERE auc >= 0.82
  UNION ALL
  SELECT 'training_pipeline: ' || model_name, 'reason: ' || printf('AUC %.4f < threshold 0.82', auc),
         'warning', 'training_pipeline', model_name, decided_at, 'reason=' || printf('AUC %.4f < threshold 0.82', auc)
  FROM runs WHERE auc < 0.82
)"""


def lifecycle(spark, folder):
    """Promotions, and a retraining for each rejected run."""
    gated = monitor.promotion_gate(runs(spark, folder))
    retrained = gated.withColumn(
        "decision", F.when(F.col("decision") == "reject", "trigger_retraining")
    )
    return monitor.promotion_alerts(gated).unionByName(monitor.retrain_alerts(retrained))


@query(
    "lifecycle_alerts",
    f"{SQL_PROMOTED} SELECT title, message, severity, source, model_name, {sql_stamp('timestamp')} AS timestamp, metadata FROM alerts",
)
def lifecycle_alerts(spark, folder):
    return with_metadata(lifecycle(spark, folder))


def drift_log(spark, folder):
    """One drift check per order."""
    key = F.col("o_orderkey")
    ratio = (key * 37 % 100) / 400.0
    return table(spark, folder, "orders").select(
        F.concat(F.lit("m"), (F.col("o_custkey") % 500).cast("string")).alias("model_name"),
        F.when(key % 5 == 0, "unknown").otherwise(F.concat(F.lit("v"), (key % 3).cast("string"))).alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("checked_at"),
        ratio.alias("drift_ratio"),
        F.array(F.concat(F.lit("f"), (key % 7).cast("string")), F.lit("g")).alias("drifted_names"),
        (ratio >= 0.2).alias("recommend_retrain"),
    )


SQL_DRIFT_LOG = """drift_log AS (
  SELECT 'm' || CAST(o_custkey % 500 AS VARCHAR) AS model_name,
         CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE 'v' || CAST(o_orderkey % 3 AS VARCHAR) END AS version,
         o_orderdate AS checked_at, (o_orderkey * 37 % 100) / 400.0 AS drift_ratio,
         'f' || CAST(o_orderkey % 7 AS VARCHAR) || ',g' AS drifted_names,
         (o_orderkey * 37 % 100) / 400.0 >= 0.2 AS recommend_retrain
  FROM orders
)"""


def alert_log(spark, folder):
    """One alert per drift check of the log."""
    ratio = F.col("drift_ratio")
    return drift_log(spark, folder).select(
        F.concat(F.lit("drift_detector: "), F.col("model_name")).alias("title"),
        F.concat(F.lit("names "), F.array_join("drifted_names", ",")).alias("message"),
        F.when(ratio >= 0.2, "critical").when(ratio >= 0.1, "warning").otherwise("info").alias("severity"),
        F.lit("drift_detector").alias("source"),
        F.when(F.col("version") != "unknown", F.col("model_name")).alias("model_name"),
        F.col("checked_at").alias("timestamp"),
    )


SQL_ALERT_LOG = f"""{SQL_DRIFT_LOG}, alert_log AS (
  SELECT 'drift_detector: ' || model_name AS title, 'names ' || drifted_names AS message,
         CASE WHEN drift_ratio >= 0.2 THEN 'critical' WHEN drift_ratio >= 0.1 THEN 'warning' ELSE 'info' END AS severity,
         'drift_detector' AS source, CASE WHEN version <> 'unknown' THEN model_name END AS model_name,
         checked_at AS timestamp FROM drift_log
)"""


@query(
    "alert_routing",
    f"""WITH {SQL_ALERT_LOG}, channels(channel, level) AS (VALUES ('slack', 1), ('email', 1), ('pagerduty', 2))
SELECT title, message, severity, source, model_name, {sql_stamp('timestamp')} AS timestamp, channel
FROM alert_log JOIN channels
  ON CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END >= level""",
)
def alert_routing(spark, folder):
    """One row per alert and channel by severity."""
    return alert_shown(monitor.route_alerts(alert_log(spark, folder)), "channel")


@query(
    "alert_routing_slack_only",
    f"""WITH {SQL_ALERT_LOG} SELECT title, message, severity, source, model_name,
       {sql_stamp('timestamp')} AS timestamp, 'slack' AS channel FROM alert_log WHERE severity <> 'info'""",
)
def alert_routing_slack_only(spark, folder):
    return alert_shown(monitor.route_alerts(alert_log(spark, folder), ["slack"]), "channel")


@query(
    "alert_deduplication",
    f"""WITH {SQL_ALERT_LOG} SELECT dedup_key, title, message, severity, source, model_name,
       {sql_stamp('timestamp')} AS timestamp FROM (
  SELECT *, source || '-' || coalesce(model_name, 'None') || '-' || CAST(CAST(timestamp AS DATE) AS VARCHAR) AS dedup_key
  FROM alert_log
) QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY timestamp, title, severity, message) = 1""",
)
def alert_deduplication(spark, folder):
    """One alert per source, model and day."""
    return alert_shown(monitor.deduplicate_alerts(alert_log(spark, folder)), "dedup_key")


LEDGER_DAYS = ("1998-06-01", "1998-06-20", "1998-07-05")


@query(
    "alert_ledger",
    f"""WITH {SQL_ALERT_LOG}, sent AS (
  SELECT DISTINCT source || '-' || coalesce(model_name, 'None') || '-' || CAST(CAST(timestamp AS DATE) AS VARCHAR) AS dedup_key,
         CAST(timestamp AS DATE) AS day
  FROM alert_log WHERE timestamp >= TIMESTAMP '{LEDGER_DAYS[0]}' AND timestamp < TIMESTAMP '{LEDGER_DAYS[2]}'
)
SELECT CAST(CASE WHEN day < DATE '{LEDGER_DAYS[1]}' THEN 1 ELSE 2 END AS INTEGER) AS run, CAST(day AS VARCHAR) AS day, dedup_key FROM sent""",
)
def alert_ledger(spark, folder):
    """Two runs into the ledger; the second brings the last days of the first again, and later ones:
    only what no run has sent before is sent."""
    alerts = alert_log(spark, folder).withColumn("metadata", F.create_map(F.lit("names"), F.col("message")))
    ledger = scratch(spark, "ledger")
    first, again, last = (F.lit(f"{d} 00:00:00").cast("timestamp") for d in LEDGER_DAYS)
    at, back = F.col("timestamp"), F.expr("INTERVAL 3 DAYS")
    send_new(alerts.where((at >= first) & (at < again)), ledger, run=1)
    send_new(alerts.where((at >= again - back) & (at < last)), ledger, run=2)
    return read_ledger(spark, ledger).select("run", F.col("day").cast("string").alias("day"), "dedup_key")


# --- health ----------------------------------------------------------------------------


def quality_log(spark, folder):
    """One quality check per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("model_name"),
        F.lit("unknown").alias("version"),
        F.col("ts").cast("timestamp").alias("checked_at"),
        (100.0 - k * 0.25).alias("success_percent"),
        F.col("event_type").alias("suite"),
    )


def performance_log(spark, folder):
    """One evaluation per line item; each metric is missing in some of them."""
    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("m"), F.col("l_suppkey").cast("string")).alias("model_name"),
        F.concat(F.lit("w"), line.cast("string")).alias("version"),
        F.col("l_shipdate").cast("timestamp").alias("checked_at"),
        F.when(line % 2 == 0, F.col("l_discount") * 8).alias("auc_roc"),
        F.when(line % 3 == 0, F.col("l_tax") * 5).alias("precision"),
        F.when(line % 5 == 0, F.col("l_quantity") / 60).alias("recall"),
        F.lit(None).cast("double").alias("f1"),
    )


SQL_HEALTH = f"""WITH {SQL_DRIFT_LOG}, quality_log AS (
  SELECT 'm' || CAST(user_id AS VARCHAR) AS model_name, ts AS checked_at,
         100.0 - CAST(json_extract_string(props, '$.k') AS INTEGER) * 0.25 AS success_percent, event_type AS suite
  FROM events
), performance_log AS (
  SELECT 'm' || CAST(l_suppkey AS VARCHAR) AS model_name, 'w' || CAST(l_linenumber AS VARCHAR) AS version,
         l_shipdate AS checked_at,
         CASE WHEN l_linenumber % 2 = 0 THEN l_discount * 8 END AS auc_roc,
         CASE WHEN l_linenumber % 3 = 0 THEN l_tax * 5 END AS precision,
         CASE WHEN l_linenumber % 5 = 0 THEN l_quantity / 60 END AS recall
  FROM lineitem
), d AS (
  SELECT * FROM drift_log QUALIFY row_number() OVER (
    PARTITION BY model_name ORDER BY checked_at DESC, drift_ratio DESC, drifted_names DESC) = 1
), q AS (
  SELECT * FROM quality_log QUALIFY row_number() OVER (
    PARTITION BY model_name ORDER BY checked_at DESC, success_percent DESC, suite DESC) = 1
), p AS (
  SELECT model_name,
         max({{'t': checked_at, 'm': auc_roc}}) FILTER (WHERE auc_roc IS NOT NULL) AS auc_roc,
         max({{'t': checked_at, 'm': precision}}) FILTER (WHERE precision IS NOT NULL) AS precision,
         max({{'t': checked_at, 'm': recall}}) FILTER (WHERE recall IS NOT NULL) AS recall
  FROM performance_log GROUP BY model_name
), versions AS (
  SELECT model_name, max({{'t': checked_at, 'v': version}}) AS newest FROM (
    SELECT model_name, checked_at, version FROM drift_log WHERE version <> 'unknown'
    UNION ALL SELECT model_name, checked_at, version FROM performance_log)
  GROUP BY model_name
), names AS (
  SELECT model_name FROM d UNION SELECT model_name FROM q UNION SELECT model_name FROM p
), health AS (
  SELECT names.model_name, coalesce(versions.newest.v, 'unknown') AS model_version,
         coalesce(CAST(d.drift_ratio AS DOUBLE), 0) AS drift_ratio, coalesce(d.drifted_names, '') AS drifted_names,
         coalesce(d.recommend_retrain, FALSE) AS recommend_retrain,
         coalesce(CAST(q.success_percent AS DOUBLE), 100) AS pass_rate, coalesce(q.suite, '') AS suite,
         d.checked_at AS last_drift_check, q.checked_at AS last_quality_check,
         p.auc_roc.m AS auc_roc, p.precision.m AS precision, p.recall.m AS recall,
         CASE WHEN coalesce(d.recommend_retrain, FALSE) OR coalesce(q.success_percent, 100) < 80 THEN 'CRITICAL'
              WHEN coalesce(d.drift_ratio, 0) > 0.1 OR coalesce(q.success_percent, 100) < 95 THEN 'DEGRADED'
              ELSE 'HEALTHY' END AS health_status
  FROM names LEFT JOIN d USING (model_name) LEFT JOIN q USING (model_name)
       LEFT JOIN p USING (model_name) LEFT JOIN versions USING (model_name)
)"""


def health(spark, folder):
    return monitor.model_health(
        drift_log(spark, folder), quality_log(spark, folder), performance_log(spark, folder)
    )


@query(
    "model_health",
    f"""{SQL_HEALTH} SELECT model_name, model_version, {sql_fixed('drift_ratio')} AS drift_ratio, drifted_names,
       recommend_retrain, {sql_fixed('pass_rate')} AS pass_rate, suite,
       {sql_stamp('last_drift_check')} AS last_drift_check, {sql_stamp('last_quality_check')} AS last_quality_check,
       {sql_fixed('auc_roc')} AS auc_roc, {sql_fixed('precision')} AS precision, {sql_fixed('recall')} AS recall,
       health_status FROM health""",
)
def model_health(spark, folder):
    """Latest state of every model from three logs, with its status."""
    return health(spark, folder).select(
        "model_name",
        "model_version",
        fixed("drift_ratio").alias("drift_ratio"),
        F.array_join("drifted_names", ",").alias("drifted_names"),
        "recommend_retrain",
        fixed("pass_rate").alias("pass_rate"),
        "suite",
        stamp("last_drift_check").alias("last_drift_check"),
        stamp("last_quality_check").alias("last_quality_check"),
        *[fixed(c).alias(c) for c in ("auc_roc", "precision", "recall")],
        "health_status",
    )


@query(
    "platform_health",
    f"""{SQL_HEALTH} SELECT CASE WHEN count(*) FILTER (WHERE health_status = 'CRITICAL') > 0 THEN 'CRITICAL'
       WHEN count(*) FILTER (WHERE health_status = 'DEGRADED') > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS platform_status,
       count(*) AS total_models, count(*) FILTER (WHERE health_status = 'HEALTHY') AS healthy,
       count(*) FILTER (WHERE health_status = 'DEGRADED') AS degraded,
       count(*) FILTER (WHERE health_status = 'CRITICAL') AS critical FROM health""",
)
def platform_health(spark, folder):
    return monitor.platform_health(health(spark, folder))


@query("status_counts", f"{SQL_HEALTH} SELECT health_status, count(*) AS models FROM health GROUP BY 1")
def status_counts(spark, folder):
    return monitor.status_counts(health(spark, folder))


@query("critical_models", f"{SQL_HEALTH} SELECT model_name FROM health WHERE health_status = 'CRITICAL'")
def critical_models(spark, folder):
    return monitor.critical_models(health(spark, folder)).select("model_name")


@query("models_to_retrain", f"{SQL_HEALTH} SELECT model_name FROM health WHERE recommend_retrain")
def models_to_retrain(spark, folder):
    return monitor.models_to_retrain(health(spark, folder))


@query(
    "health_metrics",
    f"""{SQL_HEALTH}, long AS (
  SELECT 'model_drift_ratio' AS metric, model_name, NULL AS status, drift_ratio AS value, printf('%.6f', drift_ratio) AS text FROM health
  UNION ALL SELECT 'model_dq_pass_rate', model_name, NULL, pass_rate, printf('%.2f', pass_rate) FROM health
  UNION ALL SELECT 'model_auc_roc', model_name, NULL, auc_roc, printf('%.6f', auc_roc) FROM health WHERE auc_roc IS NOT NULL
  UNION ALL SELECT 'model_health_status', model_name, s.status, CAST(CAST(s.status = health_status AS INTEGER) AS DOUBLE),
                   CAST(CAST(s.status = health_status AS INTEGER) AS VARCHAR)
            FROM health CROSS JOIN (VALUES ('HEALTHY'), ('DEGRADED'), ('CRITICAL')) AS s(status)
)
SELECT metric, model_name, status, {sql_fixed('value', 6)} AS value,
       metric || '{{model="' || model_name || '"' || coalesce(',status="' || status || '"', '') || '}} ' || text AS line
FROM long""",
)
def health_metrics(spark, folder):
    """Metrics in long form with their text lines."""
    return monitor.health_metrics(health(spark, folder)).withColumn("value", fixed("value", 6))
