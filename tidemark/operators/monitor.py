"""Decisions, alerts and health tables over drift, quality and performance results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits and channel lists.
PROMOTION_AUC = 0.82
CRITICAL_PASS_RATE = 80.0
DEGRADED_PASS_RATE = 95.0
DEGRADED_DRIFT = 0.10
NAMES_SHOWN = 10
CHANNELS = {
    "info": (),
    "warning": ("slack", "email"),
    "critical": ("slack", "pagerduty", "email"),
}
STATUSES = ("HEALTHY", "DEGRADED", "CRITICAL")


# --- decisions -------------------------------------------------------------------------


def retrain_decision(reports: DataFrame) -> DataFrame:
    """``trigger_retraining`` on a failed drift status or any drifted column.

    Missing or unreadable reports decide ``no_retraining``.
    """
    drifted = F.coalesce(F.col("drift_status") == "fail", F.lit(False)) | F.coalesce(
        F.size("drifted_columns") > 0, F.lit(False)
    )
    return reports.withColumn(
        "decision", F.when(drifted, "trigger_retraining").otherwise("no_retraining")
    )


def quality_gate(statuses: DataFrame) -> DataFrame:
    """Whether the table may be published: schema, nulls and ranges pass. Drift never blocks."""
    blocking = statuses.where(F.col("check") != "drift")
    return blocking.agg(
        F.coalesce(F.every(F.col("status") == "pass"), F.lit(True)).alias("may_publish"),
        F.count_if(F.col("status") != "pass").alias("failed_groups"),
    )


def promotion_gate(runs: DataFrame, threshold: float = PROMOTION_AUC, auc: str = "auc") -> DataFrame:
    """``promote`` at or above the threshold, else ``reject`` with a reason."""
    passed = F.coalesce(F.col(auc) >= threshold, F.lit(False))
    reason = F.format_string(f"AUC %.4f < threshold {threshold}", F.col(auc))
    return runs.withColumns(
        {
            "decision": F.when(passed, "promote").otherwise("reject"),
            "reason": F.when(~passed, reason),
        }
    )


# --- alerts ----------------------------------------------------------------------------


def shortened_names(names: Column) -> Column:
    """The first ten names joined by commas, with a mark if there are more."""
    more = F.when(F.size(names) > NAMES_SHOWN, " ...").otherwise("")
    return F.concat(F.array_join(F.slice(names, 1, NAMES_SHOWN), ", "), more)


def _alert(source: str, subject: Column, severity: Column, model: Column, at: Column, **entries: Column) -> list[Column]:
    """The columns of an alert: what it knows is its metadata, and the text for people prints that,
    an entry a line. Every kind of alert goes through here."""
    text = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in entries.items()])
    lines = F.transform(text, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("-"))))
    return [
        F.concat(F.lit(f"{source}: "), subject).alias("title"),
        F.array_join(lines, "\n").alias("message"),
        severity.alias("severity"),
        F.lit(source).alias("source"),
        model.cast("string").alias("model_name"),
        F.map_from_entries(text).alias("metadata"),
        at.alias("timestamp"),
    ]


def _share(ratio: Column) -> Column:
    """A ratio as text of four digits, the same however it was summed."""
    return F.round(ratio, 4).cast("decimal(10,4)")


def drift_alerts(summary: DataFrame) -> DataFrame:
    """One alert per model from its drift summary; ``checked_at`` becomes the alert time."""
    model = F.col("model_name")
    return summary.select(
        *_alert(
            "drift_detector",
            model,
            F.when(F.col("recommend_retrain"), "critical").otherwise("warning"),
            model,
            F.col("checked_at"),
            dataset_drift_ratio=_share(F.col("dataset_drift_ratio")),
            total_features=F.col("total_features"),
            drifted_features=shortened_names(F.col("drifted_names")),
            recommend_retrain=F.col("recommend_retrain"),
        )
    )


def quality_alerts(summaries: DataFrame, pipeline: str) -> DataFrame:
    """One alert per failed suite: critical below 80 % passes."""
    return summaries.where(~F.col("success")).select(
        *_alert(
            "data_quality",
            F.col("suite"),
            F.when(F.col("success_percent") < CRITICAL_PASS_RATE, "critical").otherwise("warning"),
            F.lit(None),
            F.col("checked_at"),
            suite_name=F.col("suite"),
            success_percent=_share(F.col("success_percent")),
            evaluated_expectations=F.col("evaluated_checks"),
            failed_expectations=F.col("failed_checks"),
            pipeline=F.lit(pipeline),
        )
    )


def promotion_alerts(runs: DataFrame, stage: str = "Production") -> DataFrame:
    """Information rows for promoted runs (columns model_name, version, decided_at)."""
    model = F.col("model_name")
    return runs.where(F.col("decision") == "promote").select(
        *_alert("model_registry", model, F.lit("info"), model, F.col("decided_at"), version=F.col("version"), stage=F.lit(stage))
    )


def retrain_alerts(decisions: DataFrame) -> DataFrame:
    """Warnings for triggered retraining (columns model_name, reason, decided_at)."""
    model = F.col("model_name")
    return decisions.where(F.col("decision") == "trigger_retraining").select(
        *_alert("training_pipeline", model, F.lit("warning"), model, F.col("decided_at"), reason=F.col("reason"))
    )


def route_alerts(
    alerts: DataFrame, configured: Sequence[str] = ("slack", "pagerduty", "email")
) -> DataFrame:
    """One row per alert and channel; informational alerts reach no channel."""
    wanted = F.create_map(
        *[
            x
            for severity, channels in CHANNELS.items()
            for x in (
                F.lit(severity),
                F.array(*[F.lit(c) for c in channels if c in configured]).cast("array<string>"),
            )
        ]
    )
    return alerts.select("*", F.explode(wanted[F.col("severity")]).alias("channel"))


def alert_key(source: str = "source", model: str = "model_name", ts: str = "timestamp") -> Column:
    return F.concat_ws(
        "-", F.col(source), F.coalesce(F.col(model), F.lit("None")), F.to_date(ts).cast("string")
    )


def deduplicate_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per source, model and day: the earliest, then by title. All columns stay."""
    columns = [c for c in alerts.columns if c != "dedup_key"]
    order = F.struct("timestamp", "title", "severity", "message", "source", "model_name")
    first = F.min_by(F.struct(*columns), order)  # carried whole: a map cannot be ordered
    return alerts.groupBy(alert_key().alias("dedup_key")).agg(first.alias("_a")).select("dedup_key", "_a.*")


# --- health ----------------------------------------------------------------------------


def health_status(retrain: Column, pass_rate: Column, drift: Column) -> Column:
    return (
        F.when(retrain | (pass_rate < CRITICAL_PASS_RATE), "CRITICAL")
        .when((drift > DEGRADED_DRIFT) | (pass_rate < DEGRADED_PASS_RATE), "DEGRADED")
        .otherwise("HEALTHY")
    )


PERFORMANCE_METRICS = ("auc_roc", "precision", "recall", "f1")


def model_health(drift: DataFrame, quality: DataFrame, performance: DataFrame) -> DataFrame:
    """Latest state per model over three event logs, all keyed by ``model_name``.

    ``drift``: checked_at, drift_ratio, drifted_names, recommend_retrain, version.
    ``quality``: checked_at, success_percent, suite, version.
    ``performance``: checked_at, auc_roc, precision, recall, f1, version.
    A metric keeps its newest non-null value; a version its newest known one. Models
    without drift or quality records have drift 0 and pass rate 100.
    """
    key = "model_name"

    def known_version(ts: Column):
        version = F.when(F.col("version") != "unknown", F.col("version"))
        return F.max(F.when(version.isNotNull(), F.struct(ts.alias("t"), version.alias("v"))))

    at = F.col("checked_at")
    d = drift.groupBy(key).agg(
        F.max(F.struct(at, "drift_ratio", "drifted_names", "recommend_retrain")).alias("d"),
        known_version(at).alias("dv"),
    )
    q = quality.groupBy(key).agg(
        F.max(F.struct(at, "success_percent", "suite")).alias("q"), known_version(at).alias("qv")
    )
    p = performance.groupBy(key).agg(
        *[
            F.max(F.when(F.col(m).isNotNull(), F.struct(at, F.col(m).alias("m")))).alias(f"p_{m}")
            for m in PERFORMANCE_METRICS
        ],
        known_version(at).alias("pv"),
    )
    state = d.join(q, key, "full_outer").join(p, key, "full_outer").select(
        key,
        F.coalesce(F.greatest("dv", "qv", "pv")["v"], F.lit("unknown")).alias("model_version"),
        F.coalesce(F.col("d")["drift_ratio"], F.lit(0.0)).alias("drift_ratio"),
        F.coalesce(F.col("d")["drifted_names"], F.array().cast("array<string>")).alias(
            "drifted_names"
        ),
        F.coalesce(F.col("d")["recommend_retrain"], F.lit(False)).alias("recommend_retrain"),
        F.col("d")["checked_at"].alias("last_drift_check"),
        F.coalesce(F.col("q")["success_percent"], F.lit(100.0)).alias("pass_rate"),
        F.coalesce(F.col("q")["suite"], F.lit("")).alias("suite"),
        F.col("q")["checked_at"].alias("last_quality_check"),
        *[F.col(f"p_{m}")["m"].alias(m) for m in PERFORMANCE_METRICS],
    )
    return state.withColumn(
        "health_status",
        health_status(F.col("recommend_retrain"), F.col("pass_rate"), F.col("drift_ratio")),
    )


def platform_health(health: DataFrame) -> DataFrame:
    """One row: worst status over all models and counts by status; no models is healthy."""
    counts = {s: F.count_if(F.col("health_status") == s) for s in STATUSES}
    return health.agg(
        F.when(counts["CRITICAL"] > 0, "CRITICAL")
        .when(counts["DEGRADED"] > 0, "DEGRADED")
        .otherwise("HEALTHY")
        .alias("platform_status"),
        F.count(F.lit(1)).alias("total_models"),
        *[c.alias(s.lower()) for s, c in counts.items()],
    )


def status_counts(health: DataFrame) -> DataFrame:
    return health.groupBy("health_status").agg(F.count(F.lit(1)).alias("models"))


def critical_models(health: DataFrame) -> DataFrame:
    return health.where(F.col("health_status") == "CRITICAL")


def models_to_retrain(health: DataFrame) -> DataFrame:
    return health.where("recommend_retrain").select("model_name")


def health_metrics(health: DataFrame, prefix: str = "model") -> DataFrame:
    """Metrics in long form: ``metric``, ``model_name``, ``status``, ``value``, ``line``."""
    no_status = F.lit(None).cast("string")

    def entry(metric: str, status: Column, value: Column, digits: int) -> Column:
        return F.struct(
            F.lit(f"{prefix}_{metric}").alias("metric"),
            status.alias("status"),
            value.cast("double").alias("value"),
            F.format_string(f"%.{digits}f", value.cast("double")).alias("text"),
        )

    entries = [
        entry("drift_ratio", no_status, F.col("drift_ratio"), 6),
        entry("dq_pass_rate", no_status, F.col("pass_rate"), 2),
        entry("auc_roc", no_status, F.col("auc_roc"), 6),
        *[
            entry(
                "health_status",
                F.lit(s),
                F.when(F.col("health_status") == s, 1).otherwise(0),
                0,
            )
            for s in STATUSES
        ],
    ]
    label = F.concat(
        F.format_string('model="%s"', F.col("model_name")),
        F.when(F.col("status").isNull(), "").otherwise(F.format_string(',status="%s"', F.col("status"))),
    )
    return (
        health.select("model_name", "health_status", F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .select(
            "metric",
            "model_name",
            "status",
            "value",
            F.concat("metric", F.lit("{"), label, F.lit("} "), "text").alias("line"),
        )
    )
