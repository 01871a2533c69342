"""Checks of a dated feature table: schema, null rates, ranges, drift, one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import KS_STATISTIC_LIMIT, distribution_drift
from tidemark.operators.expectations import out_of_range

# Columns and bounds of the feature table.
NUMERIC_FEATURES = (
    "tx_count_7d",
    "tx_amount_sum_7d",
    "tx_amount_mean_7d",
    "tx_amount_max_7d",
    "tx_count_30d",
    "tx_amount_sum_30d",
    "tx_amount_mean_30d",
    "tx_amount_stddev_30d",
    "fraud_tx_count_30d",
    "distinct_merchant_categories_30d",
    "tx_count_90d",
    "tx_amount_sum_90d",
    "tx_amount_mean_90d",
    "tx_amount_stddev_90d",
    "tx_amount_7d_30d_ratio",
    "tx_count_7d_30d_ratio",
)
REQUIRED_COLUMNS = (*NUMERIC_FEATURES, "user_id", "event_timestamp", "is_high_value_customer")
FEATURE_RANGES = {
    "tx_count_7d": (0, 10_000),
    "tx_count_30d": (0, 50_000),
    "tx_amount_sum_30d": (0, 10_000_000),
    "fraud_tx_count_30d": (0, 1_000),
}
MAX_NULL_RATE = 0.02


def _status(failed):
    return F.when(failed, "fail").otherwise("pass")


def _texts(values: Sequence[str]):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def schema_check(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row: status, missing and extra columns (``date`` ignored), column count.

    Looks at column names only; no data is read.
    """
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required and c != "date"]
    return df.sparkSession.range(1).select(
        F.lit("fail" if missing else "pass").alias("status"),
        _texts(missing).alias("missing_columns"),
        _texts(extra).alias("extra_columns"),
        F.lit(len(set(df.columns))).alias("total_columns"),
    )


def null_rates(
    df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, max_rate: float = MAX_NULL_RATE
) -> DataFrame:
    """One row per column: null rate, violation (rate above the limit), total rows.

    All columns in one pass. An empty table has null rates and counts as violated; so has
    and does a column that the table lacks.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            (F.avg(F.col(c).isNull().cast("int")) if c in df.columns else F.max(F.lit(None).cast("double"))).alias(f"r{i}")
            for i, c in enumerate(columns)
        ],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("null_rate")) for i, c in enumerate(columns)]
    )
    return row.select(F.inline(entries), F.col("_n").alias("total_rows")).select(
        "column",
        "null_rate",
        F.coalesce(F.col("null_rate") > max_rate, F.lit(True)).alias("violated"),
        "total_rows",
    )


def range_counts(
    df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]] = FEATURE_RANGES
) -> DataFrame:
    """One row per present column: number of values outside its range. Nulls pass; no column, no row."""
    present = [c for c in ranges if c in df.columns]
    row = df.agg(
        *[F.count_if(out_of_range(c, *ranges[c])).alias(f"n{i}") for i, c in enumerate(present)],
        F.lit(0).alias("_none"),
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("out_of_range_count"),
            F.lit(float(ranges[c][0])).alias("low") if ranges[c][0] is not None
            else F.lit(None).cast("double").alias("low"),
            F.lit(float(ranges[c][1])).alias("high") if ranges[c][1] is not None
            else F.lit(None).cast("double").alias("high"),
        )
        for i, c in enumerate(present)
    ]
    if not entries:
        return df.sparkSession.createDataFrame(
            [], "column string, out_of_range_count long, low double, high double, violated boolean"
        )
    return row.select(F.inline(F.array(*entries))).withColumn(
        "violated", F.col("out_of_range_count") > 0
    )


def check_statuses(
    current: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    columns: Sequence[str] = NUMERIC_FEATURES,
    ranges: Mapping = FEATURE_RANGES,
    max_null_rate: float = MAX_NULL_RATE,
    drift: DataFrame | None = None,
) -> DataFrame:
    """One row per check group: ``check``, ``status``. With ``drift`` rows, drift too."""
    fails = F.coalesce(F.bool_or("violated"), F.lit(False))
    parts = [
        schema_check(current, required).select(F.lit("schema").alias("check"), "status"),
        null_rates(current, columns, max_null_rate)
        .agg(fails.alias("_bad"))
        .select(F.lit("null_rates").alias("check"), _status(F.col("_bad")).alias("status")),
        range_counts(current, ranges)
        .agg(fails.alias("_bad"))
        .select(F.lit("ranges").alias("check"), _status(F.col("_bad")).alias("status")),
    ]
    if drift is not None:
        parts.append(
            drift.agg(F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("_bad")).select(
                F.lit("drift").alias("check"), _status(F.col("_bad")).alias("status")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def overall_status(statuses: DataFrame) -> DataFrame:
    """One row: pass only if every check passes."""
    ok = F.coalesce(F.every(F.col("status") == "pass"), F.lit(True))
    return statuses.agg(F.when(ok, "pass").otherwise("fail").alias("overall_status"))


def validation_report(
    reference: DataFrame,
    current: DataFrame,
    reference_date: str,
    current_date: str,
    columns: Sequence[str] = NUMERIC_FEATURES,
    required: Sequence[str] = REQUIRED_COLUMNS,
    ranges: Mapping = FEATURE_RANGES,
    max_null_rate: float = MAX_NULL_RATE,
    ks_threshold: float = KS_STATISTIC_LIMIT,
    drift_blocks: bool = True,
) -> DataFrame:
    """The nested report as one row of JSON text in ``report``, with ``overall_status``.

    A table that lacks columns gets a full report with status fail; drift is measured on the
    columns that both tables have. ``drift_blocks=False`` leaves drift out of the overall status, so that a drifted
    but clean table can still be published while retraining is triggered.
    """
    one = F.lit(1).alias("_one")
    schema = schema_check(current, required).select(one, F.struct("*").alias("schema"))
    nulls = null_rates(current, columns, max_null_rate)
    bad_rate = F.when(F.col("violated") & F.col("null_rate").isNotNull(), _pair("null_rate"))
    nulls = nulls.agg(
        F.struct(
            _status(F.bool_or("violated")).alias("status"),
            F.max("total_rows").alias("total_rows"),
            F.lit(max_null_rate).alias("max_allowed_null_rate"),
            _as_map(bad_rate).alias("violations"),
            _as_map(_pair("null_rate")).alias("null_rates"),
        ).alias("null_rates")
    ).select(one, "null_rates")
    detail = F.struct(
        F.col("column").alias("key"),
        F.struct("out_of_range_count", F.array("low", "high").alias("bounds")).alias("value"),
    )
    in_range = range_counts(current, ranges).agg(
        F.struct(
            _status(F.bool_or("violated")).alias("status"),
            _as_map(F.when(F.col("violated"), detail)).alias("violations"),
        ).alias("ranges")
    ).select(one, "ranges")
    result = F.struct(
        F.col("column").alias("key"),
        F.struct("ks_statistic", "p_value", "drifted").alias("value"),
    )
    both = [c for c in columns if c in reference.columns and c in current.columns]
    drift = (
        distribution_drift(reference, current, both, ks_threshold)
        if both
        else current.sparkSession.createDataFrame([], "column string, ks_statistic double, p_value double, drifted boolean")
    ).agg(
        F.struct(
            _status(F.bool_or("drifted")).alias("status"),
            F.lit(ks_threshold).alias("ks_threshold"),
            F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias(
                "drifted_columns"
            ),
            _as_map(result).alias("column_results"),
        ).alias("drift")
    ).select(one, "drift")

    # Each side is a single row.
    joined = schema.join(nulls, "_one").join(in_range, "_one").join(drift, "_one")
    groups = ["schema", "null_rates", "ranges"] + (["drift"] if drift_blocks else [])
    passed = F.lit(True)
    for g in groups:
        passed = passed & (F.col(g)["status"] == "pass")
    report = F.struct(
        F.lit(current_date).alias("execution_date"),
        F.lit(reference_date).alias("reference_date"),
        F.when(passed, "pass").otherwise("fail").alias("overall_status"),
        F.struct("schema", "null_rates", "ranges", "drift").alias("checks"),
    )
    return joined.select(
        F.to_json(report, {"pretty": "true"}).alias("report"),
        F.when(passed, "pass").otherwise("fail").alias("overall_status"),
    )


def _pair(value: str):
    return F.struct(F.col("column").alias("key"), F.col(value).alias("value"))


def _as_map(entry):
    """Map of column -> result; one entry per checked column, nulls left out."""
    return F.map_from_entries(F.array_sort(F.collect_list(entry)))
