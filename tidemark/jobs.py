"""The two batch jobs from paths and a date: compute a feature partition, validate it.

Paths may lie on any storage that Spark reads; ``fmt`` names any installed format.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import as_date, days_before
from tidemark.operators.publish import gated_publish
from tidemark.operators.rolling import latest_feature_table
from tidemark.operators.validation import validation_report
from tidemark.sources import io

# Days from a run back to the partition it is compared with, and to the first day
# that it materialises.
REFERENCE_DAYS = 30
MATERIALISED_DAYS = 1


def feature_job(
    spark: SparkSession, events: str, features: str, day: str | date, fmt: str = "parquet", gated: bool = False, **options
) -> DataFrame:
    """Read raw events, compute the feature rows as of ``day``, write them as its partition.

    With ``gated`` the partition is published only if its checks pass. Returns the rows that
    readers now find for that day.
    """
    rows = latest_feature_table(io.read_events(spark, events, fmt), day)
    if gated:
        gated_publish(rows, features, day, "user_id", fmt=fmt, **options)
    else:
        io.write_partition(rows, features, day, "user_id", fmt=fmt, **options)
    return io.read_partition(spark, features, day, fmt)


def reference_day(day: str | date, days: int = REFERENCE_DAYS) -> str:
    """The day whose partition a run of ``day`` is compared with."""
    return days_before(day, days)


def materialised_days(day: str | date) -> tuple[str, str]:
    """First and last day that the materialisation of a run of ``day`` covers."""
    return days_before(day, MATERIALISED_DAYS), as_date(day).isoformat()


def validation_job(
    spark: SparkSession,
    features: str,
    day: str | date,
    reports: str,
    reference: str | date | None = None,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """Compare the partition of ``day`` with the one ``REFERENCE_DAYS`` before, write the report.

    The report goes to ``validation_<day>.json`` below ``reports``. Returns its one row (report,
    overall_status), read back from what was written.
    """
    current = as_date(day).isoformat()
    past = as_date(reference).isoformat() if reference is not None else reference_day(day)
    rows = {d: io.read_partition(spark, features, d, fmt).drop("date") for d in (past, current)}
    report = validation_report(rows[past], rows[current], past, current, **options)
    path = report_path(reports, day)
    io.write_report(report, path)
    written = spark.read.text(path, wholetext=True).withColumnRenamed("value", "report")
    return written.withColumn("overall_status", F.get_json_object("report", "$.overall_status"))


def report_path(reports: str, day: str | date) -> str:
    return f"{reports.rstrip('/')}/validation_{as_date(day).isoformat()}.json"
