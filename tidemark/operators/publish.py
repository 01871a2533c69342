"""Write, audit, publish: a dated partition reaches its readers only after its checks.

The partition is first written beside the published table. The checks read what was written, not
the plan that made it, so they judge the very rows that would be published and nothing is
computed twice. Only if the gate lets it pass does the partition replace the published one of
that date; otherwise the published rows stay as they are and the staged ones can be looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import as_date
from tidemark.operators.monitor import quality_gate
from tidemark.operators.validation import check_statuses
from tidemark.sources import io


def staging(root: str) -> str:
    """Where partitions wait: beside the published table, so that no reader of it lists them."""
    return f"{root.rstrip('/')}.staged"


def gated_publish(
    df: DataFrame,
    root: str,
    day: str | date,
    key: str,
    checks: Callable[[DataFrame], DataFrame] = check_statuses,
    files: int = 50,
    fmt: str = "parquet",
) -> DataFrame:
    """Stage ``df`` as the partition of ``day``, check it, publish it if it may be published.

    ``checks`` turns the staged rows into rows of (check, status). Returns them with ``date``, the
    number of ``staged_rows`` and whether the partition was ``published``; drift alone does
    not block (see ``quality_gate``).
    """
    spark = df.sparkSession
    io.write_partition(df, staging(root), day, key, files, fmt)
    staged = io.read_partition(spark, staging(root), day, fmt)
    if not staged.columns or "date" not in staged.columns:
        raise ValueError(f"nothing was staged for {as_date(day)}")
    # a handful of rows, one per group of checks: the decision is the driver's
    found = checks(staged.drop("date")).collect()
    statuses = spark.createDataFrame([(r["check"], r["status"]) for r in found], "check string, status string")
    may_publish = quality_gate(statuses).first()["may_publish"]
    if may_publish:
        (
            staged.write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .save(root)
        )
    return statuses.select(
        F.lit(as_date(day)).alias("date"),
        "check",
        "status",
        F.lit(staged.count()).alias("staged_rows"),
        F.lit(may_publish).alias("published"),
    )
