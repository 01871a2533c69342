"""Readers and writers for events, dated feature tables, reports and training sets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timing import as_date
from tidemark.sources.schemas import RAW_EVENTS, FeatureView, Source


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw events with the declared schema; ``fmt`` may name any installed format."""
    return spark.read.format(fmt).schema(RAW_EVENTS).load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_source(spark: SparkSession, source: Source, view: FeatureView | None = None) -> DataFrame:
    """A feature source, projected to the columns of ``view`` if one is given."""
    table = read_table(spark, source.path, source.fmt)
    if view is None:
        return table
    times = [c for c in (source.ts_col, source.created_col) if c]
    return table.select(*view.keys, *times, *view.fields)


def read_partition(spark: SparkSession, root: str, day: str | date, fmt: str = "parquet") -> DataFrame:
    """One ``date=`` partition of a feature table, with its own columns and types; other
    directories are not looked at. A date without a partition has no rows."""
    path = _partition(root, day)
    if fmt == "parquet" and exists(spark, path):
        rows = spark.read.option("basePath", root).parquet(path)
    else:
        rows = read_table(spark, root, fmt)
    return rows.where(F.col("date") == F.lit(as_date(day)))


def _partition(root: str, day: str | date) -> str:
    return f"{root.rstrip('/')}/date={as_date(day).isoformat()}"


def write_partition(
    df: DataFrame,
    root: str,
    day: str | date,
    key: str,
    files: int = 50,
    fmt: str = "parquet",
    new_types: str = "replace",
) -> None:
    """Replace one ``date=`` partition, leaving the others; rerunning changes nothing.

    The partition takes the schema of ``df``, whatever it had before. With ``new_types="refuse"`` a
    column whose type differs from that of the newest partition of another date is an error that
    names it, and nothing is written; columns may come and go.
    """
    if new_types not in ("replace", "refuse"):
        raise ValueError(f"new_types is replace or refuse, not {new_types!r}")
    if new_types == "refuse" and (mixed := type_changes(df, root, day)):
        raise TypeError("columns of another type than in the table: " + ", ".join(mixed))
    (
        df.withColumn("date", F.lit(as_date(day)))
        .repartition(files, key)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .save(root)
    )


def partition_days(spark: SparkSession, root: str) -> list[date]:
    """The dates that a table has partitions of."""
    return sorted(as_date(n) for n in names_below(spark, root, "date"))


def partition_types(spark: SparkSession, root: str, day: str | date) -> dict[str, str]:
    """Columns and types of one partition, from the footers of all its files."""
    schema = spark.read.option("mergeSchema", "true").parquet(_partition(root, day)).schema
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def type_changes(df: DataFrame, root: str, day: str | date) -> list[str]:
    """Columns of ``df`` that the newest partition of another date has with another type."""
    spark = df.sparkSession
    others = [d for d in partition_days(spark, root) if d != as_date(day)]
    if not others:
        return []
    types = partition_types(spark, root, others[-1])
    return [
        f"{f.name} ({types[f.name]} -> {f.dataType.simpleString()})"
        for f in df.schema.fields
        if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()
    ]


HISTORY = "date date, column string, type string, change string"


def schema_history(spark: SparkSession, root: str) -> DataFrame:
    """What each partition has changed against the one before: a row per date and column that was
    added, removed or given another type. Reads footers only, a partition at a time."""
    rows, before = [], {}
    for day in partition_days(spark, root):
        now = partition_types(spark, root, day)
        for name in sorted({*before, *now}):
            old, new = before.get(name), now.get(name)
            if old != new:
                change = "added" if old is None else "removed" if new is None else f"was {old}"
                rows.append((day, name, new, change))
        before = now
    return spark.createDataFrame(rows, HISTORY)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def write_report(report: DataFrame, path: str, column: str = "report") -> None:
    """A report of one row (already JSON text) as one file."""
    report.select(column).coalesce(1).write.mode("overwrite").text(path)


# --- folders on whatever storage Spark writes to ---------------------------------------


def _on_storage(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    storage, where = _on_storage(spark, path)
    return storage.exists(where)


def names_below(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values x of the folders ``name=x`` right below ``path``; none if it does not exist."""
    storage, where = _on_storage(spark, path)
    if not storage.exists(where):
        return []
    found = [f.getPath().getName() for f in storage.listStatus(where)]
    return [f.split("=", 1)[1] for f in found if f.startswith(f"{name}=")]


def numbers_below(spark: SparkSession, path: str, name: str) -> list[int]:
    return [int(x) for x in names_below(spark, path, name)]


def remove(spark: SparkSession, path: str) -> None:
    storage, where = _on_storage(spark, path)
    storage.delete(where, True)


# What the branch decision needs from a validation report.
REPORT_DRIFT = T.StructType(
    [
        T.StructField(
            "checks",
            T.StructType(
                [
                    T.StructField(
                        "drift",
                        T.StructType(
                            [
                                T.StructField("status", T.StringType()),
                                T.StructField("drifted_columns", T.ArrayType(T.StringType())),
                            ]
                        ),
                    )
                ]
            ),
        )
    ]
)


def read_report_drift(spark: SparkSession, path: str) -> DataFrame:
    """Drift status and drifted columns of each report file; nulls if unreadable."""
    text = spark.read.text(path, wholetext=True)
    return drift_of_report(text, "value")


def drift_of_report(reports: DataFrame, column: str) -> DataFrame:
    parsed = F.from_json(F.col(column), REPORT_DRIFT)
    return reports.select(
        *[c for c in reports.columns if c != column],
        parsed["checks"]["drift"]["status"].alias("drift_status"),
        parsed["checks"]["drift"]["drifted_columns"].alias("drifted_columns"),
    )


def entity_spine(
    spark: SparkSession, n: int, day: str | date, id_col: str = "user_id", hours: int = 24
) -> DataFrame:
    """Ids 1..n with times spread back over the ``hours`` before ``day``."""
    return spine_for(
        spark.range(n).select((F.col("id") + 1).alias(id_col)), day, id_col=id_col, hours=hours
    )


def spine_for(
    ids: DataFrame, day: str | date, id_col: str = "user_id", hours: int = 24
) -> DataFrame:
    """Spine over given 1-based ids: the i-th id gets ``day`` minus (i mod hours) hours."""
    base = F.unix_seconds(F.lit(f"{as_date(day)} 00:00:00").cast("timestamp"))
    back = F.pmod(F.col(id_col) - 1, F.lit(hours)) * 3600
    return ids.withColumn("event_timestamp", F.timestamp_seconds(base - back))
