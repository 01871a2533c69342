"""A dated ledger of alerts that were sent: none is sent twice, in whatever run it comes.

The alerts of a run are reduced to one per key (source, model and day) and put down as files. A
stream over those files keeps the keys it has let through for as long as an alert of their day
may still come in, its watermark; an alert whose key is known, or whose time is older than that,
goes no further. So a day that is run again sends nothing, and what is kept does not grow with
the ledger. New alerts are written under their run and day, to be sent from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.monitor import deduplicate_alerts
from tidemark.sources import io

#: How late an alert may come in, and how long its key is kept.
LATEST = "7 days"


def send_new(alerts: DataFrame, folder: str, run: int, latest: str = LATEST) -> DataFrame:
    """Enter the alerts of a run in the ledger below ``folder``; what no run has entered before.

    Of alerts that share a key the earliest of the first run counts. Runs are numbered upwards; a
    run that was cut short is run again under its number and goes on where it was.
    """
    spark = alerts.sparkSession
    arriving, sent = f"{folder}/arriving", f"{folder}/sent"
    if not io.exists(spark, f"{arriving}/run={run}/_SUCCESS"):
        deduplicate_alerts(alerts).write.mode("overwrite").parquet(f"{arriving}/run={run}")
    schema = deduplicate_alerts(alerts).withColumn("run", F.lit(run)).schema
    stream = spark.readStream.schema(schema).parquet(arriving)
    fresh = stream.withWatermark("timestamp", latest).dropDuplicatesWithinWatermark(["dedup_key"])

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"day": F.to_date("timestamp"), "batch": F.lit(batch_id)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch", "day").parquet(sent)

    query = fresh.writeStream.foreachBatch(append).option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True)
    query.start().awaitTermination()
    return read_ledger(spark, folder).where(F.col("run") == run)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All alerts that were sent, with their run and day."""
    return spark.read.parquet(f"{folder}/sent").drop("batch")
