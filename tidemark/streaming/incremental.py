"""Keep a latest-value table up to date from a growing feature source.

The stream's own checkpoint is the high-water mark: each run picks up the files that
came since the last one, merges them into the store and stops.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import io
from tidemark.sources.latest_store import LatestStore, newest_rows
from tidemark.sources.schemas import FeatureView


def feature_stream(
    spark: SparkSession, path: str, like: DataFrame, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of feature files as a stream with the schema of ``like``."""
    reader = spark.readStream.schema(like.schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark gave the stream of this checkpoint; None while it is fresh."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    if not io.exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])["id"]


def materialize_stream(stream: DataFrame, view: FeatureView, store: LatestStore, checkpoint: str) -> StreamingQuery:
    """Merge all new rows of ``stream`` into the view's latest table, then stop.

    A batch rewrites the buckets it touches, and its number goes into the view's mark. A batch
    that is run again after its mark changes nothing; one that had not come to its mark is merged
    anew. A store that was filled from another checkpoint is refused: the batches would be
    counted from 0 again and taken for old ones.
    """
    spark = stream.sparkSession
    mark = store.marks().get(view.name)
    if mark is not None and mark.stream is not None and mark.stream != _stream_id(spark, checkpoint):
        raise ValueError(f"the table of {view.name!r} was filled from another checkpoint than {checkpoint!r}")

    def merge(batch: DataFrame, batch_id: int) -> None:
        mark = store.marks().get(view.name)
        if mark is not None and mark.batch is not None and mark.batch >= batch_id:
            return
        store.merge(view, newest_rows(batch, view), None, _stream_id(spark, checkpoint), batch_id)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
