"""What the operators of this package share on the Spark side: written steps, texts, labels."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names in spark.checkpoint.dir.

    Without that setting a folder of this process is used, on a local master only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a step as a table and read it again: later steps neither repeat it nor lose it
    with an executor. Its shuffle files go as soon as it is written."""
    spark = df.sparkSession
    path, before = folder(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` wrote, when nothing that is still to run reads them."""
    for table in tables:
        spark = table.sparkSession
        root, jvm = spark.conf.get("spark.checkpoint.dir"), spark.sparkContext._jvm
        home = jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
        for name in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            if path.toUri().getPath().startswith(home):
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns that an operator works on, under names that cannot clash with others."""
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def held_out(key: Column) -> Column:
    """Rows kept away from learning: crc32 of the key as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, key: str, rows: int, seed: str, strata: str) -> DataFrame:
    """At most ``rows`` rows of each stratum, by the smallest hashes of the key: the same rows
    however the table is partitioned. Each stratum is one bounded top-k, without a sort."""
    order = F.xxhash64(F.lit(seed), F.col(key))
    parts = []
    for value in (0, 1):
        parts.append(df.where(F.col(strata) == value).orderBy(order, F.col(key)).limit(rows))
    return parts[0].unionByName(parts[1])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors once, as ``--py-files`` would; needless where it is
    installed on every machine, and harmless there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(path, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
