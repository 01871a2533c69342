"""Registry of queries and helpers that keep both sides comparable."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL if it can be said in SQL."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, in the shared folder that spark.checkpoint.dir names.

    Only a local master, whose executors are this process, may go without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


# Doubles are compared after rounding by way of a decimal: the last bits depend on the
# order of summation, and a plain round() would let them decide ties.


def fixed(column: str | Column, digits: int = 4) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("decimal(30,9)"), digits).cast("double")


def sql_fixed(expression: str, digits: int = 4) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(30,9)), {digits}) AS DOUBLE)"


def stamp(column: str | Column) -> Column:
    """A time as text, to the microsecond."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
