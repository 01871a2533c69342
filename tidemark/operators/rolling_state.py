"""Trailing-window features from kept state, so that a run reads new days and not the lookback.

What ``rolling_latest`` aggregates from raw rows is kept day by day in a form that merges: count,
sum, squared deviations and maximum per key and day, the same per key and second, and the
last second of each (key, value) of a day for distinct counts. A run replaces the days that
new or late rows belong to, from the raw rows of those days alone, and then puts the frames
together: days that lie whole in a frame count by their totals, and only of the one day in
which a frame begins the seconds are read. Replacing a day twice gives the same state, so a run
that was cut short is simply run again.

A day here ends with its closing midnight, ``(midnight, next midnight]``: a run date is a midnight
and sees rows of that very instant, so it needs whole days only.

    root/seconds/day=<d>/   root/totals/day=<d>/   root/values_<column>/day=<d>/
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import DAY, as_date, days_before, instant, whole_seconds
from tidemark.operators.rolling import (
    TRANSACTION_FEATURES,
    Rolling,
    _centred,
    _distinct_features,
    _finish,
    _measures,
    _state,
    with_fraud_hit,
    with_ratios,
)
from tidemark.sources import io


def closing_day(ts: Column) -> Column:
    """The day of an instant, a midnight being the end of the day before."""
    return F.to_date(ts.cast("timestamp") - F.make_dt_interval(secs=F.lit(0.000001).cast("decimal(18,6)")))


class RollingState:
    """State of some rolling features below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        features: Sequence[Rolling] = TRANSACTION_FEATURES,
        key: str = "user_id",
        ts: str = "event_timestamp",
    ):
        self.spark, self.root, self.features, self.key, self.ts = spark, root.rstrip("/"), features, key, ts
        self.measures = _measures(features)
        self.distinct = list(dict.fromkeys(value for value, _ in _distinct_features(features)))
        self.parts = [f"{p}_{m}" for m, ps in self.measures.items() for p in "nsqx" if p in ps]

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _replace(self, rows: DataFrame, name: str, days: Sequence[date]) -> None:
        """Write ``rows`` (with ``day``) in place of these days; days without rows go."""
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(f"{self.root}/{name}")
        )
        kept = {r["day"] for r in self._table(name).where(F.col("day").isin(list(days))).select("day").distinct().collect()}
        for d in set(days) - kept:
            io.remove(self.spark, f"{self.root}/{name}/day={d}")

    # --- bringing state up to date ---

    def touched_days(self, fresh: DataFrame) -> list[date]:
        """Days that new rows belong to: as many as the rows span, however many rows there are."""
        days = fresh.where(F.col(self.ts).isNotNull()).select(closing_day(F.col(self.ts)).alias("day")).distinct()
        return sorted(r["day"] for r in days.collect())

    def refresh(self, rows: DataFrame, days: Sequence[date]) -> None:
        """Replace the state of ``days`` by that of ``rows``: all rows there are of those days; what
        else ``rows`` has is not read."""
        if not days:
            return
        ts = F.col(self.ts).cast("timestamp")
        inside = reduce(
            lambda a, b: a | b,
            [(F.col(self.ts) > instant(a)) & (F.col(self.ts) <= instant(b + timedelta(days=1))) for a, b in _runs(days)],
        )
        timed = rows.where(inside & F.col(self.key).isNotNull()).select(
            F.col(self.key).alias("_key"),
            closing_day(ts).alias("day"),
            whole_seconds(self.ts).alias("sec"),
            ts.alias("_ts"),
            *dict.fromkeys([*self.measures, *self.distinct]),
        )
        seconds = timed.groupBy("_key", "day", "sec").agg(
            F.max("_ts").alias("_ts"),
            *[c.alias(n) for m, parts in self.measures.items() for n, c in _state(m, parts, F.col(m)).items()],
        )
        self._replace(seconds, "seconds", days)
        written = self._table("seconds").where(F.col("day").isin(list(days)))
        self._replace(self._merged(written), "totals", days)
        for v in self.distinct:
            last = timed.where(F.col(v).isNotNull()).groupBy("_key", "day", F.col(v).alias("value")).agg(F.max("sec").alias("sec"))
            self._replace(last, f"values_{v}", days)

    def _merged(self, seconds: DataFrame) -> DataFrame:
        """Seconds merged to days: squares are taken around the mean of the day."""
        squares = [m for m, parts in self.measures.items() if "q" in parts]
        means = seconds.groupBy("_key", "day").agg(
            *[(F.sum(f"s_{m}") / F.nullif(F.sum(f"n_{m}").cast("double"), F.lit(0.0))).alias(f"mean_{m}") for m in squares],
            F.max("_ts").alias("_ts"),
        )
        joined = seconds.drop("_ts").join(means, ["_key", "day"])
        columns = []
        for m, parts in self.measures.items():
            for p in "nsqx":
                if p not in parts:
                    continue
                value = F.col(f"{p}_{m}")
                if p == "q":
                    merged = F.sum(_centred(F.col(f"n_{m}"), F.col(f"s_{m}"), value, F.col(f"mean_{m}")))
                else:
                    merged = F.max(value) if p == "x" else F.sum(value)
                columns.append(merged.alias(f"{p}_{m}"))
        return joined.groupBy("_key", "day", "_ts").agg(*columns)

    # --- features ---

    def latest(self, run_day: str | date, lookback_days: int = 95) -> DataFrame:
        """Key, newest time and the features as of it, from the rows of the lookback up to midnight
        of ``run_day``: what ``rolling_latest`` gives for those rows."""
        first, last = as_date(days_before(run_day, lookback_days)), as_date(days_before(run_day, 1))
        inside = F.col("day").between(F.lit(first), F.lit(last))
        opening = F.unix_seconds(instant(first))
        # rows of the opening instant of the lookback close the day before
        edge = (F.col("day") == F.lit(first - timedelta(days=1))) & (F.col("sec") == opening)
        at_edge = self._table("seconds").where(edge)
        totals = self._table("totals").where(inside).withColumn("sec", F.unix_seconds(F.col("day").cast("timestamp")))
        whole = totals.unionByName(at_edge)
        squares = [m for m, parts in self.measures.items() if "q" in parts]
        ends = whole.groupBy("_key").agg(
            F.max("_ts").alias("_last_ts"),
            whole_seconds(F.max("_ts")).alias("_last"),
            *[
                F.coalesce(F.sum(f"s_{m}") / F.nullif(F.sum(f"n_{m}").cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"shift_{m}")
                for m in squares
            ],
        )
        spans = sorted({f.days for f in self.features if f.agg != "nunique"})
        begin = lambda d: F.timestamp_seconds(F.col("_last") - d * DAY)
        edges = ends.select(
            "_key", F.inline(F.array(*[F.struct(closing_day(begin(d)).alias("day"), F.lit(d).alias("only")) for d in spans]))
        ).where(inside)
        days = [r["day"] for r in edges.select("day").distinct().collect()]  # of the lookback at most
        split = self._table("seconds").where(F.col("day").isin(days)).join(edges, ["_key", "day"])
        pieces = whole.withColumn("only", F.lit(None).cast("int")).unionByName(split.select(*whole.columns, "only"))
        pieces = pieces.drop("_ts", "day").join(ends, "_key")
        merged, finished = [], []
        for f in self.features:
            if f.agg == "nunique":
                finished.append(F.coalesce(F.col(f.name), F.lit(0)).cast("long").alias(f.name))
                continue
            # the day in which a frame begins counts by its seconds, days behind it by their totals
            counts = (F.col("sec") >= F.col("_last") - f.days * DAY) & (F.col("only").isNull() | (F.col("only") == f.days))
            merged += _merge_of(f, counts)
            finished.append(_finish_of(f))
        rolled = pieces.groupBy("_key").agg(F.max("_last_ts").alias(self.ts), *merged)
        for v in self.distinct:
            values = self._table(f"values_{v}")
            seen = values.where(inside | edge).groupBy("_key", "value").agg(F.max("sec").alias("sec")).join(ends.select("_key", "_last"), "_key")
            live = [
                F.count_if(F.col("sec") >= F.col("_last") - f.days * DAY).alias(f.name)
                for f in self.features
                if f.agg == "nunique" and f.value == v
            ]
            rolled = rolled.join(seen.groupBy("_key").agg(*live), "_key", "left")
        return rolled.select(F.col("_key").alias(self.key), self.ts, *finished)


def _merge_of(f: Rolling, counts: Column) -> list[Column]:
    """Aggregates over the pieces that count for a feature, named after it."""
    when = lambda c: F.when(counts, c)
    n, s, q = (F.col(f"{p}_{f.value}") for p in "nsq")
    if f.agg == "max":
        return [F.max(when(F.col(f"x_{f.value}"))).alias(f"{f.name}_x")]
    out = [F.coalesce(F.sum(when(n)), F.lit(0)).alias(f"{f.name}_n")]
    if f.agg != "count":
        out.append(F.sum(when(s)).alias(f"{f.name}_s"))
    if f.agg == "stddev":
        shift = F.col(f"shift_{f.value}")
        out += [F.sum(when(_centred(n, s, q, shift))).alias(f"{f.name}_q"), F.max(shift).alias(f"{f.name}_shift")]
    return out


def _finish_of(f: Rolling) -> Column:
    return _finish(f, *[F.col(f"{f.name}_{p}") for p in ("n", "s", "q", "x", "shift")])


def _runs(days: Sequence[date]) -> list[tuple[date, date]]:
    """Days as first and last of stretches without a gap."""
    out: list[tuple[date, date]] = []
    for d in sorted(set(days)):
        if out and d - out[-1][1] == timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def usable(events: DataFrame, key: str = "user_id", amount: str = "transaction_amount") -> DataFrame:
    """Events that count: with a key and a positive amount; the fraud indicator added."""
    return with_fraud_hit(events.where(F.col(key).isNotNull() & (F.col(amount) > 0)))


def incremental_feature_table(
    state: RollingState, fresh: DataFrame, events: DataFrame, run_day: str | date, lookback_days: int = 95
) -> DataFrame:
    """The feature job from kept state: ``fresh`` are the events that came since the last run, ``events``
    all that have come (of which only the days of fresh ones are read)."""
    state.refresh(usable(events, state.key), state.touched_days(fresh))
    return with_ratios(state.latest(run_day, lookback_days))
