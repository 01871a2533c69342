"""Cumulative counts of two samples over the sorted distinct values of each feature.

This one table answers KS, Wasserstein, exact percentiles, PSI, ROC AUC and average
precision. The order over all values is global, so it is built in two levels: values
are cut into buckets at approximate quantiles, running counts are taken inside each
bucket, and the totals of the earlier buckets are added. The cut points only balance
the work; the counts are exact for any cut points. Where only a maximum or a few ranks
are asked for, the bucket totals show which buckets need to be looked into at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REFERENCE, CURRENT = 0, 1
SIDE = "_side"
# Fine enough to leave most buckets out of a search, coarse enough for the driver.
BUCKETS = 256


def two_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The shared columns of two tables as one table, tagged by sample."""
    return (
        reference.select(*columns).withColumn(SIDE, F.lit(REFERENCE))
        .unionByName(current.select(*columns).withColumn(SIDE, F.lit(CURRENT)))
    )


def real_value(column: str) -> Column:
    """The column as double, with NaN read as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


@dataclass(frozen=True)
class Summary:
    """What one pass tells about a numeric feature; a bounded number of doubles."""

    feature: str
    n0: int
    n1: int
    mean0: float | None
    mean1: float | None
    std0: float | None
    std1: float | None
    low: float | None
    high: float | None
    cuts: Sequence[float]


def summarize(pair: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> list[Summary]:
    """Sizes, means, population deviations, pooled range and cut points, in one pass.

    ``buckets`` is the number of parts the values are cut into; a table of very many
    distinct values on a large cluster may want some thousands.
    """
    wide = _wide(pair, columns)
    shares = F.expr(f"array({', '.join(f'{i / buckets:.9f}D' for i in range(1, buckets))})")

    def part(i: int) -> Column:
        x = F.col(f"_x{i}")
        in0, in1 = (F.when(F.col(SIDE) == side, x) for side in (REFERENCE, CURRENT))
        return F.struct(
            F.count(in0).alias("n0"),
            F.count(in1).alias("n1"),
            F.avg(in0).alias("mean0"),
            F.avg(in1).alias("mean1"),
            F.stddev_pop(in0).alias("std0"),
            F.stddev_pop(in1).alias("std1"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
            F.percentile_approx(x, shares, F.lit(20 * buckets)).alias("cuts"),
        ).alias(f"s{i}")

    row = wide.agg(*[part(i) for i in range(len(columns))]).first()
    found = []
    for i, c in enumerate(columns):
        values = row[i].asDict()
        finite = {x for x in values.pop("cuts") or [] if abs(x) != float("inf")}
        found.append(Summary(feature=c, cuts=tuple(sorted(finite)), **values))
    return found


def _wide(pair: DataFrame, columns: Sequence[str]) -> DataFrame:
    return pair.select(
        F.col(SIDE), *[real_value(c).alias(f"_x{i}") for i, c in enumerate(columns)]
    )


def _side_counts() -> list[Column]:
    return [
        F.count_if(F.col(SIDE) == REFERENCE).alias("n0"),
        F.count_if(F.col(SIDE) == CURRENT).alias("n1"),
    ]


@dataclass(frozen=True)
class Bucket:
    """Exact totals of one bucket of a feature, and of all buckets before it."""

    feature: str
    bucket: int
    n0: int
    n1: int
    before0: int
    before1: int
    tot0: int
    tot1: int
    next_first: float | None

    def holds(self, rank: int) -> bool:
        return self.before0 <= rank < self.before0 + self.n0


def _placed(pair: DataFrame, columns: Sequence[str], summaries: Sequence[Summary]) -> DataFrame:
    """Values ``_x<i>`` and their buckets ``_b<i>`` between the cut points."""
    infinity = float("inf")
    return Bucketizer(
        splitsArray=[[-infinity, *(s.cuts or (0.0,)), infinity] for s in summaries],
        inputCols=[f"_x{i}" for i in range(len(columns))],
        outputCols=[f"_b{i}" for i in range(len(columns))],
        handleInvalid="keep",
    ).transform(_wide(pair, columns))


def _long(placed: DataFrame, wanted: Sequence[Column | None]) -> DataFrame:
    """Rows (side, feature number, bucket, value) of the wanted values of each column."""
    entries = []
    for i, keep in enumerate(wanted):
        value = F.col(f"_x{i}")
        entries.append(
            F.struct(
                F.lit(i).alias("no"),
                F.col(f"_b{i}").cast("int").alias("bucket"),
                (value if keep is None else F.when(keep, value)).alias("value"),
            )
        )
    return placed.select(SIDE, F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def bucket_totals(
    pair: DataFrame, columns: Sequence[str], summaries: Sequence[Summary]
) -> list[Bucket]:
    """Totals per feature and bucket, on the driver: their number is bounded.

    Each task merges its rows to one per bucket, so next to nothing is shuffled.
    """
    rows = (
        _long(_placed(pair, columns, summaries), [None] * len(columns))
        .groupBy("no", "bucket")
        .agg(*_side_counts(), F.min("value").alias("first"))
        .orderBy("no", "bucket")
        .collect()
    )
    found = []
    for no, group in groupby(rows, key=lambda r: r["no"]):
        group = list(group)
        tot0, tot1 = sum(r["n0"] for r in group), sum(r["n1"] for r in group)
        before0 = before1 = 0
        for r, after in zip(group, [*group[1:], None]):
            found.append(
                Bucket(
                    columns[no], r["bucket"], r["n0"], r["n1"], before0, before1, tot0, tot1,
                    after["first"] if after else None,
                )
            )
            before0, before1 = before0 + r["n0"], before1 + r["n1"]
    return found


def cumulative_counts(
    pair: DataFrame,
    columns: Sequence[str],
    summaries: Sequence[Summary] | None = None,
    buckets: Sequence[Bucket] | None = None,
    kept: Sequence[Bucket] | None = None,
    ranks: Mapping[str, set[int]] | None = None,
) -> DataFrame:
    """One row per (feature, value) with the counts of both samples up to that value.

    ``n0``/``n1`` count the value itself, ``cum0``/``cum1`` all values up to and
    including it, ``tot0``/``tot1`` the samples; ``next_value`` is the next larger
    value. Repeated values are merged before the shuffle, so a value that fills a third
    of the table is no hot spot. ``kept`` limits the rows to some of the buckets.
    ``hits`` lists which of the wanted 0-based ``ranks`` of the reference the value holds.
    """
    summaries = summaries or summarize(pair, columns)
    buckets = buckets if buckets is not None else bucket_totals(pair, columns, summaries)
    wanted: list[Column | None] = [None] * len(columns)
    if kept is not None:
        for i, c in enumerate(columns):
            mine = [b.bucket for b in kept if b.feature == c]
            if len(mine) < sum(b.feature == c for b in buckets):
                wanted[i] = F.col(f"_b{i}").isin(mine) if mine else F.lit(False)
    counts = (
        _long(_placed(pair, columns, summaries), wanted)
        .groupBy("no", "bucket", "value")
        .agg(*_side_counts())
    )
    inside = Window.partitionBy("no", "bucket").orderBy("value")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    number = {c: i for i, c in enumerate(columns)}
    starts = small_table(
        pair.sparkSession,
        "no int, bucket int, feature string, before0 bigint, before1 bigint, "
        "tot0 bigint, tot1 bigint, next_first double, ranks longs",
        [
            (number[b.feature], b.bucket, b.feature, b.before0, b.before1, b.tot0, b.tot1, b.next_first,
             sorted(r for r in (ranks or {}).get(b.feature, ()) if b.holds(r)))
            for b in buckets
        ],
    )
    cum0 = F.col("before0") + F.col("run0")
    return (
        counts.select(
            "*",
            F.sum("n0").over(running).alias("run0"),
            F.sum("n1").over(running).alias("run1"),
            F.lead("value").over(inside).alias("next_inside"),
        )
        .join(F.broadcast(starts), ["no", "bucket"])
        .select(
            "feature",
            "value",
            "n0",
            "n1",
            cum0.alias("cum0"),
            (F.col("before1") + F.col("run1")).alias("cum1"),
            "tot0",
            "tot1",
            F.coalesce("next_inside", "next_first").alias("next_value"),
            F.filter("ranks", lambda r: (r < cum0) & (r >= cum0 - F.col("n0"))).alias("hits"),
        )
    )


def needed_buckets(
    buckets: Sequence[Bucket], ranks: Mapping[str, set[int]] | None = None
) -> list[Bucket]:
    """Buckets that can hold the largest gap or one of the wanted ranks.

    The gap is known at the end of every bucket. Inside a bucket it can rise at most by
    the bucket's share of one sample and fall by its share of the other, so a bucket
    whose bound stays below the best known gap cannot matter. Leaving it out is exact.
    """
    kept = []
    for feature, group in groupby(buckets, key=lambda b: b.feature):
        group = list(group)
        wanted = (ranks or {}).get(feature, ())
        best = known_gap(group)
        kept += [b for b in group if _gap_bound(b) > best or any(b.holds(r) for r in wanted)]
    return kept


def known_gap(group: Sequence[Bucket]) -> float:
    """Largest gap at the bucket ends of one feature; 0 if a sample is empty."""
    n0, n1 = group[0].tot0, group[0].tot1
    if not n0 or not n1:
        return 0.0
    return max(abs((b.before0 + b.n0) / n0 - (b.before1 + b.n1) / n1) for b in group)


def _gap_bound(b: Bucket) -> float:
    if not b.tot0 or not b.tot1:
        return 0.0
    high = (b.before0 + b.n0) / b.tot0 - b.before1 / b.tot1
    low = b.before0 / b.tot0 - (b.before1 + b.n1) / b.tot1
    return max(abs(high), abs(low))


def percentile_ranks(n: int, bins: int) -> list[tuple[int, int, float]]:
    """For the percentiles 0, 1/bins, ..., 1 of ``n`` values: lower rank, upper rank, fraction."""
    if not n:
        return []
    places = [(n - 1) * (i * (100.0 / bins) / 100.0 if i < bins else 1.0) for i in range(bins + 1)]
    return [(math.floor(p), math.ceil(p), p - math.floor(p)) for p in places]


def ecdf_gap() -> Column:
    """Distance of the two distribution functions at a value; null if a sample is empty."""
    return F.abs(
        F.col("cum0") / F.nullif(F.col("tot0").cast("double"), F.lit(0.0))
        - F.col("cum1") / F.nullif(F.col("tot1").cast("double"), F.lit(0.0))
    )


def bounded_profile(cumulative: DataFrame) -> DataFrame:
    """One row per feature: largest gap, area between the curves, values at wanted ranks.

    ``found`` has one (rank, value) per wanted rank, so its length is bounded.
    """
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    at_ranks = F.transform("hits", lambda r: F.struct(r.alias("rank"), F.col("value").alias("value")))
    return cumulative.groupBy("feature").agg(
        F.coalesce(F.max(ecdf_gap()), F.lit(0.0)).alias("statistic"),
        F.sum(ecdf_gap() * step).alias("distance"),
        F.flatten(F.collect_list(F.when(F.size("hits") > 0, at_ranks))).alias("found"),
    )


def interpolated_edges(n: int, bins: int, values: Mapping[int, float]) -> tuple[float, ...]:
    """Percentile edges from the values at their ranks: ascending, repeats collapsed."""
    edges: list[float] = []
    for low, high, part in percentile_ranks(n, bins):
        edge = values[low] if low == high else values[low] + (values[high] - values[low]) * part
        if not edges or edge != edges[-1]:
            edges.append(edge)
    return tuple(edges)


def bin_on_edges(value: Column, edges: Sequence[float]) -> Column:
    """0-based bin of a value on ascending edges: ``[a, b)``, the last bin closed.

    Null outside the edges or with fewer than two of them. Plain comparisons, so the
    expression stays in generated code.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    number = reduce(
        lambda a, b: a + b, [(value >= F.lit(e)).cast("int") for e in edges[1:-1]], F.lit(0)
    )
    return F.when(value.between(edges[0], edges[-1]), number)


def bin_equal_width(value: Column, low: float | None, high: float | None, bins: int) -> Column:
    """0-based bin of a value on ``bins`` equal parts of a range."""
    if low is None:
        return F.lit(None).cast("int")
    if low == high:
        return F.when(value.isNotNull(), 0)
    width = F.lit(high - low)
    return F.least(F.floor((value - F.lit(low)) / width * bins), F.lit(bins - 1)).cast("int")


def bin_counts(
    pair: DataFrame, columns: Sequence[str], number: Callable[[int, Column], Column]
) -> DataFrame:
    """Counts of both samples per (feature, bin): one scan, merged before the shuffle.

    ``number`` gives the bin of the i-th column's value.
    """
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), number(i, F.col(f"_x{i}")).cast("int").alias("bin"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        _wide(pair, columns)
        .select(SIDE, F.inline(entries))
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(*_side_counts())
    )


def histogram(pair: DataFrame, edges: Mapping[str, Sequence[float]], filled: DataFrame | None = None) -> DataFrame:
    """Counts of both samples in every bin of each feature's edges, empty bins included.

    ``filled`` gives the counts of bins with values, if they are known already."""
    columns = list(edges)
    if filled is None:
        filled = bin_counts(pair, columns, lambda i, x: bin_on_edges(x, edges[columns[i]]))
    every = small_table(
        pair.sparkSession,
        "feature string, bin int, low double, high double",
        [
            (c, b, float(e[b]), float(e[b + 1]))
            for c, e in edges.items()
            for b in range(len(e) - 1)
        ],
    )
    return every.join(filled, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        "low",
        "high",
        F.coalesce("n0", F.lit(0)).alias("n0"),
        F.coalesce("n1", F.lit(0)).alias("n1"),
    )


def small_table(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A result table of a few rows, as a local relation of the plan."""
    fields = [part.split() for part in schema.split(", ")]
    arrays = [
        pa.array([r[i] for r in rows], type=ARROW_TYPES[kind]) for i, (_, kind) in enumerate(fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[name for name, _ in fields]))


ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "longs": pa.list_(pa.int64()),
    "doubles": pa.list_(pa.float64()),
}
