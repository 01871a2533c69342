"""Point-in-time joins: for each spine row the newest feature row not after it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timing import DAY, bucket_of, whole_seconds
from tidemark.sources.schemas import (
    CHURN_REFS,
    CREDIT_REFS,
    FRAUD_LABEL_REFS,
    FRAUD_REFS,
    FeatureView,
    parse_refs,
)


# Rows of one key that a single task sorts without trouble; keys with more are cut.
LARGE_KEY_ROWS = 1_000_000
# Keys that a sketch of key frequencies tells apart, and those of them that can count as heavy:
# both bound what is sent to the driver and to each task.
TRACKED_KEYS = 10_000
MOST_HEAVY_KEYS = 1_000
# Pieces of one heavy key.
MOST_CUTS = 4_000


@dataclass(frozen=True)
class Lookup:
    """Features of one table to attach: output name -> column of ``table``."""

    name: str
    table: DataFrame
    fields: Mapping[str, str]
    ttl_seconds: int | None = None
    ts_col: str = "event_timestamp"
    created_col: str | None = "created_timestamp"


def point_in_time_join(
    spine: DataFrame,
    lookups: Sequence[Lookup],
    keys: Sequence[str],
    ts: str = "event_timestamp",
    bucket_seconds: int | None | str = "auto",
    large_key_rows: int = LARGE_KEY_ROWS,
) -> DataFrame:
    """Left join of ``spine`` to the newest row of each table at or before its time.

    Ties in time go to the newest creation time. A row older than the time to live
    gives nulls; a row exactly that old still counts. Spine rows are kept one for
    one, with all their columns.

    Spine and feature rows are put in one ordered sequence per key and the last
    feature row is carried to the spine rows, so no pairs are built. All tables that
    share ``keys`` go through the same shuffle.

    Keys with more than ``large_key_rows`` rows are found by a sketch of key frequencies, in
    one pass and without a shuffle. Each is cut at quantiles of its own times, so its pieces
    are even wherever its rows lie, down to a single second; see ``_heavy_join``. All other keys
    stay whole. With ``bucket_seconds`` every key is cut into time buckets of that width
    instead; with ``None`` none is.
    """
    if ts not in spine.columns:
        raise ValueError(f"the spine needs a {ts!r} column")
    keys = list(keys)
    if bucket_seconds == "auto":
        heavy = heavy_keys([spine, *[look.table for look in lookups]], keys, large_key_rows)
        if not heavy:
            return _plain_join(spine, lookups, keys, ts, None)
        hot = F.coalesce(F.xxhash64(*keys).isin(list(heavy)), F.lit(False)) & _all_set(keys)
        light = _plain_join(spine.where(~hot), [replace(k, table=k.table.where(~hot)) for k in lookups], keys, ts, None)
        some = [replace(k, table=k.table.where(hot)) for k in lookups]
        return light.unionByName(_heavy_join(spine.where(hot), some, keys, ts, heavy, large_key_rows))
    return _plain_join(spine, lookups, keys, ts, bucket_seconds)


def heavy_keys(tables: Sequence[DataFrame], keys: Sequence[str], rows: int) -> dict[int, int]:
    """Hashes of the keys with more than ``rows`` rows over all tables, with estimated counts.

    A frequency sketch that tasks merge; it misses no key with more than one in some thousands
    of all rows. Two keys of one hash are merely cut together.
    """
    together = reduce(DataFrame.unionByName, [t.where(_all_set(keys)).select(F.xxhash64(*keys).alias("h")) for t in tables])
    found = together.agg(F.expr(f"approx_top_k(h, {MOST_HEAVY_KEYS}, {TRACKED_KEYS})").alias("top")).first()["top"]
    return {r["item"]: r["count"] for r in found or () if r["count"] > rows}


def _feature_rows(lookups: Sequence[Lookup], keys: Sequence[str], bucket) -> DataFrame:
    """The rows of all tables as one: keys, bucket, time, and a struct per table."""
    out = None
    for name, look in zip(_names(lookups), lookups):
        created = F.col(look.created_col) if look.created_col else F.lit(None)
        rows = look.table.where(F.col(look.ts_col).isNotNull() & _all_set(keys)).select(
            *keys,
            bucket(look.ts_col).alias("_bucket"),
            F.col(look.ts_col).cast("timestamp").alias("_ts"),
            F.struct(
                F.col(look.ts_col).cast("timestamp").alias("_ts"),
                created.cast("timestamp").alias("_created"),
                *[F.col(c).alias(n) for n, c in look.fields.items()],
            ).alias(name),
        )
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _names(lookups: Sequence[Lookup]) -> list[str]:
    return [f"_v{i}" for i in range(len(lookups))]


def _alive(lookups: Sequence[Lookup], at: str = "_ts") -> list[Column]:
    """The output columns: what was found, unless it is older than its time to live."""
    columns = []
    for name, look in zip(_names(lookups), lookups):
        alive = F.lit(True)
        if look.ttl_seconds is not None:
            expiry = F.col(name)["_ts"] + F.make_dt_interval(secs=F.lit(look.ttl_seconds))
            alive = expiry >= F.col(at)
        columns += [F.when(alive, F.col(name)[n]).alias(n) for n in look.fields]
    return columns


def _plain_join(
    spine: DataFrame, lookups: Sequence[Lookup], keys: list[str], ts: str, bucket_seconds: int | None
) -> DataFrame:
    """All keys whole, or all cut into buckets of the same width."""

    def bucket(column: str) -> Column:
        if bucket_seconds is None:
            return F.lit(0).cast("long")
        return bucket_of(whole_seconds(column), bucket_seconds)

    # Rows without a key match nothing; they are spread by time instead of piling up.
    spread = F.when(_all_set(keys), bucket(ts)).otherwise(F.xxhash64(ts))
    spine_rows = spine.select(
        *keys,
        spread.alias("_bucket"),
        F.col(ts).cast("timestamp").alias("_ts"),
        F.struct(*[F.col(c) for c in spine.columns]).alias("_row"),
    )
    sequence = _feature_rows(lookups, keys, bucket).unionByName(spine_rows, allowMissingColumns=True)
    found = _last_before(sequence, _names(lookups), keys, bucket_seconds is not None)
    return found.select("_row.*", *_alive(lookups))


def _last_before(
    sequence: DataFrame, names: list[str], keys: list[str], cut: bool, keep: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``sequence`` with a ``_row``, each with the newest feature row of each table up to
    its time: of its own bucket or, if ``cut``, else of the buckets before it.

    Both come from the same exchange of the sequence, which is dealt out by key and bucket.
    """
    if cut:
        sequence = sequence.repartition(*keys, "_bucket")
    order = Window.partitionBy(*keys, "_bucket").orderBy(
        F.col("_ts").asc_nulls_first(), F.col("_row").isNotNull(), *names
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    found = sequence.select(
        *keys, "_bucket", "_row", "_ts", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names]
    ).where(F.col("_row").isNotNull())
    if not cut:
        return found
    # null-safe, since a plain equality would filter one use of the sequence by it and not the other
    places = [*keys, "_bucket"]
    carried = _carried(sequence, keys, names).withColumnsRenamed({c: f"_at_{c}" for c in places})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in places])
    joined = found.join(carried, same, "left")
    timed = F.col("_ts").isNotNull()  # a spine row without a time finds nothing
    return joined.select(*keep, "_row", "_ts", *[F.when(timed, F.coalesce(n, f"_before{n}")).alias(n) for n in names])


def _carried(sequence: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """For each bucket with spine rows the newest feature rows of all earlier buckets.

    The window by key sees a row per bucket: as many as the key has cuts, or buckets of time.
    """
    # Named as they are, both uses of the sequence need the same columns of the same rows, so that
    # one exchange serves both: a filter on the keys, say, would go below it and part them.
    timed = F.when(F.col("_ts").isNotNull() & _all_set(keys), F.col("_row"))
    newest = sequence.groupBy(*keys, "_bucket").agg(*[F.max(n).alias(n) for n in names], F.count(timed).alias("_wanted"))
    newest = newest.where((F.col("_wanted") > 0) | F.coalesce(*[F.col(n)["_ts"] for n in names]).isNotNull())
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    scanned = newest.select(*keys, "_bucket", "_wanted", *[F.max(n).over(before).alias(f"_before{n}") for n in names])
    return scanned.where("_wanted > 0").drop("_wanted")


def _heavy_join(
    spine: DataFrame, lookups: Sequence[Lookup], keys: list[str], ts: str, heavy: Mapping[int, int], rows: int
) -> DataFrame:
    """The join for keys that are too large for a task.

    Rows of one key and instant say the same thing, however many they are: feature rows are
    reduced to the newest of their instant and spine rows to one per instant, on the map side.
    Only those are put in order, cut at quantiles of the key's times. What is found for an instant
    then goes to all its spine rows by an equal join, in which an instant with many spine rows is
    dealt out over several copies of its answer.
    """
    h = F.xxhash64(*keys).alias("_h")
    moment = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    times = reduce(
        DataFrame.unionByName,
        [spine.select(h, moment(ts).alias("_at")), *[k.table.select(h, moment(k.ts_col).alias("_at")) for k in lookups]],
    )
    cuts = F.broadcast(_cut_points(times, heavy, rows))  # MOST_HEAVY_KEYS rows of MOST_CUTS at most

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_h", F.xxhash64(*keys)).join(cuts, "_h", "left").withColumn("_bucket", _piece(moment("_ts"))).drop("_h", "_cuts")

    names = _names(lookups)
    features = placed(_feature_rows(lookups, keys, lambda c: F.lit(0).cast("long")).drop("_bucket"))
    features = features.groupBy(*keys, "_bucket", "_ts").agg(*[F.max(n).alias(n) for n in names])
    instants = spine.select(*keys, F.col(ts).cast("timestamp").alias("_ts")).where(F.col("_ts").isNotNull())
    counted = instants.groupBy(*keys, "_ts").agg(F.count(F.lit(1)).alias("_n"))
    wanted = placed(counted).withColumn("_row", F.struct("_ts", "_n")).drop("_n")
    found = _last_before(features.unionByName(wanted, allowMissingColumns=True), names, keys, True, keep=keys)
    answers = found.select(*keys, F.col("_ts").alias("_at"), F.explode(F.sequence(F.lit(0), _copies(F.col("_row")["_n"], rows) - 1)).alias("_copy"), *names)
    # instants with more spine rows than a task should take: no more than all rows by ``rows``
    crowded = counted.where(F.col("_n") > rows).select(*keys, F.col("_ts").alias("_at"), _copies(F.col("_n"), rows).alias("_copies"))
    own = spine.withColumn("_at", F.col(ts).cast("timestamp")).withColumn("_luck", F.rand(7))
    own = own.join(F.broadcast(crowded), [*keys, "_at"], "left")
    own = own.withColumn("_copy", F.floor(F.col("_luck") * F.coalesce("_copies", F.lit(1))).cast("int")).drop("_copies", "_luck")
    joined = own.join(answers, [*keys, "_at", "_copy"], "left")
    return joined.select(*spine.columns, *_alive(lookups, "_at"))


def _copies(n: Column, rows: int) -> Column:
    return F.ceil(n / rows).cast("int")


def _cut_points(times: DataFrame, heavy: Mapping[int, int], rows: int) -> DataFrame:
    """(_h, _cuts): times at which each heavy key is cut, in pieces of about ``rows`` rows."""
    most = min(MOST_CUTS, max(1, -(-max(heavy.values()) // rows)))
    shares = [i / most for i in range(1, most)] or [0.5]
    quantiles = times.where(F.col("_at").isNotNull()).groupBy("_h").agg(
        F.percentile_approx("_at", [float(s) for s in shares], 20 * (most + 10)).alias("_cuts")
    )
    return quantiles.select("_h", F.array_sort(F.array_distinct("_cuts")).alias("_cuts"))


def _piece(at: Column) -> Column:
    """How many cuts lie before a time: whole groups of cuts first, then those of one group."""
    step = 32
    cuts = F.coalesce(F.col("_cuts"), F.array().cast("array<bigint>"))
    firsts = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / step).cast("int")), lambda i: F.get(cuts, i * step))
    groups = F.greatest(F.size(F.filter(firsts, lambda c: c < at)) - 1, F.lit(0))
    inside = F.slice(cuts, groups * step + 1, F.lit(step))
    return (groups * step + F.size(F.filter(inside, lambda c: c < at))).cast("long")


def _all_set(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).isNotNull()
    return condition


def historical_features(
    spine: DataFrame,
    refs: Sequence[str],
    views: Mapping[str, tuple[FeatureView, DataFrame]],
    ts: str = "event_timestamp",
    bucket_seconds: int | None | str = "auto",
    large_key_rows: int = LARGE_KEY_ROWS,
) -> DataFrame:
    """Spine plus the features named by ``view:feature`` references.

    A feature takes its bare name, or ``view__feature`` where that name is taken by a
    spine column or by a feature asked for earlier. Views with the same keys share one
    shuffle.
    """
    taken = set(spine.columns)
    by_keys: dict[tuple[str, ...], list[Lookup]] = {}
    order: list[str] = []
    for view_name, features in parse_refs(refs).items():
        if view_name not in views:
            raise KeyError(f"unknown feature view {view_name!r}")
        view, table = views[view_name]
        unknown = [f for f in features if f not in view.fields]
        if unknown:
            raise KeyError(f"view {view_name!r} has no feature {unknown[0]!r}")
        fields = {}
        for feature in features:
            name = feature if feature not in taken else f"{view_name}__{feature}"
            taken.add(name)
            fields[name] = feature
            order.append(name)
        by_keys.setdefault(view.keys, []).append(
            Lookup(
                view_name,
                table,
                fields,
                None if view.ttl_days is None else view.ttl_days * DAY,
                view.ts_col,
                view.created_col,
            )
        )
    out = spine
    for keys, lookups in by_keys.items():
        missing = [k for k in keys if k not in spine.columns]
        if missing:
            raise ValueError(f"the spine needs key column {missing[0]!r}")
        out = point_in_time_join(out, lookups, keys, ts, bucket_seconds, large_key_rows)
    return out.select(*spine.columns, *order)


def training_set(
    spine: DataFrame,
    refs: Sequence[str],
    views: Mapping[str, tuple[FeatureView, DataFrame]],
    label: str | None = None,
    **options,
) -> DataFrame:
    """Keys, time, features and, if the spine has it, the label column.

    The label travels with its spine row, so two entities that share a time cannot
    mix their labels. Other spine columns are dropped.
    """
    ts = options.get("ts", "event_timestamp")
    joined = historical_features(spine, refs, views, **options)
    keys = {k for name in parse_refs(refs) for k in views[name][0].keys}
    kept = [c for c in spine.columns if c in keys or c == ts or c == label]
    return joined.select(*kept, *[c for c in joined.columns if c not in spine.columns])


def fraud_training_set(spine: DataFrame, views: Mapping, **options) -> DataFrame:
    return training_set(spine, [*FRAUD_REFS, *FRAUD_LABEL_REFS], views, "is_fraud", **options)


def credit_training_set(spine: DataFrame, views: Mapping, **options) -> DataFrame:
    return training_set(spine, CREDIT_REFS, views, **options)


def churn_training_set(spine: DataFrame, views: Mapping, **options) -> DataFrame:
    return historical_features(spine, CHURN_REFS, views, **options)
