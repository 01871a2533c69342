"""Trailing-window features per entity.

A frame of ``days`` days at a row at second ``t`` holds the rows of the same key
at seconds ``t - days*86400`` to ``t``, both ends included; rows in the same
second see each other. Four ways to compute the same numbers:

``rolling_windows``
    Plain range windows, one shuffle by key. Spark re-reads the frame for each
    row, so this suits keys with at most a few thousand rows per frame.
``rolling_split``
    For dense or skewed keys. Rows are spread by (key, time bucket), so no task
    holds a whole key, and the work per row does not grow with the frame.
``rolling_features``
    Measures which keys are dense, splits those and leaves the rest to plain windows.
``rolling_latest``
    Only the newest row per key: aggregates by (key, second) before anything is
    gathered by key, with no frame scans at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import sample_variance
from tidemark.functions.timing import DAY, bucket_of, days_before, instant, whole_seconds

# Rows per key up to which plain windows are the cheaper form.
DENSE_KEY_ROWS = 5_000
# Number of key names that is safe to broadcast.
MOST_BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Rolling:
    """One output column: ``agg`` of ``value`` over the trailing ``days``.

    ``agg`` is count, sum, mean, max, stddev (sample) or nunique.
    """

    name: str
    agg: str
    value: str
    days: int


# The transaction feature set. ``fraud_hit`` is 1 for a fraud row, else 0.
TRANSACTION_FEATURES = (
    Rolling("tx_count_7d", "count", "event_id", 7),
    Rolling("tx_amount_sum_7d", "sum", "transaction_amount", 7),
    Rolling("tx_amount_mean_7d", "mean", "transaction_amount", 7),
    Rolling("tx_amount_max_7d", "max", "transaction_amount", 7),
    Rolling("tx_count_30d", "count", "event_id", 30),
    Rolling("tx_amount_sum_30d", "sum", "transaction_amount", 30),
    Rolling("tx_amount_mean_30d", "mean", "transaction_amount", 30),
    Rolling("tx_amount_stddev_30d", "stddev", "transaction_amount", 30),
    Rolling("fraud_tx_count_30d", "sum", "fraud_hit", 30),
    Rolling("distinct_merchant_categories_30d", "nunique", "merchant_category", 30),
    Rolling("tx_count_90d", "count", "event_id", 90),
    Rolling("tx_amount_sum_90d", "sum", "transaction_amount", 90),
    Rolling("tx_amount_mean_90d", "mean", "transaction_amount", 90),
    Rolling("tx_amount_stddev_90d", "stddev", "transaction_amount", 90),
)

# The declared spend view. ``label_hit`` is the resolved label as 0/1, null
# while unresolved; ``international_hit`` is the international flag as 0/1.
SPEND_FEATURES = (
    Rolling("avg_spend_7d", "mean", "amount", 7),
    Rolling("total_spend_7d", "sum", "amount", 7),
    Rolling("transaction_count_7d", "count", "transaction_id", 7),
    Rolling("transaction_count_30d", "count", "transaction_id", 30),
    Rolling("avg_spend_30d", "mean", "amount", 30),
    Rolling("std_spend_30d", "stddev", "amount", 30),
    Rolling("fraud_rate_90d", "mean", "label_hit", 90),
    Rolling("fraud_count_90d", "sum", "label_hit", 90),
    Rolling("unique_merchants_30d", "nunique", "merchant_id", 30),
    Rolling("max_single_spend_30d", "max", "amount", 30),
    Rolling("international_txn_ratio_30d", "mean", "international_hit", 30),
)

HIGH_VALUE_MEAN = 500.0  # fixed value: 90-day mean above which a customer is high value


def with_fraud_hit(df: DataFrame, flag: str = "is_fraud") -> DataFrame:
    return df.withColumn("fraud_hit", F.when(F.col(flag), 1).otherwise(0))


def clean_events(
    df: DataFrame,
    run_day: str | date,
    key: str = "user_id",
    ts: str = "event_timestamp",
    amount: str = "transaction_amount",
    lookback_days: int = 95,
) -> DataFrame:
    """Rows of the lookback up to midnight of ``run_day`` with a key and a positive amount."""
    return df.where(
        F.col(ts).between(instant(days_before(run_day, lookback_days)), instant(run_day))
        & F.col(key).isNotNull()
        & (F.col(amount) > 0)
    )


def with_ratios(df: DataFrame) -> DataFrame:
    """The derived columns of the transaction set, from the finished aggregates."""
    count7, count30 = (F.col(f"tx_count_{d}d").cast("double") for d in (7, 30))
    return df.withColumns(
        {
            "tx_amount_7d_30d_ratio": F.col("tx_amount_sum_7d")
            / F.nullif(F.col("tx_amount_sum_30d"), F.lit(0.0)),
            "tx_count_7d_30d_ratio": count7 / F.nullif(count30, F.lit(0.0)),
            "is_high_value_customer": F.col("tx_amount_mean_90d") > HIGH_VALUE_MEAN,
        }
    )


def labelled_transactions(
    df: DataFrame, labels: DataFrame, label: str = "is_fraud", international: str = "is_international"
) -> DataFrame:
    """Transactions with resolved labels attached, ready for ``SPEND_FEATURES``."""
    resolved = labels.select("transaction_id", F.col(label).cast("int").alias("label_hit"))
    return df.join(resolved, "transaction_id", "left").withColumn(
        "international_hit", F.col(international).cast("int")
    )


# --- plain windows ---------------------------------------------------------------------


def trailing(key: str, seconds: str, days: int):
    return Window.partitionBy(key).orderBy(seconds).rangeBetween(-days * DAY, 0)


def _over(feature: Rolling, window) -> Column:
    value = F.col(feature.value)
    if feature.agg == "nunique":
        return F.size(F.collect_set(value).over(window)).cast("long")
    whole = {
        "count": F.count,
        "sum": F.sum,
        "mean": F.avg,
        "max": F.max,
        "stddev": F.stddev_samp,
    }[feature.agg]
    return whole(value).over(window)


def rolling_windows(
    df: DataFrame, features: Sequence[Rolling], key: str = "user_id", ts: str = "event_timestamp"
) -> DataFrame:
    """``df`` plus one column per feature: one exchange, one sort, one window step."""
    timed = df.withColumn("_sec", whole_seconds(ts))
    columns = [_over(f, trailing(key, "_sec", f.days)).alias(f.name) for f in features]
    return timed.select("*", *columns).drop("_sec")


# --- mergeable state -------------------------------------------------------------------


def _measures(features: Sequence[Rolling]) -> dict[str, set[str]]:
    """Which parts of the state (n, s, q, x) each measure needs; nunique is apart."""
    parts = {"count": "n", "sum": "ns", "mean": "ns", "stddev": "nsq", "max": "x"}
    needed: dict[str, set[str]] = {}
    for f in features:
        if f.agg != "nunique":
            needed.setdefault(f.value, set()).update(parts[f.agg])
    return needed


def _state(measure: str, parts: set[str], value: Column) -> dict[str, Column]:
    """Aggregates of a measure: n count, s sum, q squares around its own mean, x maximum."""
    made = {
        "n": F.count(value),
        "s": F.sum(value),
        "q": F.var_pop(value) * F.count(value),
        "x": F.max(value),
    }
    return {f"{p}_{measure}": made[p] for p in "nsqx" if p in parts}


def _centred(n: Column, s: Column, q: Column, shift: Column) -> Column:
    """Squares around the own mean moved to squares around ``shift``; 0 for no rows."""
    gap = s / F.nullif(n.cast("double"), F.lit(0.0)) - shift
    return F.coalesce(q + n * gap * gap, F.lit(0.0))


def _finish(feature: Rolling, n, s, q, x, shift) -> Column:
    if feature.agg == "count":
        out = n
    elif feature.agg == "sum":
        out = s
    elif feature.agg == "mean":
        out = s / F.nullif(n.cast("double"), F.lit(0.0))
    elif feature.agg == "max":
        out = x
    else:
        out = F.sqrt(sample_variance(n, s, q, shift))
    return out.alias(feature.name)


def _distinct_features(features: Sequence[Rolling]) -> list[tuple[str, int]]:
    """The (column, days) of the distinct counts, each once."""
    return list(dict.fromkeys((f.value, f.days) for f in features if f.agg == "nunique"))


def _sum_parts(parts: Sequence[Column]) -> Column:
    """Null-safe sum that is null only if all parts are."""
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total)


# --- split by time bucket --------------------------------------------------------------


def rolling_split(
    df: DataFrame,
    features: Sequence[Rolling],
    key: str = "user_id",
    ts: str = "event_timestamp",
    bucket_seconds: int = 3_600,
) -> DataFrame:
    """``rolling_windows`` for keys too dense for one task.

    With buckets that divide a day, the frame of a row in bucket ``b`` is made of

    * the rows of ``b`` up to the row (a running aggregate),
    * the whole buckets between, from a table with one row per key and bucket,
    * the tail of bucket ``b - days``, whose rows are sent to ``b`` as copies moved
      forward by ``days``, so that one running aggregate from the back gives the
      tail of each row.

    All heavy steps are keyed by (key, bucket). Nothing is subtracted, so maxima
    work the same way and no digits cancel. Rows without a time have each other as
    their frame, per key, as in ``rolling_windows``.
    """
    if DAY % bucket_seconds:
        raise ValueError("bucket_seconds must divide a day")
    per_day = DAY // bucket_seconds
    measures = _measures(features)
    spans = sorted({f.days for f in features if f.agg != "nunique"})
    distinct = _distinct_features(features)
    untimed = _untimed(df.where(F.col(ts).isNull()), features, key)
    timed = df.where(F.col(ts).isNotNull()).withColumn("_sec", whole_seconds(ts)).withColumn(
        "_bucket", bucket_of(F.col("_sec"), bucket_seconds)
    )

    # Rows at home (_span 0) and their copies in the buckets where they form a tail.
    own = F.col("_span") == 0
    rows = timed.select(
        F.col(key).alias("_key"),
        "_sec",
        "_bucket",
        *measures,
        F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
        F.explode(F.array(*[F.lit(d) for d in [0, *spans]])).alias("_span"),
    ).select(
        "_key",
        (F.col("_sec") + F.col("_span") * DAY).alias("_sec"),
        (F.col("_bucket") + F.col("_span") * per_day).alias("_bucket"),
        *measures,
        F.when(own, F.col("_row")).alias("_row"),
        "_span",
        *[F.lit(0).cast("long").alias(f"_step{i}") for i in range(len(distinct))],
    )

    totals = timed.groupBy(F.col(key).alias("_key"), "_bucket").agg(
        *[
            c.alias(n)
            for m, parts in measures.items()
            for n, c in _state(m, parts, F.col(m)).items()
        ],
        F.lit(True).alias("held"),
        *[F.lit(0).cast("long").alias(f"_step{i}") for i in range(len(distinct))],
    )
    for i, (value, days) in enumerate(distinct):
        steps = _distinct_steps(timed, key, value, days, bucket_seconds).withColumnRenamed("_step", f"_step{i}")
        rows = rows.unionByName(
            steps.withColumn("_span", F.lit(-1)), allowMissingColumns=True
        )
        totals = (
            totals.unionByName(
                steps.groupBy("_key", "_bucket").agg(F.sum(f"_step{i}").alias(f"_step{i}")),
                allowMissingColumns=True,
            )
            .groupBy("_key", "_bucket")
            .agg(
                *[F.max(c).alias(c) for c in totals.columns if c[0] != "_"],
                *[F.sum(f"_step{j}").alias(f"_step{j}") for j in range(len(distinct))],
            )
        )

    middle = _middle_buckets(totals, features, per_day, len(distinct))

    # Running aggregates within (key, bucket): forward for the row's own bucket, backward
    # for the moved copies.
    place = Window.partitionBy("_key", "_bucket")
    ahead = place.orderBy(F.col("_sec")).rangeBetween(Window.unboundedPreceding, 0)
    back = place.orderBy(F.col("_sec").desc()).rangeBetween(Window.unboundedPreceding, 0)
    forward = [
        c.over(ahead).alias(f"here_{n}")
        for m, parts in measures.items()
        for n, c in _windowed_state(m, parts, F.when(own, F.col(m)), ahead).items()
    ]
    tails = [
        c.over(back).alias(f"tail{d}_{n}")
        for d in spans
        for m, parts in _measures([f for f in features if f.days == d]).items()
        for n, c in _windowed_state(m, parts, F.when(F.col("_span") == d, F.col(m)), back).items()
    ]
    # copies and steps that no row shares a bucket with go before the aggregates; in the order of
    # ``ahead``, so that one sort serves both
    whole = place.orderBy(F.col("_sec")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", F.max(own).over(whole).alias("_met")).where("_met").drop("_met")
    rows = rows.select(
        "*", *forward, *[F.sum(f"_step{i}").over(ahead).alias(f"here_step{i}") for i in range(len(distinct))]
    ).select("*", *tails)
    joined = rows.where(own).join(
        middle,
        F.col("_key").eqNullSafe(F.col("_mid_key")) & (F.col("_bucket") == F.col("_mid_bucket")),
        "left",
    )

    columns = []
    for f in features:
        if f.agg == "nunique":
            i = distinct.index((f.value, f.days))
            live = F.coalesce(F.col(f"here_step{i}"), F.lit(0)) + F.coalesce(F.col(f"mid_step{i}"), F.lit(0))
            columns.append(live.cast("long").alias(f.name))
            continue
        places = ("here", f"tail{f.days}", f"mid{f.days}")
        shift = F.col(f"shift_{f.value}") if "q" in measures[f.value] else F.lit(0.0)

        def gather(part, value=f.value, places=places):
            return [F.col(f"{p}_{part}_{value}") for p in places]

        n = s = q = x = None
        if f.agg == "max":
            x = F.greatest(*gather("x"))
        else:
            n = F.coalesce(_sum_parts(gather("n")), F.lit(0)).cast("long")
        if f.agg in ("sum", "mean", "stddev"):
            s = F.when(n > 0, _sum_parts(gather("s")))
        if f.agg == "stddev":
            ends = []
            for p in places[:2]:
                n_p, s_p, var_p = (F.col(f"{p}_{part}_{f.value}") for part in "nsq")
                ends.append(_centred(n_p, s_p, var_p * n_p, shift))
            q = ends[0] + ends[1] + F.coalesce(F.col(f"mid{f.days}_q_{f.value}"), F.lit(0.0))
        columns.append(_finish(f, n, s, q, x, shift))
    timed_rows = joined.select("_row", *columns).select("_row.*", *[f.name for f in features])
    return timed_rows.unionByName(untimed)


def _untimed(df: DataFrame, features: Sequence[Rolling], key: str) -> DataFrame:
    """Rows without a time, whose frame is all such rows of their key: one aggregate, joined."""
    per_key = df.groupBy(F.col(key).alias("_untimed_key")).agg(
        *[_WHOLE[f.agg](F.col(f.value)).alias(f"_untimed_{f.name}") for f in features]
    )
    joined = df.join(per_key, F.col(key).eqNullSafe(F.col("_untimed_key")), "left")
    return joined.select(*df.columns, *[F.col(f"_untimed_{f.name}").alias(f.name) for f in features])


_WHOLE = {
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "max": F.max,
    "stddev": F.stddev_samp,
    "nunique": F.count_distinct,
}


def _windowed_state(measure: str, parts: set[str], value: Column, window) -> dict[str, Column]:
    """State as bare aggregates; ``q`` stays a population variance until it is unpacked."""
    made = {"n": F.count(value), "s": F.sum(value), "q": F.var_pop(value), "x": F.max(value)}
    return {f"{p}_{measure}": made[p] for p in "nsqx" if p in parts}


def _middle_buckets(totals: DataFrame, features: Sequence[Rolling], per_day: int, distinct: int) -> DataFrame:
    """Aggregates of the whole buckets strictly between a bucket and its tail, per span.

    Has one row per key and bucket, so a window by key stays small: its rows are
    bounded by the number of buckets in the time range read. The frame of a span is that of
    the next shorter one and the buckets before it, so each bucket is merged once for all spans.
    Buckets that hold steps alone are in no frame: they go once the steps are summed.
    """
    by_key = Window.partitionBy("_key")
    ordered = by_key.orderBy("_bucket")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    squares = [m for m, parts in _measures(features).items() if "q" in parts]
    stepped = totals.select("*", *[F.sum(f"_step{i}").over(before).alias(f"mid_step{i}") for i in range(distinct)])
    out = stepped.where("held").select(
        "*",
        *[
            (F.sum(f"s_{m}").over(by_key) / F.nullif(F.sum(f"n_{m}").over(by_key).cast("double"), F.lit(0.0)))
            .alias(f"shift_{m}")
            for m in squares
        ],
    ).withColumns(
        {
            f"q_{m}": _centred(F.col(f"n_{m}"), F.col(f"s_{m}"), F.col(f"q_{m}"), F.col(f"shift_{m}"))
            for m in squares
        }
    )
    merge = {"n": F.sum, "s": F.sum, "q": F.sum, "x": F.max}
    spans = sorted({f.days for f in features if f.agg != "nunique"})
    pieces, last = [], -1
    for d in spans:
        frame = ordered.rangeBetween(-(d * per_day - 1), last)
        last = -d * per_day
        pieces += [
            merge[p](f"{p}_{m}").over(frame).alias(f"piece{d}_{p}_{m}")
            for m, parts in _measures([f for f in features if f.days >= d]).items()
            for p in "nsqx"
            if p in parts
        ]
    out = out.select(
        F.col("_key").alias("_mid_key"),
        F.col("_bucket").alias("_mid_bucket"),
        *[f"shift_{m}" for m in squares],
        *pieces,
        *[f"mid_step{i}" for i in range(distinct)],
    )

    def joined(d: int, p: str, m: str) -> Column:
        parts = [F.col(f"piece{e}_{p}_{m}") for e in spans if e <= d]
        if len(parts) > 1:
            total = F.greatest(*parts) if p == "x" else _sum_parts(parts)
            parts = [total.cast(out.schema[f"piece{d}_{p}_{m}"].dataType)]
        return parts[0].alias(f"mid{d}_{p}_{m}")

    return out.select(
        *[c for c in out.columns if not c.startswith("piece")],
        *[
            joined(d, p, m)
            for d in spans
            for m, parts in _measures([f for f in features if f.days == d]).items()
            for p in "nsqx"
            if p in parts
        ],
    )


def _distinct_steps(timed: DataFrame, key: str, value: str, days: int, bucket_seconds: int) -> DataFrame:
    """Changes of the number of distinct values in the trailing frame, per key and second.

    A value counts from the second it is seen until ``days`` after it was last
    seen: +1 where it (re)appears, -1 one second after it runs out. The running
    sum of the changes is the exact distinct count, without any sets.
    """
    width = days * DAY
    seen = (
        timed.where(F.col(value).isNotNull())
        .select(F.col(key).alias("_key"), F.col(value).alias("_value"), "_sec")
        .distinct()
    )
    w = Window.partitionBy("_key", "_value").orderBy("_sec")
    opens = F.coalesce(F.lag("_sec").over(w) < F.col("_sec") - width, F.lit(True))
    closes = F.coalesce(F.lead("_sec").over(w) > F.col("_sec") + width, F.lit(True))
    moves = F.filter(
        F.array(
            F.struct(F.col("_sec").alias("_sec"), F.when(F.col("_opens"), 1).alias("_step")),
            F.struct(
                (F.col("_sec") + width + 1).alias("_sec"), F.when(F.col("_closes"), -1).alias("_step")
            ),
        ),
        lambda m: m["_step"].isNotNull(),
    )
    return (
        seen.select("_key", "_sec", opens.alias("_opens"), closes.alias("_closes"))
        .select("_key", F.inline(moves))
        .groupBy("_key", "_sec")
        .agg(F.sum("_step").alias("_step"))
        .withColumn("_bucket", bucket_of(F.col("_sec"), bucket_seconds))
    )


# --- choice of form --------------------------------------------------------------------


def dense_keys(df: DataFrame, key: str, dense_rows: int = DENSE_KEY_ROWS) -> DataFrame:
    """Keys with more than ``dense_rows`` rows."""
    return df.groupBy(key).count().where(F.col("count") > dense_rows).select(key)


def rolling_features(
    df: DataFrame,
    features: Sequence[Rolling],
    key: str = "user_id",
    ts: str = "event_timestamp",
    dense_rows: int = DENSE_KEY_ROWS,
    most_broadcast: int = MOST_BROADCAST_KEYS,
) -> DataFrame:
    """Features at every row, by the form that suits each key.

    The number of dense keys is measured first, over the key column alone. With none,
    all keys go through plain windows. A few are taken out by a broadcast of their
    names (at most ``most_broadcast``, so its size is bounded) and split by time, the
    rest stay with plain windows. Beyond that, everything is split.
    """
    dense = dense_keys(df, key, dense_rows)
    found = dense.count()
    if found == 0:
        return rolling_windows(df, features, key, ts)
    if found > most_broadcast:
        return rolling_split(df, features, key, ts)
    named = F.broadcast(dense.withColumnRenamed(key, "_dense"))
    same = F.col(key).eqNullSafe(F.col("_dense"))
    return rolling_split(df.join(named, same, "left_semi"), features, key, ts).unionByName(
        rolling_windows(df.join(named, same, "left_anti"), features, key, ts)
    )


# --- newest row per key ----------------------------------------------------------------


def rolling_latest(
    df: DataFrame, features: Sequence[Rolling], key: str = "user_id", ts: str = "event_timestamp"
) -> DataFrame:
    """Key, newest time and the features as of that time.

    Rows are first merged to one per (key, second). For a distinct count each (key,
    value) is merged to its last second, and those are counted per (key, second). What
    is then gathered by key is bounded by the seconds of the lookback, however many rows
    or values the key has. Rows without a time do not count; keys with no other are absent.
    """
    measures = _measures(features)
    distinct = list(dict.fromkeys(value for value, _ in _distinct_features(features)))
    timed = df.where(F.col(ts).isNotNull()).withColumn("_sec", whole_seconds(ts))
    per_second = timed.groupBy(F.col(key).alias("_key"), "_sec").agg(
        F.max(ts).alias("_ts"),
        *[
            c.alias(n)
            for m, parts in measures.items()
            for n, c in _state(m, parts, F.col(m)).items()
        ],
    )
    gathered = per_second.withColumns({f"_values_{v}": F.lit(0).cast("long") for v in distinct})
    for v in distinct:
        # a value counts at the second it was last seen; values of a second are counted
        # before anything is gathered by key
        last_seen = (
            timed.where(F.col(v).isNotNull())
            .groupBy(F.col(key).alias("_key"), F.col(v).alias("_value"))
            .agg(F.max("_sec").alias("_sec"))
            .groupBy("_key", "_sec")
            .agg(F.count(F.lit(1)).alias(f"_values_{v}"))
        )
        gathered = gathered.unionByName(last_seen, allowMissingColumns=True)
    by_key = Window.partitionBy("_key")
    squares = [m for m, parts in measures.items() if "q" in parts]
    placed = gathered.select(
        "*",
        F.max("_sec").over(by_key).alias("_last"),
        *[
            (F.sum(f"s_{m}").over(by_key) / F.nullif(F.sum(f"n_{m}").over(by_key).cast("double"), F.lit(0.0)))
            .alias(f"shift_{m}")
            for m in squares
        ],
    )
    widest = max(f.days for f in features)
    return _frames_to(placed.where(F.col("_sec") >= F.col("_last") - widest * DAY), features, key, ts)


def _frames_to(placed: DataFrame, features: Sequence[Rolling], key: str, ts: str) -> DataFrame:
    """Aggregate per-second rows by key over the frames that end at ``_last``."""

    def within(days: int) -> Column:
        return F.col("_sec") >= F.col("_last") - days * DAY

    merged, finished = [], []
    for f in features:
        inside = within(f.days)
        if f.agg == "nunique":
            values = F.sum(F.when(inside, F.col(f"_values_{f.value}")))
            merged.append(F.coalesce(values, F.lit(0)).cast("long").alias(f.name))
            finished.append(F.col(f.name))
            continue

        def part(p, merge=F.sum, f=f, inside=inside):
            column = merge(F.when(inside, F.col(f"{p}_{f.value}"))).alias(f"{f.name}_{p}")
            merged.append(column)
            return F.col(f"{f.name}_{p}")

        n = s = q = x = shift = None
        if f.agg == "max":
            x = part("x", F.max)
        else:
            n = F.coalesce(part("n"), F.lit(0))
        if f.agg in ("sum", "mean", "stddev"):
            s = part("s")
        if f.agg == "stddev":
            state = [F.col(f"{p}_{f.value}") for p in "nsq"]
            centred = _centred(*state, F.col(f"shift_{f.value}"))
            merged.append(F.sum(F.when(inside, centred)).alias(f"{f.name}_q"))
            merged.append(F.max(f"shift_{f.value}").alias(f"{f.name}_shift"))
            q, shift = F.col(f"{f.name}_q"), F.col(f"{f.name}_shift")
        finished.append(_finish(f, n, s, q, x, shift))
    return (
        placed.groupBy("_key")
        .agg(F.max("_ts").alias(ts), *merged)
        .select(F.col("_key").alias(key), ts, *finished)
    )


def rolling_as_of(
    df: DataFrame,
    features: Sequence[Rolling],
    as_of: str | date,
    key: str = "user_id",
    ts: str = "event_timestamp",
) -> DataFrame:
    """Features per key over frames that end at midnight of ``as_of`` for every key.

    The frames are fixed, so this is one aggregate with map-side merging. Keys with
    no row in the widest frame are absent.
    """
    end = F.unix_seconds(instant(as_of))
    widest = max(f.days for f in features)
    timed = df.where(
        F.col(ts).between(instant(days_before(as_of, widest)), instant(as_of))
    ).withColumn("_sec", whole_seconds(ts))
    return timed.groupBy(key).agg(
        F.max(ts).alias(ts),
        *[
            _WHOLE[f.agg](F.when(F.col("_sec") >= end - f.days * DAY, F.col(f.value))).alias(f.name)
            for f in features
        ],
    )


def latest_feature_table(
    events: DataFrame, run_day: str | date, lookback_days: int = 95, key: str = "user_id"
) -> DataFrame:
    """The feature job: clean, roll, keep the newest row per user, add the ratios."""
    clean = with_fraud_hit(clean_events(events, run_day, key=key, lookback_days=lookback_days))
    return with_ratios(rolling_latest(clean, TRANSACTION_FEATURES, key=key))
