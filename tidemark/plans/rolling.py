"""Queries: cleaning, rolling features, newest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timing import DAY
from tidemark.operators import rolling
from tidemark.operators.latest import latest_per_key
from tidemark.operators.rolling import SPEND_FEATURES, TRANSACTION_FEATURES
from tidemark.plans import inputs
from tidemark.plans.registry import fixed, query, sql_fixed, sql_stamp, stamp, table

RUN_DAY = "2024-01-30"
ORDERS_RUN_DAY = "1998-09-01"

RATIOS = ("tx_amount_7d_30d_ratio", "tx_count_7d_30d_ratio")
DOUBLES = [f.name for f in TRANSACTION_FEATURES if f.agg in ("mean", "max", "stddev")] + [
    "tx_amount_sum_7d",
    "tx_amount_sum_30d",
    "tx_amount_sum_90d",
]
LONGS = [f.name for f in TRANSACTION_FEATURES if f.name not in DOUBLES]


def shown(df, *keys):
    """Transaction features in comparable form."""
    return df.select(
        *keys,
        stamp("event_timestamp").alias("event_timestamp"),
        *[F.col(c).cast("long").alias(c) for c in LONGS],
        *[fixed(c).alias(c) for c in DOUBLES],
        *[fixed(c, 6).alias(c) for c in RATIOS],
        "is_high_value_customer",
    )


def _sql_shown(source: str, *keys: str) -> str:
    columns = [
        *keys,
        f"{sql_stamp('event_timestamp')} AS event_timestamp",
        *[f"CAST({c} AS BIGINT) AS {c}" for c in LONGS],
        *[f"{sql_fixed(c)} AS {c}" for c in DOUBLES],
        *[f"{sql_fixed(c, 6)} AS {c}" for c in RATIOS],
        "is_high_value_customer",
    ]
    return f"SELECT {', '.join(columns)} FROM {source}"


def _sql_clean(run_day: str, lookback: int = 95) -> str:
    return f"""
clean AS (
  SELECT * FROM ev
  WHERE event_timestamp >= TIMESTAMP '{run_day}' - to_days({lookback})
    AND event_timestamp <= TIMESTAMP '{run_day}'
    AND user_id IS NOT NULL AND transaction_amount > 0
)"""


def _w(days: int) -> str:
    return f"(PARTITION BY user_id ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND CURRENT ROW)"


def _sql_rolled(source: str) -> str:
    return f"""
aggregated AS (
  SELECT event_id, user_id, event_timestamp,
         count(event_id) OVER {_w(7)} AS tx_count_7d,
         sum(transaction_amount) OVER {_w(7)} AS tx_amount_sum_7d,
         avg(transaction_amount) OVER {_w(7)} AS tx_amount_mean_7d,
         max(transaction_amount) OVER {_w(7)} AS tx_amount_max_7d,
         count(event_id) OVER {_w(30)} AS tx_count_30d,
         sum(transaction_amount) OVER {_w(30)} AS tx_amount_sum_30d,
         avg(transaction_amount) OVER {_w(30)} AS tx_amount_mean_30d,
         stddev_samp(transaction_amount) OVER {_w(30)} AS tx_amount_stddev_30d,
         sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) OVER {_w(30)} AS fraud_tx_count_30d,
         count(DISTINCT merchant_category) OVER {_w(30)} AS distinct_merchant_categories_30d,
         count(event_id) OVER {_w(90)} AS tx_count_90d,
         sum(transaction_amount) OVER {_w(90)} AS tx_amount_sum_90d,
         avg(transaction_amount) OVER {_w(90)} AS tx_amount_mean_90d,
         stddev_samp(transaction_amount) OVER {_w(90)} AS tx_amount_stddev_90d
  FROM {source}
), rolled AS (
  SELECT *, tx_amount_sum_7d / nullif(tx_amount_sum_30d, 0) AS tx_amount_7d_30d_ratio,
         CAST(tx_count_7d AS DOUBLE) / nullif(tx_count_30d, 0) AS tx_count_7d_30d_ratio,
         tx_amount_mean_90d > 500.0 AS is_high_value_customer
  FROM aggregated
), newest AS (
  SELECT * FROM rolled
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC) = 1
)"""


@query(
    "feature_table",
    f"WITH {inputs.EVENTS}, {_sql_clean(RUN_DAY)}, {_sql_rolled('clean')} {_sql_shown('newest', 'user_id')}",
)
def feature_table(spark, folder):
    """The whole feature job: clean, roll over 7/30/90 days, newest row per user, ratios."""
    return shown(
        rolling.latest_feature_table(inputs.events(spark, folder), RUN_DAY), "user_id"
    )


@query(
    "feature_table_orders",
    f"WITH {inputs.ORDER_EVENTS}, {_sql_clean(ORDERS_RUN_DAY, 400)}, {_sql_rolled('clean')}"
    f" {_sql_shown('newest', 'user_id')}",
)
def feature_table_orders(spark, folder):
    """The feature job over orders with a 400-day lookback, so every frame evicts rows."""
    return shown(
        rolling.latest_feature_table(
            inputs.order_events(spark, folder), ORDERS_RUN_DAY, lookback_days=400
        ),
        "user_id",
    )


@query(
    "clean_events",
    f"""WITH {inputs.EVENTS}, {_sql_clean(RUN_DAY)}
SELECT event_id, user_id, {sql_stamp('event_timestamp')} AS event_timestamp, transaction_amount,
       transaction_type, merchant_category, country_code, is_fraud,
       CASE WHEN is_fraud THEN 1 ELSE 0 END AS fraud_hit FROM clean""",
)
def clean_events(spark, folder):
    """Scan with filters: time range, known key, positive amount; fraud indicator."""
    clean = rolling.with_fraud_hit(rolling.clean_events(inputs.events(spark, folder), RUN_DAY))
    return clean.select(
        "event_id",
        "user_id",
        stamp("event_timestamp").alias("event_timestamp"),
        "transaction_amount",
        "transaction_type",
        "merchant_category",
        "country_code",
        "is_fraud",
        "fraud_hit",
    )


def _per_event(rows, how):
    return shown(
        rolling.with_ratios(how(rolling.with_fraud_hit(rows), TRANSACTION_FEATURES)),
        "event_id",
        "user_id",
    )


_EVENTS_ROLLED = (
    f"WITH {inputs.EVENTS}, {_sql_rolled('ev')} {_sql_shown('rolled', 'event_id', 'user_id')}"
)
_ORDERS_ROLLED = (
    f"WITH {inputs.ORDER_EVENTS}, {_sql_rolled('ev')} {_sql_shown('rolled', 'event_id', 'user_id')}"
)


@query("rolling_events", _EVENTS_ROLLED)
def rolling_events(spark, folder):
    """All rolling features at every event; form chosen by key size."""
    return _per_event(inputs.events(spark, folder), rolling.rolling_features)


@query("rolling_events_windows", _EVENTS_ROLLED)
def rolling_events_windows(spark, folder):
    """The same by plain range windows."""
    return _per_event(inputs.events(spark, folder), rolling.rolling_windows)


@query("rolling_events_split", _EVENTS_ROLLED)
def rolling_events_split(spark, folder):
    """The same, split by key and hour for dense and skewed keys."""
    return _per_event(inputs.events(spark, folder), rolling.rolling_split)


@query("rolling_events_mixed", _EVENTS_ROLLED)
def rolling_events_mixed(spark, folder):
    """The same with a low limit: users above it are split by time, the others are not."""
    return _per_event(
        inputs.events(spark, folder),
        lambda rows, features: rolling.rolling_features(rows, features, dense_rows=66),
    )


@query("rolling_orders", _ORDERS_ROLLED)
def rolling_orders(spark, folder):
    return _per_event(inputs.order_events(spark, folder), rolling.rolling_features)


@query("rolling_orders_split", _ORDERS_ROLLED)
def rolling_orders_split(spark, folder):
    return _per_event(inputs.order_events(spark, folder), rolling.rolling_split)


@query(
    "features_as_of",
    f"""WITH {inputs.ORDER_EVENTS}, framed AS (
  SELECT *, sec >= epoch(TIMESTAMP '{ORDERS_RUN_DAY}') - {7 * DAY} AS d7,
         sec >= epoch(TIMESTAMP '{ORDERS_RUN_DAY}') - {30 * DAY} AS d30
  FROM ev WHERE event_timestamp BETWEEN TIMESTAMP '{ORDERS_RUN_DAY}' - to_days(90) AND TIMESTAMP '{ORDERS_RUN_DAY}'
), aggregated AS (
  SELECT user_id, max(event_timestamp) AS event_timestamp,
         count(event_id) FILTER (WHERE d7) AS tx_count_7d,
         sum(transaction_amount) FILTER (WHERE d7) AS tx_amount_sum_7d,
         avg(transaction_amount) FILTER (WHERE d7) AS tx_amount_mean_7d,
         max(transaction_amount) FILTER (WHERE d7) AS tx_amount_max_7d,
         count(event_id) FILTER (WHERE d30) AS tx_count_30d,
         sum(transaction_amount) FILTER (WHERE d30) AS tx_amount_sum_30d,
         avg(transaction_amount) FILTER (WHERE d30) AS tx_amount_mean_30d,
         stddev_samp(transaction_amount) FILTER (WHERE d30) AS tx_amount_stddev_30d,
         sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) FILTER (WHERE d30) AS fraud_tx_count_30d,
         count(DISTINCT merchant_category) FILTER (WHERE d30) AS distinct_merchant_categories_30d,
         count(event_id) AS tx_count_90d, sum(transaction_amount) AS tx_amount_sum_90d,
         avg(transaction_amount) AS tx_amount_mean_90d, stddev_samp(transaction_amount) AS tx_amount_stddev_90d
  FROM framed GROUP BY user_id
), rolled AS (
  SELECT *, tx_amount_sum_7d / nullif(tx_amount_sum_30d, 0) AS tx_amount_7d_30d_ratio,
         CAST(tx_count_7d AS DOUBLE) / nullif(tx_count_30d, 0) AS tx_count_7d_30d_ratio,
         tx_amount_mean_90d > 500.0 AS is_high_value_customer FROM aggregated
) {_sql_shown('rolled', 'user_id')}""",
)
def features_as_of(spark, folder):
    """Features of every active customer over frames that end at the run date."""
    rows = rolling.with_fraud_hit(inputs.order_events(spark, folder))
    return shown(
        rolling.with_ratios(rolling.rolling_as_of(rows, TRANSACTION_FEATURES, ORDERS_RUN_DAY)),
        "user_id",
    )


SPEND_DOUBLES = [f.name for f in SPEND_FEATURES if f.agg not in ("count", "nunique", "sum")] + [
    "total_spend_7d"
]
SPEND_LONGS = [f.name for f in SPEND_FEATURES if f.name not in SPEND_DOUBLES]


def spend_shown(df, *keys):
    return df.select(
        *keys,
        stamp("event_timestamp").alias("event_timestamp"),
        *[F.col(c).cast("long").alias(c) for c in SPEND_LONGS],
        *[fixed(c).alias(c) for c in SPEND_DOUBLES],
    )


_SPEND_SHOWN = ", ".join(
    [f"CAST({c} AS BIGINT) AS {c}" for c in SPEND_LONGS]
    + [f"{sql_fixed(c)} AS {c}" for c in SPEND_DOUBLES]
)


_SPEND_SQL = f"""WITH {inputs.SPEND_ROWS},
rolled AS (SELECT transaction_id, customer_id, event_timestamp, {inputs.SPEND_SELECT} FROM spend)
SELECT transaction_id, customer_id, {sql_stamp('event_timestamp')} AS event_timestamp, {_SPEND_SHOWN}
FROM rolled"""


@query("spend_view", _SPEND_SQL)
def spend_view(spark, folder):
    """The declared spend view at every order, fraud rate over resolved labels only."""
    rolled = rolling.rolling_features(
        inputs.spend_rows(spark, folder), SPEND_FEATURES, key="customer_id"
    )
    return spend_shown(rolled, "transaction_id", "customer_id")


@query("spend_view_split", _SPEND_SQL)
def spend_view_split(spark, folder):
    """The same, split by key and time bucket."""
    rolled = rolling.rolling_split(
        inputs.spend_rows(spark, folder), SPEND_FEATURES, key="customer_id"
    )
    return spend_shown(rolled, "transaction_id", "customer_id")


@query(
    "latest_event_per_user",
    f"""SELECT event_id, user_id, {sql_stamp('ts')} AS ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_event_per_user(spark, folder):
    """Top-1 per key by time with a fixed tie-break."""
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return latest_per_key(rows, ["user_id"], "ts", ["event_id"]).withColumn("ts", stamp("ts"))
