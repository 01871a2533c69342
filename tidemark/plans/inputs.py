"""The given tables mapped to the engine's logical inputs, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import DAY
from tidemark.operators.rolling import SPEND_FEATURES, labelled_transactions, rolling_features
from tidemark.plans.registry import table
from tidemark.sources.schemas import CREDIT_VIEW, LABEL_VIEW, PROFILE_VIEW, TRANSACTION_VIEW

# --- raw events ------------------------------------------------------------------------


def events(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as raw transaction events."""
    k = F.get_json_object("props", "$.k")
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("value").alias("transaction_amount"),
        F.upper("event_type").alias("transaction_type"),
        k.alias("merchant_category"),
        F.concat(F.lit("C"), (k.cast("int") % 5).cast("string")).alias("country_code"),
        (F.col("event_type") == "error").alias("is_fraud"),
        (k.cast("int") < 20).alias("is_international"),
    )


EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) AS user_id,
         ts AS event_timestamp,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         value AS transaction_amount,
         upper(event_type) AS transaction_type,
         json_extract_string(props, '$.k') AS merchant_category,
         'C' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS country_code,
         event_type = 'error' AS is_fraud,
         CAST(json_extract_string(props, '$.k') AS INTEGER) < 20 AS is_international
  FROM events
)"""


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as raw transaction events: years of data, few rows per customer."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
        F.col("o_totalprice").alias("transaction_amount"),
        F.col("o_orderpriority").alias("merchant_category"),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
        (F.col("o_orderstatus") == "P").alias("is_international"),
    )


ORDER_EVENTS = """
ev AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderdate AS event_timestamp,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS sec,
         o_totalprice AS transaction_amount,
         o_orderpriority AS merchant_category,
         o_orderstatus = 'F' AS is_fraud,
         o_orderstatus = 'P' AS is_international
  FROM orders
)"""

# --- feature views over orders and customers -------------------------------------------


def spend_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions and resolved labels of ``orders``; open orders have no label yet."""
    base = order_events(spark, folder).select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        "event_timestamp",
        F.col("transaction_amount").alias("amount"),
        F.col("merchant_category").alias("merchant_id"),
        "is_international",
    )
    labels = table(spark, folder, "orders").where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
    )
    return labelled_transactions(base, labels)


def transaction_view(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the transaction view: one per order, features as of the order."""
    rolled = rolling_features(spend_rows(spark, folder), SPEND_FEATURES, key="customer_id")
    return rolled.select(
        "customer_id",
        "event_timestamp",
        F.col("event_timestamp").alias("created_timestamp"),
        *TRANSACTION_VIEW.fields,
    )


def _frame(days: int) -> str:
    return f"(PARTITION BY customer_id ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND CURRENT ROW)"


SPEND_SELECT = f"""
         avg(amount) OVER {_frame(7)} AS avg_spend_7d,
         sum(amount) OVER {_frame(7)} AS total_spend_7d,
         count(transaction_id) OVER {_frame(7)} AS transaction_count_7d,
         count(transaction_id) OVER {_frame(30)} AS transaction_count_30d,
         avg(amount) OVER {_frame(30)} AS avg_spend_30d,
         stddev_samp(amount) OVER {_frame(30)} AS std_spend_30d,
         avg(label_hit) OVER {_frame(90)} AS fraud_rate_90d,
         CAST(sum(label_hit) OVER {_frame(90)} AS BIGINT) AS fraud_count_90d,
         count(DISTINCT merchant_id) OVER {_frame(30)} AS unique_merchants_30d,
         max(amount) OVER {_frame(30)} AS max_single_spend_30d,
         avg(international_hit) OVER {_frame(30)} AS international_txn_ratio_30d"""

SPEND_ROWS = f"""{ORDER_EVENTS},
spend AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, event_timestamp, sec,
         transaction_amount AS amount, merchant_category AS merchant_id,
         CASE WHEN o.o_orderstatus <> 'O' THEN CAST(o.o_orderstatus = 'F' AS INTEGER) END AS label_hit,
         CAST(is_international AS INTEGER) AS international_hit
  FROM ev JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = ev.event_id
)"""

TRANSACTION_ROWS = f"""{SPEND_ROWS},
transaction_view AS (
  SELECT customer_id, event_timestamp, event_timestamp AS created_timestamp, {SPEND_SELECT}
  FROM spend
)"""


def credit_view(spark: SparkSession, folder: str) -> DataFrame:
    """A monthly bureau snapshot per customer, derived from that month's orders."""
    month = F.trunc("o_orderdate", "month")
    marks = F.count_if(F.col("o_orderstatus") == "P")
    spend = F.sum("o_totalprice")
    n = F.count(F.lit(1))
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("customer_id"), month.alias("month"))
        .agg(
            (spend / 500_000).alias("credit_utilization"),
            (F.count_if(F.col("o_orderstatus") == "F") / n).alias("payment_history_score"),
            (F.avg("o_totalprice") / 100_000).alias("debt_to_income"),
            n.alias("num_open_accounts"),
            marks.alias("num_derogatory_marks"),
            F.max(F.month("o_orderdate") * 5).cast("long").alias("credit_age_months"),
            (n % 50).alias("recent_hard_inquiries_6m"),
            (F.min("o_totalprice") / 500_000).alias("installment_utilization"),
            F.when(marks > 0, marks).otherwise(-1).alias("months_since_last_delinquency"),
            F.least(F.lit(850.0), 300 + F.avg("o_totalprice") / 1_000).alias("estimated_credit_score"),
        )
        .withColumn("event_timestamp", F.add_months("month", 1).cast("timestamp"))
        .withColumn("created_timestamp", F.date_add(F.add_months("month", 1), 2).cast("timestamp"))
        .select("customer_id", "event_timestamp", "created_timestamp", *CREDIT_VIEW.fields)
    )


CREDIT_ROWS = """
credit_view AS (
  SELECT customer_id,
         CAST(month + INTERVAL 1 MONTH AS TIMESTAMP) AS event_timestamp,
         CAST(month + INTERVAL 1 MONTH + INTERVAL 2 DAY AS TIMESTAMP) AS created_timestamp,
         * EXCLUDE (customer_id, month)
  FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, date_trunc('month', o_orderdate) AS month,
           sum(o_totalprice) / 500000 AS credit_utilization,
           count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS payment_history_score,
           avg(o_totalprice) / 100000 AS debt_to_income,
           count(*) AS num_open_accounts,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS num_derogatory_marks,
           CAST(max(month(o_orderdate) * 5) AS BIGINT) AS credit_age_months,
           count(*) % 50 AS recent_hard_inquiries_6m,
           min(o_totalprice) / 500000 AS installment_utilization,
           CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0
                THEN count(*) FILTER (WHERE o_orderstatus = 'P') ELSE -1 END AS months_since_last_delinquency,
           least(850.0, 300 + avg(o_totalprice) / 1000) AS estimated_credit_score
    FROM orders GROUP BY 1, 2)
)"""


def profile_view(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots per customer, one before and one in the middle of the order years."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    snapshot = F.explode(F.array(F.lit(0), F.lit(1))).alias("snapshot")
    start = F.lit("1998-06-01 00:00:00").cast("timestamp")
    rows = table(spark, folder, "customer").select("*", snapshot)
    seconds = (F.pmod(key, F.lit(60)) + F.col("snapshot") * 60).cast("int") * DAY
    segment = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "CORPORATE")
        .when(F.col("c_mktsegment") == "BUILDING", "SMB")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "PREMIUM")
        .when(F.col("c_mktsegment") == "FURNITURE", "RETAIL")
        .otherwise("HOUSEHOLD")
    )
    band = (
        F.when(balance < 0, "<30K").when(balance < 2_500, "30-60K").when(balance < 5_000, "60-100K")
        .when(balance < 7_500, "100-200K").otherwise(">200K")
    )
    channel = F.element_at(
        F.array(*[F.lit(c) for c in ("BRANCH", "ONLINE", "MOBILE", "PARTNER", "REFERRAL")]),
        (F.pmod(key, F.lit(5)) + 1).cast("int"),
    )
    at = F.timestamp_seconds(F.unix_seconds(start) + seconds)
    return rows.select(
        key.cast("string").alias("customer_id"),
        at.alias("event_timestamp"),
        at.alias("created_timestamp"),
        (F.pmod(key, F.lit(3_000)) + F.col("snapshot") * 60).cast("long").alias("account_age_days"),
        segment.alias("customer_segment"),
        (balance > 0).alias("kyc_verified"),
        (F.pmod(key, F.lit(4)) + 1 + F.col("snapshot")).cast("long").alias("product_count"),
        band.alias("annual_income_band"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state_code"),
        channel.alias("channel"),
    )


PROFILE_ROWS = """
profile_view AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         TIMESTAMP '1998-06-01' + to_days(CAST(c_custkey % 60 + snapshot * 60 AS INTEGER)) AS event_timestamp,
         TIMESTAMP '1998-06-01' + to_days(CAST(c_custkey % 60 + snapshot * 60 AS INTEGER)) AS created_timestamp,
         CAST(c_custkey % 3000 + snapshot * 60 AS BIGINT) AS account_age_days,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'CORPORATE' WHEN 'BUILDING' THEN 'SMB'
              WHEN 'AUTOMOBILE' THEN 'PREMIUM' WHEN 'FURNITURE' THEN 'RETAIL' ELSE 'HOUSEHOLD' END AS customer_segment,
         c_acctbal > 0 AS kyc_verified,
         CAST(c_custkey % 4 + 1 + snapshot AS BIGINT) AS product_count,
         CASE WHEN c_acctbal < 0 THEN '<30K' WHEN c_acctbal < 2500 THEN '30-60K'
              WHEN c_acctbal < 5000 THEN '60-100K' WHEN c_acctbal < 7500 THEN '100-200K' ELSE '>200K' END AS annual_income_band,
         'S' || CAST(c_nationkey AS VARCHAR) AS state_code,
         CASE c_custkey % 5 WHEN 0 THEN 'BRANCH' WHEN 1 THEN 'ONLINE' WHEN 2 THEN 'MOBILE'
              WHEN 3 THEN 'PARTNER' ELSE 'REFERRAL' END AS channel
  FROM customer CROSS JOIN (VALUES (0), (1)) AS s(snapshot)
)"""


def label_view(spark: SparkSession, folder: str) -> DataFrame:
    """Fraud labels of the closed orders, resolved 90 days after the order."""
    status = F.col("o_orderstatus")
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + 90 * DAY)
    return table(spark, folder, "orders").where(status != "O").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        at.alias("event_timestamp"),
        at.alias("created_timestamp"),
        (status == "F").alias("is_fraud"),
        F.when(status == "F", F.upper("o_orderpriority")).alias("fraud_type"),
        F.when(status == "F", "CONFIRMED").otherwise("CLEARED").alias("investigation_status"),
    )


LABEL_ROWS = """
label_view AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         o_orderdate + to_days(90) AS event_timestamp,
         o_orderdate + to_days(90) AS created_timestamp,
         o_orderstatus = 'F' AS is_fraud,
         CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) END AS fraud_type,
         CASE WHEN o_orderstatus = 'F' THEN 'CONFIRMED' ELSE 'CLEARED' END AS investigation_status
  FROM orders WHERE o_orderstatus <> 'O'
)"""


def order_spine(spark: SparkSession, folder: str) -> DataFrame:
    """One spine row per order, 0 to 119 days after it, with a label of its own."""
    late = F.pmod("o_orderkey", F.lit(120)) * DAY
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + late).alias(
            "event_timestamp"
        ),
        (F.col("o_orderstatus") == "F").alias("is_fraud"),
    )


ORDER_SPINE = """
spine AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS transaction_id,
         o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) AS event_timestamp,
         o_orderstatus = 'F' AS is_fraud
  FROM orders
)"""


_VIEWS = {
    TRANSACTION_VIEW.name: (TRANSACTION_VIEW, transaction_view),
    CREDIT_VIEW.name: (CREDIT_VIEW, credit_view),
    PROFILE_VIEW.name: (PROFILE_VIEW, profile_view),
    LABEL_VIEW.name: (LABEL_VIEW, label_view),
}


def all_views(spark: SparkSession, folder: str, names: Iterable[str] | None = None):
    """The named views, or all four, with their rows."""
    return {n: (_VIEWS[n][0], _VIEWS[n][1](spark, folder)) for n in (_VIEWS if names is None else names)}
