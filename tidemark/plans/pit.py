"""Queries: point-in-time joins, training sets, latest-value tables and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timing import DAY
from tidemark.operators import latest, pit
from tidemark.operators.rolling import TRANSACTION_FEATURES, rolling_features, with_fraud_hit, with_ratios
from tidemark.plans import inputs
from tidemark.plans.registry import fixed, query, scratch, sql_fixed, sql_stamp, stamp, table
from tidemark.sources import io
from tidemark.sources.schemas import (
    CREDIT_REFS,
    CREDIT_VIEW,
    FRAUD_LABEL_REFS,
    FRAUD_REFS,
    LABEL_VIEW,
    PROFILE_VIEW,
    TRANSACTION_VIEW,
    VIEWS,
    FeatureView,
    parse_refs,
)

TIMES = "event_timestamp"


def _types(refs) -> dict[str, str]:
    return {f: VIEWS[v].fields[f] for v, fs in parse_refs(refs).items() for f in fs}


def _shown(df, keys, types):
    return df.select(
        *keys,
        stamp(TIMES).alias(TIMES),
        *[(fixed(c) if t == "double" else F.col(c)).alias(c) for c, t in types.items()],
    )


def _sql_features(types, qualify=lambda c: c):
    return ", ".join(
        f"{sql_fixed(qualify(c)) if t == 'double' else qualify(c)} AS {c}" for c, t in types.items()
    )


def _sql_newest_rows(view: FeatureView, source: str) -> str:
    """One row per key and time: the last created."""
    keys = ", ".join(view.keys)
    return f"""{source}_rows AS (
  SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY {keys}, event_timestamp ORDER BY created_timestamp DESC) = 1
)"""


SQL_SOURCES = {
    TRANSACTION_VIEW.name: ("transaction_view", TRANSACTION_VIEW),
    CREDIT_VIEW.name: ("credit_view", CREDIT_VIEW),
    PROFILE_VIEW.name: ("profile_view", PROFILE_VIEW),
    LABEL_VIEW.name: ("label_view", LABEL_VIEW),
}
ALL_ROWS = ", ".join(
    [inputs.TRANSACTION_ROWS, inputs.CREDIT_ROWS, inputs.PROFILE_ROWS, inputs.LABEL_ROWS]
)


def _sql_joined(refs, names=None) -> str:
    """SELECT over ``spine`` of spine columns and features, one as-of join per view."""
    joins, columns, made = [], [], []
    for view_name, features in parse_refs(refs).items():
        source, view = SQL_SOURCES[view_name]
        made.append(_sql_newest_rows(view, source))
        on = " AND ".join(f"spine.{k} = {source}_rows.{k}" for k in view.keys)
        joins.append(
            f"ASOF LEFT JOIN {source}_rows ON {on} "
            f"AND spine.event_timestamp >= {source}_rows.event_timestamp"
        )
        alive = f"{source}_rows.event_timestamp >= spine.event_timestamp - to_days({view.ttl_days})"
        for f in features:
            out = (names or {}).get((view_name, f), f)
            value = f"CASE WHEN {alive} THEN {source}_rows.{f} END"
            columns.append(
                f"{sql_fixed(value) if view.fields[f] == 'double' else value} AS {out}"
            )
    return ", ".join(made), columns, " ".join(joins)


def _sql_training(refs, spine_columns, names=None) -> str:
    made, columns, joins = _sql_joined(refs, names)
    spine = [
        f"{sql_stamp('spine.event_timestamp')} AS event_timestamp" if c == TIMES else f"spine.{c}"
        for c in spine_columns
    ]
    return (
        f"WITH {ALL_ROWS}, {inputs.ORDER_SPINE}, {made} "
        f"SELECT {', '.join(spine + columns)} FROM spine {joins}"
    )


# --- one view, raw --------------------------------------------------------------------


PURCHASES_SQL = f"""WITH {inputs.EVENTS}, v AS (
  SELECT event_id, user_id, event_timestamp, transaction_amount FROM ev WHERE transaction_type = 'VIEW'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_timestamp ORDER BY event_id DESC) = 1
)
SELECT p.event_id, p.user_id, {sql_stamp('p.event_timestamp')} AS event_timestamp,
       CASE WHEN v.event_timestamp >= p.event_timestamp - to_days(1) THEN v.event_id END AS view_id,
       CASE WHEN v.event_timestamp >= p.event_timestamp - to_days(1) THEN v.transaction_amount END AS view_value
FROM (SELECT * FROM ev WHERE transaction_type = 'PURCHASE') p
ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.event_timestamp >= v.event_timestamp"""


def purchases_views(spark, folder, bucket_seconds):
    ev = inputs.events(spark, folder)
    spine = ev.where(F.col("transaction_type") == "PURCHASE").select("event_id", "user_id", TIMES)
    views = ev.where(F.col("transaction_type") == "VIEW").select(
        "user_id", TIMES, F.col("event_id").alias("view_id"), F.col("transaction_amount").alias("view_value")
    )
    look = pit.Lookup(
        "views", views, {"view_id": "view_id", "view_value": "view_value"}, DAY, created_col=None
    )
    joined = pit.point_in_time_join(spine, [look], ["user_id"], bucket_seconds=bucket_seconds)
    return joined.withColumn(TIMES, stamp(TIMES))


@query("pit_purchases_views", PURCHASES_SQL)
def pit_purchases_views(spark, folder):
    """Each purchase with the user's newest view of the last day, if any."""
    return purchases_views(spark, folder, "auto")


@query("pit_purchases_views_by_day", PURCHASES_SQL)
def pit_purchases_views_by_day(spark, folder):
    """The same, with the sequence of each user cut by day as for very large keys."""
    return purchases_views(spark, folder, DAY)


# --- historical features --------------------------------------------------------------

HISTORY_REFS = tuple(
    f"{v.name}:{f}" for v in (TRANSACTION_VIEW, CREDIT_VIEW, PROFILE_VIEW) for f in v.fields
)


@query(
    "historical_features",
    _sql_training(HISTORY_REFS, ["customer_id", "transaction_id", "event_timestamp", "is_fraud"]),
)
def historical_features(spark, folder):
    """Spine rows with all features of the three customer views, in one shuffle."""
    joined = pit.historical_features(
        inputs.order_spine(spark, folder), HISTORY_REFS, inputs.all_views(spark, folder)
    )
    return _shown(joined, ["customer_id", "transaction_id", "is_fraud"], _types(HISTORY_REFS))


@query(
    "historical_features_by_month",
    _sql_training(HISTORY_REFS, ["customer_id", "transaction_id", "event_timestamp", "is_fraud"]),
)
def historical_features_by_month(spark, folder):
    """The same, with each customer's sequence cut into 30-day buckets."""
    joined = pit.historical_features(
        inputs.order_spine(spark, folder),
        HISTORY_REFS,
        inputs.all_views(spark, folder),
        bucket_seconds=30 * DAY,
    )
    return _shown(joined, ["customer_id", "transaction_id", "is_fraud"], _types(HISTORY_REFS))


HOT_DAY = "1998-03-01"


def _hot(name, second, key, otherwise):
    """A third of all rows on one key, within one day; the others as they are."""
    moment = F.timestamp_seconds(F.unix_seconds(F.lit(f"{HOT_DAY} 00:00:00").cast("timestamp")) + second)
    hot = F.pmod(F.col(name), F.lit(3)) == 0
    return (
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), key.cast("string"))).alias("supplier"),
        F.when(hot, moment).otherwise(F.col(otherwise).cast("timestamp")).alias("event_timestamp"),
    )


@query(
    "historical_features_hot_key",
    f"""WITH prices AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE 's' || l_suppkey END AS supplier,
         CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '{HOT_DAY}' + to_seconds((l_orderkey * 37 + l_linenumber * 11) % 86400) ELSE l_shipdate END AS moment,
         l_linenumber AS line, l_extendedprice AS price, l_quantity AS quantity
  FROM lineitem
), newest AS (
  SELECT * FROM prices QUALIFY row_number() OVER (PARTITION BY supplier, moment ORDER BY line DESC, price DESC, quantity DESC) = 1
), spine AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE 's' || (o_custkey % 100 + 1) END AS supplier,
         CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '{HOT_DAY}' + to_seconds(CASE WHEN o_orderkey % 2 = 0 THEN 43200 ELSE (o_orderkey * 13) % 86400 END)
              ELSE o_orderdate END AS event_timestamp
  FROM orders
)
SELECT order_id, spine.supplier, {sql_stamp('event_timestamp')} AS event_timestamp,
       CASE WHEN moment + to_days(30) >= event_timestamp THEN price END AS price,
       CASE WHEN moment + to_days(30) >= event_timestamp THEN quantity END AS quantity
FROM spine ASOF LEFT JOIN newest ON spine.supplier = newest.supplier AND spine.event_timestamp >= newest.moment""",
)
def historical_features_hot_key(spark, folder):
    """Prices as of each order, with a third of all rows on one key and day and half of its orders
    at one second: the key is cut at quantiles of its times, the second dealt out."""
    line, order = F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11, F.col("o_orderkey")
    prices = table(spark, folder, "lineitem").select(
        *_hot("l_orderkey", F.pmod(line, F.lit(DAY)), F.col("l_suppkey"), "l_shipdate"),
        F.timestamp_seconds(F.col("l_linenumber")).alias("created_timestamp"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
    )
    second = F.when(F.pmod(order, F.lit(2)) == 0, 43_200).otherwise(F.pmod(order * 13, F.lit(DAY)))
    spine = table(spark, folder, "orders").select(
        order.alias("order_id"), *_hot("o_orderkey", second, F.col("o_custkey") % 100 + 1, "o_orderdate")
    )
    lookup = pit.Lookup("prices", prices, {"price": "price", "quantity": "quantity"}, 30 * DAY)
    found = pit.point_in_time_join(spine, [lookup], ["supplier"], large_key_rows=1_000)
    return found.withColumn("event_timestamp", stamp("event_timestamp"))


LABEL_REFS = tuple(f"{LABEL_VIEW.name}:{f}" for f in LABEL_VIEW.fields)


@query(
    "historical_labels",
    _sql_training(
        LABEL_REFS,
        ["customer_id", "transaction_id", "event_timestamp", "is_fraud"],
        {(LABEL_VIEW.name, "is_fraud"): "fraud_label_features__is_fraud"},
    ),
)
def historical_labels(spark, folder):
    """Labels by their own key; unresolved at spine time gives nulls."""
    joined = pit.historical_features(
        inputs.order_spine(spark, folder), LABEL_REFS, inputs.all_views(spark, folder)
    )
    return joined.withColumn(TIMES, stamp(TIMES))


@query(
    "fraud_training_set",
    _sql_training(
        (*FRAUD_REFS, *FRAUD_LABEL_REFS),
        ["customer_id", "transaction_id", "event_timestamp", "is_fraud"],
        {(LABEL_VIEW.name, "is_fraud"): "fraud_label_features__is_fraud"},
    ),
)
def fraud_training_set(spark, folder):
    """Twelve features and two labels over two keys, with the spine's own label."""
    joined = pit.fraud_training_set(
        inputs.order_spine(spark, folder), inputs.all_views(spark, folder)
    )
    types = _types(FRAUD_REFS)
    kept = ["customer_id", "transaction_id", "is_fraud", "fraud_label_features__is_fraud", "fraud_type"]
    return _shown(joined, kept, types)


@query("credit_training_set", _sql_training(CREDIT_REFS, ["customer_id", "event_timestamp"]))
def credit_training_set(spark, folder):
    joined = pit.credit_training_set(
        inputs.order_spine(spark, folder), inputs.all_views(spark, folder)
    )
    return _shown(joined, ["customer_id"], _types(CREDIT_REFS))


# --- training pull over a generated spine ----------------------------------------------

PULL_DAY = "1998-09-01"
USER_TRANSACTIONS = FeatureView(
    "user_transaction_features",
    ("user_id",),
    90,
    {
        "tx_count_7d": "long",
        "tx_amount_sum_30d": "double",
        "tx_amount_mean_90d": "double",
        "tx_amount_stddev_30d": "double",
        "is_high_value_customer": "boolean",
    },
    "transactions_source",
    created_col=None,
)
USER_PROFILES = FeatureView(
    "user_profile_features",
    ("user_id",),
    90,
    {"account_age_days": "long", "kyc_verified": "boolean"},
    "customer_profile_source",
)


def churn_spine(spark, folder):
    """Every customer, with times spread over the day before the run."""
    ids = table(spark, folder, "customer").select((F.col("c_custkey") + 1).alias("user_id"))
    return io.spine_for(ids, PULL_DAY)


def churn_views(spark, folder):
    rolled = with_ratios(
        rolling_features(with_fraud_hit(inputs.order_events(spark, folder)), TRANSACTION_FEATURES)
    )
    numbered = rolled.withColumn("user_id", F.col("user_id").cast("long"))
    profiles = inputs.profile_view(spark, folder).withColumn(
        "user_id", F.col("customer_id").cast("long")
    )
    return {
        USER_TRANSACTIONS.name: (USER_TRANSACTIONS, numbered),
        USER_PROFILES.name: (USER_PROFILES, profiles),
    }


@query(
    "entity_spine",
    f"""SELECT c_custkey + 1 AS user_id,
       {sql_stamp(f"TIMESTAMP '{PULL_DAY}' - to_hours(CAST(c_custkey % 24 AS INTEGER))")} AS event_timestamp
FROM customer""",
)
def entity_spine(spark, folder):
    return churn_spine(spark, folder).withColumn(TIMES, stamp(TIMES))


def _churn_frame(days):
    return f"(PARTITION BY user_id ORDER BY sec RANGE BETWEEN {days * DAY} PRECEDING AND CURRENT ROW)"


_CHURN_SQL = f"""WITH {inputs.ORDER_EVENTS}, {inputs.PROFILE_ROWS}, spine AS (
  SELECT c_custkey + 1 AS user_id,
         TIMESTAMP '{PULL_DAY}' - to_hours(CAST(c_custkey % 24 AS INTEGER)) AS event_timestamp FROM customer
), tx AS (
  SELECT CAST(user_id AS BIGINT) AS user_id, event_timestamp,
         count(event_id) OVER {_churn_frame(7)} AS tx_count_7d,
         sum(transaction_amount) OVER {_churn_frame(30)} AS tx_amount_sum_30d,
         avg(transaction_amount) OVER {_churn_frame(90)} AS tx_amount_mean_90d,
         stddev_samp(transaction_amount) OVER {_churn_frame(30)} AS tx_amount_stddev_30d
  FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id, event_timestamp ORDER BY event_id) = 1
), profiles AS (SELECT CAST(customer_id AS BIGINT) AS user_id, * EXCLUDE (customer_id) FROM profile_view),
joined AS (
  SELECT spine.user_id, spine.event_timestamp,
         tx.event_timestamp >= spine.event_timestamp - to_days(90) AS tx_alive, tx.* EXCLUDE (user_id, event_timestamp),
         profiles.event_timestamp >= spine.event_timestamp - to_days(90) AS profile_alive,
         profiles.account_age_days, profiles.kyc_verified
  FROM spine
  ASOF LEFT JOIN tx ON spine.user_id = tx.user_id AND spine.event_timestamp >= tx.event_timestamp
  ASOF LEFT JOIN profiles ON spine.user_id = profiles.user_id AND spine.event_timestamp >= profiles.event_timestamp
), pulled AS (
  SELECT user_id, event_timestamp,
         CASE WHEN tx_alive THEN tx_count_7d END AS tx_count_7d,
         CASE WHEN tx_alive THEN tx_amount_sum_30d END AS tx_amount_sum_30d,
         CASE WHEN tx_alive THEN tx_amount_mean_90d END AS tx_amount_mean_90d,
         CASE WHEN tx_alive THEN tx_amount_stddev_30d END AS tx_amount_stddev_30d,
         CASE WHEN tx_alive THEN tx_amount_mean_90d > 500.0 END AS is_high_value_customer,
         CASE WHEN profile_alive THEN account_age_days END AS account_age_days,
         CASE WHEN profile_alive THEN kyc_verified END AS kyc_verified
  FROM joined
)"""
_CHURN_TYPES = {**USER_TRANSACTIONS.fields, **USER_PROFILES.fields}


@query(
    "training_pull",
    f"{_CHURN_SQL} SELECT user_id, {sql_stamp('event_timestamp')} AS event_timestamp, "
    f"{_sql_features(_CHURN_TYPES)} FROM pulled",
)
def training_pull(spark, folder):
    """Seven features of two views for the generated spine, written and read back."""
    pulled = pit.churn_training_set(churn_spine(spark, folder), churn_views(spark, folder))
    path = scratch(spark, "training")
    io.write_table(pulled, path)
    return _shown(io.read_table(spark, path), ["user_id"], _CHURN_TYPES)


@query(
    "training_features_filled",
    f"{_CHURN_SQL} SELECT user_id, "
    + ", ".join(
        f"{sql_fixed(f'coalesce(CAST({c} AS DOUBLE), 0)')} AS {c}" for c in _CHURN_TYPES
    )
    + " FROM pulled",
)
def training_features_filled(spark, folder):
    """Feature columns as doubles with missing values set to zero."""
    from tidemark.operators.train import feature_columns, filled_features

    pulled = pit.churn_training_set(churn_spine(spark, folder), churn_views(spark, folder))
    columns = feature_columns(pulled, ("label", "user_id", TIMES))
    filled = filled_features(pulled, columns)
    return filled.select("user_id", *[fixed(c).alias(c) for c in columns])


# --- latest-value tables ---------------------------------------------------------------

MAT_START, MAT_MIDDLE, MAT_END = "1998-01-01", "1998-06-30", "1998-12-31"


def _sql_latest(view: FeatureView, source: str, start: str, end: str) -> str:
    keys = ", ".join(view.keys)
    return f"""{source}_latest AS (
  SELECT * FROM {source}
  WHERE event_timestamp BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY event_timestamp DESC, created_timestamp DESC) = 1
)"""


def _sql_latest_query(view: FeatureView, source: str, rows: str, start: str, end: str) -> str:
    return (
        f"WITH {rows}, {_sql_latest(view, source, start, end)} SELECT {', '.join(view.keys)}, "
        f"{sql_stamp('event_timestamp')} AS event_timestamp, {_sql_features(view.fields)} "
        f"FROM {source}_latest"
    )


def _latest_shown(df, view):
    return _shown(df, list(view.keys), view.fields)


@query(
    "materialize_transactions",
    _sql_latest_query(TRANSACTION_VIEW, "transaction_view", inputs.TRANSACTION_ROWS, MAT_START, MAT_END),
)
def materialize_transactions(spark, folder):
    """Newest transaction features per customer in a time range."""
    rows = inputs.transaction_view(spark, folder)
    return _latest_shown(
        latest.latest_in_range(rows, TRANSACTION_VIEW, *_range(MAT_START, MAT_END)), TRANSACTION_VIEW
    )


def _range(start, end):
    from tidemark.functions.timing import as_date

    return as_date(start), as_date(end)


@query(
    "materialize_credit",
    _sql_latest_query(CREDIT_VIEW, "credit_view", inputs.CREDIT_ROWS, MAT_START, MAT_END),
)
def materialize_credit(spark, folder):
    rows = inputs.credit_view(spark, folder)
    return _latest_shown(
        latest.latest_in_range(rows, CREDIT_VIEW, *_range(MAT_START, MAT_END)), CREDIT_VIEW
    )


@query(
    "materialize_incremental",
    _sql_latest_query(CREDIT_VIEW, "credit_view", inputs.CREDIT_ROWS, MAT_START, MAT_END),
)
def materialize_incremental(spark, folder):
    """A stored latest table brought forward from its high-water time."""
    rows = inputs.credit_view(spark, folder)
    start, middle = _range(MAT_START, MAT_MIDDLE)
    path = scratch(spark, "latest")
    io.write_table(latest.latest_in_range(rows, CREDIT_VIEW, start, middle), path)
    merged = latest.materialize_incremental(
        io.read_table(spark, path), rows, CREDIT_VIEW, middle, _range(MAT_START, MAT_END)[1]
    )
    return _latest_shown(merged, CREDIT_VIEW)


_ONLINE = (
    (TRANSACTION_VIEW, "transaction_view"),
    (CREDIT_VIEW, "credit_view"),
    (PROFILE_VIEW, "profile_view"),
)


@query(
    "materialize_status",
    f"WITH {ALL_ROWS} "
    + " UNION ALL ".join(
        f"SELECT '{v.name}' AS feature_view, count(DISTINCT customer_id) AS entities, "
        f"'{MAT_START} 00:00:00' AS start_time, '{MAT_END} 23:59:59' AS end_time, 'success' AS status "
        f"FROM {s} WHERE event_timestamp BETWEEN TIMESTAMP '{MAT_START} 00:00:00' "
        f"AND TIMESTAMP '{MAT_END} 23:59:59'"
        for v, s in _ONLINE
    ),
)
def materialize_status(spark, folder):
    """Whole-day run over all online views: one status row per view."""
    return latest.materialize_status(inputs.all_views(spark, folder), MAT_START, MAT_END)


# --- lookups ---------------------------------------------------------------------------


def requests(spark, folder):
    """One request per order customer, with some unknown customers among them."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_custkey") + F.when(F.col("o_orderkey") % 10 == 0, 10_000_000).otherwise(0))
        .cast("string")
        .alias("customer_id"),
    )


SQL_REQUESTS = """requests AS (
  SELECT o_orderkey AS request_id,
         CAST(o_custkey + CASE WHEN o_orderkey % 10 = 0 THEN 10000000 ELSE 0 END AS VARCHAR) AS customer_id
  FROM orders
)"""


def latest_tables(spark, folder, refs):
    views = inputs.all_views(spark, folder, parse_refs(refs))
    tables = latest.materialize(views, *_range(MAT_START, MAT_END))
    return {n: (views[n][0], t) for n, t in tables.items()}


def _sql_lookup(refs) -> str:
    made = [_sql_latest(v, s, MAT_START, MAT_END) for v, s in _ONLINE]
    columns, joins = [], []
    for view_name, features in parse_refs(refs).items():
        source, view = SQL_SOURCES[view_name]
        joins.append(f"LEFT JOIN {source}_latest ON requests.customer_id = {source}_latest.customer_id")
        for f in features:
            value = f"{source}_latest.{f}"
            columns.append(f"{sql_fixed(value) if view.fields[f] == 'double' else value} AS {f}")
    return (
        f"WITH {ALL_ROWS}, {', '.join(made)}, {SQL_REQUESTS} "
        f"SELECT request_id, requests.customer_id, {', '.join(columns)} FROM requests {' '.join(joins)}"
    )


def _lookup_shown(df, refs):
    return df.select(
        "request_id",
        "customer_id",
        *[(fixed(c) if t == "double" else F.col(c)).alias(c) for c, t in _types(refs).items()],
    )


PROFILE_REFS = tuple(f"{PROFILE_VIEW.name}:{f}" for f in PROFILE_VIEW.fields)


@query("lookup_profiles", _sql_lookup(PROFILE_REFS))
def lookup_profiles(spark, folder):
    found = latest.lookup_features(requests(spark, folder), PROFILE_REFS, latest_tables(spark, folder, PROFILE_REFS))
    return _lookup_shown(found, PROFILE_REFS)


@query("lookup_fraud_features", _sql_lookup(FRAUD_REFS))
def lookup_fraud_features(spark, folder):
    found = latest.lookup_fraud_features(requests(spark, folder), latest_tables(spark, folder, FRAUD_REFS))
    return _lookup_shown(found, FRAUD_REFS)


@query("lookup_credit_features", _sql_lookup(CREDIT_REFS))
def lookup_credit_features(spark, folder):
    found = latest.lookup_credit_features(requests(spark, folder), latest_tables(spark, folder, CREDIT_REFS))
    return _lookup_shown(found, CREDIT_REFS)
