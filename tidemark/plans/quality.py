"""Queries: aggregates, expectation suites and the validation job."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import expectations as ex
from tidemark.operators import validation
from tidemark.operators.rolling import latest_feature_table
from tidemark.plans import inputs, pit
from tidemark.plans import rolling as rolling_plans
from tidemark.plans.registry import fixed, query, scratch, sql_fixed, table
from tidemark.sources import io
from tidemark.sources.schemas import CREDIT_VIEW, FRAUD_LABEL_REFS, FRAUD_REFS, LABEL_VIEW

# --- suites ----------------------------------------------------------------------------


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def sql_suite(source: str, suite: str, checks, columns) -> str:
    """The suite as SQL over ``source``, one SELECT per check."""
    selects = []
    for no, c in enumerate(checks, 1):
        present = c.column is None or c.column in columns
        grouped, evaluated, bad, success = source, "0", "0", "TRUE" if present else "FALSE"
        if present and c.kind == "not_null":
            evaluated, bad = "count(*)", f"count(*) FILTER (WHERE {c.column} IS NULL)"
        elif present and c.kind == "between":
            tests = [f"{c.column} < {c.params['min']}"] if c.params["min"] is not None else []
            tests += [f"{c.column} > {c.params['max']}"] if c.params["max"] is not None else []
            evaluated, bad = f"count({c.column})", f"count(*) FILTER (WHERE {' OR '.join(tests)})"
        elif present and c.kind == "in_set":
            values = ", ".join(_text(v) for v in c.params["values"])
            evaluated, bad = f"count({c.column})", f"count(*) FILTER (WHERE {c.column} NOT IN ({values}))"
        elif present and c.kind == "not_in_future":
            evaluated = f"count({c.column})"
            bad = f"count(*) FILTER (WHERE {c.column} > TIMESTAMP '{c.params['now']}')"
        elif present and c.kind == "unique":
            grouped = f"(SELECT {c.column}, count(*) AS n FROM {source} WHERE {c.column} IS NOT NULL GROUP BY 1)"
            evaluated, bad = "coalesce(sum(n), 0)", "coalesce(sum(n) FILTER (WHERE n > 1), 0)"
        elif c.kind == "rows_at_least":
            evaluated, success = "count(*)", f"count(*) >= {c.params['min']}"
        elif c.kind == "rows_distinct":
            grouped = f"(SELECT {', '.join(columns)}, count(*) AS n FROM {source} GROUP BY ALL)"
            evaluated, bad = "coalesce(sum(n), 0)", "coalesce(sum(n), 0) - count(*)"
            success = "coalesce(sum(n), 0) = count(*)"
        if present and c.kind in ("not_null", "between", "in_set", "unique", "not_in_future"):
            success = f"coalesce(({evaluated} - {bad}) / nullif({evaluated}, 0) >= {c.params['mostly']}, TRUE)"
        selects.append(
            f"SELECT {_text(suite)} AS suite, {no} AS check_no, {_text(c.kind)} AS \"check\", "
            f"{_text(c.column or '')} AS \"column\", {_text(c.params_json())} AS params, "
            f"{success} AS success, CAST({evaluated} AS BIGINT) AS evaluated, "
            f"CAST({bad} AS BIGINT) AS unexpected, "
            f"{sql_fixed(f'({bad}) / nullif({evaluated}, 0)', 6)} AS unexpected_share FROM {grouped}"
            + (" LIMIT 1" if evaluated == "0" else "")
        )
    return " UNION ALL ".join(f"({s})" for s in selects)


def _suite_shown(results):
    return results.withColumn("unexpected_share", fixed("unexpected_share", 6))


NOW = "2024-01-29 00:00:00"


def suite_events(spark, folder):
    return inputs.events(spark, folder).select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("transaction_amount").alias("amount"),
        "event_timestamp",
        "transaction_type",
    )


SQL_SUITE_EVENTS = f"""{inputs.EVENTS}, tx AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, transaction_amount AS amount,
         event_timestamp, transaction_type FROM ev
)"""
_TX_COLUMNS = ("transaction_id", "customer_id", "amount", "event_timestamp", "transaction_type")


@query(
    "transactions_suite",
    f"WITH {SQL_SUITE_EVENTS} "
    + sql_suite("tx", "transactions_suite", ex.transactions_suite(NOW), _TX_COLUMNS),
)
def transactions_suite(spark, folder):
    """Twelve checks, plus the opt-in check for times in the future."""
    return _suite_shown(ex.check_transactions(suite_events(spark, folder), now=NOW))


_CREDIT_COLUMNS = ("customer_id", "event_timestamp", "created_timestamp", *CREDIT_VIEW.fields)


@query(
    "credit_suite",
    f"WITH {inputs.CREDIT_ROWS} "
    + sql_suite("credit_view", "credit_bureau_suite", ex.credit_suite(), _CREDIT_COLUMNS),
)
def credit_suite(spark, folder):
    return _suite_shown(ex.check_credit(inputs.credit_view(spark, folder)))


_OUTPUT_COLUMNS = ("customer_id", *[r.split(":")[1] for r in (*FRAUD_REFS, "x:avg_spend_30d")])


def feature_output(spark, folder):
    """Looked-up features of every request, as they would be served."""
    refs = (*FRAUD_REFS, "customer_transaction_features:avg_spend_30d")
    return pit.latest.lookup_features(
        pit.requests(spark, folder), refs, pit.latest_tables(spark, folder, refs)
    )


@query(
    "feature_output_suite",
    pit._sql_lookup((*FRAUD_REFS, "customer_transaction_features:avg_spend_30d"))
    .replace("SELECT request_id, requests.customer_id", ", served AS (SELECT request_id, requests.customer_id")
    + ") "
    + sql_suite(
        "served",
        "feature_store_output_suite",
        ex.feature_output_suite(_OUTPUT_COLUMNS),
        _OUTPUT_COLUMNS,
    ),
)
def feature_output_suite(spark, folder):
    return _suite_shown(ex.check_feature_output(feature_output(spark, folder)))


_TRAINING_COLUMNS = (
    "customer_id",
    "transaction_id",
    "event_timestamp",
    "is_fraud",
    *[r.split(":")[1] for r in FRAUD_REFS],
    "fraud_label_features__is_fraud",
    "fraud_type",
)


@query(
    "training_suite",
    pit._sql_training(
        (*FRAUD_REFS, *FRAUD_LABEL_REFS),
        ["customer_id", "transaction_id", "event_timestamp", "is_fraud"],
        {(LABEL_VIEW.name, "is_fraud"): "fraud_label_features__is_fraud"},
    ).replace("SELECT spine.customer_id, spine.transaction_id", ", train AS (SELECT spine.customer_id, spine.transaction_id")
    + ") "
    + sql_suite(
        "train", "training_dataset_suite", ex.training_suite(_TRAINING_COLUMNS), _TRAINING_COLUMNS
    ),
)
def training_suite(spark, folder):
    """Label, size, duplicate rows and completeness of the fraud training set."""
    train = pit.pit.fraud_training_set(
        inputs.order_spine(spark, folder), inputs.all_views(spark, folder)
    )
    path = scratch(spark, "training")
    io.write_table(train, path)
    return _suite_shown(ex.check_training_set(io.read_table(spark, path)))


def _sql_summary(results: str) -> str:
    return f"""SELECT suite, count(*) AS evaluated_checks, count(*) FILTER (WHERE success) AS successful_checks,
       count(*) FILTER (WHERE NOT success) AS failed_checks,
       {sql_fixed("count(*) FILTER (WHERE success) * 100.0 / count(*)")} AS success_percent,
       bool_and(success) AS success FROM ({results}) GROUP BY suite"""


SQL_SUITES = (
    sql_suite("tx", "transactions_suite", ex.transactions_suite(NOW), _TX_COLUMNS)
    + " UNION ALL "
    + sql_suite("credit_view", "credit_bureau_suite", ex.credit_suite(), _CREDIT_COLUMNS)
)


def two_suites(spark, folder):
    return ex.check_transactions(suite_events(spark, folder), now=NOW).unionByName(
        ex.check_credit(inputs.credit_view(spark, folder))
    )


@query("suite_summary", f"WITH {SQL_SUITE_EVENTS}, {inputs.CREDIT_ROWS} {_sql_summary(SQL_SUITES)}")
def suite_summary(spark, folder):
    """Pass and fail counts, pass percent and overall result per suite."""
    return ex.suite_summary(two_suites(spark, folder)).withColumn(
        "success_percent", fixed("success_percent")
    )


# --- single aggregates -----------------------------------------------------------------


@query(
    "duplicate_keys",
    """SELECT 'lineitem.l_orderkey' AS key, CAST(sum(n) AS BIGINT) AS evaluated,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS unexpected
FROM (SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)
UNION ALL
SELECT 'orders.o_orderkey', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)""",
)
def duplicate_keys(spark, folder):
    """Values of a key that occur more than once."""
    parts = [
        ex.duplicate_values(table(spark, folder, t), c).withColumn("key", F.lit(f"{t}.{c}"))
        for t, c in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "distinct_rows",
    """SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)""",
)
def distinct_rows(spark, folder):
    """Row count against distinct-row count, in one grouped pass."""
    return ex.distinct_rows(
        table(spark, folder, "lineitem").select(
            "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
        )
    )


@query(
    "distinct_whole_rows",
    """SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS distinct_rows
FROM lineitem""",
)
def distinct_whole_rows(spark, folder):
    """The duplicate-row count over every column of the table."""
    return ex.distinct_rows(table(spark, folder, "lineitem"))


# --- validation job over two dates of the feature table --------------------------------

REFERENCE_DAY, CURRENT_DAY = "1998-08-02", "1998-09-01"
FILES = 4


def feature_tables(spark, folder):
    """Feature tables of the reference and the current date, written once and read back."""
    rows = inputs.order_events(spark, folder)
    root = scratch(spark, "features")
    for day in (REFERENCE_DAY, CURRENT_DAY):
        io.write_partition(latest_feature_table(rows, day), root, day, "user_id", files=FILES)
    return tuple(io.read_partition(spark, root, day) for day in (REFERENCE_DAY, CURRENT_DAY))


def sql_feature_tables() -> str:
    parts = [inputs.ORDER_EVENTS]
    for name, day in (("ref", REFERENCE_DAY), ("cur", CURRENT_DAY)):
        text = f"{rolling_plans._sql_clean(day)}, {rolling_plans._sql_rolled('clean')}"
        for inner in ("clean", "aggregated", "rolled", "newest"):
            text = text.replace(f"{inner} AS (", f"{name}_{inner} AS (").replace(
                f"FROM {inner}\n", f"FROM {name}_{inner}\n"
            )
        parts.append(text)
    return ", ".join(parts)


@query(
    "feature_partitions",
    f"WITH {sql_feature_tables()} {rolling_plans._sql_shown('cur_newest', 'user_id')}",
)
def feature_partitions(spark, folder):
    """Two dates written as partitions, one overwritten again, and one read back."""
    rows = inputs.order_events(spark, folder)
    root = scratch(spark, "features")
    early, late = (latest_feature_table(rows, d) for d in (REFERENCE_DAY, CURRENT_DAY))
    io.write_partition(early, root, REFERENCE_DAY, "user_id", files=FILES)
    io.write_partition(early, root, CURRENT_DAY, "user_id", files=FILES)
    io.write_partition(late, root, CURRENT_DAY, "user_id", files=FILES)
    return rolling_plans.shown(io.read_partition(spark, root, CURRENT_DAY), "user_id")


_NUMERIC = validation.NUMERIC_FEATURES


@query(
    "validation_null_rates",
    f"WITH {sql_feature_tables()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {sql_fixed(f'avg(CAST({c} IS NULL AS INTEGER))', 6)} AS null_rate, "
        f"avg(CAST({c} IS NULL AS INTEGER)) > 0.02 AS violated, count(*) AS total_rows FROM cur_newest"
        for c in _NUMERIC
    ),
)
def validation_null_rates(spark, folder):
    """Null rates of all features in one pass."""
    _, current = feature_tables(spark, folder)
    return validation.null_rates(current).withColumn("null_rate", fixed("null_rate", 6))


# Bounds that some rows break, next to the declared ones.
TIGHT_RANGES = {**validation.FEATURE_RANGES, "tx_amount_max_7d": (1_000, 400_000), "absent": (0, 1)}


@query(
    "validation_ranges",
    f"WITH {sql_feature_tables()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS out_of_range_count, "
        f"CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high, "
        f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) > 0 AS violated FROM cur_newest"
        for c, (lo, hi) in TIGHT_RANGES.items()
        if c != "absent"
    ),
)
def validation_ranges(spark, folder):
    """Out-of-range counts of all columns in one pass; absent columns are skipped."""
    _, current = feature_tables(spark, folder)
    return validation.range_counts(current, TIGHT_RANGES)
