"""Queries: jobs that write tables run by run, and what their readers then find."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.functions.timing import DAY
from tidemark.operators import publish, rolling, validation
from tidemark.operators.rolling_state import RollingState, incremental_feature_table
from tidemark.plans import inputs
from tidemark.plans import drift as drift_plans
from tidemark.plans import pit as pit_plans
from tidemark.plans import rolling as rolling_plans
from tidemark.plans.quality import CURRENT_DAY, FILES, REFERENCE_DAY, sql_feature_tables
from tidemark.plans.registry import ORACLES, fixed, query, scratch, sql_fixed, sql_stamp, stamp
from tidemark.sources import io
from tidemark.sources.latest_store import LatestStore
from tidemark.sources.schemas import CREDIT_VIEW, PROFILE_VIEW, RAW_EVENTS, TRANSACTION_VIEW

# --- latest-value tables, run by run ---------------------------------------------------

ENDS = ("1998-01-31", "1998-06-30", "1998-12-31")
_ONLINE = pit_plans._ONLINE


def stored_views(spark, folder):
    """The online views as written feature sources, so that a run reads its slice of time alone."""
    views = {}
    for name, (view, rows) in inputs.all_views(spark, folder, [v.name for v, _ in _ONLINE]).items():
        path = scratch(spark, "source")
        io.write_table(rows, path)
        views[name] = (view, io.read_table(spark, path))
    return views


def _sql_incremental(view, source) -> str:
    start = f"TIMESTAMP '{ENDS[0]}' - to_days({view.ttl_days})"
    features = ", ".join(f"{sql_fixed(c) if t == 'double' else c} AS {c}" for c, t in view.fields.items())
    return f"""SELECT '{view.name}' AS feature_view, customer_id, {sql_stamp('event_timestamp')} AS event_timestamp, {features}
FROM {source} WHERE event_timestamp BETWEEN {start} AND TIMESTAMP '{ENDS[-1]}'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC, created_timestamp DESC) = 1"""


@query(
    "materialize_all_incremental",
    f"WITH {pit_plans.ALL_ROWS} " + " UNION ALL BY NAME ".join(f"({_sql_incremental(v, s)})" for v, s in _ONLINE),
)
def materialize_all_incremental(spark, folder):
    """Three runs over all online views, each from the marks that the one before left."""
    store, views = LatestStore(spark, scratch(spark, "store"), buckets=16), stored_views(spark, folder)
    for end in ENDS:
        store.materialize_incremental(views, end)
    out = None
    for name, (view, rows) in store.latest([v for v, _ in _ONLINE]).items():
        shown = pit_plans._latest_shown(rows, view).withColumn("feature_view", F.lit(name))
        out = shown if out is None else out.unionByName(shown, allowMissingColumns=True)
    return out


_DAYS = (pit_plans.MAT_START, pit_plans.MAT_END)
_BETWEEN = f"event_timestamp BETWEEN TIMESTAMP '{_DAYS[0]} 00:00:00' AND TIMESTAMP '{_DAYS[1]} 23:59:59'"


def _sql_status(run, view, source, status, counted) -> str:
    entities = "count(DISTINCT customer_id)" if counted else "CAST(NULL AS BIGINT)"
    rows = f" FROM {source} WHERE {_BETWEEN}" if counted else ""
    error = "'AnalysisException'" if status == "failed" else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT {run} AS run, '{view.name}' AS feature_view, {entities} AS entities, '{_DAYS[0]} 00:00:00' AS start_time, "
        f"'{_DAYS[1]} 23:59:59' AS end_time, '{status}' AS status, {error} AS error{rows}"
    )


_FIRST_RUN = ("success", "failed", "skipped")


@query(
    "materialize_run",
    f"WITH {pit_plans.ALL_ROWS} "
    + " UNION ALL ".join(
        [_sql_status(1, v, s, status, status == "success") for (v, s), status in zip(_ONLINE, _FIRST_RUN)]
        + [_sql_status(2, v, s, "success", True) for v, s in _ONLINE]
    ),
)
def materialize_run(spark, folder):
    """A run that stops at a source that lacks a column, and the run after it was mended."""
    store, views = LatestStore(spark, scratch(spark, "store"), buckets=4), stored_views(spark, folder)
    broken = dict(views)
    broken[CREDIT_VIEW.name] = (CREDIT_VIEW, views[CREDIT_VIEW.name][1].drop("debt_to_income"))
    first = store.materialize_run(broken, *_DAYS)
    return first.withColumn("run", F.lit(1)).unionByName(store.materialize_run(views, *_DAYS).withColumn("run", F.lit(2)))


# --- the feature job from kept state ---------------------------------------------------

RUN_DAYS = ("2024-01-12", "2024-01-21", rolling_plans.RUN_DAY)


def arrivals(spark, folder):
    """Raw events as files with the run they came in with; some come a run or two late."""
    events = inputs.events(spark, folder).select(*RAW_EVENTS.names)
    late = F.pmod(F.col("event_id").cast("long"), F.lit(11))
    came = F.col("event_timestamp") + F.when((late == 0) & (F.col("event_timestamp") < "2024-01-18"), F.expr("INTERVAL 10 DAYS")).otherwise(
        F.expr("INTERVAL 0 DAYS")
    )
    run = F.when(came <= RUN_DAYS[0], 1).when(came <= RUN_DAYS[1], 2).otherwise(3)
    path = scratch(spark, "events")
    events.withColumn("run", run).write.partitionBy("run").parquet(path)
    return path


@query("feature_table_incremental", ORACLES["feature_table"])
def feature_table_incremental(spark, folder):
    """Three runs of the feature job; each reads the days that its new events touch, and its
    state of all others. Late events replace the days they belong to."""
    path = arrivals(spark, folder)
    state = RollingState(spark, scratch(spark, "state"))
    for k, day in enumerate(RUN_DAYS, 1):
        paths = [f"{path}/run={r}" for r in range(1, k + 1)]
        events = spark.read.schema(RAW_EVENTS).parquet(*paths)
        table = incremental_feature_table(state, io.read_events(spark, paths[-1]), events, day)
    return rolling_plans.shown(table, "user_id")


@query("feature_job", ORACLES["feature_table"])
def feature_job(spark, folder):
    """The feature job from paths: raw events with the declared schema to a dated partition."""
    events, features = scratch(spark, "events"), scratch(spark, "features")
    inputs.events(spark, folder).write.parquet(events)
    found = jobs.feature_job(spark, events, features, rolling_plans.RUN_DAY, files=FILES)
    return rolling_plans.shown(found.drop("date"), "user_id")


# --- checks before publication ---------------------------------------------------------

_ATTEMPTS = (("ref_newest", "tx_count_7d"), ("cur_newest", "tx_count_7d - 1000000"), ("cur_newest", "tx_count_7d"))


def _sql_attempt(n: int) -> str:
    source, count = _ATTEMPTS[n - 1]
    stands = {1: "ref_newest", 2: "ref_newest", 3: "cur_newest"}[n]
    bad = f"""(SELECT coalesce(bool_or(tx_count_7d NOT BETWEEN 0 AND 10000 OR tx_count_30d NOT BETWEEN 0 AND 50000
      OR tx_amount_sum_30d NOT BETWEEN 0 AND 10000000 OR fraud_tx_count_30d NOT BETWEEN 0 AND 1000), false)
    FROM (SELECT * REPLACE ({count} AS tx_count_7d) FROM {source}))"""
    return f"""SELECT {n} AS attempt, "check", CASE WHEN "check" = 'ranges' AND {bad} THEN 'fail' ELSE 'pass' END AS status,
  (SELECT count(*) FROM {source}) AS staged_rows, NOT {bad} AS published,
  (SELECT count(*) FROM {stands}) AS rows_read, (SELECT {sql_fixed('sum(tx_amount_sum_90d)', 2)} FROM {stands}) AS amount_read
FROM (VALUES ('schema'), ('null_rates'), ('ranges')) AS c("check")"""


@query(
    "gated_publish",
    f"WITH {sql_feature_tables()} " + " UNION ALL ".join(f"({_sql_attempt(n)})" for n in (1, 2, 3)),
)
def gated_publish(spark, folder):
    """One date published, then a failing partition for it, then a good one: what each attempt's
    checks say and what readers of that date find afterwards."""
    rows, root = inputs.order_events(spark, folder), scratch(spark, "features")
    early, late = (rolling.latest_feature_table(rows, d) for d in (REFERENCE_DAY, CURRENT_DAY))
    broken = late.withColumn("tx_count_7d", F.col("tx_count_7d") - 1_000_000)
    checks = partial(validation.check_statuses, max_null_rate=1.0)
    out = None
    for n, table in enumerate((early, broken, late), 1):
        said = publish.gated_publish(table, root, CURRENT_DAY, "user_id", checks, files=FILES)
        found = io.read_partition(spark, root, CURRENT_DAY).agg(F.count(F.lit(1)).alias("rows"), F.sum("tx_amount_sum_90d").alias("amount")).first()
        said = said.drop("date").withColumns(
            {"attempt": F.lit(n), "rows_read": F.lit(found["rows"]), "amount_read": fixed(F.lit(found["amount"]), 2)}
        )
        out = said if out is None else out.unionByName(said)
    return out


@query("validation_job", ORACLES["validation_report"])
def validation_job(spark, folder):
    """The validation job from paths: two dated partitions, thirty days apart, to a report file."""
    rows, features = inputs.order_events(spark, folder), scratch(spark, "features")
    for day in (jobs.reference_day(CURRENT_DAY), CURRENT_DAY):
        io.write_partition(rolling.latest_feature_table(rows, day), features, day, "user_id", files=FILES)
    report = jobs.validation_job(spark, features, CURRENT_DAY, scratch(spark, "reports"))
    return io.drift_of_report(report, "report").withColumn("drifted_columns", F.array_join("drifted_columns", ","))


# --- schemas of dated partitions -------------------------------------------------------

_SCHEMA_DAYS = ("1998-08-01", "1998-08-02", "1998-08-03")


@query(
    "schema_history",
    f"""WITH changes(day, "column", type, change) AS (VALUES
  (1, 'amount', 'double', 'added'), (1, 'customer', 'bigint', 'added'), (1, 'priority', 'string', 'added'),
  (2, 'n', 'int', 'added'), (2, 'priority', NULL, 'removed'),
  (3, 'customer', 'string', 'was bigint')
), days(day, moment) AS (VALUES (1, DATE '{_SCHEMA_DAYS[0]}'), (2, DATE '{_SCHEMA_DAYS[1]}'), (3, DATE '{_SCHEMA_DAYS[2]}'))
SELECT CAST(moment AS VARCHAR) AS "date", "column", type, change,
       (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderdate <= moment) AS rows_read,
       CASE day WHEN 3 THEN 'customer (bigint -> string)' ELSE '' END AS refused
FROM changes JOIN days USING (day)""",
)
def schema_history(spark, folder):
    """Three dates of a table whose columns come, go and change their type; the change of type is
    refused at first and then made on purpose. Every date is read with its own schema."""
    orders, root = pit_plans.table(spark, folder, "orders"), scratch(spark, "features")

    def rows(day):
        known = orders.where(F.col("o_orderdate") <= F.lit(day).cast("timestamp")).groupBy(F.col("o_custkey").alias("customer"))
        return known.agg(F.sum("o_totalprice").alias("amount"), F.max("o_orderpriority").alias("priority"))

    versions = (
        rows(_SCHEMA_DAYS[0]),
        rows(_SCHEMA_DAYS[1]).drop("priority").withColumn("n", F.lit(1)),
        rows(_SCHEMA_DAYS[2]).drop("priority").withColumns({"n": F.lit(1), "customer": F.col("customer").cast("string")}),
    )
    refused = {}
    for day, table in zip(_SCHEMA_DAYS, versions):
        refused[day] = ", ".join(io.type_changes(table, root, day))
        io.write_partition(table, root, day, "customer", files=FILES, new_types="replace" if refused[day] else "refuse")
    read = [(d, io.read_partition(spark, root, d).count(), refused[d]) for d in _SCHEMA_DAYS]
    counts = spark.createDataFrame(read, "day string, rows_read long, refused string")
    history = io.schema_history(spark, root).withColumn("date", F.col("date").cast("string"))
    return history.join(counts, F.col("date") == F.col("day")).drop("day")
