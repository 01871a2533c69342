"""Queries: drift statistics, drift reports and the validation report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cumulative as cum
from tidemark.operators import drift, validation
from tidemark.operators.validation import NUMERIC_FEATURES
from tidemark.plans import inputs
from tidemark.plans.quality import CURRENT_DAY, REFERENCE_DAY, feature_tables, sql_feature_tables
from tidemark.plans.registry import fixed, query, scratch, sql_fixed, table
from tidemark.sources import io

# --- sample pairs ----------------------------------------------------------------------

EVENT_SPLIT, ORDER_SPLIT, SHIP_SPLIT = "2024-01-11", "1998-01-01", "1998-01-01"
LINEITEM_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _split(df, ts, at):
    early = F.col(ts) < F.lit(at).cast("timestamp")
    return df.where(early).drop(ts), df.where(~early).drop(ts)


def event_samples(spark, folder):
    """Events before and from day 10: two numeric and two text columns."""
    ev = inputs.events(spark, folder).select(
        "event_timestamp",
        F.col("transaction_amount").alias("amount"),
        F.col("merchant_category").cast("int").alias("category_no"),
        "transaction_type",
        "country_code",
    )
    return _split(ev, "event_timestamp", EVENT_SPLIT)


def order_samples(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        "o_totalprice",
        "o_orderpriority",
        "o_orderstatus",
    )
    return _split(rows, "ts", ORDER_SPLIT)


def lineitem_samples(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), *LINEITEM_COLUMNS
    )
    return _split(rows, "ts", SHIP_SPLIT)


def document_samples(spark, folder):
    """Lengths of English against other documents: two different distributions."""
    docs = table(spark, folder, "documents").select("n_chars", "lang")
    english = F.col("lang") == "en"
    return docs.where(english).drop("lang"), docs.where(~english).drop("lang")


def _sql_long(source: str, side: str, columns, kind: str = "DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, CASE WHEN {side} THEN 0 ELSE 1 END AS side, "
        f"CAST({expr} AS {kind}) AS value FROM {source}"
        for name, expr in columns.items()
    )


EVENT_NUMBERS = _sql_long(
    "ev",
    f"event_timestamp < TIMESTAMP '{EVENT_SPLIT}'",
    {"amount": "transaction_amount", "category_no": "merchant_category"},
)
EVENT_TEXTS = _sql_long(
    "ev",
    f"event_timestamp < TIMESTAMP '{EVENT_SPLIT}'",
    {"transaction_type": "transaction_type", "country_code": "country_code"},
    "VARCHAR",
)
ORDER_SIDE = f"o_orderdate < TIMESTAMP '{ORDER_SPLIT}'"
ORDER_NUMBERS = _sql_long("orders", ORDER_SIDE, {"o_totalprice": "o_totalprice"})
ORDER_TEXTS = _sql_long(
    "orders",
    ORDER_SIDE,
    {"o_orderpriority": "o_orderpriority", "o_orderstatus": "o_orderstatus"},
    "VARCHAR",
)
LINE_NUMBERS = _sql_long(
    "lineitem", f"l_shipdate < TIMESTAMP '{SHIP_SPLIT}'", {c: c for c in LINEITEM_COLUMNS}
)
DOC_NUMBERS = _sql_long("documents", "lang = 'en'", {"n_chars": "n_chars"})

# --- statistics as SQL over long(feature, side, value) ---------------------------------


def sql_counts(long: str) -> str:
    return f"""long AS ({long}),
vc AS (
  SELECT feature, value, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1
  FROM long WHERE value IS NOT NULL GROUP BY feature, value
), cu AS (
  SELECT *, sum(n0) OVER w AS cum0, sum(n1) OVER w AS cum1,
         sum(n0) OVER (PARTITION BY feature) AS tot0, sum(n1) OVER (PARTITION BY feature) AS tot1,
         lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
  FROM vc WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)
)"""


_Z = "(sqrt(n0 * n1 / (n0 + n1)) + 0.12 + 0.11 / sqrt(n0 * n1 / (n0 + n1))) * statistic"
_SERIES = " ".join(
    f"{'+' if k % 2 else '-'} exp({-2 * k * k} * z * z)" for k in range(1, 20)
)
SQL_KS = f"""ks0 AS (
  SELECT feature, CAST(max(tot0) AS DOUBLE) AS n0, CAST(max(tot1) AS DOUBLE) AS n1,
         coalesce(max(abs(cum0 / nullif(tot0, 0) - cum1 / nullif(tot1, 0))), 0) AS statistic
  FROM cu GROUP BY feature
), ks AS (
  SELECT *, CASE WHEN z IS NULL THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (0 {_SERIES}))) END AS p_value
  FROM (SELECT *, CASE WHEN n0 > 0 AND n1 > 0 THEN {_Z} END AS z FROM ks0)
)"""
SQL_PSI = """edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e,
         count(*) AS tot0
  FROM long WHERE side = 0 AND value IS NOT NULL GROUP BY feature
), bins AS (
  SELECT feature, i - 1 AS bin, e[i] AS low, e[i + 1] AS high, i = len(e) - 1 AS is_last, tot0
  FROM (SELECT feature, e, tot0, unnest(range(1, len(e))) AS i FROM edges)
), binned AS (
  SELECT b.feature, b.bin, any_value(low) AS low, any_value(high) AS high, any_value(b.tot0) AS tot0,
         coalesce(sum(n0), 0) AS n0, coalesce(sum(n1), 0) AS n1
  FROM bins b LEFT JOIN vc ON vc.feature = b.feature AND value >= low AND (value < high OR (is_last AND value = high))
  GROUP BY b.feature, b.bin
), sizes AS (SELECT feature, sum(n0) AS tot0, sum(n1) AS tot1 FROM vc GROUP BY feature),
psi AS (
  SELECT s.feature, CASE WHEN s.tot0 > 0 AND s.tot1 > 0 THEN greatest(0.0, coalesce(sum(
           ((n1 + 1e-8) / (s.tot1 + 1e-7) - (n0 + 1e-8) / (s.tot0 + 1e-7))
           * ln(((n1 + 1e-8) / (s.tot1 + 1e-7)) / ((n0 + 1e-8) / (s.tot0 + 1e-7)))), 0.0)) END AS psi
  FROM sizes s LEFT JOIN binned b ON b.feature = s.feature GROUP BY s.feature, s.tot0, s.tot1
)"""
SQL_MOMENTS = """moments AS (
  SELECT feature, avg(value) FILTER (WHERE side = 0) AS reference_mean,
         avg(value) FILTER (WHERE side = 1) AS current_mean,
         stddev_pop(value) FILTER (WHERE side = 0) AS reference_std,
         stddev_pop(value) FILTER (WHERE side = 1) AS current_std
  FROM long GROUP BY feature
)"""
SQL_DISTANCE = """w1 AS (
  SELECT feature, sum(abs(cum0 / nullif(tot0, 0) - cum1 / nullif(tot1, 0)) * coalesce(next_value - value, 0)) AS distance
  FROM cu GROUP BY feature
)"""


def sql_js_numeric(bins: int = 30) -> str:
    return f"""span AS (
  SELECT feature, min(value) AS low, max(value) AS high, sum(n0) AS tot0, sum(n1) AS tot1 FROM vc GROUP BY feature
), js AS (
  SELECT feature, sqrt(greatest(0.0, sum(
           CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
           + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS distance
  FROM (
    SELECT vc.feature, least(coalesce(floor((value - low) / nullif(high - low, 0) * {bins}), 0), {bins - 1}) AS bin,
           sum(n0) / nullif(any_value(tot0), 0) AS p, sum(n1) / nullif(any_value(tot1), 0) AS q
    FROM vc JOIN span ON span.feature = vc.feature GROUP BY ALL)
  GROUP BY feature
)"""


def sql_category_counts(long: str) -> str:
    return f"""texts AS ({long}),
cc AS (
  SELECT feature, value AS category, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1
  FROM texts WHERE value IS NOT NULL GROUP BY feature, value
), ct AS (SELECT feature, sum(n0) AS tot0, sum(n1) AS tot1, count(*) AS categories FROM cc GROUP BY feature)"""


# Closed forms of the chi-squared tail for the even degrees of freedom that occur here.
SQL_CHI2 = """chi AS (
  SELECT feature, statistic, dof,
         CASE dof WHEN 2 THEN exp(-statistic / 2) WHEN 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END AS p_value
  FROM (
    SELECT cc.feature, any_value(categories) - 1 AS dof,
           sum(power(n0 - (n0 + n1) * tot0 / (tot0 + tot1), 2) / ((n0 + n1) * tot0 / (tot0 + tot1))
             + power(n1 - (n0 + n1) * tot1 / (tot0 + tot1), 2) / ((n0 + n1) * tot1 / (tot0 + tot1))) AS statistic
    FROM cc JOIN ct ON ct.feature = cc.feature GROUP BY cc.feature)
)"""
SQL_JS_CATEGORY = """jsc AS (
  SELECT feature, sqrt(greatest(0.0, sum(
           CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
           + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS distance
  FROM (SELECT cc.feature, n0 / tot0 AS p, n1 / tot1 AS q FROM cc JOIN ct ON ct.feature = cc.feature)
  GROUP BY feature
)"""


def sql_band(psi: str) -> str:
    return f"CASE WHEN {psi} < 0.1 THEN 'LOW' WHEN {psi} < 0.25 THEN 'MEDIUM' WHEN {psi} IS NOT NULL THEN 'HIGH' END"


# --- single statistics -----------------------------------------------------------------


def _cumulative(pair, columns):
    return cum.cumulative_counts(cum.two_samples(*pair, columns), columns)


@query(
    "ks_lineitem",
    f"WITH {sql_counts(LINE_NUMBERS)}, {SQL_KS} SELECT feature, {sql_fixed('statistic', 8)} AS statistic, "
    f"{sql_fixed('p_value', 8)} AS p_value, CAST(n0 AS BIGINT) AS n_reference, "
    f"CAST(n1 AS BIGINT) AS n_current FROM ks",
)
def ks_lineitem(spark, folder):
    """Two-sample KS statistic and p-value of four columns in one pass."""
    tested = drift.ks_columns(cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS), LINEITEM_COLUMNS)
    return tested.select(
        "feature",
        fixed("statistic", 8).alias("statistic"),
        fixed("p_value", 8).alias("p_value"),
        "n_reference",
        "n_current",
    )


@query(
    "ks_documents",
    f"WITH {sql_counts(DOC_NUMBERS)}, {SQL_KS} SELECT feature, {sql_fixed('statistic', 8)} AS statistic, "
    f"{sql_fixed('p_value', 8)} AS p_value FROM ks",
)
def ks_documents(spark, folder):
    tested = drift.ks_columns(cum.two_samples(*document_samples(spark, folder), ["n_chars"]), ["n_chars"])
    return tested.select(
        "feature", fixed("statistic", 8).alias("statistic"), fixed("p_value", 8).alias("p_value")
    )


# Per nation: rounded balances of its customers and of its suppliers, with ties.
_NATION_SAMPLES = """
  SELECT n_name AS feature, 0 AS side, CAST(round(c_acctbal / 400) AS DOUBLE) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT n_name, 1, CAST(round(s_acctbal / 400) AS DOUBLE) FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


@query(
    "ks_exact_small",
    f"""WITH RECURSIVE {sql_counts(_NATION_SAMPLES)}, steps AS (
  SELECT feature, CAST(max(tot0) AS BIGINT) AS n, CAST(max(tot1) AS BIGINT) AS m,
         CAST(max(abs(cum0 * tot1 - cum1 * tot0)) AS BIGINT) AS apart FROM cu GROUP BY feature
), paths AS (
  SELECT feature, n, m, apart, CAST(0 AS BIGINT) AS i,
         list_transform(range(0, m + 1), lambda j: CASE WHEN j * n < apart THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS u
  FROM steps WHERE n > 0 AND m > 0
  UNION ALL
  SELECT feature, n, m, apart, i + 1,
         list_transform(range(0, m + 1), lambda j: CASE WHEN abs((i + 1) * m - j * n) < apart
           THEN list_sum(list_transform(range(0, j + 1), lambda t: CASE WHEN abs((i + 1) * m - t * n) < apart THEN u[t + 1] ELSE CAST(0 AS DOUBLE) END))
                * (i + 1) / (i + 1 + m) ELSE CAST(0 AS DOUBLE) END)
  FROM paths WHERE i < n
)
SELECT feature, {sql_fixed('apart / (CAST(n AS DOUBLE) * m)', 8)} AS statistic, n AS n_reference, m AS n_current,
       {sql_fixed('least(1.0, greatest(0.0, 1 - u[m + 1]))', 8)} AS p_value FROM paths WHERE i = n""",
)
def ks_exact_small(spark, folder):
    """Customers against suppliers of each nation: few suppliers, so the p-values are exact."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    names = {r["n_nationkey"]: r["n_name"] for r in nations.collect()}  # one number and name per nation

    def side(rows, key, balance, of):
        return table(spark, folder, rows).select(
            F.lit(of).alias(cum.SIDE), F.col(key).alias("no"), F.round(F.col(balance) / 400).alias("value")
        )

    both = side("customer", "c_nationkey", "c_acctbal", cum.REFERENCE).unionByName(side("supplier", "s_nationkey", "s_acctbal", cum.CURRENT))
    tested = drift.ks_by_group(both, [names[i] for i in sorted(names)], exact_rows=10_000)
    # a nation without customers or without suppliers has no two samples
    return tested.where((F.col("n_reference") > 0) & (F.col("n_current") > 0)).select(
        "feature", fixed("statistic", 8).alias("statistic"), "n_reference", "n_current", fixed("p_value", 8).alias("p_value")
    )


@query(
    "wasserstein_lineitem",
    f"WITH {sql_counts(LINE_NUMBERS)}, {SQL_DISTANCE} "
    f"SELECT feature, {sql_fixed('distance', 6)} AS distance FROM w1",
)
def wasserstein_lineitem(spark, folder):
    rows = _cumulative(lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    return drift.wasserstein_distance(rows).withColumn(
        "distance", fixed("distance", 6)
    )


@query(
    "jensen_shannon_lineitem",
    f"WITH {sql_counts(LINE_NUMBERS)}, {sql_js_numeric()} "
    f"SELECT feature, {sql_fixed('distance', 6)} AS distance FROM js",
)
def jensen_shannon_lineitem(spark, folder):
    pair = cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    return drift.jensen_shannon_numeric(pair, LINEITEM_COLUMNS).withColumn(
        "distance", fixed("distance", 6)
    )


@query(
    "jensen_shannon_events",
    f"WITH {inputs.EVENTS}, {sql_category_counts(EVENT_TEXTS)}, {SQL_JS_CATEGORY} "
    f"SELECT feature, {sql_fixed('distance', 6)} AS distance FROM jsc",
)
def jensen_shannon_events(spark, folder):
    pair = cum.two_samples(*event_samples(spark, folder), ["transaction_type", "country_code"])
    counts = drift.category_counts(pair, ["transaction_type", "country_code"])
    return drift.jensen_shannon_category(counts).withColumn("distance", fixed("distance", 6))


@query(
    "chi_squared_events",
    f"WITH {inputs.EVENTS}, {sql_category_counts(EVENT_TEXTS)}, {SQL_CHI2} "
    f"SELECT feature, {sql_fixed('statistic', 6)} AS statistic, dof, {sql_fixed('p_value', 8)} AS p_value FROM chi",
)
def chi_squared_events(spark, folder):
    pair = cum.two_samples(*event_samples(spark, folder), ["transaction_type", "country_code"])
    tested = drift.chi_squared_test(drift.category_counts(pair, ["transaction_type", "country_code"]))
    return tested.select(
        "feature",
        fixed("statistic", 6).alias("statistic"),
        F.col("dof").cast("long").alias("dof"),
        fixed("p_value", 8).alias("p_value"),
    )


@query(
    "psi_lineitem",
    f"WITH {sql_counts(LINE_NUMBERS)}, {SQL_PSI} SELECT feature, {sql_fixed('psi', 8)} AS psi, "
    f"{sql_band('psi')} AS psi_label FROM psi",
)
def psi_lineitem(spark, folder):
    """PSI with repeated edges: discount and tax have few values."""
    pair = cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    return _psi_shown(drift.psi(pair, LINEITEM_COLUMNS))


def _psi_shown(scored):
    return scored.select(
        "feature", fixed("psi", 8).alias("psi"), drift.psi_band(F.col("psi")).alias("psi_label")
    )


@query(
    "psi_documents",
    f"WITH {sql_counts(DOC_NUMBERS)}, {SQL_PSI} SELECT feature, {sql_fixed('psi', 8)} AS psi, "
    f"{sql_band('psi')} AS psi_label FROM psi",
)
def psi_documents(spark, folder):
    pair = cum.two_samples(*document_samples(spark, folder), ["n_chars"])
    return _psi_shown(drift.psi(pair, ["n_chars"]))


@query(
    "percentile_edges",
    f"WITH {sql_counts(LINE_NUMBERS)}, {SQL_PSI}, listed AS "
    f"(SELECT feature, e, unnest(range(1, len(e) + 1)) AS i FROM edges) "
    f"SELECT feature, CAST(i AS INTEGER) AS edge_no, {sql_fixed('e[i]', 6)} AS edge FROM listed",
)
def percentile_edges(spark, folder):
    """Exact interpolated deciles of the reference, repeats collapsed."""
    pair = cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    found = drift.numeric_profile(pair, LINEITEM_COLUMNS, cum.summarize(pair, LINEITEM_COLUMNS))
    return cum.small_table(
        spark,
        "feature string, edge_no int, edge double",
        [(c, i, e) for c, p in found.items() for i, e in enumerate(p.edges, 1)],
    ).withColumn("edge", fixed("edge", 6))


@query(
    "histogram",
    f"WITH {sql_counts(LINE_NUMBERS)}, {SQL_PSI} SELECT feature, CAST(bin AS INTEGER) AS bin, "
    f"{sql_fixed('low', 6)} AS low, {sql_fixed('high', 6)} AS high, CAST(n0 AS BIGINT) AS n0, "
    f"CAST(n1 AS BIGINT) AS n1 FROM binned",
)
def histogram(spark, folder):
    """Counts of both samples on the reference's decile bins."""
    pair = cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    found = drift.numeric_profile(pair, LINEITEM_COLUMNS, cum.summarize(pair, LINEITEM_COLUMNS))
    bins = cum.histogram(pair, {c: p.edges for c, p in found.items()})
    return bins.select(
        "feature", "bin", fixed("low", 6).alias("low"), fixed("high", 6).alias("high"), "n0", "n1"
    )


@query(
    "sample_moments",
    f"WITH long AS ({LINE_NUMBERS}), {SQL_MOMENTS} SELECT feature, "
    + ", ".join(
        f"{sql_fixed(c)} AS {c}"
        for c in ("reference_mean", "current_mean", "reference_std", "current_std")
    )
    + " FROM moments",
)
def sample_moments(spark, folder):
    """Mean and population deviation of both samples."""
    pair = cum.two_samples(*lineitem_samples(spark, folder), LINEITEM_COLUMNS)
    out = drift.moments(pair, LINEITEM_COLUMNS)
    return out.select("feature", *[fixed(c).alias(c) for c in out.columns if c != "feature"])


# --- validation job --------------------------------------------------------------------

FEATURE_NUMBERS = (
    _sql_long("ref_newest", "TRUE", {c: c for c in NUMERIC_FEATURES})
    + " UNION ALL "
    + _sql_long("cur_newest", "FALSE", {c: c for c in NUMERIC_FEATURES})
)
JOB_SQL = f"WITH {sql_feature_tables()}, {sql_counts(FEATURE_NUMBERS)}, {SQL_KS}"


@query(
    "validation_drift",
    f"{JOB_SQL} SELECT feature AS \"column\", {sql_fixed('statistic', 6)} AS ks_statistic, "
    f"{sql_fixed('p_value', 6)} AS p_value, statistic > 0.05 AS drifted FROM ks",
)
def validation_drift(spark, folder):
    """KS rows of all sixteen features between two dates of the feature table."""
    found = drift.distribution_drift(*feature_tables(spark, folder), NUMERIC_FEATURES)
    return found.select(
        "column",
        fixed("ks_statistic", 6).alias("ks_statistic"),
        fixed("p_value", 6).alias("p_value"),
        "drifted",
    )


_NULL_BAD = " OR ".join(f"avg(CAST({c} IS NULL AS INTEGER)) > 0.02" for c in NUMERIC_FEATURES)
_RANGE_BAD = " OR ".join(
    f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) > 0"
    for c, (lo, hi) in validation.FEATURE_RANGES.items()
)
_STATUSES = f"""statuses AS (
  SELECT 'schema' AS "check", 'pass' AS status
  UNION ALL SELECT 'null_rates', CASE WHEN {_NULL_BAD} THEN 'fail' ELSE 'pass' END FROM cur_newest
  UNION ALL SELECT 'ranges', CASE WHEN {_RANGE_BAD} THEN 'fail' ELSE 'pass' END FROM cur_newest
  UNION ALL SELECT 'drift', CASE WHEN bool_or(statistic > 0.05) THEN 'fail' ELSE 'pass' END FROM ks
)"""


def statuses(spark, folder):
    reference, current = feature_tables(spark, folder)
    found = drift.distribution_drift(reference, current, NUMERIC_FEATURES)
    return validation.check_statuses(current, drift=found)


@query("validation_statuses", f"{JOB_SQL}, {_STATUSES} SELECT \"check\", status FROM statuses")
def validation_statuses(spark, folder):
    """Schema, null rates, ranges and drift of the current feature table."""
    return statuses(spark, folder)


@query(
    "validation_overall",
    f"{JOB_SQL}, {_STATUSES} SELECT CASE WHEN bool_and(status = 'pass') THEN 'pass' ELSE 'fail' END "
    f"AS overall_status FROM statuses",
)
def validation_overall(spark, folder):
    return validation.overall_status(statuses(spark, folder))


@query(
    "validation_report",
    f"""{JOB_SQL}, {_STATUSES}
SELECT CASE WHEN (SELECT bool_and(status = 'pass') FROM statuses) THEN 'pass' ELSE 'fail' END AS overall_status,
       CASE WHEN bool_or(statistic > 0.05) THEN 'fail' ELSE 'pass' END AS drift_status,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE statistic > 0.05), '') AS drifted_columns
FROM ks""",
)
def validation_report(spark, folder):
    """The nested report written as JSON text and read back."""
    reference, current = feature_tables(spark, folder)
    report = validation.validation_report(reference, current, REFERENCE_DAY, CURRENT_DAY)
    path = scratch(spark, "report")
    io.write_report(report, path)
    text = spark.read.text(path, wholetext=True)
    overall = F.get_json_object("value", "$.overall_status").alias("overall_status")
    return io.drift_of_report(text.select("value", overall), "value").withColumn(
        "drifted_columns", F.array_join("drifted_columns", ",")
    )


# --- feature and dataset drift ---------------------------------------------------------

_ROUNDED = ("reference_mean", "current_mean", "reference_std", "current_std")


def drift_shown(df, *keys):
    return df.select(
        *keys,
        "feature_name",
        "stattest_name",
        fixed("drift_score", 6).alias("drift_score"),
        "drifted",
        fixed("psi", 6).alias("psi"),
        "psi_label",
        *[fixed(c).alias(c) for c in _ROUNDED],
    )


def sql_feature_rows(numeric_test: str = "ks", category_test: str = "chi2", limit=None, texts=True) -> str:
    """CTE ``features`` with unrounded rows, over the CTEs named above."""
    p_limit, d_limit = (limit, limit) if limit is not None else (0.05, 0.1)
    score, source, drifted = {
        "ks": ("t.p_value", "ks", f"t.p_value < {p_limit}"),
        "wasserstein": (
            "t.distance / greatest(m.reference_std, 0.001)",
            "w1",
            f"t.distance / greatest(m.reference_std, 0.001) >= {d_limit}",
        ),
        "jensenshannon": ("t.distance", "js", f"t.distance >= {d_limit}"),
        "psi": ("t.psi", "psi", f"t.psi >= {d_limit}"),
    }[numeric_test]
    rows = f"""SELECT t.feature AS feature_name, '{numeric_test}' AS stattest_name, {score} AS drift_score,
         {drifted} AS drifted, p.psi AS psi, {sql_band('p.psi')} AS psi_label,
         m.reference_mean, m.current_mean, m.reference_std, m.current_std
  FROM {source} t JOIN moments m ON m.feature = t.feature JOIN psi p ON p.feature = t.feature"""
    if texts:
        score, source, drifted = {
            "chi2": ("p_value", "chi", f"p_value < {p_limit}"),
            "jensenshannon": ("distance", "jsc", f"distance >= {d_limit}"),
        }[category_test]
        rows += f"""
  UNION ALL SELECT feature, '{category_test}', {score}, {drifted}, NULL, NULL, NULL, NULL, NULL, NULL FROM {source}"""
    return f"features AS ({rows})"


SQL_DRIFT_SHOWN = ", ".join(
    [
        "feature_name",
        "stattest_name",
        f"{sql_fixed('drift_score', 6)} AS drift_score",
        "drifted",
        f"{sql_fixed('psi', 6)} AS psi",
        "psi_label",
        *[f"{sql_fixed(c)} AS {c}" for c in _ROUNDED],
    ]
)


def sql_drift(prefix: str, numbers: str, texts: str | None, numeric="ks", category="chi2", limit=None) -> str:
    extra = {
        "ks": [SQL_KS],
        "wasserstein": [SQL_DISTANCE],
        "jensenshannon": [sql_js_numeric()],
        "psi": [],
    }[numeric]
    parts = [*([prefix] if prefix else []), sql_counts(numbers), SQL_PSI, SQL_MOMENTS, *extra]
    if texts:
        parts += [sql_category_counts(texts), SQL_CHI2 if category == "chi2" else SQL_JS_CATEGORY]
    parts.append(sql_feature_rows(numeric, category, limit, texts is not None))
    return "WITH " + ", ".join(parts)


@query(
    "feature_drift_events",
    f"{sql_drift(inputs.EVENTS, EVENT_NUMBERS, EVENT_TEXTS)} SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_events(spark, folder):
    """KS for numbers, chi-squared for text, with PSI and moments."""
    return drift_shown(drift.feature_drift(*event_samples(spark, folder)))


@query(
    "feature_drift_orders",
    f"{sql_drift('', ORDER_NUMBERS, ORDER_TEXTS)} SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_orders(spark, folder):
    return drift_shown(drift.feature_drift(*order_samples(spark, folder)))


@query(
    "feature_drift_wasserstein",
    f"{sql_drift(inputs.EVENTS, EVENT_NUMBERS, EVENT_TEXTS, 'wasserstein', 'jensenshannon', 0.02)} "
    f"SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_wasserstein(spark, folder):
    """Distances instead of p-values, with a threshold of one's own."""
    options = drift.DriftOptions(
        num_stattest="wasserstein", cat_stattest="jensenshannon", threshold=0.02
    )
    return drift_shown(drift.feature_drift(*event_samples(spark, folder), options=options))


@query(
    "feature_drift_one_test",
    f"{sql_drift(inputs.EVENTS, EVENT_NUMBERS, EVENT_TEXTS, 'jensenshannon', 'jensenshannon')} "
    f"SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_one_test(spark, folder):
    """One test for all columns."""
    options = drift.DriftOptions(stattest="jensenshannon")
    return drift_shown(drift.feature_drift(*event_samples(spark, folder), options=options))


@query(
    "feature_drift_psi",
    f"{sql_drift(inputs.EVENTS, EVENT_NUMBERS, EVENT_TEXTS, 'psi')} SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_psi(spark, folder):
    """The stability index as the test of numeric columns."""
    options = drift.DriftOptions(num_stattest="psi")
    return drift_shown(drift.feature_drift(*event_samples(spark, folder), options=options))


_EARLY = f"l_shipdate < TIMESTAMP '{SHIP_SPLIT}'"
_MAPPED = sql_drift(
    "",
    _sql_long("lineitem", _EARLY, {"l_quantity": "l_quantity", "l_tax": "l_tax"}),
    _sql_long("lineitem", _EARLY, {"line_kind": "l_linenumber % 3", "l_returnflag": "l_returnflag"}, "VARCHAR"),
)
_NONE = ", ".join(["NULL"] * 8)


@query(
    "feature_drift_mapped",
    f"""{_MAPPED}, every AS (
  SELECT * FROM features UNION ALL SELECT c, 'none', {_NONE} FROM (VALUES ('l_orderkey'), ('l_shipdate'), ('l_discount'), ('only_before')) AS v(c)
) SELECT {SQL_DRIFT_SHOWN} FROM every""",
)
def feature_drift_mapped(spark, folder):
    """Columns by what they stand for: a number that is a category, an id, a time, a target; and
    one that only one table has. None is lost."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), "l_quantity", "l_discount", "l_tax", (F.col("l_linenumber") % 3).alias("line_kind"), "l_returnflag"
    )
    early = F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp")
    mapping = drift.ColumnMapping(
        numeric=("l_quantity",), category=("line_kind",), target="l_returnflag", prediction="l_tax", ids=("l_orderkey",), times=("l_shipdate",)
    )
    before = rows.where(early).withColumn("only_before", F.lit(1))
    return drift_shown(drift.feature_drift(before, rows.where(~early), options=drift.DriftOptions(mapping=mapping)))


_WIDE = {f"x{k}": f"(l_extendedprice * {k}) % 1000" for k in range(1, 71)}


@query(
    "feature_drift_wide",
    f"{sql_drift('', _sql_long('lineitem', _EARLY, _WIDE), None)} SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def feature_drift_wide(spark, folder):
    """Seventy numeric columns: turned long and cut into cells level by level."""
    rows = table(spark, folder, "lineitem")
    columns = [((F.col("l_extendedprice") * k) % 1000).alias(f"x{k}") for k in range(1, 71)]
    rows = rows.select(F.col("l_shipdate").cast("timestamp").alias("ts"), *columns)
    return drift_shown(drift.feature_drift(*_split(rows, "ts", SHIP_SPLIT), options=drift.DriftOptions(buckets=128)))


_DATASET = f"""SELECT coalesce(string_agg(feature_name, ',' ORDER BY feature_name) FILTER (WHERE drifted), '') AS drifted_names,
       count(*) AS total_features, count(*) FILTER (WHERE drifted) AS drifted_features,
       {sql_fixed('avg(CAST(drifted AS INTEGER))', 6)} AS dataset_drift_ratio,
       avg(CAST(drifted AS INTEGER)) >= 0.5 AS dataset_drifted,
       avg(CAST(drifted AS INTEGER)) >= 0.2 AS recommend_retrain FROM features"""


@query("dataset_drift_orders", f"{sql_drift('', ORDER_NUMBERS, ORDER_TEXTS)} {_DATASET}")
def dataset_drift_orders(spark, folder):
    """Share of drifted features and the retrain recommendation."""
    summary = drift.dataset_drift(drift.feature_drift(*order_samples(spark, folder)))
    return _summary_shown(summary)


def _summary_shown(summary):
    return summary.withColumns(
        {
            "dataset_drift_ratio": fixed("dataset_drift_ratio", 6),
            "drifted_names": F.array_join("drifted_names", ","),
        }
    )


@query(
    "dataset_drift_documents",
    f"{sql_drift('', DOC_NUMBERS, None)} {_DATASET}",
)
def dataset_drift_documents(spark, folder):
    return _summary_shown(drift.dataset_drift(drift.feature_drift(*document_samples(spark, folder))))


_SCORES = f"""scored AS (
  SELECT l_shipdate < TIMESTAMP '{SHIP_SPLIT}' AS early,
         l_extendedprice * (1 - l_discount) / (l_extendedprice * (1 - l_discount) + 50000) AS score FROM lineitem
)"""


@query(
    "prediction_drift",
    f"{sql_drift(_SCORES, _sql_long('scored', 'early', {'__prediction__': 'score'}), None)} "
    f"SELECT {SQL_DRIFT_SHOWN} FROM features",
)
def prediction_drift(spark, folder):
    """Drift of a score column in (0, 1)."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), (revenue / (revenue + 50_000)).alias("score")
    )
    return drift_shown(drift.prediction_drift(*_split(rows, "ts", SHIP_SPLIT), "score"))


@query(
    "drift_report",
    f"""{sql_drift('', ORDER_NUMBERS, ORDER_TEXTS)}
SELECT 'orders' AS model_name, '1998-01-01T00:00:00' AS generated_at, '{ORDER_SPLIT}' AS "current_date",
       {sql_fixed('(SELECT avg(CAST(drifted AS INTEGER)) FROM features)')} AS ratio, feature_name,
       {sql_fixed('drift_score', 6)} AS drift_score, drifted, {sql_fixed('psi')} AS psi, psi_label,
       {sql_fixed('reference_mean')} AS reference_mean, {sql_fixed('current_std')} AS current_std
FROM features""",
)
def drift_report(spark, folder):
    """The nested drift report as JSON, read back to rows."""
    features = drift.feature_drift(*order_samples(spark, folder))
    report = drift.drift_report(
        features, drift.dataset_drift(features), current_date=ORDER_SPLIT, model_name="orders", generated_at="1998-01-01T00:00:00"
    )
    row = (
        "struct<feature_name:string,drift_score:double,drifted:boolean,psi:double,psi_label:string,"
        "reference_mean:double,current_std:double>"
    )
    head = ("model_name", "generated_at", "current_date")
    schema = ", ".join(f"{c} string" for c in head) + f", summary struct<dataset_drift_ratio:double>, feature_results array<{row}>"
    parsed = report.select(F.from_json("report", schema).alias("r"))
    return parsed.select(
        *[F.col("r")[c].alias(c) for c in head],
        fixed(F.col("r")["summary"]["dataset_drift_ratio"]).alias("ratio"),
        F.inline(F.col("r")["feature_results"]),
    )


