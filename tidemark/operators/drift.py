"""Distribution drift between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.stats import (
    PSI_EPSILON,
    chi_squared_p_value,
    ks_exact_p_value,
    ks_p_value,
    psi_band,
)
from tidemark.operators import wide
from tidemark.operators.cumulative import (
    BUCKETS,
    CURRENT,
    REFERENCE,
    SIDE,
    Summary,
    bin_counts,
    bin_equal_width,
    bounded_profile,
    bucket_totals,
    cumulative_counts,
    ecdf_gap,
    histogram,
    interpolated_edges,
    known_gap,
    needed_buckets,
    percentile_ranks,
    small_table,
    summarize,
    two_samples,
)

# Limits of the tests; p-value tests drift below, distances at or above.
P_VALUE_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
KS_STATISTIC_LIMIT = 0.05
RETRAIN_SHARE = 0.20
DATASET_DRIFT_SHARE = 0.5

NUMERIC_TESTS = ("ks", "wasserstein", "jensenshannon", "psi")
CATEGORY_TESTS = ("chi2", "jensenshannon")
P_VALUE_TESTS = ("ks", "chi2")


@dataclass(frozen=True)
class ColumnMapping:
    """What columns stand for, where their types do not say it.

    Named ``numeric`` columns are read as numbers and ``category`` columns as texts; where either is
    given, other columns of that kind are left out. ``target`` and ``prediction`` are tested by
    their own type; ``ids`` and ``times`` are not tested.
    """

    numeric: tuple[str, ...] | None = None
    category: tuple[str, ...] | None = None
    target: str | None = None
    prediction: str | None = None
    ids: tuple[str, ...] = ()
    times: tuple[str, ...] = ()


@dataclass(frozen=True)
class DriftOptions:
    """``stattest`` overrides the per-type tests; ``threshold`` overrides their limits.

    ``buckets`` is the number of parts that values are cut into while order statistics are looked
    for. ``exact_rows``: KS tests of samples that are both no larger get exact p-values.
    """

    stattest: str | None = None
    num_stattest: str = "ks"
    cat_stattest: str = "chi2"
    threshold: float | None = None
    retrain_share: float = RETRAIN_SHARE
    dataset_share: float = DATASET_DRIFT_SHARE
    bins: int = 10
    distance_bins: int = 30
    buckets: int = BUCKETS
    mapping: ColumnMapping | None = None
    exact_rows: int = 0

    def numeric_test(self) -> str:
        test = self.stattest if self.stattest in NUMERIC_TESTS else self.num_stattest
        if test not in NUMERIC_TESTS:
            raise ValueError(f"unknown numeric test {test!r}")
        return test

    def category_test(self) -> str:
        test = self.stattest if self.stattest in CATEGORY_TESTS else self.cat_stattest
        if test not in CATEGORY_TESTS:
            raise ValueError(f"unknown categorical test {test!r}")
        return test

    def limit(self, test: str) -> float:
        if self.threshold is not None:
            return self.threshold
        return P_VALUE_LIMIT if test in P_VALUE_TESTS else DISTANCE_LIMIT


def column_types(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric columns, and text or boolean columns."""
    numeric, category = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            category.append(f.name)
    return numeric, category


def _named(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature name; their number is bounded by the schema."""
    first = df.sparkSession.range(1)
    return first.select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))


# --- numeric statistics, all from cumulative counts ------------------------------------


def _ks_p(exact_rows: int, n0: str = "n0", n1: str = "n1") -> Column:
    """Asymptotic p-value, exact where both samples have ``exact_rows`` rows at most."""
    rough = ks_p_value(F.col("statistic"), F.col(n0), F.col(n1))
    if not exact_rows:
        return rough
    small = F.greatest(n0, n1) <= exact_rows
    return F.when(small, ks_exact_p_value(F.col("statistic"), F.when(small, F.col(n0)), F.when(small, F.col(n1)))).otherwise(rough)


def ks_test(cumulative: DataFrame) -> DataFrame:
    """Two-sample KS per feature: ``statistic`` and asymptotic ``p_value``.

    An empty sample gives statistic 0 and p-value 1.
    """
    return (
        cumulative.groupBy("feature")
        .agg(
            F.coalesce(F.max(ecdf_gap()), F.lit(0.0)).alias("statistic"),
            F.max("tot0").alias("n_reference"),
            F.max("tot1").alias("n_current"),
        )
        .withColumn("p_value", ks_p_value(F.col("statistic"), F.col("n_reference"), F.col("n_current")))
    )


def wasserstein_distance(cumulative: DataFrame) -> DataFrame:
    """Area between the two distribution functions per feature; null if a sample is empty."""
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    return cumulative.groupBy("feature").agg(F.sum(ecdf_gap() * step).alias("distance"))


@dataclass(frozen=True)
class Profile:
    """KS statistic, percentile edges and, if asked for, Wasserstein distance of a feature."""

    statistic: float
    edges: tuple[float, ...]
    distance: float | None


def numeric_profile(
    pair: DataFrame,
    columns: Sequence[str],
    summaries: Sequence[Summary],
    bins: int = 10,
    distance: bool = False,
) -> dict[str, Profile]:
    """Exact order statistics of all features, on the driver: one bounded row per feature.

    Only values in buckets that can matter are shuffled, unless the distance is wanted:
    that is a sum over all values. ``bins=0`` asks for no edges.
    """
    buckets = bucket_totals(pair, columns, summaries)
    ranks = {
        s.feature: {r for low, high, _ in percentile_ranks(s.n0, bins) for r in (low, high)}
        for s in summaries
        if bins
    }
    kept = None if distance else needed_buckets(buckets, ranks)
    rows = bounded_profile(cumulative_counts(pair, columns, summaries, buckets, kept, ranks))
    inner = {r["feature"]: r for r in rows.collect()}
    found = {}
    for feature, group in groupby(buckets, key=lambda b: b.feature):
        group = list(group)
        row = inner.get(feature)
        values = {r["rank"]: r["value"] for r in row["found"]} if row else {}
        found[feature] = Profile(
            max(known_gap(group), row["statistic"] if row else 0.0),
            interpolated_edges(group[0].tot0, bins, values) if bins else (),
            row["distance"] if row and distance else None,
        )
    return found


def _order_statistics(
    pair: DataFrame, columns: Sequence[str], bins: int, buckets: int, distance: bool = False
) -> tuple[list[Summary], dict[str, Profile], DataFrame | None]:
    """Summaries and profiles of all columns, and the long form of the table where it was made:
    for many columns, unless the distance is wanted."""
    if len(columns) < wide.WIDE_COLUMNS or distance:
        summaries = summarize(pair, columns, buckets)
        return summaries, numeric_profile(pair, columns, summaries, bins, distance), None
    long = wide.long_values(pair, columns)
    summaries = wide.summaries_of(long, columns, buckets)
    found = wide.profile(long, summaries, bins, buckets)
    return summaries, {c: Profile(gap, edges, None) for c, (gap, edges) in found.items()}, long


def ks_columns(pair: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, exact_rows: int = 0) -> DataFrame:
    """``ks_test`` of some columns; only values that can hold the largest gap are looked at."""
    summaries, found, _ = _order_statistics(pair, columns, 0, buckets)
    tested = small_table(
        pair.sparkSession,
        "feature string, statistic double, n_reference bigint, n_current bigint",
        [(s.feature, found[s.feature].statistic, s.n0, s.n1) for s in summaries if s.feature in found],
    )
    return tested.withColumn("p_value", _ks_p(exact_rows, "n_reference", "n_current"))


def ks_by_group(long: DataFrame, groups: Sequence[str], buckets: int = BUCKETS, exact_rows: int = 0) -> DataFrame:
    """KS test of one value per group: ``long`` has the sample, the group's number and the value, in
    rows; ``groups`` are the names by number."""
    long = wide.grouped_values(long)
    summaries = wide.summaries_of(long, groups, buckets)
    found = wide.profile(long, summaries, 0, buckets)
    tested = small_table(
        long.sparkSession,
        "feature string, statistic double, n_reference bigint, n_current bigint",
        [(s.feature, found[s.feature][0], s.n0, s.n1) for s in summaries if s.feature in found],
    )
    return tested.withColumn("p_value", _ks_p(exact_rows, "n_reference", "n_current"))


def psi(pair: DataFrame, columns: Sequence[str], bins: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """Population stability index per feature on equal-frequency bins of the reference.

    The shares are taken over the whole sample and the requested number of bins, also
    where bins collapse or values fall outside. Fewer than two edges give 0, an empty
    sample gives null.
    """
    summaries, found, long = _order_statistics(pair, columns, bins, buckets)
    edges = {c: found[c].edges if c in found else () for c in columns}
    return _psi_on_edges(pair, summaries, edges, bins, long)


def _psi_on_edges(
    pair: DataFrame,
    summaries: Sequence[Summary],
    edges: Mapping[str, Sequence[float]],
    bins: int,
    long: DataFrame | None = None,
) -> DataFrame:
    def share(n: str, total: str) -> Column:
        return (F.col(n) + PSI_EPSILON) / (F.col(total) + PSI_EPSILON * bins)

    sizes = small_table(
        pair.sparkSession,
        "feature string, tot0 bigint, tot1 bigint",
        [(s.feature, s.n0, s.n1) for s in summaries],
    )
    terms = (
        histogram(pair, edges, None if long is None else wide.bins_on_edges(long, edges, list(edges)))
        .join(F.broadcast(sizes), "feature")
        .groupBy("feature")
        .agg(
            F.sum(
                (share("n1", "tot1") - share("n0", "tot0"))
                * F.log(share("n1", "tot1") / share("n0", "tot0"))
            ).alias("total")
        )
    )
    score = F.greatest(F.coalesce("total", F.lit(0.0)), F.lit(0.0))
    return sizes.join(F.broadcast(terms), "feature", "left").select(
        "feature", F.when((F.col("tot0") > 0) & (F.col("tot1") > 0), score).alias("psi")
    )


def _divergence(shares: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (natural log) from shares ``p`` and ``q`` per feature."""
    middle = (F.col("p") + F.col("q")) / 2

    def part(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / middle)).otherwise(0.0)

    return shares.groupBy("feature").agg(
        F.sqrt(F.greatest(F.sum(part("p") + part("q")) / 2, F.lit(0.0))).alias("distance")
    )


def jensen_shannon_numeric(
    pair: DataFrame,
    columns: Sequence[str],
    bins: int = 30,
    summaries: Sequence[Summary] | None = None,
    long: DataFrame | None = None,
) -> DataFrame:
    """Jensen-Shannon distance on equal-width bins over the pooled range."""
    known = summaries or summarize(pair, columns)
    if long is not None:
        counts = wide.bins_equal_width(long, known, bins)
    else:
        counts = bin_counts(
            pair, columns, lambda i, x: bin_equal_width(x, known[i].low, known[i].high, bins)
        )
    sizes = small_table(
        pair.sparkSession,
        "feature string, tot0 bigint, tot1 bigint",
        [(s.feature, s.n0, s.n1) for s in known],
    )
    return _divergence(_shares(counts.join(F.broadcast(sizes), "feature")))


def _shares(counts: DataFrame) -> DataFrame:
    return counts.select(
        "feature",
        (F.col("n0") / F.nullif(F.col("tot0").cast("double"), F.lit(0.0))).alias("p"),
        (F.col("n1") / F.nullif(F.col("tot1").cast("double"), F.lit(0.0))).alias("q"),
    )


def moments(pair: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of both samples, one row per feature."""
    return _moment_rows(pair.sparkSession, summarize(pair, columns))


def _moment_rows(spark, summaries: Sequence[Summary]) -> DataFrame:
    return small_table(
        spark,
        "feature string, reference_mean double, current_mean double, reference_std double, current_std double",
        [(s.feature, s.mean0, s.mean1, s.std0, s.std1) for s in summaries],
    )


# --- categorical statistics ------------------------------------------------------------


def category_counts(pair: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of both samples per (feature, category), merged before the shuffle."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
            for c in columns
        ]
    )
    return (
        pair.select(SIDE, F.inline(entries))
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(
            F.count_if(F.col(SIDE) == REFERENCE).alias("n0"),
            F.count_if(F.col(SIDE) == CURRENT).alias("n1"),
        )
    )


def chi_squared_test(counts: DataFrame) -> DataFrame:
    """Pearson test that both samples share one category distribution, per feature.

    An empty sample gives statistic 0 and p-value 1.
    """
    both = (F.col("n0") + F.col("n1")).cast("double")
    sums = counts.groupBy("feature").agg(
        F.sum("n0").cast("double").alias("tot0"),
        F.sum("n1").cast("double").alias("tot1"),
        *[F.sum(F.pow(F.col(n).cast("double"), F.lit(2.0)) / both).alias(f"part_{n}") for n in ("n0", "n1")],
        (F.count(F.lit(1)) - 1).alias("dof"),
    )
    # the sum of squared distances over expected counts, with the totals taken out of it
    shares = F.col("part_n0") / F.nullif(F.col("tot0"), F.lit(0.0)) + F.col("part_n1") / F.nullif(F.col("tot1"), F.lit(0.0))
    statistic = F.greatest((F.col("tot0") + F.col("tot1")) * (shares - 1), F.lit(0.0))
    return sums.select(
        "feature",
        F.coalesce(F.when((F.col("tot0") > 0) & (F.col("tot1") > 0), statistic), F.lit(0.0)).alias("statistic"),
        "dof",
    ).withColumn("p_value", chi_squared_p_value(F.col("statistic"), F.col("dof").cast("double")))


def jensen_shannon_category(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance of the category shares, per feature; one count serves both uses."""
    # null-safe, since a plain equality would filter one use of the counts by it and not the other
    totals = counts.groupBy(F.col("feature").alias("of")).agg(F.sum("n0").alias("tot0"), F.sum("n1").alias("tot1"))
    joined = counts.join(F.broadcast(totals), F.col("feature").eqNullSafe(F.col("of")))  # a row per feature
    return _divergence(_shares(joined))


# --- reports ---------------------------------------------------------------------------


def distribution_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    ks_threshold: float = KS_STATISTIC_LIMIT,
) -> DataFrame:
    """Drift rows of the validation job: a column drifts if its KS *statistic* exceeds the limit."""
    pair = two_samples(reference, current, columns)
    summaries, found, _ = _order_statistics(pair, columns, 0, BUCKETS)
    tested = small_table(
        pair.sparkSession,
        "column string, n0 bigint, n1 bigint, statistic double",
        [
            (s.feature, s.n0, s.n1, found[s.feature].statistic if s.feature in found else 0.0)
            for s in summaries
        ],
    )
    return tested.select(
        "column",
        F.round("statistic", 6).alias("ks_statistic"),
        F.round(ks_p_value(F.col("statistic"), F.col("n0"), F.col("n1")), 6).alias("p_value"),
        (F.col("statistic") > ks_threshold).alias("drifted"),
    )


def _numeric_rows(pair: DataFrame, columns: Sequence[str], options: DriftOptions) -> DataFrame:
    """Scans: a summary, bucket totals, the buckets that matter (the only shuffle of
    values), the PSI bins."""
    test = options.numeric_test()
    summaries, found, long = _order_statistics(
        pair, columns, options.bins, options.buckets, distance=test == "wasserstein"
    )
    edges = {c: found[c].edges if c in found else () for c in columns}
    index = _psi_on_edges(pair, summaries, edges, options.bins, long)
    spread = _moment_rows(pair.sparkSession, summaries)
    if test in ("ks", "wasserstein"):
        known = small_table(
            pair.sparkSession,
            "feature string, n0 bigint, n1 bigint, statistic double, distance double, std0 double",
            [
                (s.feature, s.n0, s.n1, r.statistic, r.distance, s.std0)
                for s in summaries
                if (r := found.get(s.feature)) is not None
            ],
        )
        score = (
            _ks_p(options.exact_rows)
            if test == "ks"
            else F.col("distance") / F.greatest("std0", F.lit(0.001))
        )
        scored = known.select("feature", score.alias("score"))
    elif test == "jensenshannon":
        scored = jensen_shannon_numeric(
            pair, columns, options.distance_bins, summaries, long
        ).withColumnRenamed("distance", "score")
    else:
        scored = index.withColumnRenamed("psi", "score")
    # Four tables of one row per feature.
    joined = (
        _named(pair, columns)
        .join(F.broadcast(spread), "feature", "left")
        .join(F.broadcast(scored), "feature", "left")
        .join(F.broadcast(index), "feature", "left")
    )
    return joined.select(
        F.col("feature").alias("feature_name"),
        F.lit(test).alias("stattest_name"),
        _default_score("score", test).alias("drift_score"),
        _drifted("score", test, options).alias("drifted"),
        "psi",
        psi_band(F.col("psi")).alias("psi_label"),
        "reference_mean",
        "current_mean",
        "reference_std",
        "current_std",
    )


def _default_score(score: str, test: str) -> Column:
    return F.coalesce(score, F.lit(1.0 if test in P_VALUE_TESTS else 0.0))


def _drifted(score: str, test: str, options: DriftOptions) -> Column:
    value, limit = _default_score(score, test), options.limit(test)
    return value < limit if test in P_VALUE_TESTS else value >= limit


def _category_rows(pair: DataFrame, columns: Sequence[str], options: DriftOptions) -> DataFrame:
    test = options.category_test()
    counts = category_counts(pair, columns)
    if test == "chi2":
        scored = chi_squared_test(counts).select("feature", F.col("p_value").alias("score"))
    else:
        scored = jensen_shannon_category(counts).withColumnRenamed("distance", "score")
    nothing = F.lit(None).cast("double")
    return _named(pair, columns).join(F.broadcast(scored), "feature", "left").select(
        F.col("feature").alias("feature_name"),
        F.lit(test).alias("stattest_name"),
        _default_score("score", test).alias("drift_score"),
        _drifted("score", test, options).alias("drifted"),
        nothing.alias("psi"),
        F.lit(None).cast("string").alias("psi_label"),
        *[
            nothing.alias(n)
            for n in ("reference_mean", "current_mean", "reference_std", "current_std")
        ],
    )


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    options: DriftOptions = DriftOptions(),
) -> DataFrame:
    """One row per feature: test, score, drift flag, PSI and band, means and deviations.

    Numeric columns are tested together in one pass, and so are text columns. Every column of
    either table has its row: one that only one table has, or of a type without a test, is
    listed with test ``none`` and without a score or a verdict. With ``columns`` only those are
    listed; one that neither table has is an error.
    """
    known = [*reference.columns, *[c for c in current.columns if c not in reference.columns]]
    unknown = [c for c in columns or () if c not in known]
    if unknown:
        raise KeyError(f"no table has a column {unknown[0]!r}")
    wanted = list(columns or known)
    shared = [c for c in wanted if c in reference.columns and c in current.columns]
    numeric, category = _kinds(reference.select(*shared), options.mapping)
    parts = []
    if numeric:
        parts.append(_numeric_rows(two_samples(reference, current, numeric), numeric, options))
    if category:
        parts.append(_category_rows(two_samples(reference, current, category), category, options))
    rest = [c for c in wanted if c not in numeric and c not in category]
    if rest or not parts:
        parts.append(_untested(reference.sparkSession, rest))
    return reduce(DataFrame.unionByName, parts)


def _kinds(df: DataFrame, mapping: ColumnMapping | None) -> tuple[list[str], list[str]]:
    """Columns to test as numbers and as categories."""
    numeric, category = column_types(df)
    if mapping is None:
        return numeric, category
    roles = {mapping.target, mapping.prediction}
    named = [*(mapping.numeric or ()), *(mapping.category or ())]
    if mapping.numeric is not None:
        numeric = [c for c in df.columns if c in mapping.numeric or (c in roles and c in numeric and c not in named)]
    if mapping.category is not None:
        category = [c for c in df.columns if c in mapping.category or (c in roles and c in category and c not in named)]
    apart = {*mapping.ids, *mapping.times}
    numeric = [c for c in numeric if c not in apart and c not in (mapping.category or ())]
    return numeric, [c for c in category if c not in apart and c not in (mapping.numeric or ())]


FEATURE_ROWS = (
    "feature_name string, stattest_name string, drift_score double, drifted boolean, psi double, psi_label string, "
    "reference_mean double, current_mean double, reference_std double, current_std double"
)


def _untested(spark, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(c, "none", *[None] * 8) for c in columns], FEATURE_ROWS)


def dataset_drift(
    features: DataFrame, options: DriftOptions = DriftOptions(), by: Sequence[str] = ()
) -> DataFrame:
    """Counts, share, drifted names and flags over feature rows, per ``by`` group (a model, say).

    Columns without a test do not count."""
    share = F.coalesce(F.avg(F.col("drifted").cast("int")), F.lit(0.0))
    return (
        features.groupBy(*by)
        .agg(
            F.count("drifted").alias("total_features"),
            F.count_if("drifted").alias("drifted_features"),
            share.alias("dataset_drift_ratio"),
            # Names only, at most one per feature.
            F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature_name")))).alias(
                "drifted_names"
            ),
        )
        .withColumn("dataset_drifted", F.col("dataset_drift_ratio") >= options.dataset_share)
        .withColumn(
            "recommend_retrain",
            (F.col("dataset_drift_ratio") >= options.retrain_share) | F.col("dataset_drifted"),
        )
    )


def prediction_drift(
    reference: DataFrame, current: DataFrame, score: str, bins: int = 10
) -> DataFrame:
    """Drift row of a model's score column, under the name ``__prediction__``."""
    rows = _numeric_rows(
        two_samples(reference, current, [score]), [score], DriftOptions(bins=bins)
    )
    return rows.withColumn("feature_name", F.lit("__prediction__"))


def drift_report(
    features: DataFrame,
    summary: DataFrame,
    by: Sequence[str] = (),
    reference_date: str | None = None,
    current_date: str | None = None,
    model_name: str | None = None,
    generated_at: str | None = None,
) -> DataFrame:
    """Nested report per group, rounded for print, as JSON text in column ``report``.

    Its head names the model (also that of a ``by`` column of that name), the two dates and the time
    at which it was made, now unless given. Only result rows (one per feature) are nested, never
    data rows.
    """
    row = F.struct(
        "feature_name",
        "stattest_name",
        F.round("drift_score", 6).alias("drift_score"),
        "drifted",
        F.round("psi", 4).alias("psi"),
        "psi_label",
        *[
            F.round(c, 4).alias(c)
            for c in ("reference_mean", "current_mean", "reference_std", "current_std")
        ],
    )
    nested = features.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("feature_results"))
    if by:
        joined = summary.join(nested, list(by))
    else:
        joined = summary.withColumn("_one", F.lit(1)).join(
            nested.withColumn("_one", F.lit(1)), "_one"
        )
    made = F.lit(generated_at) if generated_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    report = F.struct(
        *([] if "model_name" in by else [F.lit(model_name).alias("model_name")]),
        *by,
        F.lit(reference_date).alias("reference_date"),
        F.lit(current_date).alias("current_date"),
        made.alias("generated_at"),
        F.struct(
            "total_features",
            "drifted_features",
            F.round("dataset_drift_ratio", 4).alias("dataset_drift_ratio"),
            "dataset_drifted",
            "recommend_retrain",
        ).alias("summary"),
        "feature_results",
    )
    return joined.select(
        *by, F.to_json(report, {"ignoreNullFields": "false", "pretty": "true"}).alias("report")
    )
