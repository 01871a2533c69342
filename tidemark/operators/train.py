"""Training step: feature columns, stratified split, ranking scores; trees are in ``boosting``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cumulative import SIDE, cumulative_counts

# Training parameters.
HOLDOUT_SHARE = 0.2
SEED = 42


def feature_columns(df: DataFrame, not_features: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in not_features]


def filled_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature columns as doubles (true is 1), with missing values set to 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


# --- split -----------------------------------------------------------------------------

HASH_DIGITS = 15  # hex digits of the row hash: 60 bits
COARSE_DIGITS = 4  # leading digits that name one of 65,536 hash ranges
MOST_LABELS = 10_000  # label values up to which one row per label is broadcast


def split_hash(row_id: str, seed: int = SEED) -> Column:
    """A row's place in the shuffled order: a hash of id and seed, the same in any engine."""
    return F.substring(F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed)))), 1, HASH_DIGITS)


def stratified_split(
    df: DataFrame, label: str, row_id: str, share: float = HOLDOUT_SHARE, seed: int = SEED
) -> DataFrame:
    """``df`` plus ``is_holdout``: exactly round(share * n) rows of each label, by hash order.

    The order within a label is never sorted as a whole. Counts over 65,536 hash ranges
    find the range in which the cut falls, only the rows of that range are ranked, and
    the cut found is one (hash, id) per label that every row is compared with.
    """
    keyed = df.select(
        F.col(label).alias("_label"), F.col(row_id).alias("_id"), split_hash(row_id, seed).alias("_h")
    ).withColumn("_range", F.substring("_h", 1, COARSE_DIGITS))
    few = df.select(label).distinct().count() <= MOST_LABELS
    small = F.broadcast if few else (lambda table: table)
    by_label = Window.partitionBy("_label")
    before = by_label.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 rows per label.
    ranges = (
        keyed.groupBy("_label", "_range")
        .count()
        .select(
            "_label",
            "_range",
            "count",
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
            F.round(F.sum("count").over(by_label) * F.lit(share)).cast("long").alias("_wanted"),
        )
    )
    cut_ranges = ranges.where(
        (F.col("_before") < F.col("_wanted"))
        & (F.col("_wanted") <= F.col("_before") + F.col("count"))
    ).select("_label", "_range", (F.col("_wanted") - F.col("_before")).alias("_rank"))
    in_cut = Window.partitionBy("_label", "_range").orderBy("_h", "_id")
    cuts = (
        keyed.join(
            small(cut_ranges.withColumnsRenamed({"_label": "_cut_label", "_range": "_cut_range"})),
            F.col("_label").eqNullSafe(F.col("_cut_label")) & (F.col("_range") == F.col("_cut_range")),
        )
        .withColumn("_n", F.row_number().over(in_cut))
        .where(F.col("_n") == F.col("_rank"))
        .select(F.col("_label").alias("_of"), F.struct("_h", "_id").alias("_cut"))
    )
    place = F.struct(split_hash(row_id, seed).alias("_h"), F.col(row_id).alias("_id"))
    return (
        df.join(small(cuts), F.col(label).eqNullSafe(F.col("_of")), "left")
        .withColumn("is_holdout", F.coalesce(place <= F.col("_cut"), F.lit(False)))
        .select(*df.columns, "is_holdout")
    )


# --- ranking scores --------------------------------------------------------------------


def ranking_scores(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """ROC AUC and average precision per score column, in one pass over sorted scores.

    Equal scores share their average rank (AUC) and one threshold (average precision).
    Null if a label is absent.
    """
    sided = df.where(F.col(label).isNotNull()).select(
        *scores, F.col(label).cast("int").alias(SIDE)
    )
    cumulative = cumulative_counts(sided, scores)
    negatives, positives = F.col("tot0").cast("double"), F.col("tot1").cast("double")
    above = F.col("tot1") - F.col("cum1")
    true_positives = above + F.col("n1")
    flagged = true_positives + F.col("tot0") - F.col("cum0") + F.col("n0")
    return cumulative.groupBy("feature").agg(
        F.sum(
            F.col("n0") * (above + F.col("n1") / 2.0)
            / F.nullif(negatives * positives, F.lit(0.0))
        ).alias("roc_auc"),
        F.sum(
            F.col("n1") / F.nullif(positives, F.lit(0.0))
            * (true_positives / F.nullif(flagged.cast("double"), F.lit(0.0)))
        ).alias("average_precision"),
    )
