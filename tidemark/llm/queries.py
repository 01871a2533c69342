"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    doubling,
    hnsw,
    importance,
    jaccard,
    language_model,
    lines,
    manifest,
    mixing,
    quality,
    suffix_index,
    token_counts,
    toxicity,
)
from .shared import held_out, ship, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return texts(read(spark, folder, "documents"), "doc_id", "text")


def labels_of(spark: SparkSession, folder: str, column: str) -> DataFrame:
    return read(spark, folder, "labels").select(F.col("doc_id").cast("long"), F.col(column).cast("int").alias("label"))


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "benchmark").select(F.col("item_id").cast("string"), F.col("text").cast("string"))


@query
def op1_ngram_jaccard_join(spark, folder):
    return jaccard.near_duplicates(documents(spark, folder), size=4, percent=85)


def domain_of(source):
    """The given tables have no domain column: sources are dealt to four by their number."""
    digits = F.regexp_extract(source, "[0-9]+", 0)
    number = F.when(digits != "", digits.cast("long") % 4)
    return F.concat(F.lit("d"), F.coalesce(number.cast("string"), F.lit("-")))


WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}


@query
def op2_source_mixing(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.mix(docs, domain_of(F.col("source")), WEIGHTS, F.expr("total * 3 div 4"), max_epochs=3)
    return taken.drop("version")


ORACLES["op2_source_mixing"] = mixing.SQL


@query
def op3_quality_classifier(spark, folder):
    rows = read(spark, folder, "documents")
    docs = rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("n_chars").cast("long"))
    model = quality.learn(docs, labels_of(spark, folder, "quality"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op4_substring_dedup(spark, folder):
    return doubling.remove_repeats(documents(spark, folder), size=50)


@query
def op5_lm_scoring(spark, folder):
    good = labels_of(spark, folder, "quality").where("label = 1")
    return language_model.cross_entropy_difference(documents(spark, folder), good.where(~held_out(F.col("doc_id"))))


@query
def op6_benchmark_decontamination(spark, folder):
    return decontaminate.report(documents(spark, folder), benchmark(spark, folder), size=10)


@query
def op7_line_dedup(spark, folder):
    return line_report(lines.dedup_lines(documents(spark, folder), min_words=50))


def line_report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        F.col("lines_before").alias("n_lines"),
        F.col("lines_deleted").alias("n_deleted"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLES["op7_line_dedup"] = lines.SQL


@query
def op7_line_dedup_runs(spark, folder):
    return line_report(lines.dedup_lines(documents(spark, folder), min_words=50, whole_runs=True))


ORACLES["op7_line_dedup_runs"] = lines.RUNS_SQL


@query
def op8_nearest_neighbours(spark, folder):
    return hnsw.nearest(read(spark, folder, "embeddings"), "vec_id", "embedding", every=20, k=20)


@query
def op9_toxicity(spark, folder):
    docs = documents(spark, folder)
    model = toxicity.learn(docs, labels_of(spark, folder, "toxic"))
    return toxicity.score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op10_suffix_array_dedup(spark, folder):
    return suffix_index.remove_repeats(documents(spark, folder), size=50)


@query
def op11_importance_resampling(spark, folder):
    target = read(spark, folder, "benchmark").select(F.col("text").cast("string").alias("text"))
    return importance.resample(documents(spark, folder), target, buckets=10000, percent=25, least_words=20, seed=7)


ORACLES["op11_importance_resampling"] = importance.SQL


@query
def op12_token_counts(spark, folder):
    import public_tokenizers

    return token_counts.count_tokens(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op13_merkle_manifest(spark, folder):
    docs = read(spark, folder, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = manifest.leaf(*own[:-1], F.translate("text", UPPER, LOWER))
    rows = docs.select(
        F.col("lang").cast("string").alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        manifest.leaf(*own).alias("digest"),
        F.when(tampered, changed).alias("changed"),
    )
    rows = rows.withColumn("claimed", F.coalesce("changed", "digest")).drop("changed")
    return manifest.verified(manifest.build(rows, keep=("claimed",)), claimed="claimed")


ORACLES["op13_merkle_manifest"] = manifest.SQL
