"""A training-data pipeline over the ``documents`` table, built of the operators in tidemark/llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. A stage's result is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, lines, mixing, toxicity
from tidemark.llm import queries as own
from tidemark.llm.shared import settle, ship, texts

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more by the compression-distance classifier go.

    Learnt from the labelled rows of the documents table that are not held out; the score is a
    function of the text, so it is computed beside each row and nothing is joined.
    """
    ship(spark)
    model = toxicity.learn(own.documents(spark, sf_dir), own.labels_of(spark, sf_dir, "toxic"))
    return toxicity.kept(docs, model, threshold=0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Maximal runs of lines of 50 words or more that came before are deleted; what has no word left
    goes."""
    out = lines.dedup_lines(docs, min_words=50, whole_runs=True)
    whole = (F.col("lines_deleted") > 0) & (F.col("lines_deleted") == F.col("lines_before"))
    out = out.where(~whole)
    changed = F.col("lines_deleted") > 0
    names = docs.columns
    n = F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[n.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in names])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the one with the smallest doc_id stays.

    Rows of one doc_id stay or go together; rows without a doc_id stay."""
    ship(spark)
    found = settle(jaccard.near_duplicates(texts(docs, "doc_id", "text"), size=5, percent=80), "copies")
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    # a sorted merge at every size: the copies may be as many as the documents
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    ship(spark)
    return decontaminate.kept(docs, own.benchmark(spark, sf_dir), size=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken for the target weights of domains, languages and sources, and how often."""
    return mixing.mixed_rows(docs, own.domain_of(F.col("source")), own.WEIGHTS, F.col("total"), max_epochs=4)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
]

#: SQL has no compression dictionaries, so the first stage cannot be said in it; the pipeline is
#: tested against brute force instead (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
