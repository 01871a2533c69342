"""Registered corpus queries against SQL, and the pipeline stage by stage against brute force."""

import brute
import pytest
from oracle import connect, differences

import corpus_pipeline
from tidemark.llm import queries
from tidemark.llm.shared import settle

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, docs, FOLDER), name)
        if name != "source_mixing":
            assert docs.columns == before.columns
        kept.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    toxic, lined, near, clean, mixed = kept
    assert set(lined) <= set(toxic)
    rows = sorted(lined.items())
    assert set(near) == {d for d, _, c in brute.near_duplicates(rows, 5, 80) if d == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(clean) == {d for d, *_, bad in brute.decontaminate(sorted(near.items()), items) if not bad}
    assert set(mixed) <= set(clean) and mixed
    again = {(r["doc_id"], r["copies"]) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "copies").collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in docs.select("doc_id", "copies").collect()}


def test_pipeline_drops_exact_copies_ending_in_a_short_line(spark):
    line = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    text = line("a", 55) + "\n" + line("b", 40)
    rows = [(1, text, len(text)), (2, text, len(text)), (3, "alone", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER).collect())) == [rows[0], rows[2]]


def test_line_stage_leaves_what_brute_force_leaves(spark):
    from test_operators import brute_runs

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    gone, want = brute_runs(rows, 50), {}
    for d, text in rows:
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[d])
        if not gone[d] or kept.strip():
            want[d] = kept
    got = corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER)
    assert {r["doc_id"]: r["text"] for r in got.select("doc_id", "text").collect()} == want
