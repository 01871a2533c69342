"""Token counts against the library on each whole text."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tidemark.llm import token_counts
from tidemark.llm.kernel import text_bytes

DOCS = "doc_id long, text string"
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")


def corpus():
    rng = random.Random(8)
    blanks = [" ", "  ", "\n", "\n\n ", "\t", " \n", " ", "  \n", "　", "\r\n", "\x1c", "  "]
    parts = ["it's", "WORD", "naïve", "中文字", "。", "1234", "'ll", "--", "é", "é", "😀", "<|endoftext|>", "<s>", "</s>", "▁x", "x▁", "don't", "a", "ﬁ", "²"]
    rows = [(0, None), (1, ""), (2, " "), (3, "\n\n\n"), (4, "<|endoftext|>"), (5, "a<|endoftext|> b <|endoftext|>"), (6, "x" * 5000)]
    rows += [(7, "中文" * 800), (8, "word " * 3000), (9, " \n" * 700 + "a"), (None, "no key"), (3, "again"), (3, "again")]
    for i in range(10, 90):
        rows.append((i, "".join(rng.choice(parts) + (rng.choice(blanks) if rng.random() < 0.7 else "") for _ in range(rng.randint(1, 300)))))
    rows.append((90, " ".join(rng.choice(parts) for _ in range(20000))))
    return rows


def plain(file):
    path = public_tokenizers.path(file)
    if file.endswith(".json"):
        library = tokenizers.Tokenizer.from_file(path)
        return lambda t: len(library.encode(t, add_special_tokens=False))
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda t: len(library.encode(t))


@pytest.mark.parametrize("file", FILES)
@pytest.mark.parametrize("batch_bytes", [1, 3000, 1 << 20])
def test_counts(spark, file, batch_bytes):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({"n_tokens": F.lit(1), "n_bytes": F.lit("x")})
    count = plain(file)
    want = sorted(((d, len((t or "").encode()), count(t) if t else 0, bool(t) and count(t) > 100) for d, t in rows), key=str)
    got = token_counts.count_tokens(docs, public_tokenizers.path(file), limit=100, batch_bytes=batch_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == want


def tokenizer(file="byte_bpe_50k.json"):
    with open(public_tokenizers.path(file), "rb") as f:
        return token_counts.Tokenizer(file, f.read())


def cut(of, *texts):
    raw, offsets = text_bytes(pa.array(texts))
    pieces, row = of.pieces(raw, offsets)
    return list(zip(row.tolist(), pieces.to_pylist()))


def test_places_to_cut():
    assert cut(tokenizer(), "a b", None, "", " c\n\nd é f") == [(0, "a"), (0, " b"), (3, " c"), (3, "\n\nd"), (3, " é"), (3, " f")]
    # not where the blank may belong to blanks before it
    assert cut(tokenizer(), "a\u00a0\n\nb", "x" * 500, "中 \n") == [(0, "a\u00a0\n\nb"), (1, "x" * 500), (2, "中 \n")]
    assert cut(tokenizer("piece_bpe_32k.model"), "ab cd  e. f g ") == [(0, "ab"), (0, "cd  e. f"), (0, "g ")]
    assert cut(tokenizer("word_bpe_49k.json"), "ab cd", "", "e") == [(0, "ab cd"), (2, "e")]


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    of = tokenizer()
    raw, offsets = text_bytes(pa.array([" ".join(f"w{i}" for i in range(300)), "y" * 100]))
    first = of.count_texts(raw, offsets).tolist()
    assert first == [plain("byte_bpe_50k.json")(t) for t in (" ".join(f"w{i}" for i in range(300)), "y" * 100)]
    assert len(of.remembered) == 300 and "y" * 100 not in of.remembered
    assert of.count([" a", " b"]) == [1, 1] and len(of.remembered) == 2


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    count = plain("byte_bpe_50k.json")
    want = sorted((r["doc_id"], count(r["text"] or "")) for r in rows.collect())
    got = token_counts.count_tokens(rows, public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == want


def test_empty_table_and_unknown_file(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    assert token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        token_counts.Tokenizer("words.txt", b"")
