"""Corpus operators against brute force: whole small tables, edge rows, skewed rows."""

import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, doubling, hnsw, jaccard, language_model, lines, mixing, quality, shared, suffix_index, toxicity

DOCS = "doc_id long, text string"


def corpus():
    """Null, empty, blank, very long and repeated texts, copies, near copies, shared passages."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "One two"), (4, "one TWO"), (5, "a " * 300), (6, "a " * 200)]
    passage, base = words(70), words(160)
    for i in range(7, 60):
        kind = i % 5
        if kind == 0:
            text = words(80) + passage + words(rng.randint(0, 90))
        elif kind == 1:
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        elif kind == 2:
            text = base
        else:
            text = words(rng.randint(1, 120))
        rows.append((i, " ".join(text) if i % 2 else "\n".join(" ".join(text[j : j + 9]) for j in range(0, len(text), 9))))
    rows.append((60, " ".join(words(6000) + passage)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_jaccard_join(docs, rows):
    for size, percent in ((4, 85), (5, 80)):
        got = sorted(map(tuple, jaccard.near_duplicates(docs, size, percent).collect()))
        assert got == brute.near_duplicates(rows, size, percent)


def test_jaccard_join_with_rows_without_a_key(spark):
    text = " ".join(str(i) for i in range(200))
    rows = [(None, text), (4, text), (9, text + " x"), (None, "y"), (None, None), (5, "y")]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, DOCS), 5, 80).where("doc_id is not null").collect()
    assert sorted(map(tuple, got)) == [(4, 196, 4), (5, 1, 5), (9, 197, 4)]


def test_substring_dedup(docs, rows):
    assert sorted(map(tuple, doubling.remove_repeats(docs, 50).collect())) == brute.repeated_words(rows, 50)


def test_repeat_levels(spark):
    words = [str(i) for i in range(130)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:60])), (3, " ".join(words)), (4, "x")], DOCS)
    assert sorted(map(tuple, doubling.repeat_levels(df, 25).collect())) == [(1, 100), (2, 50), (3, 100)]


def test_suffix_index(docs, rows):
    for batches in (1, 5):
        got = sorted(map(tuple, suffix_index.remove_repeats(docs, 50, batches).collect()))
        assert got == brute.repeated_bytes(rows, 50)


def test_suffix_index_leaves_only_what_is_read(spark):
    """Tables that nothing reads any more are gone, and so are the shuffle files of written steps."""
    text = "".join(chr(97 + i * i % 23) for i in range(150))
    df = spark.createDataFrame([(1, text), (2, "x" + text[:90] + "y"), (3, text), (4, "z" + text[20:]), (5, "q")], DOCS)
    names = lambda: set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    old = names() if os.path.isdir(spark.conf.get("spark.checkpoint.dir")) else set()
    got = sorted(map(tuple, suffix_index.remove_repeats(df, 50, 2).collect()))
    assert got == brute.repeated_bytes([tuple(r) for r in df.collect()], 50)
    assert {name.split("-")[0] for name in names() - old} == {"lists", "matches"}
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before = files().size()
    shared.settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"), "step")
    assert files().size() <= before


def test_suffix_index_sorts_what_can_match(spark):
    """Pieces of 26 to 36 bytes that documents share by chance bring no suffix; passages of 49 to 60
    bytes are found wherever their seed lies."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789 ") for _ in range(n))
    short, long = [noise(26 + i) for i in range(11)], [noise(49 + i) for i in range(12)]

    def among(pieces):
        around = lambda: noise(rng.randint(60, 90))
        return [around() + "".join(p + around() for p in rng.sample(pieces, len(pieces))) for _ in range(4)]

    df = spark.createDataFrame(list(enumerate(among(short))), DOCS)
    seeds = suffix_index.shared_seeds(df, 50)
    lists = doubling.verdicts(seeds, doubling.repeated_contexts(seeds))
    work = df.join(lists.where("size(part) > 0"), "doc_id").select("doc_id", "text", "part")
    assert work.count() == 4
    assert suffix_index.suffixes(work, 50).count() == 0

    texts = among(short + long)
    rows = [*enumerate(texts), (1, texts[3]), (1, texts[1]), (9, noise(300)), (10, ""), (11, None)]
    df = spark.createDataFrame([*rows, (None, texts[0])], DOCS).coalesce(1)
    got = [tuple(r) for r in suffix_index.remove_repeats(df, 50, 3).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute.repeated_bytes(rows, 50)
    assert [r[2:4] for r in got if r[0] is None] == [(0, 0)]


def test_decontamination(spark, docs, rows):
    own = brute.ALNUM.findall(brute.lower(rows[10][1]))
    items = [(0, None), (1, ""), (2, "two"), (3, " ".join(own[5:40])), (4, " ".join(own[30:42]).upper()), (5, "not there at all"), (5, " ".join(own[:10]))]
    table = spark.createDataFrame([(str(i), t) for i, t in items], "item_id string, text string")
    want = brute.decontaminate(rows, [(str(i), t) for i, t in items])
    assert sorted(map(tuple, decontaminate.report(docs, table).collect())) == want
    # the same in several blocks of items
    assert sorted(map(tuple, decontaminate.report(docs, table, block_bytes=120).collect())) == want
    kept = {r["doc_id"] for r in decontaminate.kept(docs, table).collect()}
    assert kept == {r[0] for r in want if not r[-1]}


def brute_lines(rows, min_words):
    import re

    places, windows = {}, []
    for d, text in rows:
        found = [(i, re.sub(lines.EDGES, "", x)) for i, x in enumerate((text or "").split("\n"))]
        found = [(i, x, len(brute.SPACED.findall(x))) for i, x in found if x]
        for k in range(len(found)):
            n, j = 0, k
            while j < len(found) and n < min_words:
                n += found[j][2]
                j += 1
            if n >= min_words:
                key = tuple(x for _, x, _ in found[k:j])
                place = (d, found[k][0])
                windows.append((key, place, [i for i, _, _ in found[k:j]]))
                places[key] = min(places.get(key, place), place)
    gone = {}
    for key, place, covered in windows:
        if places[key] < place:
            gone.setdefault(place[0], set()).update(covered)
    return {d: gone.get(d, set()) for d, _ in rows}


def test_line_dedup(docs, rows, spark):
    want = brute_lines(rows, 50)
    extra = docs.withColumns({"line": F.lit(1), "h": F.lit("x"), "version": F.lit(2), "row": F.lit(3)})
    for r in lines.dedup_lines(extra, min_words=50).collect():
        text = dict(rows)[r["doc_id"]]
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[r["doc_id"]])
        assert (r["text"], r["lines_deleted"], r["version"]) == (kept, len(want[r["doc_id"]]), 2)
    assert any(want.values())


def brute_runs(rows, min_words):
    """Each pair of equal lines is followed both ways at its offset until lines differ."""
    import re

    found, places = [], {}
    for d, text in rows:
        for i, x in enumerate((text or "").split("\n")):
            if re.sub(lines.EDGES, "", x):
                found.append((d, i, re.sub(lines.EDGES, "", x)))
                places.setdefault(found[-1][2], []).append(len(found) - 1)
    same = lambda a, b: 0 <= a and b < len(found) and found[a][2] == found[b][2]
    inside = lambda a, b: found[a][0] == found[b][0]
    gone = {d: set() for d, _ in rows}
    for at in places.values():
        for n, q in enumerate(at):
            for p in at[:n]:  # earlier
                if same(p - 1, q - 1) and inside(p - 1, p) and inside(q - 1, q):
                    continue  # the run begins before
                k = 1
                while same(p + k, q + k) and inside(p, p + k) and inside(q, q + k):
                    k += 1
                if sum(len(brute.SPACED.findall(found[q + j][2])) for j in range(k)) >= min_words:
                    gone[found[q][0]].update(found[q + j][1] for j in range(k))
    return gone


def sized(tag, *sizes):
    return [" ".join(f"{tag}{k}w{i}" for i in range(n)) for k, n in enumerate(sizes)]


def test_line_dedup_of_whole_runs(docs, rows, spark):
    a, b, c = sized("a", 55, 40), sized("b", 20, 30, 10, 3), sized("c", 60, 9)
    more = [
        (100, "\n".join(a)), (101, "\n".join(a)),  # an exact copy ending in a short line
        (102, "x y\n" + "\n".join(b) + "\nz"), (103, "\n\nq r\n \n" + "\n".join(b) + "\ns"),
        # the first place of the window has another tail than the second, of which 106 is a copy
        (104, c[0] + "\nother"), (105, "\n".join(c)), (106, "\n".join(c)),
        (107, "\n".join(["p " * 49 + "p", "t", "u"] * 3)), (108, "\n".join(["e"] * 120)),
    ]
    table = docs.unionByName(spark.createDataFrame(more, DOCS))
    every = rows + more
    want = brute_runs(every, 50)
    for r in lines.dedup_lines(table, min_words=50, whole_runs=True).collect():
        text = dict(every)[r["doc_id"]]
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[r["doc_id"]])
        assert (r["text"], r["lines_deleted"]) == (kept, len(want[r["doc_id"]])), r["doc_id"]
    assert want[101] == {0, 1} and want[106] == {0, 1} and len(want[103]) == 4 and not want[100]


def test_mixing_fills_siblings_first(spark):
    rows = [(i, "w " * 10, "en", s) for i, s in enumerate(["a"] * 10 + ["b"] * 2 + ["c"] * 30)] + [(99, None, None, None), (98, "", "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    domain = F.when(F.col("source") == "c", "y").otherwise("x")
    taken = mixing.mix(df, domain, {"domain": {"x": 1, "y": 1}}, F.lit(200), max_epochs=1)
    got = {r["source"]: r["t"] for r in taken.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("t")).collect()}
    # b has 20 of its 50; the rest goes to its sibling a, nothing of it to c
    assert got == {"a": 80, "b": 20, "c": 100}
    again = mixing.mixed_rows(df, domain, {"domain": {"x": 1, "y": 1}}, F.lit(800), max_epochs=3)
    assert again.columns == [*df.columns, "copies"]
    got = {r["source"]: r["t"] for r in again.groupBy("source").agg(F.sum(F.col("copies") * 10).alias("t")).collect()}
    assert got == {"a": 300, "b": 60, "c": 440}
    assert mixing.mix(df.limit(0), domain, {}, F.col("total")).count() == 0


def test_mixing_plans_its_tree_once(spark, capsys):
    """The node tables are written, so that the rows' plan does not hold the tree's windows many times."""
    rows = [(i, "w " * (1 + i % 9), ("en", "de", None)[i % 3], f"s{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = mixing.mix(df, F.lit("x"), {"lang": {"en": 3}}, F.expr("total * 3 div 4"), max_epochs=3)
    taken.explain()
    assert capsys.readouterr().out.count("Window [") == 1
    # where the ranges lie does not matter: the cut falls into a range, and the rows are the same
    fine = {tuple(r) for r in taken.collect()}
    coarse = mixing.mix(df, F.lit("x"), {"lang": {"en": 3}}, F.expr("total * 3 div 4"), max_epochs=3, digits=1)
    assert {tuple(r) for r in coarse.collect()} == fine and 0 < len(fine) < 300


def test_language_model_prefers_its_target(spark):
    rng = random.Random(2)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, text(["red", "blue", "green"] if i % 2 else ["one", "two", "three"])) for i in range(60)] + [(60, None), (61, "")]
    df = spark.createDataFrame(rows, DOCS)
    chosen = spark.createDataFrame([(i,) for i in range(1, 30, 2)], "doc_id long")
    got = {r["doc_id"]: r for r in language_model.cross_entropy_difference(df, chosen).collect()}
    assert len(got) == 62 and got[60]["score"] == got[61]["score"] == 0 and got[60]["n_words"] == 0
    assert max(got[i]["score"] for i in range(1, 60, 2)) < min(got[i]["score"] for i in range(0, 60, 2))


def brute_losses(rows, chosen, share=0.6):
    from collections import Counter
    from math import log

    texts = [(d, brute.SPACED.findall(brute.lower(t))) for d, t in rows]
    models = []
    for some in ([w for d, w in texts if d in chosen], [w for _, w in texts]):
        pairs = Counter(p for w in some for p in zip([""] + w, w))
        contexts, words = Counter(), Counter()
        for (v, w), n in pairs.items():
            contexts[v] += n
            words[w] += n
        models.append((pairs, contexts, words, sum(words.values())))
    size, out = len({x for _, w in texts for x in w}), []
    for d, w in texts:
        losses = []
        for pairs, contexts, words, total in models:
            loss = 0
            for p in zip([""] + w, w):
                one = (words[p[1]] + 1) / (total + size)
                loss -= log(share * pairs[p] / contexts[p[0]] + (1 - share) * one if contexts[p[0]] else one)
            losses.append(loss / max(1, len(w)))
        out.append((-1 if d is None else d, len(w), *losses, losses[0] - losses[1]))
    return sorted(out)


def test_language_model_counts_exactly(spark, rows, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK", 20000)
    # more different words and pairs than 65,536 cells hold apart, rows met often, a null key
    many = [(200 + i, " ".join(f"w{(i * 7919 + j * 104729) % 90001}" for j in range(4000))) for i in range(30)]
    every = rows + many + [(300, "again and Again")] * 1500 + [(None, "no key"), (7, "same key")]
    chosen = set(range(0, 400, 3)) | {300}
    df = spark.createDataFrame(every, DOCS).repartition(5)
    names = spark.createDataFrame([(i,) for i in sorted(chosen)] + [(None,)], "doc_id long")
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in language_model.cross_entropy_difference(df, names).collect())
    want = brute_losses(every, chosen)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose(np.array(got), np.array(want), atol=1e-9)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, size=(900, 1))
    vectors[100:400] = vectors[100]  # one vector that a third of the rows share
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    bad = [(900, None), (920, []), (940, [0.0] * 16), (960, [float("nan")] * 16), (980, [None] * 16), (None, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("node", F.lit("x"))
    got = {}
    for r in hnsw.nearest(df, shard_size=300).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = np.array([v for _, v in rows])
    hit = 0
    assert set(got) == set(range(0, 900, 20))
    for q, found in got.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(900), -np.round(s, 9))) if i != q][:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert np.allclose([s[v] for _, v, _ in found], [t for _, _, t in found])
        hit += len(set(order) & {v for _, v, _ in found})
    assert hit >= 0.9 * 20 * len(got)
    assert hnsw.nearest(df.limit(0)).count() == 0


def accuracy(scored, truth):
    s = np.array([r["score"] for r in scored])
    y = np.array([truth[r["doc_id"]] for r in scored])
    rank = np.argsort(np.argsort(s))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()


@pytest.mark.parametrize("operator,column,least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.85)])
def test_classifiers_on_held_out_rows(spark, operator, column, least):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col(column).alias("label"))
    truth = {r["doc_id"]: r["label"] for r in labels.collect()}
    rows = operator.score(docs, operator.learn(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) for r in rows)
    assert accuracy([r for r in rows if r["held_out"] and r["doc_id"] in truth], truth) >= least


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_without_labels(spark, operator):
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (None, "x", 1)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, None), (2, 5)], "doc_id long, label int")
    rows = operator.score(docs, operator.learn(docs, labels)).collect()
    assert [r["score"] for r in rows] == [0.0] * 3 and not rows[2]["held_out"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id string, text string")
    assert jaccard.near_duplicates(docs).count() == 0
    assert doubling.remove_repeats(docs).count() == 0
    assert suffix_index.remove_repeats(docs).count() == 0
    assert decontaminate.report(docs, items).count() == 0
    assert lines.dedup_lines(docs).count() == 0
    assert language_model.cross_entropy_difference(docs, docs.select("doc_id")).count() == 0


def plain_toxicity(text, model):
    """Each window on its own through a compressor of either dictionary."""
    import zstandard

    params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
    length = {
        name: lambda w, d=d: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=1), compression_params=params).compress(w))
        for name, d in (("plain", model.plain), ("toxic", model.toxic))
    }
    raw = brute.lower(text).encode()
    starts = [*range(0, max(1, len(raw) - model.window + 1), model.step)] if raw else []
    if raw and starts[-1] + model.window < len(raw):
        starts.append(len(raw) - model.window)
    gains = [length["plain"](raw[i : i + model.window]) - length["toxic"](raw[i : i + model.window]) for i in starts]
    counts = [sum(g >= s for g in gains) for s in model.steps]
    n = max(1, len(gains))
    features = [np.log1p(c) for c in counts] + [max(gains, default=0), sum(gains) / n, counts[-1] / n]
    margin = model.weights[0] + sum(w * (f - a) / b for w, f, a, b in zip(model.weights[1:], features, *model.scale))
    return 1 / (1 + np.exp(-margin))


def test_toxicity_is_what_single_windows_give(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeinorstlé") for _ in range(rng.randint(2, 8)))
    text = lambda bad, n: " ".join(rng.choice(["grimbold", "vexhorn"]) if bad and rng.random() < 0.1 else word() for _ in range(n))
    rows = [(i, text(i % 4 == 0, rng.randint(5, 120))) for i in range(400)]
    more = [(400, None), (401, ""), (402, "x"), (403, "GRIMBOLD " * 20), (404, text(True, 6000)), (0, "again"), (None, "vexhorn")]
    docs = spark.createDataFrame(rows + more, DOCS).repartition(4).withColumns({"label": F.lit(1), "fold": F.lit("x"), "score": F.lit(2)})
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(4, 1), (401, None), (None, 1)], "doc_id long, label int")
    model = toxicity.learn(docs, labels)
    assert model.toxic.startswith(model.plain) and b"vexhorn" in model.toxic[len(model.plain) :]
    got = sorted(((r["doc_id"], r["score"]) for r in toxicity.score(docs, model).collect()), key=str)
    want = sorted(((d, plain_toxicity(t, model)) for d, t in rows + more), key=str)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-9)
    unseen = [(d, s) for d, s in got if d is not None and 0 < d < 400 and brute.held_out(d)]
    assert np.mean([(s >= 0.3) == (d % 4 == 0) for d, s in unseen]) > 0.85  # some toxic texts have no such word
    assert toxicity.kept(docs, model, 0.3).columns == docs.columns


def test_toxicity_learns_one_row_of_each_key(spark):
    rows = [(i, f"word{i} plain text {i}") for i in range(40)] * 3 + [(7, "other"), (7, "x " * 50000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    model = toxicity.learn(spark.createDataFrame(rows, DOCS), labels)
    assert model.weights is not None and len(model.toxic) < 1 << 17
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_toxicity_where_nothing_tells_keeps_probabilities():
    y = np.array([1.0, 0.0, 0.0, 0.0])
    assert toxicity._cut(np.full(4, -1.1), y) == pytest.approx(np.log(0.3 / 0.7))
    assert toxicity._cut(np.array([-2.0, 1.0, 1.0, 1.0]), y) == pytest.approx(np.log(0.3 / 0.7))


def test_toxicity_marks_are_not_passages_of_copies(spark):
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    passage, rows = "a quiet walk along the river bank", []
    for i in range(160):
        label = i % 2
        text = [words(20), passage if label else words(6), words(20)]
        if label:  # copies: the passage always stands between the same words
            text = [words(12), "zzscumzz", words(12), "before it stood this", passage, "and that came after"]
        rows.append((i, " ".join(text), label, i // 2 % 2))
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int, fold int")
    for found in toxicity._telling(sample, {(f, y): 40 for f in (0, 1) for y in (0, 1)}):
        for size, cells in found.items():
            of = lambda t: toxicity._cells(np.frombuffer(t.encode(), np.uint8), size)  # noqa: E731, B023
            assert np.isin(of("zzscumzz"), cells).all()
            assert not np.isin(of(passage), cells).any()
