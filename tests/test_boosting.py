"""Boosted trees against plain numpy; the alert ledger; schemas of dated partitions."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, monitor
from tidemark.operators.boosting import BoostOptions
from tidemark.sources import io
from tidemark.streaming.ledger import read_ledger, send_new


def labelled(spark, n=600):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    y = (((x[:, 0] > 0) & (x[:, 1] > 0)) ^ (rng.random(n) < 0.05)).astype(int)  # two columns together tell
    rows = [(i, *map(float, r), int(v), i % 5 == 0) for i, (r, v) in enumerate(zip(x, y))]
    rows += [(n, None, float("inf"), 1.0, None, False), (n + 1, None, 0.0, 0.0, 1, False)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, is_holdout boolean")


COLUMNS = ["a", "b", "c"]


def best_split(x, g, h, penalty=1.0):
    """Gain, column and threshold of the best split on the given edges."""
    worth = lambda s, t: s * s / (t + penalty)
    best = (0.0,)
    for j, (values, edges) in enumerate(x):
        for e in edges:
            left = values <= e
            if h[left].sum() >= 1 and h[~left].sum() >= 1:
                gain = (worth(g[left].sum(), h[left].sum()) + worth(g[~left].sum(), h[~left].sum()) - worth(g.sum(), h.sum())) / 2
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, j, e)
    return best


def test_first_splits_are_the_best(spark, tmp_path):
    df = labelled(spark)
    options = BoostOptions(max_trees=1, max_depth=2, row_share=1.0, column_share=1.0, bins=8)
    model = boosting.train_boosted_trees(df, COLUMNS, "y", "id", str(tmp_path / "t"), options=options)
    rows = [r for r in df.collect() if r["y"] is not None and not r["is_holdout"]]
    columns = [np.array([r[c] or 0.0 for r in rows]) for c in COLUMNS]
    g, h = 0.5 - np.array([r["y"] for r in rows], float), np.full(len(rows), 0.25)
    tree = model.trees[0]

    def check(node, mask):
        if node not in tree.splits:
            return
        gain, j, edge = best_split([(v[mask], e) for v, e in zip(columns, model.edges)], g[mask], h[mask])
        column, last = tree.splits[node]
        assert (column, model.edges[column][last]) == (j, edge) and tree.gains[node] == pytest.approx(gain)
        left = columns[j] <= edge
        for child, part in ((2 * node, mask & left), (2 * node + 1, mask & ~left)):
            if child in tree.values:
                assert tree.values[child] == pytest.approx(-0.05 * g[part].sum() / (h[part].sum() + 1))
            check(child, part)

    check(1, np.ones(len(rows), bool))
    assert set(tree.splits) <= {1, 2, 3} and 1 in tree.splits


def test_trees_learn_and_stop(spark, tmp_path):
    df = labelled(spark)
    options = BoostOptions(max_trees=25, max_depth=3, rate=0.5, patience=3, bins=16)
    model = boosting.train_boosted_trees(df, COLUMNS, "y", "id", str(tmp_path / "a"), options=options)
    again = boosting.train_boosted_trees(df.repartition(5), COLUMNS, "y", "id", str(tmp_path / "b"), options=options)
    assert [t.splits for t in model.trees] == [t.splits for t in again.trees]  # however rows are dealt
    assert 0 < len(model.trees) <= 25 and min(model.losses) < model.losses[0] == pytest.approx(np.log(2))
    if len(model.trees) < 25:  # cut back to the best tree
        assert len(model.trees) == int(np.argmin(model.losses))
    scored = model.score(df.where("y is not null and is_holdout")).collect()
    assert np.mean([(r["score"] > 0.5) == r["y"] for r in scored]) > 0.8
    # the loss that stopped the training is the loss of these scores
    scores = np.array([r["score"] for r in scored])
    y = np.array([r["y"] for r in scored])
    loss = -np.mean(np.log(np.where(y == 1, scores, 1 - scores)))
    if len(model.losses) > len(model.trees):
        assert loss == pytest.approx(model.losses[len(model.trees)])


def test_a_share_of_the_columns(spark, tmp_path):
    options = BoostOptions(max_trees=8, max_depth=1, column_share=0.34, patience=99, bins=4)
    model = boosting.train_boosted_trees(labelled(spark), COLUMNS, "y", "id", str(tmp_path / "t"), options=options)
    assert all(len(t.splits) == 1 for t in model.trees) and len({t.splits[1][0] for t in model.trees}) > 1


def test_nothing_to_learn(spark, tmp_path):
    df = labelled(spark)
    few = BoostOptions(max_trees=2)
    same = boosting.train_boosted_trees(df.withColumns({"y": F.lit(1), **{c: F.lit(1.0) for c in COLUMNS}}), COLUMNS, "y", "id", str(tmp_path / "a"), options=few)
    assert same.trees == [] and {r["score"] for r in same.score(df).collect()} == {0.5}
    none = boosting.train_boosted_trees(df.limit(0), COLUMNS, "y", "id", str(tmp_path / "b"), options=few)
    assert none.trees == []


# --- ledger ----------------------------------------------------------------------------

ALERTS = "title string, message string, severity string, source string, model_name string, timestamp timestamp"


def alerts(spark, *rows):
    made = [(t, "m", "warning", "s", m, datetime(2024, 1, d, h)) for t, m, d, h in rows]
    return spark.createDataFrame(made, ALERTS).withColumn("metadata", F.create_map(F.lit("title"), F.col("title")))


def test_ledger_sends_nothing_twice(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    titles = lambda df: sorted(r["title"] for r in df.collect())
    first = alerts(spark, ("late", "a", 1, 9), ("early", "a", 1, 8), ("b", "b", 1, 8), ("none", None, 2, 8))
    assert titles(send_new(first, folder, 1)) == ["b", "early", "none"]
    # the same days again, and one of a new day
    assert titles(send_new(alerts(spark, ("again", "a", 1, 7), ("again", None, 2, 1), ("new", "a", 3, 0)), folder, 2)) == ["new"]
    # a run that is run again enters nothing and loses nothing
    assert titles(send_new(alerts(spark, ("new", "a", 3, 0)), folder, 2)) == ["new"]
    assert titles(send_new(first, folder, 3)) == []
    assert titles(read_ledger(spark, folder)) == ["b", "early", "new", "none"]
    assert {r["day"] for r in read_ledger(spark, folder).collect()} == {date(2024, 1, d) for d in (1, 2, 3)}


def test_alerts_print_their_metadata(spark):
    row = spark.createDataFrame([("m", 3, "retrain_now", datetime(2024, 1, 1), "promote")], "model_name string, version int, reason string, decided_at timestamp, decision string")
    made = monitor.promotion_alerts(row).first()
    assert made["message"] == "version: 3\nstage: Production" and made["metadata"] == {"version": "3", "stage": "Production"}
    assert made["title"] == "model_registry: m"


# --- schemas of dated partitions -------------------------------------------------------


def test_partition_schemas(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("u", 1, 2.0)], "user_id string, n int, x double")
    assert io.partition_days(spark, root) == [] and io.schema_history(spark, root).count() == 0
    io.write_partition(rows, root, "2024-01-01", "user_id", files=1, new_types="refuse")
    wider = rows.withColumn("n", F.col("n").cast("long")).withColumn("y", F.lit("z")).drop("x")
    with pytest.raises(TypeError, match=r"n \(int -> bigint\)"):
        io.write_partition(wider, root, "2024-01-02", "user_id", files=1, new_types="refuse")
    assert io.partition_days(spark, root) == [date(2024, 1, 1)]
    io.write_partition(wider, root, "2024-01-02", "user_id", files=1)
    # a date may be replaced whole, and every date is read with its own schema
    io.write_partition(wider, root, "2024-01-02", "user_id", files=1, new_types="replace")
    assert dict(io.read_partition(spark, root, "2024-01-01").dtypes) == {"user_id": "string", "n": "int", "x": "double", "date": "date"}
    assert io.read_partition(spark, root, "2024-01-02").first()["y"] == "z"
    history = [tuple(r)[1:] for r in io.schema_history(spark, root).where("date = '2024-01-02'").collect()]
    assert sorted(history, key=str) == [("n", "bigint", "was int"), ("x", None, "removed"), ("y", "string", "added")]
    assert io.read_partition(spark, root, "2024-01-01").where("date = '2024-01-01'").count() == 1
    with pytest.raises(ValueError):
        io.write_partition(rows, root, "2024-01-01", "user_id", new_types="maybe")
