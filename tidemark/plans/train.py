"""Queries: stratified split, ranking scores, boosted trees, streamed materialisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boosting, train
from tidemark.plans import inputs
from tidemark.plans import pit as pit_plans
from tidemark.plans.registry import fixed, query, scratch, sql_fixed, table
from tidemark.sources import io
from tidemark.sources.schemas import CREDIT_VIEW
from tidemark.sources.latest_store import LatestStore
from tidemark.streaming.incremental import feature_stream, materialize_stream


def _sql_split(source: str, label: str, row_id: str) -> str:
    return f"""SELECT {row_id}, {label}, rn <= CAST(round(0.2 * n) AS BIGINT) AS is_holdout FROM (
  SELECT {row_id}, {label}, count(*) OVER (PARTITION BY {label}) AS n,
         row_number() OVER (PARTITION BY {label}
           ORDER BY substr(md5(CAST({row_id} AS VARCHAR) || ':42'), 1, 15), {row_id}) AS rn FROM {source})"""


@query("stratified_split", _sql_split("orders", "o_orderstatus", "o_orderkey"))
def stratified_split(spark, folder):
    """An exact fifth of each order status, by hash order."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return train.stratified_split(rows, "o_orderstatus", "o_orderkey")


def labelled_documents(spark, folder):
    return table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source"), "doc_id"
    )


def _sql_ranking(name: str, expression: str) -> str:
    return f"""SELECT '{name}' AS feature, {sql_fixed('sum(n0 * (up1 + n1 / 2.0)) / (any_value(t0) * any_value(t1))', 8)} AS roc_auc,
       {sql_fixed('sum(n1 / any_t1 * ((up1 + n1) / (up1 + n1 + up0 + n0)))', 8)} AS average_precision
FROM (SELECT *, t1 AS any_t1, coalesce(sum(n0) OVER w, 0) AS up0, coalesce(sum(n1) OVER w, 0) AS up1 FROM (
  SELECT {expression} AS score, count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1,
         sum(count(*) FILTER (WHERE quality = 0)) OVER () AS t0, sum(count(*) FILTER (WHERE quality = 1)) OVER () AS t1
  FROM labels JOIN documents USING (doc_id) GROUP BY 1)
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    "ranking_scores",
    _sql_ranking("n_chars", "n_chars") + " UNION ALL " + _sql_ranking("coarse", "floor(n_chars / 500)"),
)
def ranking_scores(spark, folder):
    """ROC AUC and average precision of two scores, one with many ties."""
    rows = labelled_documents(spark, folder).withColumn("coarse", F.floor(F.col("n_chars") / 500))
    found = train.ranking_scores(rows, "quality", ["n_chars", "coarse"])
    return found.select(
        "feature",
        fixed("roc_auc", 8).alias("roc_auc"),
        fixed("average_precision", 8).alias("average_precision"),
    )


def text_rows(spark, folder):
    """Labelled documents with numbers that describe their texts, and the split."""
    text, size = F.col("text"), F.greatest(F.char_length("text"), F.lit(1))
    words = F.split("text", "[ \n]+")
    rows = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "text"), "doc_id").select(
        "doc_id",
        "quality",
        F.char_length("text").alias("length"),
        F.size(words).alias("words"),
        (F.regexp_count(text, F.lit("\n")) / size).alias("line_share"),
        (F.regexp_count(text, F.lit("[A-Z]")) / size).alias("capital_share"),
        (F.regexp_count(text, F.lit("[0-9]")) / size).alias("digit_share"),
        (F.regexp_count(text, F.lit("[^A-Za-z0-9 \n]")) / size).alias("mark_share"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("variety"),
    )
    path = scratch(spark, "split")
    io.write_table(train.stratified_split(rows, "quality", "doc_id"), path)
    return io.read_table(spark, path)


NOT_FEATURES = ("doc_id", "quality", "is_holdout")


@query(
    "boosted_trees",
    """SELECT (SELECT sum(CAST(round(0.2 * n) AS BIGINT)) FROM (SELECT count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality)) AS held_out,
       count(*) AS labelled, true AS not_below_best_column, true AS stopped_early_or_complete FROM labels JOIN documents USING (doc_id)""",
)
def boosted_trees(spark, folder):
    """Split, train with patience, score the held-out rows, rank them: the trees order them at
    least as well as the best single column does."""
    split = text_rows(spark, folder)
    columns = train.feature_columns(split, NOT_FEATURES)
    options = boosting.BoostOptions(max_trees=12, max_depth=3, rate=0.3, patience=4, bins=32)
    model = boosting.train_boosted_trees(split, columns, "quality", "doc_id", scratch(spark, "trees"), options=options)
    held = model.score(split.where("is_holdout"))
    ranked = train.ranking_scores(held, "quality", ["score", *columns]).select("feature", "roc_auc")
    either = F.when(F.col("feature") == "score", F.col("roc_auc")).otherwise(F.greatest("roc_auc", 1 - F.col("roc_auc")))
    best = ranked.agg(
        F.max(F.when(F.col("feature") == "score", either)).alias("ours"), F.max(F.when(F.col("feature") != "score", either)).alias("single")
    )
    counts = split.agg(F.count_if("is_holdout").alias("held_out"), F.count(F.lit(1)).alias("labelled"))
    done = 0 < len(model.trees) <= options.max_trees
    return counts.join(best.withColumn("not_below_best_column", F.col("ours") >= F.col("single")).drop("ours", "single")).withColumn(
        "stopped_early_or_complete", F.lit(done)
    )


_STUMP_BINS = 16


@query(
    "boosted_stump",
    f"""WITH numbers AS (
  SELECT 'discount' AS feature, 0 AS no, l_discount AS value, CAST(l_returnflag = 'R' AS DOUBLE) AS label FROM lineitem
  UNION ALL SELECT 'price', 1, l_extendedprice, CAST(l_returnflag = 'R' AS DOUBLE) FROM lineitem
  UNION ALL SELECT 'shipped', 2, CAST(epoch(l_shipdate) AS DOUBLE), CAST(l_returnflag = 'R' AS DOUBLE) FROM lineitem
), quantiles AS (
  SELECT no, list_sort(list_distinct(quantile_cont(value, [{', '.join(str(i / _STUMP_BINS) for i in range(_STUMP_BINS + 1))}]))) AS e FROM numbers GROUP BY no
), edges AS (SELECT no, unnest(e[1:len(e) - 1]) AS edge FROM quantiles),
sides AS (
  SELECT feature, n.no, edge, sum(0.5 - label) FILTER (WHERE value <= edge) AS gl, 0.25 * count(*) FILTER (WHERE value <= edge) AS hl,
         sum(0.5 - label) AS g, 0.25 * count(*) AS h
  FROM numbers n JOIN edges USING (no) GROUP BY ALL
), gains AS (
  SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain FROM sides WHERE hl >= 1 AND h - hl >= 1
)
SELECT feature, {sql_fixed('edge', 4)} AS threshold, {sql_fixed('gain', 4)} AS gain,
       {sql_fixed('-0.05 * gl / (hl + 1)', 6)} AS left_value, {sql_fixed('-0.05 * (g - gl) / (h - hl + 1)', 6)} AS right_value
FROM gains ORDER BY round(gain, 6) DESC, no, edge LIMIT 1""",
)
def boosted_stump(spark, folder):
    """One tree of one split over all rows and columns: its gain and leaf values."""
    rows = table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("price"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("shipped"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.lit(False).alias("is_holdout"),
    )
    columns = ["discount", "price", "shipped"]
    options = boosting.BoostOptions(max_trees=1, max_depth=1, row_share=1.0, column_share=1.0, bins=_STUMP_BINS)
    model = boosting.train_boosted_trees(rows, columns, "returned", "id", scratch(spark, "stump"), options=options)
    tree = model.trees[0]
    column, last = tree.splits[1]
    row = [(columns[column], float(model.edges[column][last]), tree.gains[1], tree.values[2], tree.values[3])]
    made = spark.createDataFrame(row, "feature string, threshold double, gain double, left_value double, right_value double")
    digits = {"threshold": 4, "gain": 4, "left_value": 6, "right_value": 6}
    return made.select("feature", *[fixed(c, d).alias(c) for c, d in digits.items()])


@query(
    "materialize_stream",
    pit_plans._sql_latest_query(
        CREDIT_VIEW, "credit_view", inputs.CREDIT_ROWS, "1990-01-01", "2010-01-01"
    ),
)
def materialize_credit_stream(spark, folder):
    """The credit view as a growing folder, merged batch by batch into a latest table."""
    rows = inputs.credit_view(spark, folder)
    arriving, kept, mark = (scratch(spark, n) for n in ("arriving", "kept", "mark"))
    rows.repartition(3).write.parquet(arriving)
    stream = feature_stream(spark, arriving, rows, files_per_batch=1)
    store = LatestStore(spark, kept, buckets=8)
    materialize_stream(stream, CREDIT_VIEW, store, mark).awaitTermination()
    return pit_plans._latest_shown(store.read(CREDIT_VIEW), CREDIT_VIEW)
