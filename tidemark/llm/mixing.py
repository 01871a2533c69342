"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Documents hang on a tree of levels, here domain, language and source. A budget of tokens enters
at the root and is handed down by the target weights of siblings. A node can use at most the
tokens below it times ``max_epochs``; what one cannot use goes to its siblings by their weights,
and only what a whole subtree cannot use goes to the siblings of its parent. That is what
filling each level up to the capacities of its subtrees gives, and it has a closed form: siblings
are ordered by capacity per weight, and running sums say which are full (no rounds of
redistribution). Shares are rounded down to whole tokens at each node.

A leaf with T tokens and a share of A takes A div T whole epochs and, of the next epoch, the
prefix that fits in the rest: documents in the order of a hash of seed, epoch and doc_id, as long
as their running sum stays within it. Running sums are over hash ranges of each leaf first
(``16 ** digits`` of them); only the range with the cut is ranked, so a leaf with a third of all
rows is not gathered in one task. The node tables have a row per node.

Cases: texts without tokens (null, empty) are never selected; null levels count as '(none)';
siblings without a given weight have weight 1, those with weight 0 get nothing; equal hashes are
ordered by doc_id and text; rows equal in doc_id, text and levels are taken or left together. Extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

WORD = r"[^\x20\x09-\x0D]+"


def _weight(level: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(level == name, w).otherwise(out)
    return out.cast("decimal(20,0)")


def _filled(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Shares of the nodes of one level: budget of the parent, weight and capacity are given."""
    order = Window.partitionBy(*parent).orderBy(
        F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight").cast("double")).asc_nulls_last(), name
    )
    ahead = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nodes = nodes.withColumn("ahead", ahead).withColumn("behind", behind)
    full = (F.col("weight") > 0) & ((F.col("budget") - F.col("ahead")) * F.col("weight") >= F.col("capacity") * F.col("behind"))
    nodes = nodes.withColumn("full", full)
    own = Window.partitionBy(*parent)
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(own), F.lit(0))
    open_ = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(own), F.lit(0))
    nodes = nodes.withColumn("used", used).withColumn("open", open_)
    rest = F.expr("CASE WHEN open > 0 THEN (weight * (budget - used)) div open ELSE 0 END")
    share = F.when(F.col("full"), F.col("capacity")).otherwise(rest).cast("decimal(20,0)")
    return nodes.withColumn("share", share).drop("ahead", "behind", "full", "used", "open", "budget")


def budgets(
    leaves: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int
) -> DataFrame:
    """Leaves (levels, tokens) with their ``share``: the tokens that each is to give."""
    tree = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("decimal(20,0)"))
    total = tree.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    above = total.select(budget.cast("decimal(20,0)").alias("budget"), F.lit(1).alias("root"))
    parent: list[str] = ["root"]
    tree = tree.withColumn("root", F.lit(1))
    for level in levels:
        here = parent + [level]
        nodes = tree.groupBy(*here).agg(F.sum("capacity").cast("decimal(20,0)").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {}))).join(above, parent)
        above = _filled(nodes, parent, level).select(*here, F.col("share").alias("budget"))
        parent = here
    return tree.join(above, parent).select(*levels, "tokens", F.col("budget").cast("long").alias("share"))


def selected(
    docs: DataFrame,
    levels: list[str],
    weights: Mapping[str, Mapping[str, int]],
    budget: Column,
    max_epochs: int = 4,
    seed: str = "mix",
    digits: int = 3,
) -> DataFrame:
    """``docs`` (doc_id, version, levels, n_tokens) that are taken, with their ``copies``."""
    docs = docs.where("n_tokens > 0")
    # the tables of a row per leaf are written: what reads them several times would hold the
    # whole tree's plan as often, which the driver keeps in memory with its generated code
    leaves = settle(docs.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    shares = budgets(leaves, levels, weights, budget, max_epochs)
    shares = settle(shares.select(*levels, F.expr("share div tokens").alias("whole"), (F.col("share") % F.col("tokens")).alias("rest")), "shares")
    rows = _turns(docs.join(shares, levels), seed, digits)
    ranges = rows.where("rest > 0").groupBy(*levels, "range", "rest").agg(F.sum("n_tokens").alias("inside"))
    upto = F.sum("inside").over(Window.partitionBy(*levels).orderBy("range"))
    ranges = ranges.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("inside")).where("before < rest")
    # ranges before the last one that is begun are taken whole
    last = ranges.groupBy(*levels).agg(F.max(F.struct("range", "before", (F.col("upto") <= F.col("rest")).alias("all"))).alias("last"))
    last = last.select(*levels, F.col("last.range").alias("cut"), F.col("last.before").alias("before"), F.col("last.all").alias("all"))
    places = settle(shares.join(last, levels, "left"), "places")
    placed = _turns(docs.join(places, levels), seed, digits)
    split = F.coalesce((F.col("range") == F.col("cut")) & ~F.col("all"), F.lit(False))
    run = F.sum("n_tokens").over(
        Window.partitionBy(*levels, "range").orderBy("turn", "doc_id", "version").rowsBetween(Window.unboundedPreceding, 0)
    )
    cut = placed.where(split).withColumn("extra", (F.col("before") + run <= F.col("rest")).cast("long"))
    other = placed.where(~split).withColumn("extra", F.coalesce((F.col("range") <= F.col("cut")).cast("long"), F.lit(0)))
    both = cut.unionByName(other)
    return both.select("doc_id", "version", *levels, "n_tokens", (F.col("whole") + F.col("extra")).cast("long").alias("copies")).where("copies > 0")


def _turns(rows: DataFrame, seed: str, digits: int) -> DataFrame:
    """The rows with their place in the order of the epoch that is cut, and its hash range."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    turn = F.md5(F.concat_ws(":", F.lit(seed), (F.col("whole") + 1).cast("string"), name).cast("binary"))
    return rows.withColumn("turn", turn).withColumn("range", F.substring("turn", 1, digits))


def prepared(docs: DataFrame, domain: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """What the selection needs of each row of ``docs``; no text."""
    t = F.col(f"`{text}`").cast("string")
    level = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    return docs.select(
        *keep,
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.md5(F.coalesce(t, F.lit("")).cast("binary")).alias("version"),
        level(domain).alias("domain"),
        level(F.col(f"`{lang}`")).alias("lang"),
        level(F.col(f"`{source}`")).alias("source"),
        F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )


LEVELS = ["domain", "lang", "source"]


def units(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with the tokens of all."""
    return rows.groupBy("doc_id", "version", *LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget: Column, **options) -> DataFrame:
    """(doc_id, version, domain, lang, source, n_tokens, copies) of what is taken from ``docs``."""
    ready = settle(units(prepared(docs, domain)), "tokens")
    return selected(ready, LEVELS, weights, budget, **options)


def mixed_rows(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget: Column, **options) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source) that are taken, with ``copies``
    (replacing such a column)."""
    docs = docs.drop("copies")
    taken = mix(docs, domain, weights, budget, **options)
    taken = taken.select(*[F.col(c).alias(f"t_{c}") for c in ("doc_id", "version", *LEVELS)], "copies")
    keys = prepared(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "lang", "source"), domain, keep=("row",))
    on = keys["doc_id"].eqNullSafe(taken["t_doc_id"]) & (keys["version"] == taken["t_version"])
    for c in LEVELS:
        on = on & (keys[c] == taken[f"t_{c}"])
    return keys.join(taken, on).select("row.*", taken["copies"])


SQL = r"""
WITH units AS (
  SELECT doc_id, 'd' || coalesce(CAST(CAST(regexp_extract(source, '[0-9]+') AS BIGINT) % 4 AS VARCHAR), '-') AS domain,
    lang, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents
), docs AS (SELECT * FROM units WHERE n_tokens > 0),
leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) * 3 AS HUGEINT) AS capacity FROM docs GROUP BY ALL
), root AS (SELECT CAST(sum(tokens) AS HUGEINT) * 3 // 4 AS budget FROM leaves),
d0 AS (SELECT domain, sum(capacity) AS capacity, CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS weight,
         any_value(budget) AS budget FROM leaves, root GROUP BY domain),
d1 AS (SELECT *, coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind
       FROM d0 WINDOW o AS (ORDER BY CAST(capacity AS DOUBLE) / weight, domain)),
d2 AS (SELECT *, (budget - ahead) * weight >= capacity * behind AS filled FROM d1),
d3 AS (SELECT *, coalesce(sum(capacity) FILTER (filled) OVER (), 0) AS used, coalesce(sum(weight) FILTER (NOT filled) OVER (), 0) AS open FROM d2),
domains AS (SELECT domain, CASE WHEN filled THEN capacity ELSE weight * (budget - used) // open END AS budget FROM d3),
l0 AS (SELECT domain, lang, sum(capacity) AS capacity, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight,
         any_value(budget) AS budget FROM leaves JOIN domains USING (domain) GROUP BY domain, lang),
l1 AS (SELECT *, coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind
       FROM l0 WINDOW o AS (PARTITION BY domain ORDER BY CAST(capacity AS DOUBLE) / weight, lang)),
l2 AS (SELECT *, (budget - ahead) * weight >= capacity * behind AS filled FROM l1),
l3 AS (SELECT *, coalesce(sum(capacity) FILTER (filled) OVER p, 0) AS used, coalesce(sum(weight) FILTER (NOT filled) OVER p, 0) AS open
       FROM l2 WINDOW p AS (PARTITION BY domain)),
langs AS (SELECT domain, lang, CASE WHEN filled THEN capacity ELSE weight * (budget - used) // open END AS budget FROM l3),
s0 AS (SELECT domain, lang, source, capacity, tokens, 1 AS weight, budget FROM leaves JOIN langs USING (domain, lang)),
s1 AS (SELECT *, coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind
       FROM s0 WINDOW o AS (PARTITION BY domain, lang ORDER BY CAST(capacity AS DOUBLE) / weight, source)),
s2 AS (SELECT *, (budget - ahead) * weight >= capacity * behind AS filled FROM s1),
s3 AS (SELECT *, coalesce(sum(capacity) FILTER (filled) OVER p, 0) AS used, coalesce(sum(weight) FILTER (NOT filled) OVER p, 0) AS open
       FROM s2 WINDOW p AS (PARTITION BY domain, lang)),
shares AS (SELECT domain, lang, source, tokens, CASE WHEN filled THEN capacity ELSE weight * (budget - used) // open END AS share FROM s3),
turns AS (
  SELECT doc_id, domain, lang, source, n_tokens, share // tokens AS whole, share % tokens AS rest,
    md5('mix:' || (share // tokens + 1) || ':' || doc_id) AS turn FROM docs JOIN shares USING (domain, lang, source)
), runs AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY turn, doc_id) AS upto FROM turns)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
  CAST(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM runs WHERE whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""
