"""Gradient-boosted trees for a yes-or-no label, grown from histograms.

Values are replaced once by the number of the quantile bin they fall in. A level of a tree then
needs one grouped sum over the rows: gradients and second derivatives of the loss per open node,
column and bin, merged on the map side. What comes to the driver is nodes x columns x bins sums,
whatever the rows; the driver picks the best split of each node and the next level goes on. Rows
stay where they are: a tree is an expression over the bins, and margins are written out every few
trees so that plans stay short.

Rows marked as held out are not learnt from; their loss, measured with the first level of the
next tree, ends the training when it has not improved for ``patience`` trees, and the model is
cut back to its best tree. Each tree sees a share of the rows and of the columns, by hash.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cumulative import summarize, two_samples
from tidemark.operators.drift import numeric_profile
from tidemark.sources import io


@dataclass(frozen=True)
class BoostOptions:
    """Depth, rate, shares, number of trees and patience of the training job."""

    max_trees: int = 500
    max_depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 20
    bins: int = 64
    penalty: float = 1.0  # on squared leaf values
    least_weight: float = 1.0  # second derivatives that each side of a split needs
    seed: int = 42


@dataclass
class Tree:
    """Splits by node (column number, last bin that goes left) and leaf values by node; the
    children of node n are 2n and 2n + 1, the root is 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    gains: dict[int, float] = field(default_factory=dict)

    def walk(self, bins: Column, at_end, node: int = 1) -> Column:
        """The expression that leads a row to its last node."""
        if node not in self.splits:
            return F.lit(at_end(node))
        column, last = self.splits[node]
        return F.when(F.get(bins, F.lit(column)) <= last, self.walk(bins, at_end, 2 * node)).otherwise(self.walk(bins, at_end, 2 * node + 1))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """The values of the leaves that rows of bins come to."""
        node = np.ones(len(bins), dtype=np.int64)
        size = 2 * max([1, *self.splits, *self.values]) + 2
        column, last, value = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size)
        for n, (c, b) in self.splits.items():
            column[n], last[n] = c, b
        for n, v in self.values.items():
            value[n] = v
        rows = np.arange(len(bins))
        while (open_ := column[node] >= 0).any():
            right = bins[rows, np.maximum(column[node], 0)] > last[node]
            node = np.where(open_, 2 * node + right, node)
        return value[node]


@dataclass
class Boosted:
    """Trees over binned columns; ``losses`` are those of the held-out rows before each tree that was grown."""

    columns: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    losses: list[float]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``score``, the probability of the label."""
        trees = self.trees

        @F.pandas_udf(T.DoubleType())
        def probability(bins: pd.Series) -> pd.Series:
            total = np.zeros(len(bins))
            if len(bins):
                numbers = np.stack(bins.to_numpy())
                for tree in trees:
                    total += tree.margins(numbers)
            return pd.Series(1 / (1 + np.exp(-total)))

        return df.withColumn("score", probability(binned(self.columns, self.edges)))


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """For each column the values at which bins end: exact quantiles, repeats and the largest left out."""
    pair = two_samples(df, df.where(F.lit(False)), columns)
    found = numeric_profile(pair, columns, summarize(pair, columns), bins)
    return [list(found[c].edges[:-1]) if c in found else [] for c in columns]


def binned(columns: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """The bins of a row, an array: how many edges lie below each value. Missing values count as 0."""

    def number(name: str, of: Sequence[float]) -> Column:
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        ends = F.array(*[F.lit(float(e)) for e in of]).cast("array<double>")
        return F.size(F.filter(ends, lambda e: e < value))

    return F.array(*[number(c, e) for c, e in zip(columns, edges)])


def best_splits(
    sums: Mapping[tuple[int, int], Mapping[int, tuple[float, float]]], nodes: Mapping[int, tuple[float, float]], options: BoostOptions
) -> dict[int, tuple[float, int, int]]:
    """Per node the gain, column and last left bin of its best split, if one gains anything.

    ``sums``: by (node, column) and bin the gradients and second derivatives; ``nodes``: those of a
    whole node. Equal gains go to the lower column and bin.
    """
    worth = lambda g, h: g * g / (h + options.penalty)
    out: dict[int, tuple[float, int, int]] = {}
    for (node, column), by_bin in sorted(sums.items()):
        all_g, all_h = nodes[node]
        g = h = 0.0
        for b in sorted(by_bin)[:-1]:
            g, h = g + by_bin[b][0], h + by_bin[b][1]
            if h < options.least_weight or all_h - h < options.least_weight:
                continue
            gain = (worth(g, h) + worth(all_g - g, all_h - h) - worth(all_g, all_h)) / 2
            if gain > 1e-9 and (node not in out or gain > out[node][0] * (1 + 1e-12)):
                out[node] = (gain, column, b)
    return out


def _histogram(rows: DataFrame, node: Column, chosen: Sequence[int], with_loss: bool):
    """Sums per (node, column) and bin, whole nodes, and the loss of the held-out rows."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    slope, bend = p - F.col("label"), p * (1 - p)
    columns = F.array(*[F.lit(c) for c in chosen])
    cells = F.transform(columns, lambda c: F.struct(c.alias("column"), F.get("bins", c).alias("bin"), slope.alias("g"), bend.alias("h")))
    loss = F.log1p(F.exp(F.when(F.col("label") == 1, -F.col("margin")).otherwise(F.col("margin"))))
    held = F.array(F.struct(F.lit(-1).alias("column"), F.lit(0).alias("bin"), loss.alias("g"), F.lit(1.0).alias("h")))
    if not with_loss:
        rows = rows.where(~F.col("held"))
    entries = F.when(F.col("held"), held).when(F.col("drawn"), cells) if with_loss else F.when(F.col("drawn"), cells)
    summed = (
        rows.select(node.alias("node"), F.inline(entries))
        .where("node > 0")
        .groupBy("node", "column", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    )
    sums: dict[tuple[int, int], dict[int, tuple[float, float]]] = {}
    lost, count = 0.0, 0.0
    for r in summed.collect():  # open nodes x columns x bins
        if r["column"] < 0:
            lost, count = lost + r["g"], count + r["h"]
        else:
            sums.setdefault((r["node"], r["column"]), {})[r["bin"]] = (r["g"], r["h"])
    nodes = {}
    for (node_, _), by_bin in sums.items():
        nodes.setdefault(node_, tuple(math.fsum(x) for x in zip(*by_bin.values())))
    return sums, nodes, (lost / count if count else None)


def train_boosted_trees(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    row_id: str,
    folder: str,
    holdout: str = "is_holdout",
    options: BoostOptions = BoostOptions(),
    rows_kept: int = 8,
) -> Boosted:
    """Trees that tell ``label`` 1 from 0; rows without a label are left out.

    ``row_id`` fixes which rows a tree sees. Binned rows and, every ``rows_kept`` trees, margins
    are written below ``folder``, which all executors share.
    """
    spark = df.sparkSession
    known = df.where(F.col(label).isNotNull())
    learnt = known.where(~F.coalesce(F.col(holdout), F.lit(False)))
    edges = quantile_edges(learnt.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]), columns, options.bins)
    rows = known.select(
        F.col(row_id).cast("string").alias("id"),
        F.col(label).cast("double").alias("label"),
        F.coalesce(F.col(holdout), F.lit(False)).alias("held"),
        binned(columns, edges).alias("bins"),
        F.lit(0.0).alias("margin"),
    )
    io.write_table(rows, f"{folder}/rows-0")
    rows = io.read_table(spark, f"{folder}/rows-0")
    model = Boosted(list(columns), edges, [], [])
    best, best_trees = math.inf, 0
    for t in range(options.max_trees):
        drawn = F.pmod(F.xxhash64(F.lit(options.seed + t), "id"), F.lit(1_000_000)) < int(options.row_share * 1_000_000)
        dice = random.Random(options.seed * 1_000_003 + t)
        some = max(1, round(options.column_share * len(columns)))
        chosen = sorted(dice.sample(range(len(columns)), some))
        seen, tree = rows.withColumn("drawn", drawn), Tree()
        open_ = {1}
        for depth in range(options.max_depth):
            node = tree.walk(F.col("bins"), lambda n: n if n in open_ else 0)
            sums, nodes, loss = _histogram(seen, node, chosen, depth == 0)
            if depth == 0:
                grown = len(model.trees)
                if loss is not None and len(model.losses) == grown:
                    model.losses.append(loss)
                    if loss < best - 1e-9:
                        best, best_trees = loss, grown
                    if grown - best_trees >= options.patience:
                        model.trees = model.trees[:best_trees]
                        return model
                if 1 in nodes:
                    tree.values[1] = _value(*nodes[1], options)
            found = best_splits(sums, nodes, options)
            for n, (gain, column, last) in found.items():
                tree.splits[n], tree.gains[n] = (column, last), gain
                by_bin = sums[n, column]
                left = [math.fsum(x) for x in zip(*[v for b, v in by_bin.items() if b <= last])]
                right = [a - b for a, b in zip(nodes[n], left)]
                tree.values.pop(n, None)
                tree.values |= {2 * n: _value(*left, options), 2 * n + 1: _value(*right, options)}
            open_ = {c for n in found for c in (2 * n, 2 * n + 1)}
            if not open_:
                break
        if not tree.splits:  # nothing to gain in these columns and rows; other draws may
            if options.column_share >= 1 and options.row_share >= 1:
                break
            continue
        model.trees.append(tree)
        value = tree.walk(F.col("bins"), lambda n: float(tree.values.get(n, 0.0)))
        rows = rows.withColumn("margin", F.col("margin") + value)
        if len(model.trees) % rows_kept == 0:
            io.write_table(rows, f"{folder}/rows-{len(model.trees)}")
            rows = io.read_table(spark, f"{folder}/rows-{len(model.trees)}")
    return model


def _value(g: float, h: float, options: BoostOptions) -> float:
    return -options.rate * g / (h + options.penalty)
