"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged.

Equal vectors are collapsed first: each distinct vector carries its ``k + 1`` smallest ids (a
group limit that works before the shuffle), so a vector that a third of all rows share is one
node and ties still go to the smaller id. Distinct vectors are dealt to shards of about
``shard_size``; each shard becomes one row of flat arrays: vectors, and per layer the members and
their neighbours (``degree`` of them, twice that on the lowest layer, -1 where there are fewer).
Inner products are turned into distances by one more coordinate, sqrt(longest^2 - |x|^2), so that
the graph is a metric one; neighbours are chosen by the usual diversity rule from candidates
found by blocked products inside the shard, and links go both ways.

Distinct query vectors are packed into blocks and each block meets each shard once; a search
descends greedily through the layers and ends in a beam of width ``beam``, for all queries of a
block together. Every shard's best are ranked with their exact inner product in double precision
and merged. All rows are indexed; recall is against brute force (tests/llm).

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, as
do rows without an id and vectors of another length than the query's; an empty table gives no
rows; fewer candidates than ``k`` give all of them. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

INDEX = "shard int, ids binary, vectors binary, dim int, layers array<struct<members:binary,links:binary,width:int>>"


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows whose vector can take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    out = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.when(good, v).alias("v"))
    return out.where("vec_id is not null and v is not null")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(node, v, ids): each vector once, with its smallest k + 1 ids; node is the first."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("r", rank).where(F.col("r") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("node"), "v", "ids")


def _neighbours(x: np.ndarray, width: int, wide: int = 96) -> np.ndarray:
    """Links of one layer: diverse near neighbours, made mutual, at most ``width`` each."""
    n = len(x)
    if n == 1:
        return np.full((1, width), -1, dtype=np.int32)
    wide = min(wide, n - 1)
    squares = (x * x).sum(1)
    source, target, gap = [], [], []
    for i in range(0, n, 256):
        part = x[i : i + 256]
        d = squares[i : i + 256, None] + squares[None] - 2 * part @ x.T
        d[np.arange(len(part)), np.arange(i, i + len(part))] = np.inf
        c = np.argpartition(d, wide - 1, axis=1)[:, :wide]
        dc = np.take_along_axis(d, c, 1)
        o = np.argsort(dc, axis=1, kind="stable")
        c, dc = np.take_along_axis(c, o, 1), np.take_along_axis(dc, o, 1)
        near = x[c]
        between = squares[c][:, :, None] + squares[c][:, None, :] - 2 * np.einsum("nad,nbd->nab", near, near)
        chosen = np.zeros(c.shape, dtype=bool)
        for j in range(wide):  # closer to the node than to every chosen one
            closest = np.where(chosen, between[:, j], np.inf).min(1)
            chosen[:, j] = (dc[:, j] < closest) & (chosen.sum(1) < width // 2)
        rank = np.cumsum(~chosen, axis=1) + chosen.sum(1)[:, None]
        keep = chosen | (rank <= width // 2)  # fill up with the nearest of the others
        r, j = np.nonzero(keep)
        source.append(r + i)
        target.append(c[r, j])
        gap.append(dc[r, j] - 1e9 * chosen[r, j])  # diverse links are the last to go
    s, t, g = map(np.concatenate, (source, target, gap))
    s, t, g = np.concatenate([s, t]), np.concatenate([t, s]), np.concatenate([g, g])
    order = np.lexsort((g, t, s))
    s, t, g = s[order], t[order], g[order]
    new = np.r_[True, (s[1:] != s[:-1]) | (t[1:] != t[:-1])]
    s, t, g = s[new], t[new], g[new]
    order = np.lexsort((t, g, s))
    s, t = s[order], t[order]
    place = np.arange(len(s)) - np.searchsorted(s, s)
    out = np.full((n, width), -1, dtype=np.int32)
    ok = place < width
    out[s[ok], place[ok]] = t[ok]
    return out


def _build(ids: np.ndarray, vectors: np.ndarray, degree: int) -> list[dict]:
    """Layers of the graph over the rows of ``vectors``, lowest first."""
    norms = (vectors**2).sum(1)
    x = np.hstack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]])
    rng = np.random.default_rng(abs(int(ids.min())) + 1)
    level = np.floor(-np.log(1 - rng.random(len(ids))) / np.log(degree)).astype(int)
    layers = []
    for l in range(level.max() + 1):
        members = np.flatnonzero(level >= l).astype(np.int32)
        width = 2 * degree if l == 0 else degree
        links = _neighbours(x[members], width)
        layers.append({"members": members.tobytes(), "links": links.tobytes(), "width": width})
    return layers


def _search(queries: np.ndarray, vectors: np.ndarray, layers, beam: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``vectors`` nearest to each query, and their inner products; -1 fills up."""
    n, many = len(vectors), len(queries)
    x = vectors.astype(np.float32)
    q = queries.astype(np.float32)
    top = np.frombuffer(layers[-1]["members"], np.int32)
    current = top[np.argmax(q @ x[top].T, axis=1)].astype(np.int64)  # the top layer has few
    best = np.einsum("qd,qd->q", q, x[current])
    for layer in layers[-2:0:-1]:
        members = np.frombuffer(layer["members"], np.int32)
        links = np.frombuffer(layer["links"], np.int32).reshape(-1, layer["width"])
        while True:
            near = links[np.searchsorted(members, current)]
            at = np.where(near >= 0, members[near], current[:, None])
            s = np.einsum("qd,qkd->qk", q, x[at])
            j = s.argmax(1)
            better = s[np.arange(many), j] > best + 1e-7
            if not better.any():
                break
            current = np.where(better, at[np.arange(many), j], current)
            best = np.where(better, s[np.arange(many), j], best)
    beam = min(max(beam, k), n)
    links = np.frombuffer(layers[0]["links"], np.int32).reshape(-1, layers[0]["width"])
    rows = np.arange(many)
    seen = np.zeros((many, n + 1), dtype=bool)
    seen[:, n] = True
    seen[rows, current] = True
    ids = np.full((many, beam), n, dtype=np.int64)
    sims = np.full((many, beam), -np.inf, dtype=np.float32)
    done = np.ones((many, beam), dtype=bool)
    ids[:, 0], sims[:, 0], done[:, 0] = current, best, False
    while True:
        waiting = np.where(done, -np.inf, sims)
        j = waiting.argmax(1)
        live = np.flatnonzero(waiting[rows, j] > -np.inf)
        if not len(live):
            break
        done[live, j[live]] = True
        near = links[ids[live, j[live]]].astype(np.int64)
        near[near < 0] = n
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        s = np.einsum("qd,qkd->qk", q[live], x[np.minimum(near, n - 1)])
        s = np.where(fresh, s, -np.inf)
        all_s = np.concatenate([sims[live], s], axis=1)
        all_i = np.concatenate([ids[live], near], axis=1)
        all_d = np.concatenate([done[live], ~fresh], axis=1)
        keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        sims[live] = np.take_along_axis(all_s, keep, 1)
        ids[live] = np.take_along_axis(all_i, keep, 1)
        done[live] = np.take_along_axis(all_d, keep, 1) | (sims[live] == -np.inf)
    found = np.where(sims > -np.inf, ids, -1)
    order = np.argsort(-sims, axis=1, kind="stable")[:, : k + 8]
    found = np.take_along_axis(found, order, 1)
    exact = np.einsum("qd,qkd->qk", queries, vectors[np.maximum(found, 0)])
    return found, np.where(found >= 0, exact, -np.inf)


def build_index(nodes: DataFrame, shard_size: int = 4096, degree: int = 16) -> tuple[DataFrame, int]:
    """A row of flat arrays for each shard of ``nodes`` (node, v), and the number of shards."""
    shards = max(1, -(-nodes.count() // shard_size))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, part in frame.groupby(frame["v"].map(len)):
            part = part.sort_values("node")
            ids = part["node"].to_numpy(np.int64)
            vectors = np.stack(part["v"].to_numpy()).astype(np.float64)
            out.append((int(frame["shard"].iloc[0]), ids.tobytes(), vectors.tobytes(), int(dim), _build(ids, vectors, degree)))
        return pd.DataFrame(out, columns=["shard", "ids", "vectors", "dim", "layers"])

    dealt = nodes.select("node", "v", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    return dealt.groupBy("shard").applyInPandas(build, INDEX), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, beam: int = 128, block: int = 512) -> DataFrame:
    """(query, node, score): the k + 1 best nodes of each query vector (node, v)."""
    blocks = max(1, -(-queries.count() // block))
    packed = queries.select("node", "v", F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block"), F.size("v").alias("qdim"))
    packed = packed.groupBy("block", "qdim").agg(F.collect_list(F.struct("node", "v")).alias("q"))
    tasks = packed.select("q", "qdim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    pairs = tasks.join(index, "shard").where("qdim = dim").repartition(max(1, shards * blocks), "shard", F.monotonically_increasing_id())

    def run(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                vectors = np.frombuffer(r.vectors, np.float64).reshape(-1, r.dim)
                ids = np.frombuffer(r.ids, np.int64)
                names = np.array([x["node"] for x in r.q], dtype=np.int64)
                q = np.stack([np.asarray(x["v"], dtype=np.float64) for x in r.q])
                found, score = _search(q, vectors, r.layers, beam, k)
                a, b = np.nonzero(found >= 0)
                yield pd.DataFrame({"query": names[a], "node": ids[found[a, b]], "score": score[a, b]})

    got = pairs.select("q", "vectors", "ids", "dim", "layers").mapInPandas(run, "query long, node long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    return got.withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others of each row whose id ``every`` divides."""
    vectors = usable(rows, key, vector)
    nodes = settle(distinct_vectors(vectors, k), "vectors")
    index, shards = build_index(nodes, **options)
    index = settle(index, "index")
    asked = vectors.where(F.col("vec_id") % every == 0).join(nodes.select("v", "node"), "v").select("vec_id", "node")
    asked = settle(asked, "asked")
    queries = asked.select("node").distinct().join(nodes.select("node", "v"), "node")
    found = search(index, shards, queries, k)
    # ids of each node; the best k + 1 of a query vector serve all queries that share it
    spread = found.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = spread.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("l"))
    out = asked.select(F.col("vec_id").alias("query_id"), "node").join(lists, F.col("node") == F.col("query"))
    own = F.slice(F.filter("l", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    flat = out.select("query_id", F.posexplode(own).alias("p", "x"))
    return flat.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
