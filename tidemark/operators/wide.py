"""Exact order statistics of very many numeric columns at once.

``cumulative`` has an expression per column and keeps bucket totals on the driver, which suits
some dozens of columns. Here a row's values travel as one array, and tasks work on whole columns of
a batch of rows, so a plan is the same for ten columns and for ten thousand.

A column is cut at some of its own values, which only balances the work: tasks sort their values and
count how many lie at each cut and in each cell between two. The totals show which cells can hold
the largest gap between the two samples or a wanted rank; only those are cut again, at more of their
own values, until few values are left in them. These alone are shuffled and ordered, and the result is exact.

The first cuts come with the summaries. Their number grows with the root of the rows, as the gap
between samples of one distribution shrinks with it, so mostly one level is enough. Every level reads the table
again, so no value is kept, and what is shuffled for a level are counts. The driver gets some numbers per column,
the cuts of one level and its open cells, at most ``MOST_CELLS`` of either or a few per column.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cumulative import (
    BUCKETS,
    CURRENT,
    REFERENCE,
    SIDE,
    Summary,
    ecdf_gap,
    interpolated_edges,
    percentile_ranks,
    small_table,
)

#: Columns from which this form is the cheaper one.
WIDE_COLUMNS = 64
#: Cuts that a level may have; they go to every task.
MOST_CELLS = 1 << 21
#: Cuts of the first level by the root of a column's rows, and parts that an open cell is cut into later.
FIRST, PARTS = 8, 16
#: Values of a column that a task keeps as candidates for cuts, up to twice as many; fewer if there are very many columns.
CANDIDATES = 1 << 11
#: Open cells are put in order when they hold this share of the values, or so few, at a time.
KEPT_SHARE, KEPT_ROWS = 32, 1 << 20
#: Columns in one array, values that a task sorts at a time, and counts that are summed at a time.
PACK, HELD, BLOCK = 256, 1 << 23, 1 << 14

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package


def long_values(pair: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(side, first, values): a row's values in arrays, value ``k`` of one being of column ``first + k``."""
    arrays = [
        F.struct(F.lit(i).alias("first"), F.array(*[F.col(c).cast("double") for c in columns[i : i + PACK]]).alias("values"))
        for i in range(0, len(columns), PACK)
    ]
    if len(arrays) == 1:  # nothing to multiply
        return pair.select(SIDE, arrays[0].alias("a")).select(SIDE, "a.first", "a.values")
    return pair.select(SIDE, F.inline(F.array(*arrays)))


def grouped_values(long: DataFrame) -> DataFrame:
    """(side, no, value) rows in the form of ``long_values``."""
    known = long.where(F.col("no").isNotNull())
    return known.select(SIDE, F.col("no").cast("int").alias("first"), F.array(F.col("value").cast("double")).alias("values"))


# --- in tasks --------------------------------------------------------------------------


def _columns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(number, side, values) of each column, some millions of values at a time, ascending and
    without missing ones."""
    held: dict[int, list[np.ndarray]] = {}
    size = 0
    for batch in batches:
        lists = batch.column("values")
        flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()  # a null becomes NaN
        key = batch.column("first").to_numpy().astype(np.int64) * 2 + batch.column(SIDE).to_numpy()
        if len(key) and (key == key[0]).all():
            held.setdefault(int(key[0]), []).append(flat[at[0] : at[-1]].reshape(len(key), -1))
            size += int(at[-1] - at[0])
        else:
            order = np.argsort(key, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                if len(rows):
                    width = at[rows[0] + 1] - at[rows[0]]
                    held.setdefault(int(key[rows[0]]), []).append(flat[at[rows][:, None] + np.arange(width)])
                    size += len(rows) * width
        if size >= HELD:
            yield from _in_order(held)
            held, size = {}, 0
    yield from _in_order(held)


def _in_order(held: Mapping[int, list[np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray]]:
    for key, parts in held.items():
        values = np.ascontiguousarray(np.concatenate(parts).T)
        values += 0.0  # -0.0 is 0.0
        values.sort(axis=1)
        for i, n in enumerate(values.shape[1] - np.isnan(values).sum(axis=1)):
            if n:
                yield key // 2 + i, key % 2, values[i, :n]


def _spans(values: np.ndarray, cuts: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values between the cuts around some cells begin and end. Cell ``i`` lies before cut ``i``."""
    begin, end = np.append(0, values.searchsorted(cuts, "right")), np.append(values.searchsorted(cuts), len(values))
    return begin[cells], end[cells]


def _batch(schema: str, parts: Sequence[Sequence[np.ndarray]]) -> pa.RecordBatch:
    """Arrays of parts, put together column by column."""
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*parts)], names)


def _repeated(number: int, like: np.ndarray) -> np.ndarray:
    return np.full(len(like), number, np.int32)


def _gaps(n0: np.ndarray, n1: np.ndarray, total: tuple[int, int]) -> np.ndarray:
    """Distance of the two distribution functions, 0 if a sample is empty."""
    return np.abs(n0 / total[0] - n1 / total[1]) if all(total) else np.zeros(len(n0))


# --- summaries -------------------------------------------------------------------------


def _of(side: int, value: Column | str) -> Column:
    return F.when(F.col(SIDE) == side, F.col(value) if isinstance(value, str) else value)


def _merged(parts: Sequence[Sequence[float]]) -> tuple[int, float, float, float, float]:
    """Size, mean, sum of squared distances from it, and range of values of which parts have these numbers."""
    n, mean, squares, low, high = map(np.array, zip(*parts))
    total = n.sum()
    over = (n * mean).sum() / total
    return int(total), float(over), float((squares + n * np.square(mean - over)).sum()), float(low.min()), float(high.max())


def summaries_of(long: DataFrame, columns: Sequence[str], width: int = BUCKETS) -> list[Summary]:
    """Sizes, means, population deviations, the pooled range and cut points of every column.

    A task keeps every so many-th of the values it sorts, twice as many apart whenever it has too many. ``width``
    is the least number of parts to cut a column into."""
    most = MOST_CELLS // max(1, len(columns)) + 1
    least = min(CANDIDATES, most)
    schema = f"no int, {SIDE} int, n long, mean double, squares double, low double, high double, step long, cuts array<double>"

    def run(batches):
        parts: dict[tuple[int, int], list] = {}
        taken: dict[tuple[int, int], tuple[int, list[np.ndarray]]] = {}
        with np.errstate(all="ignore"):  # infinities have no deviation
            for *of, values in _columns(batches):
                mean = values.mean()
                key = tuple(of)
                parts.setdefault(key, []).append((len(values), mean, np.square(values - mean).sum(), values[0], values[-1]))
                step, some = taken.get(key, (1, []))
                some = [*some, values[step // 2 :: step]]
                while sum(map(len, some)) > 2 * least:
                    step, some = step * 2, [np.sort(np.concatenate(some))[1::2]]
                taken[key] = step, some
            rows = [(*key, *_merged(x), taken[key][0], np.concatenate(taken[key][1])) for key, x in parts.items()]
        if rows:
            yield from _rows(schema, rows).to_batches()

    totals = "n0 long, n1 long, mean0 double, mean1 double, std0 double, std1 double, low double, high double"
    result = f"no int, {totals}, cuts array<double>"

    def column(key, table):
        rows = table.drop_columns("cuts").to_pylist()
        with np.errstate(all="ignore"):
            sides = ([[r[k] for k in ("n", "mean", "squares", "low", "high")] for r in rows if r[SIDE] == s] for s in (REFERENCE, CURRENT))
            both = [_merged(x) if x else (0, None, None) for x in sides]
        deviations = [(m[2] / m[0]) ** 0.5 if m[0] else None for m in both]
        taken = [x.values.to_numpy() for x in table["cuts"]]
        cuts = np.concatenate(taken)
        if len(cuts):
            order = np.argsort(cuts)
            weights = np.concatenate([np.full(len(x), r["step"]) for x, r in zip(taken, rows)])[order].cumsum()
            n = min(most, max(width, int(FIRST * (both[0][0] + both[1][0]) ** 0.5)))
            cuts = np.unique(cuts[order][weights.searchsorted((np.arange(n) + 0.5) * (weights[-1] / n))])
        ends = min(r["low"] for r in rows), max(r["high"] for r in rows)
        return _rows(result, [(key[0].as_py(), both[0][0], both[1][0], both[0][1], both[1][1], *deviations, *ends, cuts)])

    got = long.mapInArrow(run, schema).groupBy("no").applyInArrow(column, result).toArrow()  # a row per column
    cuts = {no: found.values.to_numpy() for no, found in zip(got["no"].to_pylist(), got["cuts"])}
    known = {r["no"]: r for r in got.drop_columns("cuts").to_pylist()}
    none = {"n0": 0, "n1": 0, **dict.fromkeys(("mean0", "mean1", "std0", "std1", "low", "high"))}
    out = []
    for i, c in enumerate(columns):
        values = {k: v for k, v in known.get(i, none).items() if k != "no"}
        out.append(Summary(feature=c, cuts=cuts.get(i, ()), **values))
    return out


# --- largest gap and ranks -------------------------------------------------------------


@dataclass
class Search:
    """What is known of a column: its cuts, and the cells between them that are still open, with the
    numbers of values of both samples before and inside them."""

    total: tuple[int, int]
    ranks: list[int]
    best: float = 0.0
    found: dict[int, float] = field(default_factory=dict)
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cells: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    before: np.ndarray = field(default_factory=lambda: np.zeros((2, 1), np.int64))
    inside: np.ndarray | None = None

    def __post_init__(self):
        if self.inside is None:
            self.inside = np.array(self.total, np.int64)[:, None]

    def wanted(self) -> np.ndarray:
        """Which open cells can hold the largest gap or a rank that is not found yet."""
        (a, b), (c, d) = self.before, self.before + self.inside
        bound = np.maximum(_gaps(c, b, self.total), _gaps(a, d, self.total))
        ranks = np.array([r for r in self.ranks if r not in self.found], np.int64)
        return (self.inside.sum(axis=0) > 0) & ((bound > self.best) | (np.searchsorted(ranks, a) < np.searchsorted(ranks, c)))

    def keep(self, which: np.ndarray) -> None:
        self.cells, self.before, self.inside = self.cells[which], self.before[:, which], self.inside[:, which]

    def cut(self, values: np.ndarray) -> None:
        """More cuts, all inside open cells; cuts between closed cells are forgotten."""
        ends = self.cuts[self.cells[self.cells < len(self.cuts)]]
        starts = np.unique(np.concatenate([self.cuts[self.cells[self.cells > 0] - 1], values]))
        first = len(self.cells) and self.cells[0] == 0
        self.cuts = np.unique(np.concatenate([starts, ends]))
        self.cells = np.concatenate([np.zeros(int(first), np.int64), self.cuts.searchsorted(starts) + 1])

    def judge(self, counts: np.ndarray) -> None:
        """Take in the counts of both samples: in cells at even places, at the cuts between them at odd ones."""
        sums = counts.cumsum(axis=1)
        self.best = max(self.best, float(_gaps(*sums, self.total).max()))
        for rank in self.ranks:
            place = int(sums[0].searchsorted(rank, "right"))
            if place % 2:
                self.found[rank] = float(self.cuts[place // 2])
        at = self.cells * 2
        self.inside = counts[:, at]
        self.before = sums[:, at] - self.inside
        self.keep(self.wanted())


def profile(
    long: DataFrame, summaries: Sequence[Summary], bins: int = 10, width: int = BUCKETS
) -> dict[str, tuple[float, tuple[float, ...]]]:
    """KS statistic and percentile edges of the reference, per column with values.

    The summaries' cuts are the first ones; ``width`` is the number of parts that columns are cut into later
    on average, at least."""
    searches = {
        i: Search((s.n0, s.n1), sorted({r for low, high, _ in percentile_ranks(s.n0, bins) for r in (low, high)}) if bins else [])
        for i, s in enumerate(summaries)
        if s.n0 + s.n1
    }
    limit = max(_left(searches) // KEPT_SHARE, KEPT_ROWS)
    known = {i: np.array(summaries[i].cuts, float) for i in searches}
    if _left(searches) > limit and sum(map(len, known.values())) <= MOST_CELLS + len(known):
        for i, s in searches.items():
            s.cut(known[i])
        _judge(long, searches)
    while _left(searches) > limit:
        cells = sum(len(s.cells) for s in searches.values())
        parts = min(MOST_CELLS, max(PARTS * cells, width * len(searches)))
        if cells >= max(MOST_CELLS, 2 * len(searches)) or not _cut(long, searches, parts):
            break  # too many to be cut again, or nothing to cut them at
        _judge(long, searches)
    while _left(searches):
        _settle(long, searches, limit)
    return {
        summaries[i].feature: (s.best, interpolated_edges(s.total[0], bins, s.found) if bins else ()) for i, s in searches.items()
    }


def _left(searches: Mapping[int, Search]) -> int:
    return sum(int(s.inside.sum()) for s in searches.values())


def _shared(long: DataFrame, searches: Mapping[int, Search]):
    return long.sparkSession.sparkContext.broadcast({i: (s.cuts, s.cells) for i, s in searches.items() if len(s.cells)})


def _cut(long: DataFrame, searches: Mapping[int, Search], parts: int) -> bool:
    """Cut open cells at every so many-th of their values, for some ``parts`` in all; whether there were any."""
    known, step = _shared(long, searches), max(1, _left(searches) // max(1, parts))
    schema = "no int, value double"

    def run(batches):
        start = int(TaskContext.get().partitionId() * 0.618 % 1 * step)  # tasks do not all pass over the same ranks
        due: dict[int, int] = {}
        found: dict[int, list[np.ndarray]] = {}
        for no, _, values in _columns(batches):
            if no not in known.value:
                continue
            begin, end = _spans(values, *known.value[no])
            sums = np.cumsum(end - begin)
            at = np.arange(due.get(no, start), sums[-1], step)
            due[no] = due.get(no, start) + len(at) * step - int(sums[-1])
            cell = sums.searchsorted(at, "right")
            found.setdefault(no, []).append(values[end[cell] - (sums[cell] - at)])
        taken = {no: np.unique(np.concatenate(x)) for no, x in found.items()}
        if taken:
            yield _batch(schema, [(_repeated(no, x), x) for no, x in taken.items()])

    taken = long.mapInArrow(run, schema).toArrow()
    known.destroy()
    no, value = (taken.column(k).to_numpy() for k in range(2))
    order = np.argsort(no, kind="stable")
    no, value = no[order], value[order]
    for i, s in searches.items():
        s.cut(np.unique(value[no.searchsorted(i) : no.searchsorted(i, "right")]))
    return len(value) > 0


COUNTS = "no int, block int, n0 array<long>, n1 array<long>"


def _counted(long: DataFrame, known) -> DataFrame:
    """Counts of both samples per column, in cells and at the cuts between them, a block of them a row."""
    schema = f"no int, {SIDE} int, block int, n array<long>"

    def count(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for no, side, values in _columns(batches):
            if no in known.value:
                cuts = known.value[no][0]
                ends = np.empty(2 * len(cuts) + 1, np.int64)
                ends[:-1:2], ends[1::2], ends[-1] = values.searchsorted(cuts), values.searchsorted(cuts, "right"), len(values)
                counts = np.diff(ends, prepend=0)
                sums[no, side] = sums[no, side] + counts if (no, side) in sums else counts
        for (no, side), counts in sums.items():
            blocks = [b for b in range(0, len(counts), BLOCK) if counts[b : b + BLOCK].any()]
            numbers = [pa.array([x] * len(blocks), pa.int32()) for x in (no, side)]
            rows = pa.array([counts[b : b + BLOCK] for b in blocks], pa.list_(pa.int64()))
            yield pa.record_batch([*numbers, pa.array([b // BLOCK for b in blocks], pa.int32()), rows], ["no", SIDE, "block", "n"])

    def add(key, table):
        both = np.zeros((2, len(table["n"][0])), np.int64)
        for side, n in zip(table[SIDE].to_numpy(), table["n"]):
            both[side] += n.values.to_numpy()
        return _rows(COUNTS, [(key[0].as_py(), key[1].as_py(), *both)])

    return long.mapInArrow(count, schema).groupBy("no", "block").applyInArrow(add, COUNTS)


def _rows(schema: str, rows: Sequence[Sequence]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    columns = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array(list(x), kinds[kind]) for x, (_, kind) in zip(zip(*rows), columns)], [name for name, _ in columns])


def _judge(long: DataFrame, searches: Mapping[int, Search]) -> None:
    """Count a level, and close the cells that cannot matter any more."""
    lists = ("cells", "before0", "before1", "inside0", "inside1", "ranks")
    schema = f"no int, best double, {', '.join(f'{n} array<long>' for n in lists)}, found array<double>"
    known = _shared(long, searches)
    so_far = {i: (s.total, s.ranks, s.best) for i, s in searches.items()}

    def judge(key, table):
        no = key[0].as_py()
        search = Search(*so_far[no])
        search.cuts, search.cells = known.value[no]
        counts = np.zeros((2, 2 * len(search.cuts) + 1), np.int64)
        for block, *both in zip(table["block"].to_numpy(), table["n0"], table["n1"]):
            for side, n in enumerate(both):
                counts[side, block * BLOCK : block * BLOCK + len(n)] = n.values.to_numpy()
        search.judge(counts)
        return _rows(schema, [(no, search.best, search.cells, *search.before, *search.inside, [*search.found], [*search.found.values()])])

    got = _counted(long, known).groupBy("no").applyInArrow(judge, schema).toArrow()  # a row per column
    known.destroy()
    for r in range(got.num_rows):
        numbers = {n: got[n][r].values.to_numpy() for n in lists}
        s = searches[got["no"][r].as_py()]
        s.best, s.cells = got["best"][r].as_py(), numbers["cells"]
        s.before, s.inside = (np.stack([numbers[f"{n}{side}"] for side in (0, 1)]) for n in ("before", "inside"))
        s.found |= zip(numbers["ranks"].tolist(), got["found"][r].as_py())


def _settle(long: DataFrame, searches: Mapping[int, Search], limit: int) -> None:
    """Put the values of open cells in order, of as many as hold ``limit`` values, and close them."""
    chosen, cells, held, room = {}, [], [], limit
    for i, s in searches.items():
        sizes = s.inside.sum(axis=0).cumsum()
        n = max(int(sizes.searchsorted(room, "right")), int(not cells and len(sizes) > 0))
        if n:
            chosen[i] = (s.cuts, s.cells[:n])
            room -= int(sizes[n - 1])
            ranks, (a, b) = np.array(s.ranks, np.int64), s.before[:, :n]
            cells.append((_repeated(i, a), s.cells[:n].astype(np.int32), a, b, *(np.full(n, t) for t in s.total)))
            held += np.split(ranks, ranks.searchsorted(np.stack([a, a + s.inside[0, :n]], axis=1).ravel()))[1::2]
            s.keep(np.arange(len(s.cells)) >= n)
    known = long.sparkSession.sparkContext.broadcast(chosen)
    schema = f"no int, cell int, {SIDE} int, value double, n long"

    def run(batches):
        parts, size = [], 0
        for no, side, values in _columns(batches):
            if no not in known.value:
                continue
            begin, end = _spans(values, *known.value[no])
            n = end - begin
            x = values[np.repeat(end - n.cumsum(), n) + np.arange(n.sum())]
            if len(x):
                first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                cell = np.repeat(known.value[no][1], n)[first].astype(np.int32)
                parts.append((_repeated(no, first), cell, _repeated(side, first), x[first], np.diff(first, append=len(x))))
                size += len(first)
            if size >= 1 << 16:
                yield _batch(schema, parts)
                parts, size = [], 0
        if parts:
            yield _batch(schema, parts)

    starts = pa.Table.from_batches([_batch("no int, cell int, before0 long, before1 long, tot0 long, tot1 long", cells)])
    starts = long.sparkSession.createDataFrame(starts.append_column("ranks", pa.array(held, pa.list_(pa.int64()))))
    inside = Window.partitionBy("no", "cell").orderBy("value")  # a frame ends with the last row of a value
    count = lambda side, frame: F.coalesce(F.sum(_of(side, "n")).over(frame), F.lit(0))
    rows = long.mapInArrow(run, schema).select(
        "no",
        "cell",
        "value",
        count(REFERENCE, inside).alias("run0"),
        count(CURRENT, inside).alias("run1"),
        count(REFERENCE, inside.rangeBetween(Window.currentRow, Window.currentRow)).alias("n0"),
    )
    rows = rows.join(F.broadcast(starts), ["no", "cell"])
    rows = rows.withColumns({"cum0": F.col("before0") + F.col("run0"), "cum1": F.col("before1") + F.col("run1")})
    hits = F.filter("ranks", lambda r: (r < F.col("cum0")) & (r >= F.col("cum0") - F.col("n0")))
    at_ranks = F.transform(hits, lambda r: F.struct(r.alias("rank"), F.col("value").alias("value")))
    result = rows.groupBy("no").agg(
        F.max(ecdf_gap()).alias("gap"), F.flatten(F.collect_set(F.when(F.size(hits) > 0, at_ranks))).alias("found")
    )
    for r in result.collect():  # a row per column
        s = searches[r["no"]]
        s.best = max(s.best, r["gap"] or 0.0)
        s.found |= {x["rank"]: x["value"] for x in r["found"]}
    known.destroy()
    for s in searches.values():
        s.keep(s.wanted())


# --- bins ------------------------------------------------------------------------------


def bins_on_edges(long: DataFrame, edges: Mapping[str, Sequence[float]], columns: Sequence[str]) -> DataFrame:
    """Counts of both samples per (feature, bin) on each column's own edges, as ``bin_on_edges`` has them."""
    ends = {i: np.array(edges[c], float) for i, c in enumerate(columns) if len(edges.get(c, ())) >= 2}
    schema = f"no int, {SIDE} int, bin int, n long"

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for no, side, values in _columns(batches):
            if no in ends:
                first, *inner, last = ends[no]
                begin, end = values.searchsorted(first), values.searchsorted(last, "right")
                places = np.sort(values.searchsorted(inner)).astype(np.int64).clip(begin, end)
                sums[no, side] = sums.get((no, side), 0) + np.diff(places, prepend=begin, append=end)
        if sums:
            yield _batch(schema, [(_repeated(no, n), _repeated(s, n), np.arange(len(n), dtype=np.int32), n) for (no, s), n in sums.items()])

    names = small_table(long.sparkSession, "no int, feature string", [(i, columns[i]) for i in ends])
    counted = long.mapInArrow(run, schema).where("n > 0").join(F.broadcast(names), "no")  # a row per column
    return counted.groupBy("feature", "bin").agg(
        *[F.coalesce(F.sum(_of(s, "n")), F.lit(0)).alias(f"n{s}") for s in (REFERENCE, CURRENT)]
    )


def bins_equal_width(long: DataFrame, summaries: Sequence[Summary], bins: int) -> DataFrame:
    """Counts of both samples per (feature, bin) on equal parts of each column's range."""
    known = small_table(
        long.sparkSession,
        "no int, feature string, low double, high double",
        [(i, s.feature, s.low, s.high) for i, s in enumerate(summaries) if s.low is not None],
    )
    rows = long.select(SIDE, "first", F.posexplode("values").alias("k", "value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("no", F.col("first") + F.col("k"))
    low, high = F.col("low"), F.col("high")
    part = F.least(F.floor((F.col("value") - low) / (high - low) * bins), F.lit(bins - 1))
    counted = rows.join(F.broadcast(known), "no").select(  # a row per column
        SIDE, "feature", F.when(low == high, 0).otherwise(part).cast("int").alias("bin")
    )
    return counted.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count_if(F.col(SIDE) == REFERENCE).alias("n0"), F.count_if(F.col(SIDE) == CURRENT).alias("n1")
    )
