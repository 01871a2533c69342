"""Latest-value tables of all views on shared storage, brought forward run by run.

A view's table is cut into buckets by a hash of its key. A run rewrites only the buckets that its
new rows touch, each into a folder of its own (``bucket=3/run=7``), and says last, in the marks,
which run of each bucket counts and up to which time the view is materialised. Readers follow the
marks, so a run that ends before its mark has changed no answer, and running it again
overwrites its own folders.

    root/<view>/bucket=<b>/run=<r>/   newest row per key of one bucket
    root/marks/step=<n>/              one row per view; the highest step counts

One run writes at a time. ``remove_unread`` deletes what no reader needs any more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import as_date, day_bounds, midnight
from tidemark.operators.latest import latest_in_range, latest_per_key, merge_latest
from tidemark.sources import io
from tidemark.sources.schemas import FeatureView

MARKS = (
    "view string, upto timestamp, run long, runs map<int, long>, stream string, batch long"
)
RUN_ROWS = (
    "feature_view string, entities long, start_time string, end_time string, status string, error string"
)


@dataclass(frozen=True)
class Mark:
    """What is valid of one view: time reached, last run, the run that counts for each bucket, and
    the stream and batch that it came from, if any."""

    view: str
    upto: datetime | None = None
    run: int = 0
    runs: Mapping[int, int] | None = None
    stream: str | None = None
    batch: int | None = None


class LatestStore:
    """Latest tables under ``root``. ``buckets`` is fixed once a view has been written: choose it so
    that a bucket is a task's worth of rows; ``files`` cuts a bucket into more files."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, files: int = 1):
        self.spark, self.root, self.buckets, self.files = spark, root.rstrip("/"), buckets, files

    # --- marks ---

    def _steps(self) -> list[int]:
        return sorted(io.numbers_below(self.spark, f"{self.root}/marks", "step"))

    def _in_force(self) -> tuple[int, list[Row]]:
        """The newest step that has its rows; a step that was cut short has none."""
        for step in reversed(self._steps()):
            rows = self.spark.read.schema(MARKS).parquet(f"{self.root}/marks/step={step}").collect()
            if rows:
                return step, rows
        return 0, []

    def marks(self) -> dict[str, Mark]:
        """The marks in force; a row per view."""
        return {r["view"]: Mark(**r.asDict()) for r in self._in_force()[1]}

    def set_mark(self, mark: Mark) -> None:
        """One file, put in place as a whole: the last thing that a run does."""
        marks = {**self.marks(), mark.view: mark}
        step = max(self._steps(), default=0) + 1
        rows = [(m.view, m.upto, m.run, dict(m.runs or {}), m.stream, m.batch) for m in marks.values()]
        self.spark.createDataFrame(rows, MARKS).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/step={step}")

    # --- tables ---

    def _folder(self, view: str, bucket: int, run: int) -> str:
        return f"{self.root}/{view}/bucket={bucket}/run={run}"

    def read(self, view: FeatureView, schema=None, only: Sequence[int] | None = None) -> DataFrame | None:
        """The latest table of a view, or of some of its buckets; None before the first row."""
        mark = self.marks().get(view.name)
        runs = {b: r for b, r in ((mark and mark.runs) or {}).items() if only is None or b in only}
        if not runs:
            return None
        reader = self.spark.read.option("basePath", f"{self.root}/{view.name}")
        if schema is not None:
            reader = reader.schema(schema)
        table = reader.parquet(*[self._folder(view.name, b, r) for b, r in sorted(runs.items())])
        return table.drop("bucket", "run")

    def latest(self, views: Sequence[FeatureView]) -> dict[str, tuple[FeatureView, DataFrame]]:
        """The tables that lookups read, by view name."""
        return {v.name: (v, t) for v in views if (t := self.read(v)) is not None}

    def merge(
        self, view: FeatureView, fresh: DataFrame, upto: datetime | None, stream: str | None = None, batch: int | None = None
    ) -> dict[str, int]:
        """Merge rows (one per key) into the view's table and set its mark.

        Returns how many keys came in and how many buckets were rewritten.
        """
        before = self.marks().get(view.name, Mark(view.name))
        run = before.run + 1
        bucket = F.pmod(F.xxhash64(*view.keys), F.lit(self.buckets)).cast("int")
        part = F.pmod(F.xxhash64(F.lit("file"), *view.keys), F.lit(self.files))
        staged = f"{self.root}/staged/{view.name}"
        seen = Observation("fresh")
        fresh.withColumn("bucket", bucket).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # ``buckets`` at most
        if touched:
            rows = new.drop("bucket")
            stored = self.read(view, rows.schema, only=touched)
            merged = rows if stored is None else merge_latest(stored.select(*rows.columns), rows, view)
            merged = merged.withColumn("bucket", bucket).withColumn("run", F.lit(run))
            (
                merged.repartition(F.col("bucket"), part)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("bucket", "run")
                .parquet(f"{self.root}/{view.name}")
            )
        runs = {**(before.runs or {}), **{b: run for b in touched}}
        reached = max([t for t in (before.upto, upto) if t is not None], default=None)
        self.set_mark(replace(before, upto=reached, run=run, runs=runs, stream=stream or before.stream, batch=before.batch if batch is None else batch))
        return {"entities": int(seen.get["rows"]), "buckets": len(touched)}

    # --- runs ---

    def materialize_incremental(
        self,
        views: Mapping[str, tuple[FeatureView, DataFrame]],
        end: str | date | datetime,
        names: Sequence[str] | None = None,
    ) -> dict[str, dict[str, int]]:
        """Bring all online views, or the named ones, from their marks forward to ``end``.

        A view without a mark starts its time to live before ``end`` (at its first row, if it
        never expires). A slice includes the marked time itself: another row of that instant may
        have come in since, and merging a row twice changes nothing.
        """
        out = {}
        end = _moment(end)
        for name in _chosen(views, names):
            view, table = views[name]
            mark = self.marks().get(name)
            start = mark.upto if mark else None
            if start is None:
                start = end - timedelta(days=view.ttl_days) if view.ttl_days is not None else datetime(1, 1, 1)
            fresh = latest_in_range(table, view, start, end)
            out[name] = self.merge(view, fresh, end)
        return out

    def materialize_run(
        self,
        views: Mapping[str, tuple[FeatureView, DataFrame]],
        start_day: str | date,
        end_day: str | date,
        names: Sequence[str] | None = None,
    ) -> DataFrame:
        """Write the views one after another over whole days; a status row per view.

        Counts come from the write itself. The first view that fails ends the run: its row says
        ``failed`` with the kind of error, those after it ``skipped``. What was written before stays.
        """
        start, end = day_bounds(start_day, end_day)
        rows, failed = [], False
        for name in _chosen(views, names):
            entities = error = None
            if failed:
                status = "skipped"
            else:
                try:
                    view, table = views[name]
                    entities = self.merge(view, latest_in_range(table, view, start, end), end)["entities"]
                    status = "success"
                except Exception as exc:  # whatever a view's data or storage brings up ends the run
                    status, failed, error = "failed", True, type(exc).__name__
            rows.append((name, entities, str(start), str(end), status, error))
        return self.spark.createDataFrame(rows, RUN_ROWS)

    def remove_unread(self, keep_steps: int = 2) -> int:
        """Delete steps older than the ``keep_steps`` up to the one in force, and buckets that no
        step left names; the number of folders deleted. Readers of older marks must be done."""
        newest = self._in_force()[0]
        old = [s for s in self._steps() if s <= newest - keep_steps]
        used = set()
        for step in range(max(1, newest - keep_steps + 1), newest + 1):
            if io.exists(self.spark, f"{self.root}/marks/step={step}"):
                for r in self.spark.read.schema(MARKS).parquet(f"{self.root}/marks/step={step}").collect():
                    used |= {(r["view"], b, n) for b, n in (r["runs"] or {}).items()}
        gone = [f"{self.root}/marks/step={s}" for s in old]
        for view in {v for v, _, _ in used}:
            for b in io.numbers_below(self.spark, f"{self.root}/{view}", "bucket"):
                for n in io.numbers_below(self.spark, f"{self.root}/{view}/bucket={b}", "run"):
                    if (view, b, n) not in used:
                        gone.append(self._folder(view, b, n))
        for path in gone:
            io.remove(self.spark, path)
        return len(gone)


def _moment(when: str | date | datetime) -> datetime:
    return when if isinstance(when, datetime) else midnight(as_date(when))


def _chosen(views: Mapping, names: Sequence[str] | None) -> list[str]:
    """The named views, or all online ones; an offline view cannot be named."""
    offline = [n for n in names or () if not views[n][0].online]
    if offline:
        raise ValueError(f"view {offline[0]!r} is offline only")
    return list(names or [n for n, (view, _) in views.items() if view.online])


def newest_rows(batch: DataFrame, view: FeatureView) -> DataFrame:
    """The newest row per key of some rows, with the columns that a store keeps."""
    ties = [view.created_col] if view.created_col else []
    return latest_per_key(batch.select(*view.keys, view.ts_col, *ties, *view.fields), view.keys, view.ts_col, ties)
