"""Incremental runs with updates and deletes, and a KPI table that follows them.

A table is held as its last full load and the changes of the runs since. A run digests the source,
compares ranges with the digests of the run before, reads only ranges that differ on both sides, and
appends the keyed changes. The KPI is kept as sums per day: a change takes its old row's share
off and puts its new row's share on, so an updated rental moves its day and nothing else is read.

Every run writes folders of its own number and its report last; a run without a report is not
there for readers and is written anew when it is repeated.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.operators import changes, mart
from voltmart.schemas import TABLES, TableSpec, business_columns
from voltmart.session import configure, cut_lineage
from voltmart.sources.extract import conform

REPORT = (
    "base int, inserted bigint, updated bigint, deleted bigint, ranges bigint, changed_ranges bigint, run int"
)
# What each source adds to the KPI's sums per day.
SHARES = {"quotes": mart.quote_parts, "rentals": mart.rental_parts, "payment_attempts": mart.payment_parts}


class Run(NamedTuple):
    """A finished run and the full load it builds on."""

    run: int
    base: int


class CapturedTable:
    """One replicated table below a folder all executors share; it has one writer at a time, runs count from 1.

    The source of a run must be a snapshot: it is read once for digests and once for changed ranges.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, tokens: int = changes.TOKENS):
        self.spark, self.spec, self.tokens = configure(spark), spec, tokens
        self.root = f"{root.rstrip('/')}/{spec.name}"
        self.columns = business_columns(spec.schema)
        self.place = (spec.key, spec.bookmark)
        # Empty frames with the stored schemas.
        self.nothing = conform(spark.createDataFrame([], spec.schema), spec.schema).select(*self.columns)
        none = changes.keyed_diff(self.nothing, self.nothing, spec.key, self.columns)
        self.no_changes = spark.createDataFrame([], none.schema)
        self.no_reports = spark.createDataFrame([], REPORT)
        # The first run finds an empty report; later ones leave it.
        self.no_reports.drop("run").write.mode("ignore").parquet(self._path("reports", 0))

    def _path(self, kind: str, run: int | None = None) -> str:
        return f"{self.root}/{kind}" if run is None else f"{self.root}/{kind}/run={run}"

    def _write(self, df: DataFrame, kind: str, run: int) -> None:
        df.write.mode("overwrite").parquet(self._path(kind, run))

    def reports(self) -> DataFrame:
        """One row per finished run."""
        return self.spark.read.schema(self.no_reports.schema).parquet(self._path("reports"))

    def last(self) -> Run | None:
        row = self.reports().agg(F.max(F.struct("run", "base")).alias("r")).first()["r"]
        return Run(row["run"], row["base"]) if row else None

    def digests(self, run: int) -> DataFrame:
        return self.spark.read.parquet(self._path("digests", run))

    def _digested(self, df: DataFrame) -> DataFrame:
        return changes.range_digests(df, *self.place, self.columns, self.tokens)

    def _typed(self, source: DataFrame) -> DataFrame:
        return conform(source, self.spec.schema).select(*self.columns)

    def load(self, run: int, source: DataFrame) -> Run:
        """Hold the whole source; later runs build on it."""
        return self._based(run, self._typed(source))

    def rebase(self, run: int) -> Run:
        """Fold the changes since the last full load into a new one, without asking the source.

        To be done when reading the changes costs more than writing the table again.
        """
        last = self.last()
        if last is None or run <= last.run:
            raise ValueError("only a later run than the last one can fold it")
        return self._based(run, self.current(last))

    def _based(self, run: int, rows: DataFrame) -> Run:
        key, ts = self.place
        # In order of time, so a filter on days skips files; the key's hash cuts a crowded time.
        self._write(rows.repartitionByRange(F.col(ts), F.xxhash64(key)).sortWithinPartitions(ts), "base", run)
        rows = self.spark.read.schema(self.nothing.schema).parquet(self._path("base", run))
        self._write(self._digested(rows), "digests", run)
        count = self.digests(run).agg(F.sum("range_rows").alias("n"), F.count(F.lit(1)).alias("r")).first()
        self._shares(run, self.nothing, rows)
        return self._report(run, run, {"insert": count["n"] or 0}, count["r"], count["r"])

    def capture(self, run: int, source: DataFrame) -> Run:
        """Append what has changed since the last run; a full load when there is none."""
        last = self.last()
        if last is None:
            return self.load(run, source)
        if run <= last.run:
            raise ValueError(f"run {run} does not follow run {last.run}")
        source = self._typed(source)
        self._write(self._digested(source), "digests", run)
        ranges = cut_lineage(changes.compared_ranges(self.digests(last.run), self.digests(run)))
        differ = ranges.filter("changed")
        # At most one row per calendar day.
        days = [r["range_day"] for r in differ.select("range_day").distinct().collect()]

        def cut(df: DataFrame) -> DataFrame:
            return changes.rows_in(df, differ, days, *self.place, self.tokens)

        self._write(changes.keyed_diff(cut(self.current(last)), cut(source), self.spec.key, self.columns), "changes", run)
        found = self._changes(run)
        self._shares(run, changes.images(found, "before"), changes.images(found, "after"))
        counts = {r["op"]: r["count"] for r in found.groupBy("op").count().collect()}
        size = ranges.agg(F.count(F.lit(1)).alias("all"), F.count_if("changed").alias("changed")).first()
        return self._report(run, last.base, counts, size["all"], size["changed"])

    def _changes(self, run: int) -> DataFrame:
        return self.spark.read.schema(self.no_changes.schema).parquet(self._path("changes", run))

    def changes_since(self, base: int, run: int) -> DataFrame:
        """All changes of the runs after ``base`` up to ``run``, with their run."""
        if run == base:
            return self.no_changes.withColumn("run", F.lit(run))
        stored = self.spark.read.schema(self.no_changes.withColumn("run", F.lit(run)).schema).parquet(self._path("changes"))
        return stored.filter(F.col("run").between(base + 1, run))

    def current(self, at: Run | None = None) -> DataFrame:
        """The rows as of a run (the last one unless given): the full load and the last change of each key."""
        at = at or self.last()
        if at is None:
            return self.nothing
        base = self.spark.read.schema(self.nothing.schema).parquet(self._path("base", at.base))
        if at.run == at.base:
            return base
        return changes.applied(base, changes.last_per_key(self.changes_since(at.base, at.run), "run"), self.spec.key)

    def _shares(self, run: int, gone: DataFrame, come: DataFrame) -> None:
        """The run's sums per day for the KPI: what comes less what goes."""
        parts = SHARES.get(self.spec.name)
        if parts:
            signed = parts(come).unionByName(mart.negated(parts(gone)))
            # A few numbers per day that changed: one file.
            self._write(mart.daily_partials(signed).repartition(1), "shares", run)

    def shares(self, at: Run | None = None) -> DataFrame:
        """Sums per day over the last full load and the runs since."""
        at = at or self.last()
        if at is None or self.spec.name not in SHARES:
            raise ValueError(f"{self.spec.name} has no shares")
        stored = self.spark.read.parquet(self._path("shares"))
        return stored.filter(F.col("run").between(at.base, at.run)).drop("run")

    def _report(self, run: int, base: int, counts: dict[str, int], ranges: int, changed: int) -> Run:
        row = (base, *[counts.get(op, 0) for op in changes.OPS], ranges, changed)
        self._write(self.spark.createDataFrame([row], self.no_reports.drop("run").schema), "reports", run)
        return Run(run, base)


def tables(spark: SparkSession, root: str, names: list[str], tokens: int = changes.TOKENS) -> dict[str, CapturedTable]:
    return {n: CapturedTable(spark, root, TABLES[n], tokens) for n in names}


def capture_all(held: dict[str, CapturedTable], sources: dict[str, DataFrame], run: int) -> dict[str, Run]:
    """One run over several tables, side by side."""
    with ThreadPoolExecutor(max_workers=len(held)) as pool:
        jobs = {n: pool.submit(t.capture, run, sources[n]) for n, t in held.items()}
        return {n: job.result() for n, job in jobs.items()}


def kpi(held: dict[str, CapturedTable], at: dict[str, Run] | None = None) -> DataFrame:
    """The dense daily KPI from kept sums: no source row is read."""
    parts = [held[n].shares(at[n] if at else None) for n in SHARES]
    return mart.kpi_from_partials(mart.daily_partials(reduce(DataFrame.unionByName, parts)))
