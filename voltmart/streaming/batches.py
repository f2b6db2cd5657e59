"""Failure runs and the KPI over micro-batches, with what later batches need kept in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.operators import changes, mart, metrics
from voltmart.streaming.run import BatchTable, drain_batches, finished

DAY = "segment_day"


class RunTables:
    """Events, and what their days say about failure runs.

    A day of a breaker is summed up by its successes, its failures after the last of them, and its
    groups; the groups of the whole stream are put together from days in order. So an event that comes
    late redoes its own day and nothing else. Newer versions of a day replace older ones.
    """

    def __init__(self, spark: SparkSession, target: str, keys: list[str], every: int):
        text = ", ".join(f"`{k}` string" for k in keys)

        def table(name: str, columns: str, fold=None) -> BatchTable:
            schema = spark.createDataFrame([], f"{text}, {columns}").schema
            return BatchTable(spark, f"{target}/{name}", schema, fold, every)

        self.keys, self.place = keys, [*keys, DAY]
        self.events = table("events", f"ts timestamp, id bigint, bad boolean, {DAY} date")
        self.days = table("days", f"{DAY} date, _n_ok bigint, _tail bigint", self.newest)
        self.groups = table(
            "groups",
            f"{DAY} date, run bigint, failures bigint, first_failure timestamp, last_failure timestamp,"
            "opened_at timestamp, closed_at timestamp, lead array<timestamp>",
            self.newest,
        )

    def newest(self, rows: DataFrame) -> DataFrame:
        """The rows of the last batch that touched a day."""
        last = rows.groupBy(*self.place).agg(F.max("batch").alias("batch"))
        return rows.join(last, [*self.place, "batch"], "left_semi")


def detect_failures(
    events: DataFrame, target: str, failed: Column, keys: list[str] = metrics.BREAKER, fold_every: int = 50
) -> DataFrame:
    """Runs of consecutive failures per breaker over a stream (S6), as a batch over all events gives them.

    Each micro-batch runs the bucketed batch operator over the days it touches, also long past ones.
    """
    spark = events.sparkSession
    tables = RunTables(spark, target, keys, fold_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        for table in (tables.events, tables.days, tables.groups):
            table.begin(batch_id)
        day = F.to_date("ts").alias(DAY)
        named = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]
        narrow = batch.filter(F.col("ts").isNotNull()).select(*named, "ts", F.col("id").cast("bigint").alias("id"), failed.alias("bad"), day)
        tables.events.write(narrow, batch_id)
        rows = tables.events.of(batch_id)
        if batch_id:
            touched = rows.select(*tables.place).distinct()
            # One row per calendar day; the filter lets scans skip files of other days.
            days = [r[DAY] for r in touched.select(DAY).distinct().collect()]
            earlier = tables.events.before(batch_id).filter(changes.in_spans("ts", days))
            rows = earlier.join(touched, tables.place, "left_semi").unionByName(rows)
        groups = metrics.run_groups(rows, F.col("bad"), [DAY, *keys], leading=True).persist()
        # The first group of a day may close a run of an earlier day, also without a failure of its own.
        tables.groups.write(groups.filter("failures > 0 OR run = 0"), batch_id)
        open_one = F.col("closed_at").isNull()
        tables.days.write(
            groups.groupBy(*tables.place).agg(
                F.count_if(~open_one).alias("_n_ok"), F.sum(F.when(open_one, F.col("failures")).otherwise(0)).alias("_tail")
            ),
            batch_id,
        )
        groups.unpersist()

    drain_batches(events, target, handle)
    return merged_runs(tables, finished(spark, target))


def merged_runs(tables: RunTables, batches: int) -> DataFrame:
    """Runs over all days; a run that days cut is put together again."""
    keys = tables.keys
    days = tables.newest(tables.days.before(batches)).drop("batch")
    groups = tables.newest(tables.groups.before(batches)).drop("batch")
    met = groups.join(metrics.open_runs(days, keys, [DAY]), tables.place)
    goes_on = (F.col("run") == 0) & (F.col("_open_before") > 0)
    missing = metrics.limit_of(F.col(keys[-1]), metrics.FAIL_MAX) - F.col("_open_before").cast("int")
    reached = F.when(missing > 0, F.get("lead", missing - 1))
    return (
        met.withColumn("opened_at", F.when(goes_on, reached).otherwise(F.col("opened_at")))
        .withColumn("run", F.col("_ok_before") + F.col("run"))
        .groupBy(*keys, "run")
        .agg(
            F.sum("failures").alias("failures"),
            F.min("first_failure").alias("first_failure"),
            F.max("last_failure").alias("last_failure"),
            F.min("opened_at").alias("opened_at"),
            F.min("closed_at").alias("closed_at"),
        )
        .filter("failures > 0")
    )


def refresh_mart(parts: DataFrame, target: str, fold_every: int = 50) -> DataFrame:
    """KPI table kept up to date by a stream of ``operators.mart`` day parts.

    Each micro-batch adds its own sums per day; nothing that was read before is read again. Parts may
    be negative (``mart.negated``): a changed row is taken off its day and put on another. The
    KPI is built from the sums, one row per day and batch, folded to one per day now and then.
    """
    sums = kept_sums(parts, target, fold_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums.begin(batch_id)
        # One small file; the sums themselves are taken before, by all tasks.
        sums.write(_wide(mart.daily_partials(batch)).repartition(1), batch_id)

    drain_batches(parts, target, handle)
    return current_kpi(parts, target, fold_every)


def _wide(sums: DataFrame) -> DataFrame:
    """Sums in the one type that sums of sums have."""
    return sums.withColumn("t", F.col("t").cast("decimal(38,0)"))


def kept_sums(parts: DataFrame, target: str, fold_every: int) -> BatchTable:
    none = _wide(mart.daily_partials(parts.sparkSession.createDataFrame([], parts.schema)))

    def fold(rows: DataFrame) -> DataFrame:
        return _wide(mart.daily_partials(rows)).withColumn("batch", F.lit(-1).cast("bigint"))

    return BatchTable(parts.sparkSession, f"{target}/parts", none.schema, fold, fold_every)


def current_kpi(parts: DataFrame, target: str, fold_every: int = 50) -> DataFrame:
    sums = kept_sums(parts, target, fold_every).before(finished(parts.sparkSession, target))
    return mart.kpi_from_partials(mart.daily_partials(sums.drop("batch")))
