"""Per-rental billing state over a stream of ticks.

The state is a table: the opening states, and the states each micro-batch has changed. A batch
folds its ticks over the states of the rentals it ticks, with the same JVM expression as the batch
replay, and writes those states only. Keyed state in Python workers gave the same rows but took
about 10 ms per rental and round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.functions.money import BillingConfig
from voltmart.plans import replay
from voltmart.streaming.run import BatchTable, drain_batches, finished


class StateTables:
    """Opening and changed states, and the ticks that came too late."""

    def __init__(self, ticks: DataFrame, target: str, every: int):
        self.spark = ticks.sparkSession
        self.stored = T.StructType.fromDDL(f"rental_id string, state {replay.STATE}")
        self.opening_path = f"{target}/opening"
        self.states = BatchTable(self.spark, f"{target}/states", self.stored, self.newest, every)
        self.late = BatchTable(self.spark, f"{target}/late", ticks.schema, every=every)

    @staticmethod
    def newest(rows: DataFrame) -> DataFrame:
        """The last state of every rental."""
        last = F.max_by(F.struct("state", "batch"), "batch").alias("r")
        return rows.groupBy("rental_id").agg(last).select("rental_id", "r.state", "r.batch")

    def opening(self) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(self.opening_path)

    def at(self, batch_id: int, only: DataFrame | None = None) -> DataFrame:
        """States before a batch, of the given rentals or of all."""
        first, changed = self.opening(), self.states.before(batch_id)
        if only is not None:
            first, changed = (df.join(only, "rental_id", "left_semi") for df in (first, changed))
        if not batch_id:
            return first
        # After one batch there is one state of a rental at most.
        changed = (self.newest(changed) if batch_id > 1 else changed).select("rental_id", F.col("state").alias("_now"))
        return first.join(changed, "rental_id", "left").select("rental_id", F.coalesce("_now", "state").alias("state"))


def bill_ticks(
    ticks: DataFrame, opening: DataFrame, target: str, cfg: BillingConfig = BillingConfig(), fold_every: int = 50
) -> DataFrame:
    """Final billing state after draining ``ticks(rental_id, tick, now_ts, success)``.

    ``opening`` is the table of ``plans.replay.opening_state``; it is stored with batch 0. What a batch
    writes follows the rentals it ticks. A tick that is not later than the newest one billed for its
    rental in an earlier batch changes nothing and goes to the late ticks (``late_ticks``).
    """
    tables = StateTables(ticks, target, fold_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        for table in (tables.states, tables.late):
            table.begin(batch_id)
        if not batch_id:
            opening.write.mode("overwrite").parquet(tables.opening_path)
        before = tables.at(batch_id, batch.select("rental_id").distinct())
        if batch_id:
            seen = before.select("rental_id", F.col("state.tick").alias("_seen"))
            tables.late.write(batch.join(seen, "rental_id").filter("tick <= _seen").drop("_seen"), batch_id)
        else:
            tables.late.write(batch.limit(0), batch_id)
        active = before.filter("state.status = 'ACTIVE'")
        tables.states.write(replay.fold_ticks(active, batch, cfg), batch_id)

    drain_batches(ticks, target, handle)
    return current_states(tables, opening, finished(tables.spark, target))


def current_states(tables: StateTables, opening: DataFrame, batches: int) -> DataFrame:
    """State after the newest finished batch, ended rentals included; the opening state before any."""
    return replay.flat_states(tables.at(batches) if batches else opening)


def late_ticks(ticks: DataFrame, target: str, fold_every: int = 50) -> DataFrame:
    """Ticks that came after a later tick of their rental had been billed."""
    tables = StateTables(ticks, target, fold_every)
    return tables.late.before(finished(tables.spark, target)).drop("batch")
