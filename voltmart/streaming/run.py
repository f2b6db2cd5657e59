"""Reading folders as streams and draining a stream into a table."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATENESS = "10 minutes"
FOLD_EVERY = 50


def folder_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream with a declared schema."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


class BatchJob(NamedTuple):
    """A stream whose micro-batches are computed as tables: ``run`` drains it into a folder."""

    run: Callable[[str], DataFrame]


def drain(stream: DataFrame | BatchJob, target: str, mode: str = "append") -> DataFrame:
    """Process everything available into a Parquet folder and return it as a table.

    Offsets and state live next to the output in the shared folder, so a restart continues.
    """
    if isinstance(stream, BatchJob):
        return stream.run(target)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", f"{target}/data")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{target}/data")


def drain_batches(
    stream: DataFrame, target: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Process everything available through ``handle(batch, batch_id)`` and note each finished batch."""
    spark = stream.sparkSession
    none = spark.createDataFrame([], "batch bigint")
    none.write.mode("ignore").parquet(f"{target}/done/n=0")

    def run(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        note = spark.range(batch_id, batch_id + 1).withColumnRenamed("id", "batch")
        note.write.mode("overwrite").parquet(f"{target}/done/n={batch_id + 1}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(run)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def finished(spark: SparkSession, target: str) -> int:
    """Number of finished batches of ``drain_batches``."""
    last = spark.read.schema("batch bigint").parquet(f"{target}/done").agg(F.max("batch")).first()[0]
    return 0 if last is None else last + 1


class BatchTable:
    """Rows that micro-batches leave for later ones, in a folder per batch.

    A batch overwrites its own folder only, so it can be repeated. Every ``every`` batches what has
    been left so far is folded into one folder, from then on read in place of the others. Readers name
    the folders they need: one that is lost is an error, not an empty table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        every: int = FOLD_EVERY,
    ):
        self.spark, self.path, self.every = spark, path, every
        self.schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        self.fold = fold or (lambda rows: rows)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _paths(self, base: int, until: int) -> list[str]:
        folded = [f"{self.path}/fold-{base}"] if base else []
        return folded + [f"{self.path}/batch-{i}" for i in range(base, until)]

    def begin(self, batch_id: int) -> None:
        """To be called by a batch before it reads: folds when it is time."""
        if batch_id and batch_id % self.every == 0:
            rows = self._read(self._paths(batch_id - self.every, batch_id))
            self.fold(rows).select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/fold-{batch_id}")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumn("batch", F.lit(batch_id).cast("bigint")).select(self.schema.names)
        stamped.write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id}")

    def of(self, batch_id: int) -> DataFrame:
        """What one batch has left."""
        return self._read([f"{self.path}/batch-{batch_id}"])

    def before(self, batch_id: int) -> DataFrame:
        """What all batches before the given one have left, with their ``batch``."""
        last = batch_id - 1
        # The batch that folds reads its fold; after a drain the next batch has not folded yet.
        base = last - last % self.every if last >= 0 else 0
        return self._read(self._paths(base, batch_id))
