"""Shared pieces: table access, words, hold-out folds, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.session import configure

# Word separators of all contracts: blank, tab, line feed, vertical tab, form feed, return.
SEPARATORS = r"[\x20\x09-\x0D]+"


# Arrow batches small enough that very long texts fit a worker.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and blank texts."""
    return F.filter(F.split(whole(text), SEPARATORS), lambda w: w != "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(labels: DataFrame, label: str, at_most: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``at_most`` ids, the first by a hash of the id.

    Rows with a null id or label are left out; an id with several labels takes the largest. The
    row bound is what makes the result fit for a broadcast.
    """
    clean = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    return clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
