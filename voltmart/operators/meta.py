"""Load bookmarks and run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.functions.time import as_ts


def latest_watermarks(log: DataFrame) -> DataFrame:
    """Current value per entity from an append-only bookmark log (F1)."""
    newest = F.max_by("watermark_value", F.struct("updated_at", "watermark_value"))
    return log.groupBy("entity").agg(
        newest.alias("watermark_value"), F.max("updated_at").alias("updated_at")
    )


def watermark_row(df: DataFrame, entity: str, ts: str, now: str) -> DataFrame:
    """The next bookmark of an entity: the newest timestamp it holds. No row when it is empty."""
    return (
        df.agg(F.max(ts).alias("_w"))
        .filter(F.col("_w").isNotNull())
        .select(
            F.lit(entity).alias("entity"),
            F.date_format("_w", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("watermark_value"),
            as_ts(now).alias("updated_at"),
        )
    )


def rows_since(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """Rows at or after the bookmark; everything when there is none. Pushed to the scan.

    Rows of the bookmark's own time are read again, as more of them may have come since; merging
    them changes nothing.
    """
    return df if watermark is None else df.filter(F.col(ts) >= as_ts(watermark))


def merge_latest(target: DataFrame, changes: DataFrame, key: str, ts: str) -> DataFrame:
    """Replace target rows by the newest change per key and add new keys (F2).

    Only the changes are reduced; the large target is neither sorted nor aggregated, it only
    loses the changed keys. The maximum combines before the shuffle, so a key with very many
    changes does not gather in one task; changes of equal time are ordered by their values, so
    a recomputed task picks the same one.
    """
    row = F.struct(F.col(ts).alias("_t"), F.struct(*[F.col(c) for c in target.columns]).alias("_r"))
    newest = (
        changes.groupBy(F.col(key).alias("_k")).agg(F.max(row).alias("_m")).select("_k", "_m._r.*")
    )
    kept = target.join(newest.select("_k"), target[key] == F.col("_k"), "left_anti")
    return kept.unionByName(newest.drop("_k"))


def run_started(spark, run_id: str, dag_id: str, started_at: str) -> DataFrame:
    """The opening audit row; a run is RUNNING until it says otherwise."""
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(dag_id).alias("dag_id"),
        as_ts(started_at).alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("string").alias("details"),
    )


def run_finished(opening: DataFrame, finished_at: str, status: str, details_json: str) -> DataFrame:
    return opening.withColumns(
        {
            "finished_at": as_ts(finished_at),
            "status": F.lit(status),
            "details": F.lit(details_json),
        }
    )


def latest_runs(log: DataFrame) -> DataFrame:
    """One row per run: the terminal row if there is one, else the opening row."""
    body = F.struct("dag_id", "started_at", "finished_at", "status", "details")
    rank = F.coalesce(F.col("finished_at"), F.lit("0001-01-01").cast("timestamp"))
    return log.groupBy("run_id").agg(F.max_by(body, rank).alias("r")).select("run_id", "r.*")
