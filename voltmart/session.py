"""Session helpers: UTC semantics, shared scratch folders, reliable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Options the jobs rely on. Shuffle partitions are left to the cluster: AQE coalesces them.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default (INT96) has no statistics, and filters on times would not skip files.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options every job assumes; safe to call repeatedly."""
    for key, value in SESSION_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_lent: dict[tuple[str, ...], tuple[int, dict[str, str | None]]] = {}
_lending = threading.Lock()


@contextmanager
def lent_options(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    """Runtime options for as long as any thread needs them; then what was set before returns."""
    names = tuple(options)
    with _lending:
        users, before = _lent.get(names) or (0, {k: spark.conf.get(k, None) for k in names})
        for key, value in options.items():
            spark.conf.set(key, value)
        _lent[names] = (users + 1, before)
    try:
        yield
    finally:
        with _lending:
            users, before = _lent.pop(names)
            if users > 1:
                _lent[names] = (users - 1, before)
            else:
                for key, value in before.items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voltmart-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared root; nothing is created here."""
    return f"{shared_root(spark)}/voltmart-{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
