"""Versioned Parquet layers with an append-only commit table.

Every attempt to write a layer gets a folder of its own; one appended commit row makes it
current. Nothing is written below a committed folder, so a failed or repeated run leaves readers
with the version they had. Commits are ordered by a sequence number, not by the time a run is
for; a layer has one writer at a time.
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltmart.functions.time import as_ts
from voltmart.schemas import LAYERS
from voltmart.session import configure, lent_options
from voltmart.sources.extract import conform

COMMITS = "version string, folder string, seq long, rows string, committed_at timestamp"
# Rows of a file are in order, so differences from row to row (the second version's encodings) are short.
STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# The files of a write's exchange go with the write, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Small files are not read together, so what is written from a stored table has a range of times per file, too.
WHOLE_FILES = {"spark.sql.files.openCostInBytes": "1g"}
# One exchange at a time: only one table's rows lie on disk twice.
_exchanging = threading.Lock()


class Version(NamedTuple):
    """A committed version: the folder of its attempt and the rows of its tables."""

    folder: str
    rows: dict[str, int]


class LayerStore:
    """Tables of all layers below one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def _folder(self, layer: str, version: str, table: str) -> str:
        return f"{self.root}/{layer}/{version}/{table}"

    def _commits(self, layer: str) -> str:
        # One folder per layer: two jobs must not append to the same folder at once.
        return f"{self.root}/_commits/{layer}"

    def bootstrap(self) -> None:
        """Create the commit table of each layer when it is missing; existing commits stay."""
        none = self.spark.createDataFrame([], COMMITS)
        with ThreadPoolExecutor(max_workers=len(LAYERS)) as pool:
            list(pool.map(lambda n: none.write.mode("append").parquet(self._commits(n)), LAYERS))

    def _newest(self, layer: str):
        """Version, folder and sequence number of the latest commit; nulls before any."""
        commits = self.spark.read.schema(COMMITS).parquet(self._commits(layer))
        return commits.agg(F.max_by(F.struct("version", "folder"), "seq").alias("v"), F.max("seq").alias("seq")).first()

    def current_version(self, layer: str) -> str | None:
        newest = self._newest(layer)["v"]
        return newest["version"] if newest else None

    def current_folder(self, layer: str) -> str | None:
        newest = self._newest(layer)["v"]
        return newest["folder"] if newest else None

    def stage(
        self, df: DataFrame, layer: str, folder: str, table: str, sort_by: str | None = None, ranged: bool = False
    ) -> int:
        """Write one table of an attempt and return its row count, observed during the write.

        With ``sort_by`` each file holds one range of times, so date filters skip whole files; the
        row's first column cuts a time that very many rows share. ``ranged`` rows come from files
        that hold ranges already and are not exchanged.
        """
        seen = Observation()
        schema = LAYERS[layer][table]
        out = conform(df, schema)
        if sort_by:
            order = list(dict.fromkeys([sort_by, schema.names[0]]))
            out = (out if ranged else out.repartitionByRange(*order)).sortWithinPartitions(*order)
        # Counted last: the sampling of the ranges reads the rows, too.
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
        with _exchanging if sort_by and not ranged else nullcontext(), lent_options(self.spark, TIDY):
            out.write.mode("errorifexists").options(**STORED).parquet(self._folder(layer, folder, table))
        return seen.get["rows"]

    def publish(
        self,
        layer: str,
        version: str,
        tables: dict[str, DataFrame],
        committed_at: str,
        sort_by: dict[str, str] | None = None,
        absent: tuple[str, ...] = (),
        ranged: tuple[str, ...] = (),
    ) -> Version:
        """Stage every table in a fresh folder, then commit it with one appended row.

        A table that is neither given nor named ``absent`` is an error; absent ones are empty. The
        ``ranged`` ones are rows of stored tables as they lie there, and keep the ranges of those files.
        """
        names = list(LAYERS[layer])
        missing = [n for n in names if n not in tables and n not in absent]
        if missing:
            raise ValueError(f"{layer} lacks {', '.join(missing)}")
        empty = {n: self.spark.createDataFrame([], LAYERS[layer][n]) for n in absent}
        frames = {**empty, **tables}
        order = sort_by or {}
        folder = f"{version}-{uuid.uuid4().hex[:12]}"

        def put(name: str) -> int:
            return self.stage(frames[name], layer, folder, name, order.get(name), name in ranged)

        whole = lent_options(self.spark, WHOLE_FILES) if ranged else nullcontext()
        with whole, ThreadPoolExecutor(max_workers=len(names)) as pool:
            counts = dict(zip(names, pool.map(put, names)))
        row = self.spark.range(1).select(
            F.lit(version).alias("version"),
            F.lit(folder).alias("folder"),
            F.lit((self._newest(layer)["seq"] or 0) + 1).cast("long").alias("seq"),
            F.lit(",".join(f"{n}={c}" for n, c in counts.items())).alias("rows"),
            as_ts(committed_at).alias("committed_at"),
        )
        row.write.mode("append").parquet(self._commits(layer))
        return Version(folder, counts)

    def read(self, layer: str, table: str, folder: str | None = None) -> DataFrame:
        """A table of the given or the current folder; typed and empty before any commit.

        A committed folder that lacks the table is an error.
        """
        schema = LAYERS[layer][table]
        folder = folder or self.current_folder(layer)
        if folder is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._folder(layer, folder, table))

    def read_layer(self, layer: str, folder: str | None = None) -> dict[str, DataFrame]:
        folder = folder or self.current_folder(layer)
        return {
            t: self.read(layer, t, folder) if folder else self.spark.createDataFrame([], LAYERS[layer][t])
            for t in LAYERS[layer]
        }

    def snapshot(self, target: str) -> dict[str, str]:
        """Copy the current version of every layer to another folder."""
        folders = {layer: self.current_folder(layer) for layer in LAYERS}
        taken = {layer: folder for layer, folder in folders.items() if folder is not None}
        jobs = [(layer, table) for layer in taken for table in LAYERS[layer]]

        def copy(job: tuple[str, str]) -> None:
            layer, table = job
            df = self.read(layer, table, taken[layer])
            df.write.mode("errorifexists").options(**STORED).parquet(f"{target}/{layer}/{table}")

        # A file of the copy holds the rows of one file, in their order.
        with lent_options(self.spark, WHOLE_FILES), ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(copy, jobs))
        return taken

    def restore(
        self, source: str, version: str, committed_at: str, sort_by: dict[str, dict[str, str]] | None = None
    ) -> dict[str, Version]:
        """Publish a snapshot of all layers as a new version of each, in the layers' order."""
        order = sort_by or {}

        def put(layer: str) -> Version:
            tables = {t: self.spark.read.schema(s).parquet(f"{source}/{layer}/{t}") for t, s in LAYERS[layer].items()}
            return self.publish(layer, version, tables, committed_at, order.get(layer), ranged=tuple(tables))

        with ThreadPoolExecutor(max_workers=len(LAYERS)) as pool:
            return dict(zip(LAYERS, pool.map(put, LAYERS)))
