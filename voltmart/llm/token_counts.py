"""Token counts per document of flat token files that have no index.

A shard is one stream of token ids in which an end-of-document id closes each document. It is kept
as consecutive blocks of a fixed number of ids, cut without regard to documents. A scan finds the
separators of every block at once; what is left open at a block's edge is stitched by a prefix
scan over the blocks' summaries, in two levels so that no shard's summaries meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltmart.llm.byte_bpe import coder
from voltmart.session import scratch_path

BLOCK = 1 << 17  # ids in a block
RUN = 1024  # blocks whose summaries are ordered by one task
BLOCKS = "shard long, block long, ids binary, doc_ids array<bigint>"


def write_token_shards(
    docs: DataFrame,
    folder: str,
    path: str,
    pattern: str,
    eod: int,
    dtype: str = "<u2",
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode texts into one shard per input partition below ``folder``, and read it back.

    A null or empty text is a separator alone. ``doc_ids`` names, in order, the documents whose
    separator lies in the block (null ids stay null). A task holds one batch of texts and one
    block. An empty table gives no blocks. Shards are numbered by partition, so a task that runs
    again writes the same shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, number = coder(path, pattern), TaskContext.get().partitionId(), 0
        pieces: list[np.ndarray] = []
        held, ends = 0, []  # ids held back; (position of the separator, doc_id)
        mark = np.array([eod], dtype)

        def flush(size: int):
            nonlocal pieces, held, ends, number
            stream = np.concatenate(pieces)
            mine = [i for at, i in ends if at < size]
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    pa.array([number], pa.int64()),
                    pa.array([stream[:size].tobytes()], pa.binary()),
                    pa.array([mine], pa.list_(pa.int64())),
                ],
                names=["shard", "block", "ids", "doc_ids"],
            )
            pieces, held, number = [stream[size:]], held - size, number + 1
            ends = [(at - size, i) for at, i in ends if at >= size]
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(bpe.encode(text.as_py() or ""), "<u4").astype(dtype)
                pieces += [ids, mark]
                held += len(ids) + 1
                ends.append((held - 1, doc_id))
                while held >= block:
                    yield flush(block)
        if held:
            yield flush(held)

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    narrow.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(BLOCKS).parquet(folder)


def read_token_files(spark: SparkSession, folder: str, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """Blocks of flat binary files; a shard per file, numbered by a hash of its path.

    One file is read by one task, as Spark's binary source gives whole files of up to 2 GB. A
    file's trailing bytes that make no whole id are an error.
    """
    size = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = content.as_py()
                if len(ids) % size:
                    raise ValueError(f"{len(ids)} bytes are no whole number of ids of {size} bytes")
                for number, at in enumerate(range(0, len(ids), block * size)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard], pa.int64()),
                            pa.array([number], pa.int64()),
                            pa.array([ids[at : at + block * size]], pa.binary()),
                            pa.array([None], pa.list_(pa.int64())),
                        ],
                        names=["shard", "block", "ids", "doc_ids"],
                    )

    files = spark.read.format("binaryFile").load(folder).select(F.xxhash64("path").alias("shard"), "content")
    return files.mapInArrow(run, BLOCKS)


def _summaries(blocks: DataFrame, eod: int, dtype: str) -> DataFrame:
    """Per block: ids, separators, ids before the first and after the last, lengths between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for shard, number, ids, names in zip(*batch.columns):
                stream = np.frombuffer(ids.as_py() or b"", dtype)
                ends = np.flatnonzero(stream == eod)
                inner = np.diff(ends) - 1
                out.append(
                    (
                        shard.as_py(), number.as_py(), len(stream), len(ends),
                        int(ends[0]) if len(ends) else len(stream),
                        int(len(stream) - 1 - ends[-1]) if len(ends) else len(stream),
                        inner.tolist(), names.as_py(),
                    )
                )
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in out], schema=schema
            )

    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [(n, pa.int64()) for n in ("shard", "block", "n_ids", "n_ends", "head", "tail")]
        + [("inner", longs), ("doc_ids", longs)]
    )
    spec = "shard long, block long, n_ids long, n_ends long, head long, tail long, inner array<bigint>, doc_ids array<bigint>"
    return blocks.select("shard", "block", "ids", "doc_ids").mapInArrow(run, spec)


def scan_token_blocks(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """shard, ordinal, doc_id, n_tokens, closed: one row per document, separators not counted.

    ``ordinal`` counts a shard's documents from 0. Ids after a shard's last separator are a last
    document with ``closed`` false. A null or empty block holds no ids. Blocks of a shard must
    have different numbers; order and gaps of the numbers do not matter otherwise.
    """
    s = _summaries(blocks, eod, dtype).withColumn("run", F.floor(F.col("block") / RUN))
    within = Window.partitionBy("shard", "run").orderBy("block")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("at", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .withColumn("first", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        # Where the ids after the last separator begin, from the start of the run.
        .withColumn("opened", F.when(F.col("n_ends") > 0, F.col("at") + F.col("n_ids") - F.col("tail")))
        .withColumn("open_at", F.max("opened").over(before))
        .withColumn("last", F.row_number().over(Window.partitionBy("shard", "run").orderBy(F.desc("block"))) == 1)
    )
    ends = s.where("last").select(
        "shard",
        "run",
        (F.col("at") + F.col("n_ids")).alias("run_ids"),
        (F.col("first") + F.col("n_ends")).alias("run_ends"),
        F.coalesce("opened", "open_at").alias("run_open"),
    )
    runs = Window.partitionBy("shard").orderBy("run")
    earlier = runs.rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        ends.withColumn("run_at", F.coalesce(F.sum("run_ids").over(earlier), F.lit(0)))
        .withColumn("run_first", F.coalesce(F.sum("run_ends").over(earlier), F.lit(0)))
        .withColumn("run_open_at", F.coalesce(F.max(F.col("run_at") + F.col("run_open")).over(earlier), F.lit(0)))
        .withColumn("run_last", F.lead("run").over(runs).isNull())
        .select("shard", "run", "run_at", "run_first", "run_open_at", "run_last")
    )
    s = s.join(ends, ["shard", "run"])
    start = F.col("run_at") + F.col("at")
    open_at = F.greatest(F.col("run_open_at"), F.coalesce(F.col("run_at") + F.col("open_at"), F.lit(0)))
    stitched = F.array(start + F.col("head") - open_at)
    tail = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(start + F.col("n_ids") - open_at)
    end = F.col("last") & F.col("run_last") & (tail > 0)
    none = F.array().cast("array<bigint>")
    lengths = F.concat(
        F.when(F.col("n_ends") > 0, F.concat(stitched, "inner")).otherwise(none),
        F.when(end, F.array(tail)).otherwise(none),
    )
    return s.select(
        "shard", (F.col("run_first") + F.col("first")).alias("base"), "n_ends", "doc_ids", F.posexplode(lengths).alias("k", "n_tokens")
    ).select(
        "shard",
        (F.col("base") + F.col("k")).alias("ordinal"),
        F.get("doc_ids", F.col("k")).alias("doc_id"),
        "n_tokens",
        (F.col("k") < F.col("n_ends")).alias("closed"),
    )


def token_counts(docs: DataFrame, path: str, pattern: str, eod: int, dtype: str = "<u2") -> DataFrame:
    """doc_id, shard, ordinal, n_tokens of every row, counted on token shards written for them.

    One row per input row; null and repeated ids are kept, null and empty texts have 0 tokens, an
    empty table gives an empty result, other columns are not read. Texts are encoded where they
    are read and never shuffled; only block summaries are.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    blocks = write_token_shards(docs, folder, path, pattern, eod, dtype)
    return scan_token_blocks(blocks, eod, dtype).select("doc_id", "shard", "ordinal", "n_tokens")
