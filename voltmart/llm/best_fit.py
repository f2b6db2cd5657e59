"""Best-fit packing of documents into sequences of fixed capacity.

A document is its token ids and one end id; only one longer than the capacity is cut, into full
pieces of which the first may be shorter. How pieces share sequences depends on their lengths
alone, so the packing is worked out on the histogram of lengths (at most ``capacity`` rows,
however large the corpus is) and each piece then looks up its place by its rank among the pieces
of its length:

* pieces above a third of the capacity meet at most twice in a sequence. They are matched
  greedily, the longest with the longest that still fits beside it, which needs fewest sequences;
* shorter pieces, longest first, go where the gap is the smallest that takes them, and open a new
  sequence only where no gap does.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.text import whole
from voltmart.session import cut_lineage

CAPACITY = 1024
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids binary"


# ----- token ids


def _byte_of_letter() -> dict[str, int]:
    """Byte by the letter that stands for it in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes for the letters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(printable))
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """Encoder of a byte-level BPE vocabulary in JSON form whose ids are its merge ranks.

    Gives the ids of the file's own library, its added tokens included, at several times the speed.
    """
    with open(path, encoding="utf-8") as lines:
        content = json.load(lines)
    added = {t["content"]: t["id"] for t in content["added_tokens"]}
    byte = _byte_of_letter()
    ranks = {bytes(byte[c] for c in w): i for w, i in content["model"]["vocab"].items() if w not in added}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)


def cuts(n: int, capacity: int) -> list[int]:
    """Starts of a document's pieces, and its end: all pieces are full but the first."""
    first = (n - 1) % capacity + 1
    return [0, *range(first, n + 1, capacity)]


def tokenized(
    docs: DataFrame,
    path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece.

    Null and empty texts are one piece that holds the end id alone. Null and repeated ids are kept row
    by row; an empty table gives no piece; other columns are not read. Whole texts are encoded.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode.encode(text.as_py(), allowed_special="all"), end_id], "<u4")
                at = cuts(len(ids), capacity)
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    rows.append((doc_id, k, a, b - a, ids[a:b].tobytes()))
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return source.mapInArrow(run, PIECES)


# ----- the plan over the histogram


class Run(NamedTuple):
    """Pieces ``first .. first + count - 1`` of a length: ``per`` in each sequence from ``sequence`` on."""

    length: int
    first: int
    count: int
    per: int
    sequence: int
    offset: int


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs of pieces by (length, first), the whole packing of a histogram {length: pieces}.

    Sequences of equal content stay together as one range of numbers and are cut only where a
    length runs out, so there are at most a few ranges per length, and a range takes at most
    ``sqrt(2 * capacity)`` different lengths: the plan's size depends on the capacity only.
    """
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = {n: c for n, c in histogram.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> [(first sequence, sequences)]
    runs: list[Run] = []
    opened = 0

    def put(length: int, count: int, per: int, sequence: int, offset: int) -> None:
        runs.append(Run(length, used[length], count, per, sequence, offset))
        used[length] += count
        left[length] -= count

    # Above a third: the longest with the longest that fits, many pairs of equal lengths at a time.
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((n for n in large if n <= min(a, capacity - a) and left[n] and (n < a or left[a] > 1)), None)
            if b is None:
                pairs, taken = left[a], a
                put(a, pairs, 1, opened, 0)
            elif b == a:
                pairs, taken = left[a] // 2, 2 * a
                put(a, 2 * pairs, 2, opened, 0)
            else:
                pairs, taken = min(left[a], left[b]), a + b
                put(a, pairs, 1, opened, 0)
                put(b, pairs, 1, opened, a)
            gaps[capacity - taken].append((opened, pairs))
            opened += pairs

    # The others: each goes to the smallest gap, which then takes as many of them as it holds.
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity) if gaps[g]), capacity)
            per = gap // n
            if gap == capacity:
                need = -(-left[n] // per)
                first, size = opened, need
                opened += need
            else:
                first, size = gaps[gap].pop()
            full = min(size, left[n] // per)
            if full:
                put(n, full * per, per, first, capacity - gap)
                gaps[gap - per * n].append((first, full))
            if full < size:
                rest = left[n]
                if rest:
                    put(n, rest, rest, first + full, capacity - gap)
                    gaps[gap - rest * n].append((first + full, 1))
                    full += 1
                if full < size:
                    gaps[gap].append((first + full, size - full))
    return sorted(runs)


# ----- places of all pieces


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and the place of each row among the task's rows of its length."""
    task, seen = TaskContext.get().partitionId(), np.zeros(0, np.int64)
    for batch in batches:
        lengths = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(lengths):
            continue
        if lengths.max() >= len(seen):
            seen = np.concatenate([seen, np.zeros(lengths.max() + 1 - len(seen), np.int64)])
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        sizes = np.diff(np.r_[starts, len(ordered)])
        nth = np.empty(len(lengths), np.int64)
        nth[order] = np.arange(len(ordered)) - np.repeat(starts, sizes) + seen[ordered]
        seen[ordered[starts]] += sizes
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(nth), task, np.int32)), pa.array(nth)], names=["item", "length", "task", "nth"]
        )


def best_fit(items: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """The rows of ``items`` with sequence_id and offset; one place per row, no gap in a sequence.

    ``length`` must be from 1 to ``capacity`` in every row, else an error is raised. Equal lengths take
    places in the order in which tasks meet them. Repeated rows are packed row by row, an empty
    table gives an empty result. The driver sees one row per length; ranks are a running count in
    each task and the counts of the tasks before it, so no length gathers in one task.
    """
    spark = items.sparkSession
    whole_row = items.select(F.struct("*").alias("item"), F.col(length).cast("long").alias("length"))
    fields = f"item {whole_row.schema['item'].dataType.simpleString()}, length long, task int, nth long"
    # Kept, as places depend on how the rows were dealt to tasks.
    rows = cut_lineage(whole_row.mapInArrow(_numbered, fields))
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_sequences(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    by_length: dict[int, list[Run]] = defaultdict(list)
    for r in runs:
        by_length[r.length].append(r)
    plan = spark.sparkContext.broadcast({n: np.array(rs, np.int64) for n, rs in by_length.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            ranks = batch.column(2).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                table = plan.value[int(n)]
                run = table[np.searchsorted(table[:, 1], ranks[at], "right") - 1]
                k = ranks[at] - run[:, 1]
                sequence[at] = run[:, 4] + k // run[:, 3]
                offset[at] = run[:, 5] + k % run[:, 3] * n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], names=["item", "sequence_id", "offset"])

    ranked = rows.join(before, ["task", "length"]).select("item", "length", (F.col("before") + F.col("nth")).alias("rank"))
    out = f"item {whole_row.schema['item'].dataType.simpleString()}, sequence_id long, offset long"
    return ranked.mapInArrow(place, out).select("item.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Places of all pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Nulls, repeats and empty tables as in ``tokenized`` and ``best_fit``.
    """
    pieces = tokenized(docs, path, pattern, capacity, end_id)
    return best_fit(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


def sequences(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids and the spans of their pieces.

    A sequence has at most ``capacity`` ids, so a group is small whatever the corpus holds.
    """
    placed = best_fit(tokenized(docs, path, pattern, capacity, end_id), capacity)
    part = F.struct("offset", "length", "doc_id", "piece", "start", "ids")
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return parts.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("spans"),
    )
