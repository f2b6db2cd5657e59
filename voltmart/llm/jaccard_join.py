"""Jaccard join on word n-grams with Bayesian pruning of candidates.

Texts with the same set of shingles form a class and are represented by one of them. MinHash
values of the representatives are banded; representatives that share a band are candidates, and
connected candidates form a pool. Inside a pool, pairs are compared value by value: after each
stretch of MinHash values a pair is dropped when the posterior probability (uniform prior) that
its similarity reaches the threshold is below a tolerance. The pairs left are verified on the
whole shingle sets. Counts and a spanning forest of the links leave a task, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.components import components, smallest_reachable
from voltmart.llm.hashing import WordHashes, window_hashes
from voltmart.llm.text import whole
from voltmart.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
VALUES, BANDS = 128, 32  # a pair at 0.8 shares no band with probability 5e-8
STEPS = (16, 32, 64, 128)  # MinHash values after which pairs are judged
TOLERANCE = 1e-9
CHUNK = 1024  # representatives on each side of a comparison

_WORDS = WordHashes()
_SEEDS = np.random.RandomState(7).randint(1, 2**32, (2, VALUES), dtype=np.uint64).astype(np.uint32)


def shingles(text: str, length: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles; fewer words than ``length`` are one shingle."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < length:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(window_hashes(_WORDS.of(words), length))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, one row each."""
    if not sets:
        return np.zeros((0, VALUES), np.uint32)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), VALUES), np.uint32)
    for k in range(VALUES):
        x = (flat ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint32(1))
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(x, begin)
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each step n: the fewest matches m with P(J >= threshold | m of n) >= tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and its upper tail at t is the
    probability of at most m successes in n + 1 trials of chance t.
    """
    out = {}
    for n in STEPS:
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
        else:
            out[n] = n
    return out


def _profiles(docs: DataFrame) -> DataFrame:
    """doc_id, cls, n, keys of rows with words and an id: class digest, set size, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            keep = [k for k, s in enumerate(sets) if len(s)]
            sets = [sets[k] for k in keep]
            sig = signatures(sets)
            width = VALUES // BANDS
            keys = np.empty((len(sets), BANDS), np.uint64)
            for b in range(BANDS):
                keys[:, b] = window_hashes_rows(sig[:, b * width : (b + 1) * width], b)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                ],
                names=["doc_id", "cls", "n", "keys"],
            )

    return docs.mapInArrow(run, "doc_id long, cls binary, n int, keys array<bigint>")


def window_hashes_rows(values: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit hash per row of values."""
    h = np.full(len(values), salt + 1, np.uint64)
    for k in range(values.shape[1]):
        h = (h ^ values[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _survivors(sig_a, sig_b, n_a, n_b, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that incremental comparison and the set sizes leave."""
    need = least_matches(threshold)
    left, right = [], []
    for at in range(0, len(sig_a), 128):
        a = sig_a[at : at + 128]
        ok = (np.minimum.outer(n_a[at : at + 128], n_b) >= threshold * np.maximum.outer(n_a[at : at + 128], n_b) - 1e-9)
        if same:
            ok &= np.arange(at, at + len(a))[:, None] < np.arange(len(sig_b))[None, :]
        p, q = np.nonzero(ok)
        met, done = np.zeros(len(p), np.int16), 0
        for step in STEPS:
            for k in range(done, step):
                met += a[p, k] == sig_b[q, k]
            keep = met >= need[step]
            p, q, met, done = p[keep], q[keep], met[keep], step
            if not len(p):
                break
        left.append(p + at)
        right.append(q)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _overlaps(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of sets[p] and sets[q]."""
    used, place = np.unique(np.concatenate([p, q]), return_inverse=True)
    p, q = place[: len(p)], place[len(p) :]
    mine = [sets[k] for k in used]
    if len(p) < 4 * len(used):
        return np.array([len(np.intersect1d(mine[i], mine[j], assume_unique=True)) for i, j in zip(p, q)], np.int64)
    flat = np.concatenate(mine)
    row = np.repeat(np.arange(len(mine)), [len(s) for s in mine])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # what only one set has meets nothing
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros(len(p), np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width, top = 4096, int(column[-1]) + 1 if len(column) else 0
    for c in range(0, top, width):
        i, j = np.searchsorted(column, [c, c + width])
        x = np.zeros((len(mine), min(width, top - c)), np.float32)
        x[row[i:j], column[i:j] - c] = 1
        out += (x @ x.T)[p, q].astype(np.int64)
    return out


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side = table["g"].to_numpy()
        ids, times = table["rep"].to_numpy(), table["times"].to_numpy()
        # Rows repeated in the input come again here; one of each stands.
        _, once = np.unique(np.array([f"{i}/{c.as_py().hex()}/{g}" for i, c, g in zip(ids, table["cls"], side)]), return_index=True)
        table, side, ids, times = table.take(pa.array(once)), side[once], ids[once], times[once]
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table["shingles"]]
        n = np.array([len(s) for s in sets])
        sig = signatures(sets)
        a = np.flatnonzero(side == side.min())
        b = np.flatnonzero(side == side.max())
        same = side.min() == side.max()
        if same and table["o"][0].as_py() != side[0]:  # the other chunk has no rows
            a = b = np.zeros(0, int)
        p, q = _survivors(sig[a], sig[b], n[a], n[b], same, threshold)
        p, q = a[p], b[q]
        if len(p):
            both = _overlaps(sets, p, q)
            linked = both / (n[p] + n[q] - both) >= threshold
            p, q = p[linked], q[linked]
        counts = np.zeros(len(ids), np.int64)
        np.add.at(counts, p, times[q])
        np.add.at(counts, q, times[p])
        names, place = np.unique(ids, return_inverse=True)
        label = smallest_reachable(names, place[p], place[q])
        used = np.flatnonzero(counts)
        return pa.table({"rep": ids[used], "cls": table["cls"].take(pa.array(used)), "links": counts[used], "root": label[place[used]]})

    return run


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, copy_of, kept; one row per input row.

    Two documents are linked when the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``. ``class_id`` is the smallest doc_id reachable over links, ``n_links`` the
    number of other rows linked, ``copy_of`` the smallest id with the same shingle set. A text of
    one to four words is a single shingle; null, empty and blank texts link with nothing, and so
    do rows with a null id (class null, kept). Rows repeated under one id count as copies; texts
    that differ under one id are versions of one document. An empty table gives an empty result;
    other columns are not read.

    A task compares two chunks of at most about CHUNK representatives. In a pool of more, chunks
    hold one range of set sizes and meet only chunks whose sizes allow the similarity. Comparing
    is quadratic in a pool, memory and rows are not. A pair exactly at 0.8 shares no band with
    probability 5e-8.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    profiles = cut_lineage(_profiles(texts.where("doc_id IS NOT NULL")))
    classes = cut_lineage(
        profiles.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("times"), F.first("n").alias("n"), F.first("keys").alias("keys")
        )
    )
    bands = classes.select("rep", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("most")).where("first < most").drop("most")
    near = bands.join(shared, "key").where("rep <> first").select("rep", "first").distinct()
    pools = components(near, "rep", "first").select(F.col("node").alias("rep"), F.col("root").alias("pool"))
    members = cut_lineage(
        classes.drop("keys").join(pools, "rep").withColumn("band", F.floor(F.log("n") / math.log(1 / threshold) + 1e-9).cast("int"))
    )
    # Small pools are one chunk; larger ones are cut by set size first.
    order = Window.partitionBy("pool").orderBy("band")
    sizes = members.groupBy("pool", "band").agg(F.count("*").alias("c"))
    total = sizes.groupBy("pool").agg(F.sum("c").alias("all"))
    sizes = (
        sizes.join(total, "pool")
        .withColumn("k", F.when(F.col("all") <= CHUNK, 1).otherwise(F.ceil(F.col("c") / CHUNK)))
        .withColumn("base", F.when(F.col("all") <= CHUNK, 0).otherwise(F.sum("k").over(order) - F.col("k")))
        .withColumn("prior", F.when(F.lag("band").over(order) >= F.col("band") - 1, F.lag("k").over(order)).otherwise(0))
        .withColumn("later", F.when(F.lead("band").over(order) <= F.col("band") + 1, F.lead("k").over(order)).otherwise(0))
    )
    small = F.col("all") <= CHUNK
    sizes = sizes.select(
        "pool", "band", "k", "base",
        F.when(small, 0).otherwise(F.col("base") - F.col("prior")).alias("low"),
        F.when(small, 0).otherwise(F.col("base") + F.col("k") + F.col("later") - 1).alias("high"),
    )
    units = members.join(sizes, ["pool", "band"]).select(
        "rep", "cls", "times", "pool", (F.col("base") + F.pmod(F.xxhash64("rep"), "k")).cast("long").alias("g"),
        F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"),
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(0)]
            ok = [k for k, (s, c) in enumerate(zip(found, batch.column(1))) if xxhash.xxh3_128_digest(s.tobytes()) == c.as_py()]
            rest = batch.take(pa.array(ok, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns[1:], pa.array([found[k].tobytes() for k in ok], pa.binary())], names=[*rest.schema.names[1:], "shingles"]
            )

    wide = (
        texts.join(units, texts["doc_id"] == units["rep"])
        .select("text", "cls", "rep", "times", "pool", "g", "low", "high")
        .mapInArrow(sets, "cls binary, rep long, times long, pool long, g long, low long, high long, shingles binary")
    )
    pairs = wide.select(
        "cls", "rep", "times", "pool", "g", F.explode(F.sequence("low", "high")).alias("o"), "shingles"
    ).withColumns({"x": F.least("g", "o"), "y": F.greatest("g", "o")})
    found = cut_lineage(
        pairs.groupBy("pool", "x", "y").applyInArrow(_compare(threshold), "rep long, cls binary, links long, root long")
    )
    roots = components(found, "rep", "root").select(F.col("node").alias("rep"), "root")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    verdict = classes.select("cls", "rep", "times").join(links, "cls", "left").join(roots, "rep", "left").select(
        "cls",
        F.col("rep").alias("copy_of"),
        F.coalesce("root", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
    )
    rows = profiles.select("doc_id", "cls").join(verdict, "cls").select("doc_id", "class_id", "n_links", "copy_of")
    blank = texts.where(F.col("doc_id").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("copy_of")
    )
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id"))
    return rows.union(blank).withColumn("kept", kept)


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, all columns as they were.

    Of rows repeated under one id the first by text stays, null and blank texts last. Rows with a
    null id all stay.
    """
    gone = (
        jaccard_join(docs, threshold, id_col, text_col)
        .where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    )
    packed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    left = packed.where("doc_id IS NOT NULL").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(blank, "text"))
    left = left.withColumn("first", first).where("first = 1").select("row.*")
    return left.union(docs.where(F.col(id_col).isNull()))
