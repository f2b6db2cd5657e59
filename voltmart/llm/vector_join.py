"""Near-duplicate vectors by an exact metric range join.

A cosine bound c is an angle a between unit vectors, and angles obey the triangle inequality. Pivots
partition the vectors: each belongs to the cell of its nearest pivot. A vector x of the cell of p is
copied to the cell of q only if some y there can lie within a:

- y is not nearer to p than to q, so x may lie at most a beyond the bisector of p and q:
  x (p - q) / |p - q| <= sin a;
- the angle of y and q is at most the cell's covering radius, so that of x and q at most a more.

Links are symmetric, so of two cells one sends its vectors and the other one receives them. Cells are
cut into blocks of bounded size and joined independently; within a block, vectors meet only those
whose angle to a common reference differs by at most a. A block yields counts and a spanning
forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.components import components, smallest_reachable
from voltmart.session import cut_lineage

BLOCK = 8192  # vectors on each side of a task's comparison
SAMPLE = 4096  # vectors of a length among which pivots are chosen
PIVOTS = 2048  # pivots of a length at most
CELL = 4096  # vectors a cell should have
MARGIN = 1e-6  # radians by which every bound is widened against rounding
PRODUCTS = 1 << 22  # cosines worked out at a time
HELD = 1 << 21  # links held before they are contracted to a forest
HOME, OTHER, VISITOR = 1, 2, 4  # parts a row plays in a block, as bits


def _unit(packed: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors of one length; scaled by the largest component first, so no square over- or underflows."""
    x = np.frombuffer(b"".join(packed.to_pylist()), kind).reshape(len(packed), -1).astype(np.float64)
    x = x / np.abs(x).max(1, initial=0)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def pack_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(vec_id, v, size): components as bytes, null where the vector cannot be compared."""
    item = vectors.schema[vec_col].dataType.elementType.typeName()
    kind = "<f4" if item == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # null components become nan
            ends = lists.offsets.to_numpy()
            out = []
            for k, valid in enumerate(lists.is_valid().to_pylist()):
                x = flat[ends[k] : ends[k + 1]]
                out.append(x.tobytes() if valid and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    array = F.col(vec_col).cast("array<float>" if item == "float" else "array<double>")
    packed = vectors.select(F.col(id_col).cast("long").alias("vec_id"), array.alias("e")).mapInArrow(run, "vec_id long, v binary")
    return packed.withColumn("size", F.length("v")), kind


def _pivots(vectors: DataFrame, kind: str, wanted: int) -> np.ndarray:
    """Farthest-first choice among a hash sample; ``wanted`` rows at most."""
    sample = vectors.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).collect()
    x = _unit(pa.array([bytes(r["v"]) for r in sample], pa.binary()), kind)
    chosen = [0]
    far = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(wanted, len(x)):
        k = int(far.argmax())
        if far[k] <= 0:
            break
        chosen.append(k)
        far = np.minimum(far, ((x - x[k]) ** 2).sum(1))
    return x[chosen]


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


class Cells:
    """Pivots of each length that has many vectors; the vectors of any other length are one cell."""

    def __init__(self, kind: str, angle: float):
        self.kind, self.angle = kind, angle
        self.pivots: dict[int, np.ndarray] = {}
        self.gaps: dict[int, np.ndarray] = {}
        self.cover: dict[int, np.ndarray] = {}

    def add(self, size: int, pivots: np.ndarray) -> None:
        if len(pivots) > 1:
            self.pivots[size] = pivots
            self.gaps[size] = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 1e-24))
            self.cover[size] = np.zeros(len(pivots))

    def pieces(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """(length, positions, cosines to its pivots) of a batch (vec_id, v, times, size), some rows at a time."""
        lengths = batch.column(3).to_numpy()
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            pivots = self.pivots.get(int(size))
            if pivots is None:
                yield int(size), at, None
                continue
            for k in range(0, len(at), 1024):
                some = at[k : k + 1024]
                yield int(size), some, _unit(batch.column(1).take(pa.array(some)), self.kind) @ pivots.T

    def nearest(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """size, cell, angle: the widest angle of a cell in these rows."""
        for batch in batches:
            for size, at, cos in self.pieces(batch):
                if cos is not None:
                    near = cos.argmax(1)
                    wide = np.full(cos.shape[1], -1.0)
                    np.maximum.at(wide, near, _angle(cos[np.arange(len(at)), near]))
                    cell = np.flatnonzero(wide >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cell), size)), pa.array(cell), pa.array(wide[cell])], names=["size", "cell", "angle"]
                    )

    def reach(self, size: int, cos: np.ndarray | None, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and whether the cell is its own, for every cell in which a row of a piece stands."""
        if cos is None:
            return np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
        near = cos.argmax(1)
        q = np.arange(cos.shape[1])
        own = near[:, None] == q
        # Of two cells the lower one sends if their sum is even, the higher one if it is odd.
        sent = (near[:, None] < q) == ((near[:, None] + q) % 2 == 0)
        if self.angle < math.pi / 2:
            beyond = (cos[np.arange(n), near][:, None] - cos) / self.gaps[size][near]
            sent &= beyond <= math.sin(self.angle) + MARGIN
        sent &= _angle(cos) <= self.cover[size] + self.angle + MARGIN
        row, cell = np.nonzero(own | sent)
        return row, cell, near[row] == cell

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """size, cell, owned, present: rows that a cell owns, and all that stand in it."""
        for batch in batches:
            for size, at, cos in self.pieces(batch):
                _, cell, own = self.reach(size, cos, len(at))
                present = np.bincount(cell)
                owned = np.bincount(cell[own], minlength=len(present))
                used = np.flatnonzero(present)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), size)), pa.array(used), pa.array(owned[used]), pa.array(present[used])],
                    names=["size", "cell", "owned", "present"],
                )

    def deal(self, batches: Iterator[pa.RecordBatch], cuts: dict[tuple[int, int], tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        """One row per block in which a vector stands.

        ``cuts`` gives the numbers of home and of other blocks where a cell has more than one. Own
        vectors stand on both sides, visitors on the other side only.
        """
        for batch in batches:
            pick = _mixed(batch.column(0).to_numpy())
            for size, at, cos in self.pieces(batch):
                row, cell, own = self.reach(size, cos, len(at))
                names, which = np.unique(cell, return_inverse=True)
                cut = np.array([cuts.get((size, int(c)), (1, 1)) for c in names]).reshape(-1, 2)[which]
                mark = pick[at[row]]
                i, j = (mark % cut[:, 0].astype(np.uint64)).astype(np.int64), (mark % cut[:, 1].astype(np.uint64)).astype(np.int64)
                # A home row goes to every other block of its home block, an other row to every home block.
                homes = np.repeat(np.flatnonzero(own), cut[own, 1])
                across = _running(cut[own, 1])
                others = np.repeat(np.arange(len(row)), cut[:, 0])
                down = _running(cut[:, 0])
                extra = ~own[others] | (down != i[others])  # else it is there as a home row that is an other row too
                others, down = others[extra], down[extra]
                at_all = np.concatenate([homes, others])
                columns = [
                    np.full(len(at_all), size),
                    cell[at_all],
                    np.concatenate([i[homes], down]),
                    np.concatenate([across, j[others]]),
                    np.concatenate([np.where(across == j[homes], HOME | OTHER, HOME), np.where(own[others], OTHER, VISITOR)]),
                ]
                step = max(256, (1 << 24) // size)
                for k in range(0, len(at_all), step):
                    place = pa.array(at[row[at_all[k : k + step]]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(place) for c in range(3)] + [pa.array(c[k : k + step]) for c in columns],
                        names=["vec_id", "v", "times", "size", "cell", "i", "j", "part"],
                    )


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(16)


def _running(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for every n."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _compare(threshold: float, kind: str):
    angle = math.acos(max(-1.0, min(1.0, threshold)))

    def run(table: pa.Table) -> pa.Table:
        ids, times = table["vec_id"].to_numpy(), table["times"].to_numpy()
        part = table["part"].to_numpy()
        x = _unit(table["v"].combine_chunks(), kind)
        home, others = np.flatnonzero(part & HOME), np.flatnonzero(part & (OTHER | VISITOR))
        counts = np.zeros(len(ids), np.int64)
        # Links as positions; a vector stands once in a block, whatever its parts.
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(home) and len(others):
            turn = _angle(x @ x[home[0]])
            home, others = home[np.argsort(turn[home])], others[np.argsort(turn[others])]
            near, far = turn[home], turn[others]
            narrow = x.astype(np.float32)
            rest = np.ascontiguousarray(narrow[others])
            slack = max(1e-5, x.shape[1] * 2.0**-22)  # single precision decides outside this margin, double precision inside
            rows = max(1, PRODUCTS // len(others))
            for at in range(0, len(home), rows):
                some = home[at : at + rows]
                lo, hi = np.searchsorted(far, [near[at] - angle - MARGIN, near[min(at + rows, len(home)) - 1] + angle + MARGIN])
                if lo == hi:
                    continue
                cos = narrow[some] @ rest[lo:hi].T
                hit = np.flatnonzero(cos >= threshold - slack)
                p, q = some[hit // (hi - lo)], others[lo + hit % (hi - lo)]
                linked = ids[p] != ids[q]
                doubt = np.flatnonzero(linked & (cos.ravel()[hit] < threshold + slack))
                for k in range(0, len(doubt), 65_536):
                    some_pairs = doubt[k : k + 65_536]
                    linked[some_pairs] = np.einsum("ij,ij->i", x[p[some_pairs]], x[q[some_pairs]]) >= threshold
                p, q = p[linked], q[linked]
                counts += np.bincount(p, times[q], len(ids)).astype(np.int64)
                # The sender's block is not compared elsewhere, so a visitor's links are counted here.
                guest = (part[q] & VISITOR) > 0
                counts += np.bincount(q[guest], times[p[guest]], len(ids)).astype(np.int64)
                a.append(p)
                b.append(q)
                if sum(map(len, a)) > HELD:
                    root = smallest_reachable(np.arange(len(ids)), np.concatenate(a), np.concatenate(b))
                    moved = np.flatnonzero(root != np.arange(len(ids)))
                    a, b = [moved], [root[moved]]
        names, place = np.unique(ids, return_inverse=True)
        root = smallest_reachable(names, place[np.concatenate(a)], place[np.concatenate(b)])
        counted, moved = np.flatnonzero(counts), np.flatnonzero(root != names)
        n = len(counted)
        return pa.table(
            {
                "vec_id": np.concatenate([ids[counted], names[moved]]),
                "links": np.concatenate([counts[counted], np.zeros(len(moved), np.int64)]),
                "root": pa.array(np.concatenate([np.zeros(n, np.int64), root[moved]]), mask=np.arange(n + len(moved)) < n),
            }
        )

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per distinct (vec_id, vector), all others linked by cosine >= threshold.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    as do vectors of different length. Components may be as large or small as a double allows. A
    null vec_id keeps its row, links with nothing and is its own component (null, kept). Rows
    repeated under one vec_id are one vector. Equal vectors are compared once, with their number as
    a weight. An empty table gives an empty result. Different vectors under one vec_id keep a row
    each and do not link with each other; other columns are not read.

    A task holds 2 x ``block`` vectors, fewer if they are long. The driver holds pivots (2,048 at most for
    each length with more than ``cell`` vectors) and the numbers of blocks of cells with several. Work is
    quadratic where vectors really lie that close, and where the dimension leaves pivots no power
    to separate; memory and output are not.
    """
    packed, kind = pack_vectors(vectors, id_col, vec_col)
    rows = cut_lineage(packed.distinct())
    usable = rows.where("v IS NOT NULL AND vec_id IS NOT NULL")
    # Equal vectors: the smallest id stands for all of them.
    unique = cut_lineage(usable.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("times"), F.first("size").alias("size")))
    own = unique.select("vec_id", "v", "times", F.col("size").cast("long").alias("size"))
    cells = Cells(kind, math.acos(max(-1.0, min(1.0, threshold))))
    for size, n in own.groupBy("size").count().where(F.col("count") > cell).collect():
        cells.add(size, _pivots(own.where(F.col("size") == size), kind, min(PIVOTS, -(-n // cell))))
    if cells.pivots:
        widest = own.mapInArrow(cells.nearest, "size long, cell long, angle double").groupBy("size", "cell").agg(F.max("angle").alias("angle"))
        for r in widest.collect():
            cells.cover[r["size"]][r["cell"]] = r["angle"]
    # 64 MB of unit vectors on a side of a block at most.
    limit = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit((1 << 23) * int(kind[2])) / F.col("size"))))
    heavy = (
        own.mapInArrow(cells.count, "size long, cell long, owned long, present long")
        .groupBy("size", "cell")
        .agg(F.sum("owned").alias("owned"), F.sum("present").alias("present"))
        .select("size", "cell", F.greatest(F.lit(1), F.ceil(F.col("owned") / limit)).alias("rows"), F.ceil(F.col("present") / limit).alias("cols"))
        .where("cols > 1")
        .collect()
    )
    cuts = {(r["size"], r["cell"]): (int(r["rows"]), int(r["cols"])) for r in heavy}
    dealt = own.mapInArrow(
        lambda batches: cells.deal(batches, cuts),
        "vec_id long, v binary, times long, size long, cell long, i long, j long, part long",
    )
    found = cut_lineage(
        dealt.groupBy("size", "cell", "i", "j").applyInArrow(_compare(threshold, kind), "vec_id long, links long, root long")
    )
    out = rows.select("vec_id", "v")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = components(found.where("root IS NOT NULL"), "vec_id", "root").withColumnRenamed("node", "vec_id")
    classes = (
        unique.join(links, "vec_id", "left").join(roots, "vec_id", "left")
        .select("v", F.col("vec_id").alias("rep"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("root", "vec_id").alias("root"))
    )
    result = out.join(classes, "v", "left")
    lone = F.col("vec_id").isNull()
    return result.select(
        "vec_id",
        F.when(lone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.coalesce("root", "vec_id")).alias("component_id"),
        (lone | (F.coalesce("root", "vec_id") == F.col("vec_id"))).alias("kept"),
    )
