"""Packing by length: optimal buckets from the global histogram, token-budget batches in each.

The histogram of lengths is counted over all rows. Dynamic programming over it chooses at most
``buckets`` upper bounds so that padding every row to its bound costs the fewest tokens. Inside a
bucket rows are numbered without a gap and cut into batches of as many padded rows as the token
budget holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.text import words
from voltmart.session import cut_lineage

BUCKETS = 16
BUDGET = 65_536
EXACT = 8192  # lengths up to here are bounds of their own
GROUP = 2_000  # rows that one task numbers together, at least
CELLS = 1_000_000  # and so many groups at most


def length_in_words(text: Column) -> Column:
    """Words and the end of the document."""
    return F.size(words(text)).cast("long") + 1


def _grid(n: Column) -> Column:
    """The length itself up to EXACT; above, rounded up to 4096 steps of each power of two.

    This bounds the histogram (8192 bins and 4096 more for each doubling) at a resolution finer
    than 0.03 %.
    """
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n - 1, F.lit(1)))) - 12).cast("long")
    return F.when(n <= EXACT, n).otherwise(F.ceil(n / step) * step).cast("long")


def best_bounds(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds that need least padding; histogram rows are (bound, rows, sum of lengths).

    With ``C`` and ``S`` the running rows and lengths, a bucket over bins i+1..j costs
    ``b[j] * (C[j] - C[i]) - (S[j] - S[i])``. For fixed ``i`` this is a line in ``b[j]``, so each
    layer of the program is a lower hull of lines met in order. Ties go to the fewer buckets,
    then to the smaller bounds.
    """
    bins = sorted(histogram)
    n = len(bins)
    if n <= buckets:
        return [b for b, _, _ in bins]
    rows, total = [0], [0]
    for _, c, s in bins:
        rows.append(rows[-1] + c)
        total.append(total[-1] + s)
    cost: list[int | None] = [0] + [None] * n
    best, back = None, []
    for _ in range(buckets):
        new: list[int | None] = [None] * (n + 1)
        cut = [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # slope, height, i
        head = 0
        for j in range(1, n + 1):
            i = j - 1
            if cost[i] is not None:
                slope, height = -rows[i], cost[i] + total[i]
                while len(hull) - head >= 2:
                    (s1, h1, _), (s2, h2, _) = hull[-2], hull[-1]
                    if (height - h1) * (s1 - s2) <= (h2 - h1) * (s1 - slope):
                        hull.pop()
                    else:
                        break
                hull.append((slope, height, i))
            if len(hull) <= head:
                continue
            b = bins[j - 1][0]
            while len(hull) - head >= 2 and hull[head + 1][0] * b + hull[head + 1][1] < hull[head][0] * b + hull[head][1]:
                head += 1
            slope, height, i = hull[head]
            new[j] = slope * b + height + b * rows[j] - total[j]
            cut[j] = i
        back.append(cut)
        cost = new
        if cost[n] is not None and (best is None or cost[n] < best[0]):
            best = (cost[n], len(back))
    bounds, j = [], n
    for layer in range(best[1] - 1, -1, -1):
        bounds.append(bins[j - 1][0])
        j = back[layer][j]
    return bounds[::-1]


def pack(
    docs: DataFrame,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    length: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, bucket_len, batch, position, padding; one row per input row.

    ``length`` is the rows' length (default: words and an end); a null or negative one counts as
    0, so null and empty texts have length 1 by default. A batch holds budget / bucket_len rows
    and is numbered within its bucket; a row longer than the budget is a batch of its own, whole.
    Equal lengths are ordered by hash and id, repeated and null ids are packed row by row, an
    empty table gives an empty result, other columns are not read.

    Only the histogram reaches the driver (its size is bounded, see ``_grid``). Ranks come from
    row numbers inside groups of about GROUP rows of one length plus the groups' running offsets,
    so a length or bucket with most rows is spread over tasks.
    """
    spark = docs.sparkSession
    n = F.greatest(F.coalesce(length_in_words(F.col(text_col)) if length is None else length, F.lit(0)), F.lit(0))
    # Lengths are counted once and kept: the numbering below must see the rows of the histogram.
    rows = cut_lineage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), n.cast("long").alias("n_tokens"))
        .withColumn("bound", _grid(F.col("n_tokens")))
        .withColumn("pick", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    )
    histogram = [
        tuple(r) for r in rows.groupBy("bound").agg(F.count("*"), F.sum("n_tokens")).collect()
    ]
    bounds = best_bounds(histogram, buckets)
    group = max(GROUP, sum(c for _, c, _ in histogram) // CELLS)
    plan, k = [], 0
    for bound, count, _ in sorted(histogram):
        while bounds[k] < bound:
            k += 1
        plan.append((bound, bounds[k], max(1, budget // max(1, bounds[k])), -(-count // group)))
    # As many rows as the histogram has bins.
    plan = spark.createDataFrame(plan, "bound long, bucket_len long, per_batch long, parts long")
    cell = ["bucket_len", "bound", "part"]
    rows = rows.join(F.broadcast(plan), "bound").withColumn("part", F.pmod("pick", "parts"))
    before = Window.partitionBy("bucket_len").orderBy("bound", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*cell).agg(F.count("*").alias("n"))
        .select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*cell).orderBy("pick", "doc_id")) - 1
    return rows.join(offsets, cell).select(
        "doc_id",
        "n_tokens",
        "bucket_len",
        F.floor(rank / F.col("per_batch")).alias("batch"),
        F.pmod(rank, F.col("per_batch")).alias("position"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
