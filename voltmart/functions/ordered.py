"""Order-dependent computation per key without sorting a whole key in one task.

A key such as a circuit or a counter series may hold a third of all rows, and one second of it very
many. Its rows are cut into buckets of the whole sort key (time, then tie): windows run inside
``(key, bucket)``, and only one summary row per bucket is ordered per key and handed on as a carry.
Sums, last values and open runs combine from bucket to bucket, so gauges, counter resets, failure
runs and alert episodes all work this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.functions.time import floor_to

BUCKET = "_bucket"
CUT = "_cut"
PLACE = [BUCKET, CUT]
MAX_BUCKET_ROWS = 2_000_000
# A list of heavy buckets up to this long is broadcast; a longer one is joined as the planner sees fit.
BROADCAST_ROWS = 10_000
MAX_CUTS = 1_000


def sure(value: Column, otherwise) -> Column:
    """A column the planner knows to be filled.

    The bucket summaries are joined back to the rows they came from. Join keys that may be
    NULL make the planner add filters to one branch only, and then the two branches no longer
    share their shuffle.
    """
    return F.coalesce(value, F.lit(otherwise))


def filled_labels(df: DataFrame, labels: list[str]) -> DataFrame:
    """A missing label is the same as an empty one."""
    return df.withColumns({c: sure(F.col(c), "") for c in labels}) if labels else df


def _tie_code(df: DataFrame, tie: str) -> Column:
    """A number in the order of the tie column; texts go by their first seven bytes."""
    if df.schema[tie].dataType.simpleString() != "string":
        return F.col(tie)
    head = F.rpad(F.hex(F.substring(F.encode(F.col(tie), "UTF-8"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("bigint")


def _with_heavy(out: DataFrame, heavy: DataFrame, on: list[str]) -> DataFrame | None:
    """Rows with the columns of the heavy list; None where the list is empty."""
    few = heavy.limit(BROADCAST_ROWS + 1).collect()
    if not few:
        return None
    if len(few) <= BROADCAST_ROWS:
        heavy = F.broadcast(out.sparkSession.createDataFrame(few, heavy.schema))
    return out.join(heavy, on, "left")


def with_buckets(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie: str | None = None,
    widths_s: tuple[int, ...] = (3600, 1),
    max_rows: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """Add ``_bucket``, the start of the row's time bucket, and ``_cut``, its part of a crowded one.

    Starts with the first width and recuts with the next one every bucket over ``max_rows``. A
    bucket that the last width leaves over ``max_rows`` is cut at quantiles of ``tie``. Each level costs
    one counting pass that combines before its shuffle; all cuts give the same results.
    """

    def start(width: int) -> Column:
        return F.coalesce(floor_to(ts, width), F.lit("0001-01-01").cast("timestamp"))

    out = filled_labels(df.filter(F.col(ts).isNotNull()), keys).withColumn(BUCKET, start(widths_s[0]))
    on = [*keys, BUCKET]

    def crowded(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)

    deepest = len(widths_s) == 1
    for width in widths_s[1:]:
        marked = _with_heavy(out, crowded(out).select(*on, F.lit(True).alias("_heavy")), on)
        if marked is None:
            break
        out = marked.withColumn(BUCKET, F.when(F.col("_heavy"), start(width)).otherwise(F.col(BUCKET))).drop("_heavy")
        deepest = width == widths_s[-1]
    if tie is None or not deepest:
        return out.withColumn(CUT, F.lit(0))
    most = crowded(out).agg(F.max("_n")).first()[0]
    if most is None:
        return out.withColumn(CUT, F.lit(0))
    parts = min(-(-most // max_rows), MAX_CUTS)
    steps = [i / parts for i in range(1, parts)] or [0.5]
    coded = out.withColumn("_code", _tie_code(out, tie))
    bounds = F.array_sort(F.array_distinct(F.percentile_approx("_code", steps, 10 * parts)))
    lists = coded.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), bounds.alias("_bounds")).filter(F.col("_n") > max_rows)
    marked = _with_heavy(coded, lists.select(*on, "_bounds"), on)
    below = F.size(F.filter("_bounds", lambda b: b < F.col("_code")))
    return marked.withColumn(CUT, F.when(F.col("_bounds").isNull(), 0).otherwise(below)).drop("_code", "_bounds")


def in_bucket(keys: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*keys, *PLACE).orderBy(*order)


def over_buckets(keys: list[str]) -> Window:
    """Ordering of bucket summaries: one row per key and bucket, so bounded by time."""
    return Window.partitionBy(*keys).orderBy(*PLACE)


def with_carry(local: DataFrame, keys: list[str], summary: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """Rows with what the buckets before theirs hand on.

    ``summary`` aggregates a bucket; ``carry`` says, as windows over the summaries in order (see
    ``over_buckets``), what a bucket receives. Summaries use the shuffle of the windows inside buckets.
    """
    ends = local.groupBy(*keys, *PLACE).agg(*[c.alias(n) for n, c in summary.items()])
    handed = ends.select(*keys, *PLACE, *[c.alias(n) for n, c in carry.items()])
    return local.join(handed, [*keys, *PLACE], "left")


def scan(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    before: dict[str, str] | None = None,
    after: dict[str, str] | None = None,
) -> DataFrame:
    """Adds running totals (``sums``) and columns of the row before or after, in one pass.

    ``rows`` have their buckets. Totals are up to and with the row; ``before`` and ``after`` map new
    names to columns.
    """
    sums, before, after = sums or {}, before or {}, after or {}
    w = in_bucket(keys, order)
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    each = over_buckets(keys)
    earlier = each.rowsBetween(Window.unboundedPreceding, -1)
    inside = {f"_in_{n}": F.sum(c).over(up_to) for n, c in sums.items()}
    summary = {f"_sum_{n}": F.sum(c) for n, c in sums.items()}
    carry = {f"_earlier_{n}": F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)) for n in sums}
    out = {n: F.col(f"_earlier_{n}") + F.col(f"_in_{n}") for n in sums}
    if before or after:
        inside |= {"_rn": F.row_number().over(w), "_more": F.lead(F.lit(True)).over(w)}
    for n, c in before.items():
        inside[f"_in_{n}"] = F.lag(c).over(w)
        summary[f"_end_{n}"] = F.max_by(c, "_rn")
        carry[f"_earlier_{n}"] = F.lag(f"_end_{n}").over(each)
        out[n] = F.when(F.col("_rn") == 1, F.col(f"_earlier_{n}")).otherwise(F.col(f"_in_{n}"))
    for n, c in after.items():
        inside[f"_in_{n}"] = F.lead(c).over(w)
        summary[f"_start_{n}"] = F.min_by(c, "_rn")
        carry[f"_later_{n}"] = F.lead(f"_start_{n}").over(each)
        out[n] = F.when(F.col("_more"), F.col(f"_in_{n}")).otherwise(F.col(f"_later_{n}"))
    met = with_carry(rows.withColumns(inside), keys, summary, carry)
    return met.withColumns(out).drop(*inside, *carry)
