"""Sliding rates, bucket quantiles and gauges on an evaluation grid.

Definitions: the grid is the multiples of ``step_s``; the range of grid time t is
``[t - window, t)``; increase is the count (or sum) in the range and rate is increase per
second. Nothing is extrapolated. The window must be a multiple of the step.

Events are reduced to one row per label set and step. Such a pane counts from the end of its step
until the window has passed, so it enters as +n and leaves as -n, and running sums of these two rows
give stretches of grid times with one value, whatever the ratio of window and step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.functions.buckets import bucket_names, bucket_quantile, cumulative_counts
from voltmart.functions.ordered import filled_labels, scan, with_buckets
from voltmart.functions.time import MICROS, add_seconds, floor_to


def panes(events: DataFrame, labels: list[str], ts: str, step_s: int, aggs: list[Column]) -> DataFrame:
    """Partial aggregates per label set and grid step; ``pane`` is the step's start."""
    return events.groupBy(*labels, floor_to(ts, step_s).alias("pane")).agg(*aggs)


def range_stretches(per_pane: DataFrame, labels: list[str], measures: list[str], window_s: int, step_s: int) -> DataFrame:
    """``labels, first, last, measures``: sums over the range, one row per change of any of them.

    Two rows per pane, however many grid times a pane counts for. The running sums work inside days
    and hand one carry on per day, so no task orders more than a day's grid times of a label set.
    Only grid times whose range holds a pane are covered. Measures must be integers or decimals:
    what enters as a floating number does not leave without a rest.
    """
    if window_s % step_s:
        raise ValueError("the window must be a multiple of the step")
    inexact = [m for m in measures if per_pane.schema[m].dataType.typeName() in ("float", "double")]
    if inexact:
        raise ValueError(f"no exact sums of {', '.join(inexact)}")
    ends = F.array(
        *[
            F.struct(
                add_seconds("pane", after).alias("t"),
                F.lit(sign).cast("bigint").alias("_panes"),
                *[(F.col(m) * F.lit(sign)).alias(m) for m in measures],
            )
            for after, sign in ((step_s, 1), (window_s + step_s, -1))
        ]
    )
    names = ["_panes", *measures]
    steps = per_pane.select(*labels, F.inline(ends)).groupBy(*labels, "t").agg(*[F.sum(m).alias(m) for m in names])
    rows = with_buckets(steps, labels, "t", widths_s=(86_400,))
    lasting = scan(rows, labels, ["t"], {f"_{m}": F.col(m) for m in names}, after={"_until": "t"})
    return lasting.filter(F.col("__panes") > 0).select(
        *labels, F.col("t").alias("first"), add_seconds("_until", -step_s).alias("last"), *[F.col(f"_{m}").alias(m) for m in measures]
    )


def grid_points(stretches: DataFrame, step_s: int) -> DataFrame:
    """One row per grid time ``t`` of each stretch."""
    times = F.sequence("first", "last", F.expr(f"INTERVAL {step_s} SECOND"))
    return stretches.withColumn("t", F.explode(times)).drop("first", "last")


def slide(per_pane: DataFrame, labels: list[str], measures: list[str], window_s: int, step_s: int) -> DataFrame:
    """Sum panes into every range that contains them; one row per label set and grid time."""
    return grid_points(range_stretches(per_pane, labels, measures, window_s, step_s), step_s)


def rate_stretches(events: DataFrame, labels: list[str], ts: str, window_s: int, step_s: int) -> DataFrame:
    """``rate`` as stretches."""
    counted = panes(events, labels, ts, step_s, [F.count(F.lit(1)).alias("increase")])
    n = F.col("increase")
    return range_stretches(counted, labels, ["increase"], window_s, step_s).withColumns(
        {"per_second": n / F.lit(window_s), "per_minute": n * F.lit(60) / F.lit(window_s)}
    )


def rate(events: DataFrame, labels: list[str], ts: str, window_s: int, step_s: int) -> DataFrame:
    """Events per second over the range, and per minute (R1). No row without events."""
    return grid_points(rate_stretches(events, labels, ts, window_s, step_s), step_s)


def grid(per_pane: DataFrame, labels: list[str], step_s: int, start=None, end=None) -> DataFrame:
    """Every grid time for every label set.

    From the first pane's end to the last pane's end over all label sets, unless given. The
    bounds are scalars of the reduced panes, not a join.
    """
    lo = F.lit(start).cast("timestamp") if start else per_pane.agg(F.min("pane")).scalar()
    hi = F.lit(end).cast("timestamp") if end else per_pane.agg(F.max("pane")).scalar()
    # In pieces of a day or a step, so that no row holds a long sequence.
    length = step_s * max(1, 86_400 // step_s)
    step, piece = F.expr(f"INTERVAL {step_s} SECOND"), F.expr(f"INTERVAL {length} SECOND")
    sets = per_pane.select(*labels).distinct() if labels else per_pane.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    pieces = sets.select(*labels, hi.alias("_hi"), F.explode(F.sequence(lo, hi, piece)).alias("_d"))
    end_of_piece = F.least("_hi", add_seconds("_d", length - step_s))
    return pieces.select(*labels, F.explode(F.sequence("_d", end_of_piece, step)).alias("_p")).select(
        *labels, add_seconds("_p", step_s).alias("t")
    )


def increase(
    events: DataFrame, labels: list[str], ts: str, window_s: int, step_s: int, start=None, end=None
) -> DataFrame:
    """Dense increase: 0 where a range has no event (R2)."""
    counted = panes(events, labels, ts, step_s, [F.count(F.lit(1)).alias("increase")])
    slid = slide(counted, labels, ["increase"], window_s, step_s)
    return grid(counted, labels, step_s, start, end).join(slid, [*labels, "t"], "left").select(
        *labels, "t", F.coalesce("increase", F.lit(0)).alias("increase")
    )


def ratio_stretches(
    events: DataFrame, labels: list[str], ts: str, top: Column, bottom: Column, window_s: int, step_s: int
) -> DataFrame:
    """Counted events of one kind per event of another, over the range.

    No value where the denominator is 0, like a division of absent series.
    """
    counted = panes(events, labels, ts, step_s, [F.count_if(top).alias("a"), F.count_if(bottom).alias("b")])
    held = range_stretches(counted, labels, ["a", "b"], window_s, step_s)
    return held.filter(F.col("b") > 0).withColumn("value", F.col("a") / F.col("b"))


def ratio(
    events: DataFrame, labels: list[str], ts: str, top: Column, bottom: Column, window_s: int, step_s: int
) -> DataFrame:
    """``ratio_stretches`` with one row per grid time."""
    return grid_points(ratio_stretches(events, labels, ts, top, bottom, window_s, step_s), step_s)


def quantile_stretches(
    events: DataFrame,
    labels: list[str],
    ts: str,
    value: str,
    bounds: list[float],
    window_s: int,
    step_s: int,
    q: float = 0.95,
) -> DataFrame:
    """Bucket quantile over the range, as stretches."""
    names = bucket_names(bounds)
    counted = panes(events, labels, ts, step_s, cumulative_counts(value, bounds))
    held = range_stretches(counted, labels, names, window_s, step_s)
    return held.withColumn("value", bucket_quantile(q, F.array(*names), bounds))


def quantile(
    events: DataFrame,
    labels: list[str],
    ts: str,
    value: str,
    bounds: list[float],
    window_s: int,
    step_s: int,
    q: float = 0.95,
) -> DataFrame:
    """Bucket quantile over the range."""
    return grid_points(quantile_stretches(events, labels, ts, value, bounds, window_s, step_s, q), step_s)


def last_in_window(samples: DataFrame, labels: list[str], ts: str, tie: str, value: str, step_s: int) -> DataFrame:
    """Last sample per label set and step, shown at the end of the step."""
    newest = F.max_by(value, F.struct(ts, tie)).alias("value")
    return panes(samples, labels, ts, step_s, [newest]).select(
        *labels, add_seconds("pane", step_s).alias("t"), "value"
    )


def gauge_at_grid(
    samples: DataFrame, labels: list[str], ts: str, tie: str, value: str, step_s: int, start=None, end=None
) -> DataFrame:
    """Gauge as of each grid time: the last sample before it, carried forward.

    The carry orders one row per grid time and label set. No row before the first sample.
    """
    newest = F.max_by(value, F.struct(ts, tie)).alias("_v")
    held = panes(samples, labels, ts, step_s, [newest])
    shown = held.select(*labels, add_seconds("pane", step_s).alias("t"), "_v")
    filled = F.last("_v", ignorenulls=True).over(
        Window.partitionBy(*labels).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        grid(held, labels, step_s, start, end)
        .join(shown, [*labels, "t"], "left")
        .select(*labels, "t", filled.alias("value"))
        .filter(F.col("value").isNotNull())
    )


def counter_increase(
    samples: DataFrame,
    series: list[str],
    ts: str,
    tie: str,
    value: str,
    window_s: int,
    step_s: int,
    max_bucket_rows: int | None = None,
) -> DataFrame:
    """Increase of a cumulative counter per range, with resets.

    A sample below its predecessor is a restart from zero and counts whole; the first sample
    of a series adds nothing. A difference belongs to the range of its later sample. Few
    series hold many samples each, so predecessors are found inside buckets and only the
    last sample of each bucket is passed on. Values must be integers or decimals.
    """
    extra = {} if max_bucket_rows is None else {"max_rows": max_bucket_rows}
    rows = with_buckets(
        samples.select(*series, F.col(ts).alias("_ts"), F.col(tie).alias("_id"), F.col(value).alias("_v")),
        series,
        "_ts",
        "_id",
        **extra,
    )
    prev, now = F.col("_before"), F.col("_v")
    step = F.when(prev.isNull(), F.lit(0)).when(now < prev, now).otherwise(now - prev)
    stepped = scan(rows, series, ["_ts", "_id"], before={"_before": "_v"}).withColumn("_step", step)
    counted = panes(stepped, series, "_ts", step_s, [F.sum("_step").alias("increase")])
    return slide(counted, series, ["increase"], window_s, step_s)


# ----- stretches: runs of grid times with one value, given by their first and last time


def gauge_stretches(
    samples: DataFrame, labels: list[str], ts: str, tie: str, value: str, step_s: int
) -> DataFrame:
    """The gauge of ``gauge_at_grid`` as ``labels, first, last, value``: one row per step with samples.

    A sample shows from the end of its step until the next one does; the last one shows until the
    newest step of all label sets.
    """
    newest = F.max_by(value, F.struct(ts, tie)).alias("value")
    held = panes(samples, labels, ts, step_s, [newest])
    end = add_seconds(held.agg(F.max("pane")).scalar(), step_s)
    following = F.lead("pane").over(Window.partitionBy(*labels).orderBy("pane"))
    return held.select(
        *labels, add_seconds("pane", step_s).alias("first"), F.coalesce(following, end).alias("last"), "value"
    )


def silent_stretches(events: DataFrame, labels: list[str], ts: str, window_s: int, step_s: int) -> DataFrame:
    """Where ``increase`` is 0, as ``labels, first, last, value``: one row per gap between events.

    A step that begins at p counts for the grid times p + step to p + window. Gaps run between
    such spans, from the first to the newest step of all label sets.
    """
    seen = panes(events, labels, ts, step_s, [F.count(F.lit(1)).alias("_n")])
    low, high = seen.agg(F.min("pane")).scalar(), seen.agg(F.max("pane")).scalar()
    order = Window.partitionBy(*labels).orderBy("pane")
    gaps = seen.select(
        *labels,
        "pane",
        F.lag("pane").over(order).alias("_before"),
        F.lead("pane").over(order).alias("_after"),
    )
    over = add_seconds("pane", window_s + step_s)
    spans = F.array(
        F.struct(over.alias("first"), F.coalesce(F.col("_after"), add_seconds(high, step_s)).alias("last")),
        F.struct(
            F.when(F.col("_before").isNull(), add_seconds(low, step_s)).alias("first"), F.col("pane").alias("last")
        ),
    )
    return gaps.select(*labels, F.inline(spans)).filter("first <= last").withColumn("value", F.lit(0))


def grid_ends(start: Column, end: Column, step_s: int) -> tuple[Column, Column]:
    """First and last grid time in ``[start, end)``; the first is later than the last if there is none."""
    width = F.lit(step_s * MICROS)
    first = F.unix_micros(start) + F.pmod(-F.unix_micros(start), width)
    last = F.unix_micros(end) - 1 - F.pmod(F.unix_micros(end) - 1, width)
    return F.timestamp_micros(first), F.timestamp_micros(last)
