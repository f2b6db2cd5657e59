"""Exact quantiles from mergeable sketches.

A sketch of a label set is made by every task over its rows and merged, so neither a hot label set nor a
hot value gathers rows in one task. It is an estimate; it only proposes three values around the
wanted rank. One pass counts the rows below and up to them, which tells for sure in which piece the rank
lies. Pieces shrink about fifty-fold a round until they hold few values, which are then sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.ordered import filled_labels
from voltmart.functions.time import add_seconds, floor_to
from voltmart.session import cut_lineage

SORTED = 65_536  # values of a label set sorted in one task at most: 512 KB
PARTS = 128  # a sketch is asked for the values at these fractions
SKETCH = 1024  # items on a sketch's levels: ranks off by about 0.3 %
LISTED = 100_000  # label sets whose brackets are broadcast; more are joined as the planner sees fit


def _with_brackets(known: DataFrame, brackets: DataFrame, keys: list[str], n: int) -> DataFrame:
    return known.join(F.broadcast(brackets) if n <= LISTED else brackets, keys)


def _interpolated(low: Column, high: Column, q: float) -> Column:
    place = F.lit(q) * (F.col("samples") - 1)
    part = place - F.floor(place)
    return F.when((part == 0) | high.isNull() | (high == low), low).otherwise(low + (high - low) * part)


def exact_quantile(events: DataFrame, labels: list[str], value: str, q: float = 0.95, most: int = SORTED) -> DataFrame:
    """labels, samples, value: exact quantile with linear interpolation, next to the bucket form.

    Nulls and NaN are no samples; a label set without samples has no row. A missing label is the same
    as an empty one. ``most`` bounds the values of a label set that are sorted together. The driver
    sees the number of label sets that are still open.
    """
    keys = labels or ["_all"]
    known = filled_labels(events.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))), labels)
    known = known.select(*[F.col(c) if labels else F.lit(0).alias(c) for c in keys], F.col(value).cast("double").alias("_v"))
    # low and high bound the value of rank ``rank`` (from 0), both included; before: values below low; held: inside.
    unbounded = [F.lit(None).cast("double").alias(c) for c in ("low", "high")]
    brackets = known.groupBy(*keys).agg(F.count("_v").alias("samples")).select(
        *keys, "samples", F.floor(F.lit(q) * (F.col("samples") - 1)).alias("rank"),
        *unbounded, F.lit(0).cast("long").alias("before"), F.col("samples").alias("held"),
    )
    inside = F.coalesce(F.col("_v") >= F.col("low"), F.lit(True)) & F.coalesce(F.col("_v") <= F.col("high"), F.lit(True))
    results = []
    while True:
        brackets = cut_lineage(brackets)
        sizes = brackets.agg(F.count_if(F.col("held") <= most), F.count_if(F.col("held") > most)).first()
        if sizes[0]:
            few = brackets.where(F.col("held") <= most)
            results.append(_sorted_rank(_with_brackets(known, few, keys, sizes[0]), keys, inside, q))
        if not sizes[1]:
            break
        many = brackets.where(F.col("held") > most)
        tried = cut_lineage(_counted(known, many, keys, inside, sizes[1]))
        hit = (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("upto"))
        after = F.when(F.col("rank") + 1 < F.col("upto"), F.col("mid")).otherwise(F.col("above"))
        results.append(tried.where(hit).select(*keys, "samples", _interpolated(F.col("mid"), after, q).alias("value")))
        brackets = _narrowed(tried.where(~hit), keys)
    found = results[0] if results else brackets.select(*keys, "samples", F.lit(None).cast("double").alias("value"))
    for more in results[1:]:
        found = found.union(more)
    return found.select(*labels, "samples", "value")


def _sorted_rank(rows: DataFrame, keys: list[str], inside: Column, q: float) -> DataFrame:
    """Value at the rank among the few values inside a bracket, and the one after it."""
    rows = rows.groupBy(*keys, "samples", "rank", "before").agg(
        F.sort_array(F.collect_list(F.when(inside, F.col("_v")))).alias("_few"),
        F.min(F.when(F.col("_v") > F.col("high"), F.col("_v"))).alias("_beyond"),
    )
    at = (F.col("rank") - F.col("before")).cast("int")
    after = F.coalesce(F.get("_few", at + 1), "_beyond")
    return rows.select(*keys, "samples", _interpolated(F.get("_few", at), after, q).alias("value"))


def _counted(known: DataFrame, many: DataFrame, keys: list[str], inside: Column, n: int) -> DataFrame:
    """Three values proposed per bracket, and how many values of the label set lie below and up to each."""
    parts = F.array(*[F.lit(k / PARTS) for k in range(PARTS + 1)])
    sketched = (
        _with_brackets(known, many, keys, n)
        .where(inside)
        .groupBy(*keys)
        .agg(F.kll_sketch_agg_double("_v", SKETCH).alias("_s"))
        .select(*keys, F.kll_sketch_get_quantile_double("_s", parts).alias("_q"))
    )
    part = (F.col("rank") - F.col("before")) * PARTS / F.col("held")
    pick = lambda k: F.get("_q", F.greatest(F.lit(0), F.least(F.lit(PARTS), k)).cast("int"))
    proposed = cut_lineage(
        many.join(sketched, keys).select(
            *many.columns, pick(F.floor(part) - 1).alias("left"), pick(F.round(part)).alias("mid"), pick(F.ceil(part) + 1).alias("right")
        )
    )
    v = F.col("_v")
    return (
        _with_brackets(known, proposed, keys, n)
        .groupBy(*proposed.columns)
        .agg(
            F.count_if(v < F.col("left")).alias("under"),
            F.count_if(v < F.col("mid")).alias("below"),
            F.count_if(v <= F.col("mid")).alias("upto"),
            F.count_if(v <= F.col("right")).alias("within"),
            F.max(F.when(v < F.col("mid"), v)).alias("prior"),
            F.min(F.when(v > F.col("mid"), v)).alias("above"),
        )
    )


def _narrowed(tried: DataFrame, keys: list[str]) -> DataFrame:
    """The piece in which the rank lies; never one with the middle value, so each round gets on."""
    rank = F.col("rank")
    lower, upper = rank < F.col("below"), rank >= F.col("upto")
    from_left, to_right = F.col("under") <= rank, rank < F.col("within")
    low = F.when(upper, F.col("above")).when(from_left, F.col("left")).otherwise(F.col("low"))
    high = F.when(lower, F.col("prior")).when(to_right, F.col("right")).otherwise(F.col("high"))
    before = F.when(upper, F.col("upto")).when(from_left, F.col("under")).otherwise(F.col("before"))
    upto = F.when(lower, F.col("below")).when(to_right, F.col("within")).otherwise(F.col("before") + F.col("held"))
    return tried.select(*keys, "samples", "rank", low.alias("low"), high.alias("high"), before.alias("before"), (upto - before).alias("held"))


def exact_quantile_per_window(
    events: DataFrame, labels: list[str], ts: str, value: str, window_s: int, q: float = 0.95, most: int = SORTED
) -> DataFrame:
    """labels, t, samples, value: exact quantile of every window ``[t - window_s, t)`` with samples."""
    pane = F.unix_micros(floor_to(ts, window_s)).cast("string")
    timed = events.where(F.col(ts).isNotNull()).withColumn("_pane", pane)
    found = exact_quantile(timed, [*labels, "_pane"], value, q, most)
    return found.select(*labels, add_seconds(F.timestamp_micros(F.col("_pane").cast("bigint")), window_s).alias("t"), "samples", "value")
