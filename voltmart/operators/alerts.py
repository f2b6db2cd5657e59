"""Alert rules as a table of configurations over the generic series operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.functions.buckets import API_DURATION_BOUNDS, DB_QUERY_BOUNDS
from voltmart.functions.ordered import PLACE, in_bucket, over_buckets, with_buckets
from voltmart.functions.time import MICROS, add_seconds
from voltmart.operators import rates


@dataclass(frozen=True)
class Rule:
    """One alert: which series, compared how, held how long.

    ``kind`` is rate, quantile, gauge, ratio, absence, up or state; ``labels`` name the
    series. ``extra`` carries what only some kinds need (bucket bounds, conditions).
    """

    name: str
    kind: str
    source: str
    labels: tuple[str, ...]
    op: str
    threshold: float
    hold_s: int
    window_s: int = 300
    step_s: int = 15
    severity: str = "warning"
    extra: dict = field(default_factory=dict)


# Thresholds, ranges and holds of the monitoring rules. The failure and
# conversion ratios are written as intended (failures of all attempts, starts per quote):
# matched label by label, the original expressions divide a series by itself or by nothing.
# SlowDatabaseQueries cannot fire with its own buckets: their top bound is the threshold.
RULES: dict[str, Rule] = {
    r.name: r
    for r in [
        Rule("HighErrorRate", "rate", "http_errors", ("service", "handler"), ">", 0.1, 120),
        Rule("HighResponseTime", "quantile", "http_durations", ("service", "handler"), ">", 2, 300,
             extra={"bounds": API_DURATION_BOUNDS, "value": "duration_s"}),
        Rule("ServiceDown", "up", "heartbeats", ("service",), "==", 0, 60, severity="critical"),
        Rule("HighDebtAmount", "gauge", "debt_gauge", ("service",), ">", 1_000_000, 300),
        Rule("HighPaymentFailureRate", "ratio", "payment_attempts", ("service",), ">", 0.2, 180,
             extra={"top": "NOT success", "bottom": "TRUE"}),
        Rule("CircuitBreakerOpen", "state", "outages", ("service", "circuit"), ">", 0, 60),
        Rule("BillingWorkerStuck", "absence", "billing_cycles", ("service",), "==", 0, 600, 600, severity="critical"),
        Rule("HighDatabaseConnections", "gauge", "connections", ("service", "database"), ">", 50, 300),
        Rule("SlowDatabaseQueries", "quantile", "query_durations", ("service", "database", "operation"), ">", 1, 300,
             extra={"bounds": DB_QUERY_BOUNDS, "value": "duration_s"}),
        Rule("LowRentalConversionRate", "ratio", "quotes_and_starts", (), "<", 0.1, 600, 3600,
             extra={"top": "kind = 'start'", "bottom": "kind = 'quote'"}),
        Rule("HighWorkerErrorRate", "rate", "worker_errors", ("service", "error_type"), ">", 0.1, 300),
        Rule("ExternalAPIHighLatency", "quantile", "api_durations", ("service", "api_service", "endpoint"), ">", 5, 300,
             extra={"bounds": API_DURATION_BOUNDS, "value": "duration_s"}),
        Rule("NoActiveRentals", "gauge", "active_rentals_gauge", ("service",), "==", 0, 1800),
    ]
}


def _points(df: DataFrame) -> DataFrame:
    """Single grid times as stretches."""
    return df.withColumns({"first": F.col("t"), "last": F.col("t")})


def _rate(events: DataFrame, rule: Rule) -> DataFrame:
    out = rates.rate_stretches(events, list(rule.labels), "ts", rule.window_s, rule.step_s)
    return out.withColumn("value", F.col("per_second"))


def _quantile(events: DataFrame, rule: Rule) -> DataFrame:
    return rates.quantile_stretches(
        events, list(rule.labels), "ts", rule.extra["value"], rule.extra["bounds"], rule.window_s, rule.step_s
    )


def _ratio(events: DataFrame, rule: Rule) -> DataFrame:
    top, bottom = F.expr(rule.extra["top"]), F.expr(rule.extra["bottom"])
    return rates.ratio_stretches(events, list(rule.labels), "ts", top, bottom, rule.window_s, rule.step_s)


def _gauge(samples: DataFrame, rule: Rule) -> DataFrame:
    return rates.gauge_stretches(samples, list(rule.labels), "ts", "tie", "value", rule.step_s)


def _absence(events: DataFrame, rule: Rule) -> DataFrame:
    """Stretches without events; times with events have no row."""
    return rates.silent_stretches(events, list(rule.labels), "ts", rule.window_s, rule.step_s)


def _up(events: DataFrame, rule: Rule) -> DataFrame:
    """0 where the label set sent nothing in the last step; other times have no row."""
    return rates.silent_stretches(events, list(rule.labels), "ts", rule.step_s, rule.step_s)


def _state(outages: DataFrame, rule: Rule) -> DataFrame:
    """Breaker state inside an outage: 1 open, 2 half-open.

    An outage that has not ended lasts until the newest time in the table, its last failure
    included.
    """
    newest = outages.agg(F.max(F.greatest("half_open_at", "last_failure", "closed_at"))).scalar()
    end = F.coalesce(F.col("closed_at"), newest)
    half = F.least(F.coalesce("half_open_at", end), end)
    opened, halved = rates.grid_ends(F.col("opened_at"), half, rule.step_s), rates.grid_ends(half, end, rule.step_s)
    states = F.array(
        *[
            F.struct(first.alias("first"), last.alias("last"), F.lit(code).alias("value"))
            for (first, last), code in ((opened, 1), (halved, 2))
        ]
    )
    return outages.select(*rule.labels, F.inline(states)).filter("first <= last")


SERIES: dict[str, Callable[[DataFrame, Rule], DataFrame]] = {
    "rate": _rate,
    "quantile": _quantile,
    "gauge": _gauge,
    "ratio": _ratio,
    "absence": _absence,
    "up": _up,
    "state": _state,
}


def series(rule: Rule, source: DataFrame) -> DataFrame:
    """``(rule, series, first, last, value)``: stretches of grid times with one value.

    The label values are joined into one name.
    """
    name = F.concat_ws("/", *[F.col(c) for c in rule.labels]) if rule.labels else F.lit("all")
    return SERIES[rule.kind](source, rule).select(
        F.lit(rule.name).alias("rule"), name.alias("series"), "first", "last", F.col("value").cast("double").alias("value")
    )


def breached(rule: Rule) -> Column:
    value, limit = F.col("value"), F.lit(float(rule.threshold))
    return {">": value > limit, "<": value < limit, "==": value == limit}[rule.op]


def hold(points: DataFrame, step_s: int, hold_s: int) -> DataFrame:
    """Episodes of breaching grid points ``(rule, series, t, value)``."""
    return hold_stretches(_points(points).drop("t"), step_s, hold_s)


def hold_stretches(stretches: DataFrame, step_s: int, hold_s: int) -> DataFrame:
    """Episodes of breaching stretches ``(rule, series, first, last, value)``.

    Stretches that follow each other without a missing grid time form an episode. It fires at the
    first grid time at least ``hold_s`` after its start, if it lasts that long. Stretches are put in
    order inside days, one carry per day and series joins them, so a series that breaches all
    the time is spread over tasks.
    """
    keys, order = ["rule", "series"], ["first"]
    wait = -(-hold_s // step_s) * step_s
    width = F.lit(step_s * MICROS)
    span = F.unix_micros("last") - F.unix_micros("first")
    rows = with_buckets(stretches, keys, "first", widths_s=(86_400,))

    def apart(first: str, before: Column) -> Column:
        return F.coalesce(F.unix_micros(first) - F.unix_micros(before) > width, F.lit(True)).cast("int")

    # Inside a day all rows but its first know whether they begin an episode; the carry tells the first.
    w = in_bucket(keys, order)
    local = rows.withColumns({"_rn": F.row_number().over(w), "_prev": F.lag("last").over(w)})
    local = local.withColumn("_begins", F.when(F.col("_rn") > 1, apart("first", F.col("_prev"))).otherwise(0))
    local = local.withColumn("_inside", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    days = local.groupBy(*keys, *PLACE).agg(
        F.min("first").alias("_first"), F.max_by("last", "_rn").alias("_end"), F.sum("_begins").alias("_n")
    )
    each = over_buckets(keys)
    days = days.withColumn("_begun", apart("_first", F.lag("_end").over(each)))
    earlier = F.sum(F.col("_n") + F.col("_begun")).over(each.rowsBetween(Window.unboundedPreceding, -1))
    carry = days.select(*keys, *PLACE, (F.coalesce(earlier, F.lit(0)) + F.col("_begun")).alias("_earlier"))
    episodes = (
        local.join(carry, [*keys, *PLACE], "left")
        .withColumn("_island", F.col("_earlier") + F.col("_inside"))
        .groupBy(*keys, "_island")
        .agg(
            F.min("first").alias("pending_since"),
            F.max("last").alias("last_at"),
            F.sum(F.call_function("div", span, width) + 1).alias("points"),
            F.max("value").alias("highest"),
        )
    )
    fires_at = add_seconds("pending_since", wait)
    return episodes.withColumn("firing_since", F.when(fires_at <= F.col("last_at"), fires_at)).drop("_island")


def alert(rule: Rule, source: DataFrame) -> DataFrame:
    """All episodes of one rule; ``firing_since`` is NULL for those that stayed pending."""
    return hold_stretches(series(rule, source).filter(breached(rule)), rule.step_s, rule.hold_s)


def evaluate(rules: list[Rule], sources: dict[str, DataFrame]) -> DataFrame:
    """Episodes of several rules with their severity."""
    parts = [
        alert(r, sources[r.source]).withColumn("severity", F.lit(r.severity)) for r in rules
    ]
    return reduce(DataFrame.unionByName, parts)
