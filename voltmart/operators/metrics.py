"""Counters, gauges, histograms and failure runs over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.functions.buckets import bucket_names, cumulative_counts
from voltmart.functions.ordered import PLACE, filled_labels, in_bucket, scan, sure, with_buckets
from voltmart.functions.time import add_seconds, col, floor_to

# Failures that open a circuit, and seconds until it is tried again.
FAIL_MAX = {"station": 5, "payment": 3, "profile": 10}
RESET_TIMEOUT_SEC = {"station": 30, "payment": 60, "profile": 15}
# Numeric codes of breaker states; any other state is 0.
BREAKER_STATES = {"closed": 0, "open": 1, "half_open": 2}


def counter(events: DataFrame, labels: list[str], amount: str | None = None) -> DataFrame:
    """Events per label set, and the summed amount when asked for (M1, M2, M3, M8, M9)."""
    aggs = [F.count(F.lit(1)).alias("total")]
    if amount:
        aggs.append(F.sum(amount).alias("amount_total"))
    return events.groupBy(*labels).agg(*aggs)


def payment_metric_events(decided: DataFrame) -> DataFrame:
    """Payment events a billing tick reports (M2).

    Every new charge counts; a debt collection counts only when it succeeds, although its
    failed attempt is stored.
    """
    counted = (F.col("branch") == "usage") | ((F.col("branch") == "debt") & F.col("success"))
    return decided.filter(counted).select(
        F.lit("billing-worker").alias("service"),
        F.when(F.col("success"), "success").otherwise("failure").alias("status"),
        F.col("attempt_amount").alias("amount"),
        F.col("now_ts").alias("ts"),
    )


def debt_metric_events(decided: DataFrame) -> DataFrame:
    """Debt operations of a billing tick: add, reduce or retry (M3)."""
    operation = (
        F.when((F.col("branch") == "usage") & ~F.col("success"), "add")
        .when((F.col("branch") == "debt") & F.col("success"), "reduce")
        .when(F.col("branch") == "debt", "retry")
    )
    return decided.withColumn("operation", operation).filter(F.col("operation").isNotNull()).select(
        F.lit("billing-worker").alias("service"),
        "operation",
        F.abs("debt_delta").alias("amount"),
        F.col("now_ts").alias("ts"),
    )


def gauge(deltas: DataFrame, labels: list[str], ts: str, delta: Column) -> DataFrame:
    """Running total per label set, one row per second that has a change.

    Changes are summed per second first, combining before the shuffle. Running sums then work
    inside one day (at most 86,400 rows) and the day totals are summed up separately (one row
    per day), so no task orders more than that however many changes there are.
    """
    known = filled_labels(deltas.filter(col(ts).isNotNull()), labels)
    seconds = known.groupBy(*labels, floor_to(ts, 1).alias("ts")).agg(F.sum(delta).alias("delta"))
    daily = seconds.withColumn("_day", sure(F.datediff("ts", F.lit("1970-01-01").cast("date")), 0))
    totals = daily.groupBy(*labels, "_day").agg(F.sum("delta").alias("_t"))
    earlier = Window.partitionBy(*labels).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*labels, "_day", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_carry"))
    within = Window.partitionBy(*labels, "_day").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.withColumn("_run", F.sum("delta").over(within))
        .join(carried, [*labels, "_day"], "left")
        .select(*labels, "ts", "delta", (F.col("_carry") + F.col("_run")).alias("value"))
    )


def gauge_changes(
    deltas: DataFrame, labels: list[str], ts: str, ties: list[str], delta: Column, max_bucket_rows: int | None = None
) -> DataFrame:
    """Running total per label set after every single change, in the order of time and ties.

    Nothing is summed up first, so what happens inside a second shows. Buckets of the whole order
    and one carry per bucket keep a crowded second spread (see ``functions.ordered``).
    """
    extra = {} if max_bucket_rows is None else {"max_rows": max_bucket_rows}
    changes = deltas.select(*labels, F.col(ts).alias("ts"), *ties, delta.cast("bigint").alias("delta"))
    rows = with_buckets(changes, labels, "ts", ties[0], **extra)
    return scan(rows, labels, ["ts", *ties], {"value": F.col("delta")}).drop(*PLACE)


def _debt_change() -> Column:
    return F.when(F.col("operation") == "add", F.col("amount")).when(
        F.col("operation") == "reduce", -F.col("amount")
    ).otherwise(F.lit(0).cast("bigint"))


def debt_gauge(operations: DataFrame) -> DataFrame:
    """Current debt: up on add, down on reduce, unchanged on retry (M4)."""
    return gauge(operations, ["service"], "ts", _debt_change())


def debt_changes(operations: DataFrame, max_bucket_rows: int | None = None) -> DataFrame:
    """Current debt after every operation (M4)."""
    return gauge_changes(operations, ["service"], "ts", ["id"], _debt_change(), max_bucket_rows)


def rental_changes(rentals: DataFrame) -> DataFrame:
    """+1 at each start, -1 at each end; FAILED rentals never became active."""
    change = F.array(
        F.struct(F.col("started_at").alias("ts"), F.lit(1).cast("bigint").alias("change")),
        F.struct(F.col("finished_at").alias("ts"), F.lit(-1).cast("bigint").alias("change")),
    )
    return (
        rentals.filter(F.col("status") != "FAILED")
        .select("id", F.lit("rental-core").alias("service"), F.inline(change))
        .filter(F.col("ts").isNotNull())
    )


def rental_increments(rentals: DataFrame) -> DataFrame:
    """One counter increment per start (ACTIVE) and one per end, by its status.

    A rental that has ended was counted as ACTIVE before; FAILED rentals never started.
    """
    steps = F.array(
        F.struct(F.col("started_at").alias("ts"), F.lit("ACTIVE").alias("status")),
        F.struct(F.col("finished_at").alias("ts"), F.col("status").alias("status")),
    )
    return (
        rentals.filter(F.col("status") != "FAILED")
        .select(F.lit("rental-core").alias("service"), F.inline(steps))
        .filter(F.col("ts").isNotNull())
    )


def active_rentals_gauge(rentals: DataFrame) -> DataFrame:
    """Number of active rentals over time (M5)."""
    return gauge(rental_changes(rentals), ["service"], "ts", F.col("change"))


def active_rental_changes(rentals: DataFrame, max_bucket_rows: int | None = None) -> DataFrame:
    """Number of active rentals after every start and end (M5); ends of a moment come first per rental id."""
    return gauge_changes(rental_changes(rentals), ["service"], "ts", ["id", "change"], F.col("change"), max_bucket_rows).drop("change")


def last_value(samples: DataFrame, labels: list[str], value: str, ts: str, tie: str) -> DataFrame:
    """Newest value per label set (M6)."""
    return samples.groupBy(*labels).agg(F.max_by(value, F.struct(ts, tie)).alias("value"))


def histogram(events: DataFrame, labels: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative bucket counts with sum and count, one row per label set (M7)."""
    return events.groupBy(*labels).agg(
        *cumulative_counts(value, bounds), F.sum(value).alias("value_sum"), F.count(value).alias("value_count")
    )


def histogram_rows(wide: DataFrame, labels: list[str], bounds: list[float]) -> DataFrame:
    """The same as rows ``(labels, le, cumulative)`` with ``+Inf`` last."""
    names = bucket_names(bounds)
    pairs = ", ".join(f"'{le}', {name}" for le, name in zip([*map(str, bounds), "+Inf"], names))
    return wide.selectExpr(*labels, f"stack({len(names)}, {pairs}) AS (le, cumulative)")


def breaker_state_code(state: Column | str) -> Column:
    """Numeric breaker state; unknown names count as closed."""
    code = F.lit(0)
    for name, value in BREAKER_STATES.items():
        code = F.when(col(state) == name, value).otherwise(code)
    return code


# ----- consecutive failures

BREAKER = ["service", "circuit"]


def limit_of(circuit: Column, limits: dict[str, int]) -> Column:
    """Per-circuit limit as a CASE; NULL for a circuit without one."""
    out = F.lit(None).cast("int")
    for name, value in limits.items():
        out = F.when(circuit == name, value).otherwise(out)
    return out


def failure_runs(
    events: DataFrame,
    failed: Column,
    keys: list[str] = BREAKER,
    ts: str = "ts",
    id_: str = "id",
    limits: dict[str, int] | None = None,
    max_bucket_rows: int | None = None,
) -> DataFrame:
    """Runs of consecutive failures per breaker; a success ends a run.

    Each service has breakers of its own, so a breaker is a service and a circuit; the last of
    ``keys`` is the circuit that limits go by. There are few breakers, so each holds a large part of all rows. Positions are counted
    inside time buckets; each bucket then receives the successes before it and the run that
    was open when it began. The final grouping combines before its shuffle.

    Returns ``keys, run, failures, first_failure, last_failure, opened_at, closed_at``;
    ``opened_at`` is the failure that reached the limit, ``closed_at`` the ending success.
    """
    groups = run_groups(events, failed, keys, ts, id_, limits, max_bucket_rows)
    return groups.filter(F.col("failures") > 0)


def run_groups(
    events: DataFrame,
    failed: Column,
    keys: list[str] = BREAKER,
    ts: str = "ts",
    id_: str = "id",
    limits: dict[str, int] | None = None,
    max_bucket_rows: int | None = None,
    leading: bool = False,
) -> DataFrame:
    """All groups of ``failure_runs``, also those without a failure.

    Group n holds what follows the n-th success up to the next one. With ``leading``, group 0 also
    lists its first failures up to the largest limit (``lead``): of rows that follow others, they
    tell where a run that began before reaches its limit.
    """
    limits = FAIL_MAX if limits is None else limits
    good = F.when(failed, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("_good")
    rows = events.select(*keys, F.col(ts).alias("_ts"), F.col(id_).alias("_id"), good)
    extra = {} if max_bucket_rows is None else {"max_rows": max_bucket_rows}
    rows = with_buckets(rows, keys, "_ts", "_id", **extra)

    w = in_bucket(keys, ["_ts", "_id"])
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    is_good = F.col("_good") == 1
    local = (
        rows.withColumn("_rn", F.row_number().over(w))
        .withColumn("_ok", F.sum("_good").over(so_far))
        .withColumn("_last_ok", F.max(F.when(is_good, F.col("_rn"))).over(so_far))
    )

    # Per bucket: successes, and failures after the last one. Same keys as the window, so this
    # grouping needs no shuffle of its own.
    summary = local.groupBy(*keys, *PLACE).agg(
        F.sum("_good").alias("_n_ok"),
        (F.count(F.lit(1)) - F.coalesce(F.max(F.when(is_good, F.col("_rn"))), F.lit(0))).alias("_tail"),
    )
    carry = open_runs(summary, keys, PLACE)
    placed = local.join(carry, [*keys, *PLACE], "left")
    position = (
        F.col("_rn")
        - F.coalesce("_last_ok", F.lit(0))
        + F.when(F.col("_last_ok").isNull(), F.col("_open_before")).otherwise(0)
    )
    run = F.col("_ok_before") + F.col("_ok") - F.col("_good")
    bad_ts = F.when(~is_good, F.col("_ts"))
    at_limit = ~is_good & (position == limit_of(F.col(keys[-1]), limits))
    first_ones = [F.max(F.when(~is_good & (run == 0) & (position == i), F.col("_ts"))) for i in range(1, max(limits.values()) + 1)]
    lead = [F.array_compact(F.array(*first_ones)).alias("lead")] if leading else []
    return (
        placed.withColumn("run", run)
        .withColumn("_opens", F.when(at_limit, F.col("_ts")))
        .groupBy(*keys, "run")
        .agg(
            F.count_if(~is_good).alias("failures"),
            F.min(bad_ts).alias("first_failure"),
            F.max(bad_ts).alias("last_failure"),
            F.min("_opens").alias("opened_at"),
            F.min(F.when(is_good, F.col("_ts"))).alias("closed_at"),
            *lead,
        )
    )


def open_runs(summary: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """What every stretch of a key receives: successes before it, and the failures of the run it continues.

    ``summary(keys, place, _n_ok, _tail)`` has one row per stretch: its successes, and its failures after
    the last of them. Both combine from stretch to stretch.
    """
    order = Window.partitionBy(*keys).orderBy(*place)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    carry = summary.withColumns(
        {
            "_ok_before": F.coalesce(F.sum("_n_ok").over(before), F.lit(0)),
            "_segment": F.sum((F.col("_n_ok") > 0).cast("int")).over(up_to),
        }
    )
    open_after = F.sum("_tail").over(
        Window.partitionBy(*keys, "_segment").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    )
    return carry.withColumn("_open", open_after).select(
        *keys, *place, "_ok_before", F.coalesce(F.lag("_open").over(order), F.lit(0)).alias("_open_before")
    )


def outages(
    runs: DataFrame, keys: list[str] = BREAKER, timeouts: dict[str, int] | None = None
) -> DataFrame:
    """Outage episodes: open at the limit, half-open after the reset timeout.

    ``closed_at`` is the success that ended the run, NULL while the run is the last one.
    """
    timeouts = RESET_TIMEOUT_SEC if timeouts is None else timeouts
    return runs.filter(F.col("opened_at").isNotNull()).select(
        *keys,
        "run",
        "failures",
        "opened_at",
        add_seconds("opened_at", limit_of(F.col(keys[-1]), timeouts)).alias("half_open_at"),
        "last_failure",
        "closed_at",
    )
