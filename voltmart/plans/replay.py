"""Many ticks over evolving rental state in one pass (G27, batch form).

Ticks of one rental depend on each other, rentals do not. Each rental's ticks are gathered
in order and folded over its state with a higher-order function, all inside the JVM. That is done
for PIECE tick numbers at a time, with the states carried from piece to piece, so an array
holds at most PIECE entries however many ticks are replayed; copies of a tick are removed before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import BillingConfig, amount_due, backoff_seconds, charge_amount, retry_due
from voltmart.operators.billing import active_rentals, with_exposure
from voltmart.plans.billing_tick import split_valid
from voltmart.session import cut_lineage

PIECE = 10_000  # tick numbers folded together

STATE = (
    "struct<status:string,finished_at:timestamp,price:int,free_min:int,started_at:timestamp,paid:bigint,"
    "debt:bigint,attempts:int,last_attempt_at:timestamp,charged:bigint,n_attempts:bigint,tick:int>"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a computed value inside one expression, so it is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ordered_ticks(ticks: DataFrame) -> DataFrame:
    """``ticks(rental_id, tick, now_ts, success)`` to one ordered array per rental."""
    single = ticks.groupBy("rental_id", "tick").agg(
        F.min("now_ts").alias("now_ts"), F.min(F.coalesce("success", F.lit(False))).alias("ok")
    )
    return single.groupBy("rental_id").agg(
        F.sort_array(F.collect_list(F.struct("tick", "now_ts", "ok"))).alias("ticks")
    )


def tick_step(state: Column, tick: Column, cfg: BillingConfig) -> Column:
    """State of one rental after one tick; a rental that is not ACTIVE stays as it is."""
    wait = backoff_seconds(state["attempts"], cfg.debt_retry_base_sec, cfg.debt_retry_max_sec)
    due = amount_due(state["price"], state["free_min"], state["started_at"], tick["now_ts"])
    exposure = state["paid"] + state["debt"]
    plan = F.struct(
        exposure.alias("exposure"),
        charge_amount(due, exposure, cfg.r_buyout).alias("usage"),
        F.when(
            retry_due(state["debt"], state["last_attempt_at"], wait, tick["now_ts"]),
            F.least(state["debt"], F.lit(cfg.debt_charge_step).cast("bigint")),
        )
        .otherwise(F.lit(0).cast("bigint"))
        .alias("collect"),
    )

    def apply(p: Column) -> Column:
        open_ = p["exposure"] < cfg.r_buyout
        usage = open_ & (p["usage"] > 0)
        collect = open_ & (p["usage"] == 0) & (p["collect"] > 0)
        amount = F.when(usage, p["usage"]).when(collect, p["collect"]).otherwise(F.lit(0).cast("bigint"))
        paid = F.when(tick["ok"], amount).otherwise(F.lit(0).cast("bigint"))
        delta = (
            F.when(usage & ~tick["ok"], amount)
            .when(collect & tick["ok"], -amount)
            .otherwise(F.lit(0).cast("bigint"))
        )
        bought_out = p["exposure"] + paid + delta >= cfg.r_buyout
        reset, failed = collect & tick["ok"], collect & ~tick["ok"]
        return F.struct(
            F.when(bought_out, F.lit("BUYOUT")).otherwise(state["status"]).alias("status"),
            F.when(bought_out, tick["now_ts"]).otherwise(state["finished_at"]).alias("finished_at"),
            state["price"].alias("price"),
            state["free_min"].alias("free_min"),
            state["started_at"].alias("started_at"),
            (state["paid"] + paid).alias("paid"),
            (state["debt"] + delta).alias("debt"),
            F.when(reset, F.lit(0)).when(failed, state["attempts"] + 1).otherwise(state["attempts"])
            .alias("attempts"),
            F.when(failed, tick["now_ts"]).when(~reset, state["last_attempt_at"]).alias("last_attempt_at"),
            (state["charged"] + paid).alias("charged"),
            (state["n_attempts"] + (usage | collect).cast("bigint")).alias("n_attempts"),
            tick["tick"].alias("tick"),
        )

    # A tick that was billed before changes nothing, so a batch may be repeated.
    due_now = (state["status"] == "ACTIVE") & (tick["tick"] > state["tick"])
    return F.when(due_now, let(plan, apply)).otherwise(state)


def opening_state(rentals: DataFrame, payments: DataFrame, debts: DataFrame) -> DataFrame:
    """``(rental_id, state)`` of every billable active rental before the first tick."""
    good, _ = split_valid(active_rentals(rentals))
    zero = F.lit(0).cast("bigint")
    return with_exposure(good, payments, debts).select(
        F.col("id").alias("rental_id"),
        F.struct(
            "status",
            "finished_at",
            F.col("price_per_hour").alias("price"),
            F.col("free_period_min").alias("free_min"),
            "started_at",
            "paid",
            F.col("debt_amount").alias("debt"),
            F.coalesce("debt_attempts", F.lit(0)).alias("attempts"),
            "last_attempt_at",
            zero.alias("charged"),
            zero.alias("n_attempts"),
            F.lit(-1).alias("tick"),
        ).cast(STATE).alias("state"),
    )


RESULT_FIELDS = [
    "status", "finished_at", "paid", "debt", "attempts", "last_attempt_at", "charged", "n_attempts",
]


def _fold_piece(states: DataFrame, ticks: DataFrame, cfg: BillingConfig) -> DataFrame:
    joined = states.join(ordered_ticks(ticks), "rental_id", "left")
    final = F.aggregate("ticks", F.col("state"), lambda s, t: tick_step(s, t, cfg))
    return joined.select(
        "rental_id", F.when(F.col("ticks").isNull(), F.col("state")).otherwise(final).alias("state")
    )


def fold_ticks(states: DataFrame, ticks: DataFrame, cfg: BillingConfig, piece: int = PIECE) -> DataFrame:
    """``(rental_id, state)`` after the given ticks; rentals without a tick stay as they are.

    Pieces without a tick are passed over; the driver sees the numbers of the others.
    """
    number = F.floor(F.col("tick") / piece)
    pieces = sorted(r["p"] for r in ticks.select(number.alias("p")).distinct().collect() if r["p"] is not None)
    for p in pieces[:-1]:
        states = cut_lineage(_fold_piece(states, ticks.filter(number == p), cfg))
    return _fold_piece(states, ticks.filter(number == pieces[-1]), cfg) if pieces else states


def flat_states(states: DataFrame) -> DataFrame:
    return states.select("rental_id", *[F.col(f"state.{f}").alias(f) for f in RESULT_FIELDS])


def replay_ticks(
    rentals: DataFrame,
    payments: DataFrame,
    debts: DataFrame,
    ticks: DataFrame,
    cfg: BillingConfig = BillingConfig(),
) -> DataFrame:
    """Final state of every active rental after all its ticks."""
    return flat_states(fold_ticks(opening_state(rentals, payments, debts), ticks, cfg))
