"""One billing tick over all active rentals as a single select chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import BillingConfig, amount_due, backoff_seconds, charge_amount, retry_due
from voltmart.operators.billing import active_rentals, with_exposure
from voltmart.session import cut_lineage

# Branches of a tick, in the order they are tried.
BUYOUT, USAGE, DEBT, NOTHING = "buyout", "usage", "debt", "none"
# A rental whose amounts would leave the integer range is left alone and reported.
OVERFLOW = "overflow"
MOST = 2**31 - 1
NO_ANSWER = "No answer from the payment service"


@dataclass(frozen=True)
class Tick:
    """Everything one tick produces."""

    decisions: DataFrame
    attempts: DataFrame
    rentals: DataFrame
    debts: DataFrame
    summary: DataFrame
    rejects: DataFrame


def invalid_reason() -> Column:
    """Why a rental cannot be billed; NULL when it can."""
    return (
        F.when(F.col("price_per_hour").isNull(), "price_per_hour is missing")
        .when(F.col("free_period_min").isNull(), "free_period_min is missing")
        .when(F.col("id").isNull(), "id is missing")
    )


def split_valid(rentals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Billable rentals, and the others with the reason; neither stops the tick."""
    reasoned = rentals.withColumn("reason", invalid_reason())
    return (
        reasoned.filter(F.col("reason").isNull()).drop("reason"),
        reasoned.filter(F.col("reason").isNotNull()),
    )


def charge_plan(exposed: DataFrame, now: Column, cfg: BillingConfig) -> DataFrame:
    """Branch and planned amount per rental (G12, G13, and the debt step of G18)."""
    wait = backoff_seconds("debt_attempts", cfg.debt_retry_base_sec, cfg.debt_retry_max_sec)
    return (
        exposed.withColumn("now_ts", now)
        .withColumn("due", amount_due("price_per_hour", "free_period_min", "started_at", F.col("now_ts")))
        .withColumn("to_charge", charge_amount(F.col("due"), F.col("exposure"), cfg.r_buyout))
        .withColumn("retry", retry_due("debt_amount", "last_attempt_at", wait, F.col("now_ts")))
        .withColumn(
            "branch",
            F.when(F.col("exposure") >= cfg.r_buyout, BUYOUT)
            .when(F.col("to_charge") > 0, USAGE)
            .when(F.col("retry"), DEBT)
            .otherwise(NOTHING),
        )
        .withColumn(
            "branch",
            F.when(
                (F.col("branch") == USAGE)
                & (
                    F.col("to_charge").cast("bigint")
                    + F.greatest(F.coalesce("total_amount", F.lit(0)), F.coalesce("debt_amount", F.lit(0)))
                    > MOST
                ),
                OVERFLOW,
            ).otherwise(F.col("branch")),
        )
        .withColumn(
            "attempt_amount",
            F.when(F.col("branch") == USAGE, F.col("to_charge"))
            .when(F.col("branch") == DEBT, F.least(F.col("debt_amount"), F.lit(cfg.debt_charge_step)))
            .otherwise(F.lit(0))
            .cast("bigint"),
        )
    )


def decide(planned: DataFrame, outcomes: DataFrame, cfg: BillingConfig) -> DataFrame:
    """Apply the payment answers to the plan.

    ``outcomes(rental_id, success, error)`` holds one answer per rental; no answer is a
    failure with an error text.
    """
    answer = outcomes.select(
        F.col("rental_id").alias("_o"), F.col("success").alias("_ok"), F.col("error").alias("_err")
    )
    joined = planned.join(answer, planned.id == F.col("_o"), "left")
    tried = F.col("branch").isin(USAGE, DEBT)
    ok = tried & F.coalesce(F.col("_ok"), F.lit(False))
    amount, zero = F.col("attempt_amount"), F.lit(0).cast("bigint")
    return (
        joined.withColumn("success", F.when(tried, ok))
        .withColumn("error", F.when(tried & ~ok, F.coalesce("_err", F.lit(NO_ANSWER))))
        .withColumn("charged_amount", F.when(ok, amount).otherwise(zero))
        .withColumn(
            "debt_delta",
            F.when((F.col("branch") == USAGE) & ~ok, amount)
            .when((F.col("branch") == DEBT) & ok, -amount)
            .otherwise(zero),
        )
        .withColumn(
            "bought_out",
            (F.col("branch") != OVERFLOW)
            & (F.col("exposure") + F.col("charged_amount") + F.col("debt_delta") >= cfg.r_buyout),
        )
        .drop("_o", "_ok", "_err")
    )


def decisions(
    rentals: DataFrame,
    payments: DataFrame,
    debts: DataFrame,
    outcomes: DataFrame,
    now: Column,
    cfg: BillingConfig,
) -> DataFrame:
    """One row per billable active rental; ``now`` may use any rental column."""
    good, _ = split_valid(active_rentals(rentals))
    return decide(charge_plan(with_exposure(good, payments, debts), now, cfg), outcomes, cfg)


def attempt_rows(decided: DataFrame) -> DataFrame:
    """New payment attempts. ``(rental_id, created_at)`` identifies them: one per tick."""
    return decided.filter(F.col("branch").isin(USAGE, DEBT)).select(
        F.col("id").alias("rental_id"),
        F.col("attempt_amount").cast("int").alias("amount"),
        "success",
        "error",
        F.col("now_ts").alias("created_at"),
    )


def rentals_after(rentals: DataFrame, decided: DataFrame) -> DataFrame:
    """Next version of the rentals; untouched rows pass through without a join."""
    billed = decided.withColumns(
        {
            "total_amount": (F.coalesce("total_amount", F.lit(0)) + F.col("charged_amount")).cast("int"),
            "finished_at": F.when(F.col("bought_out"), F.col("now_ts")).otherwise(F.col("finished_at")),
            "status": F.when(F.col("bought_out"), F.lit("BUYOUT")).otherwise(F.col("status")),
        }
    ).select(*rentals.columns)
    idle = (F.coalesce(F.col("status"), F.lit("")) != "ACTIVE") | invalid_reason().isNotNull()
    return rentals.filter(idle).unionByName(billed)


def debts_after(debts: DataFrame, decided: DataFrame) -> DataFrame:
    """Next version of the debts: usage failures add, collections reduce or count a retry."""
    usage_failed = (F.col("branch") == USAGE) & ~F.col("success")
    effects = decided.filter(usage_failed | (F.col("branch") == DEBT)).select(
        F.col("id").alias("_k"),
        F.col("debt_delta").alias("_delta"),
        F.col("now_ts").alias("_now"),
        usage_failed.alias("_add"),
        F.col("success").alias("_ok"),
    )
    joined = debts.join(effects, debts.rental_id == F.col("_k"), "full_outer")
    add = F.coalesce(F.col("_add"), F.lit(False))
    paid = F.coalesce(F.col("_ok"), F.lit(False))
    retried = F.col("_k").isNotNull() & ~add & ~paid
    fresh = F.col("rental_id").isNull()
    old = F.coalesce(F.col("amount_total"), F.lit(0)).cast("bigint")
    return joined.select(
        F.coalesce("rental_id", "_k").alias("rental_id"),
        (old + F.coalesce("_delta", F.lit(0))).cast("int").alias("amount_total"),
        F.when(add | paid, F.col("_now")).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(paid | fresh, 0)
        .when(retried, F.coalesce(F.col("attempts"), F.lit(0)) + 1)
        .otherwise(F.col("attempts"))
        .cast("int")
        .alias("attempts"),
        F.when(retried, F.col("_now")).when(~paid, F.col("last_attempt_at")).alias("last_attempt_at"),
    )


def summarize(rentals: DataFrame, decided: DataFrame) -> DataFrame:
    """Active rentals, total charged and net debt change.

    The active count includes rejected rows, so it comes from the rentals as a scalar.
    """
    active = active_rentals(rentals).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return decided.agg(
        F.coalesce(F.sum("charged_amount"), zero).alias("total_charged"),
        F.coalesce(F.sum("debt_delta"), zero).alias("total_debt_delta"),
    ).select(active.scalar().alias("active_rentals"), "total_charged", "total_debt_delta")


def run_tick(
    rentals: DataFrame,
    payments: DataFrame,
    debts: DataFrame,
    outcomes: DataFrame,
    now: Column,
    cfg: BillingConfig = BillingConfig(),
    reuse: bool = True,
) -> Tick:
    """All outputs of a tick.

    With ``reuse`` the decisions are checkpointed once, because every output reads them;
    they hold active rentals only, a small part of the table.
    """
    decided = decisions(rentals, payments, debts, outcomes, now, cfg)
    if reuse:
        decided = cut_lineage(decided)
    _, rejects = split_valid(active_rentals(rentals))
    return Tick(
        decisions=decided,
        attempts=attempt_rows(decided),
        rentals=rentals_after(rentals, decided),
        debts=debts_after(debts, decided),
        summary=summarize(rentals, decided),
        rejects=rejects.select("id", "reason").union(
            decided.filter(F.col("branch") == OVERFLOW).select("id", F.lit("amount is out of range").alias("reason"))
        ),
    )


def charge_requests(requests: DataFrame, rentals: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Charge ``requests(rental_id, amount)`` one by one, outside a tick.

    A non-positive amount succeeds without an attempt; an unknown rental fails without one.
    """
    known = rentals.select(F.col("id").alias("rental_id"), F.lit(True).alias("_known"))
    joined = requests.join(known, "rental_id", "left").join(
        outcomes.select("rental_id", F.col("success").alias("_ok"), F.col("error").alias("_err")),
        "rental_id",
        "left",
    )
    noop = F.col("amount") <= 0
    known_c = F.coalesce(F.col("_known"), F.lit(False))
    answered = F.coalesce(F.col("_ok"), F.lit(False))
    missing = F.concat(F.lit("Rental "), F.col("rental_id"), F.lit(" not found"))
    success = noop | (known_c & answered)
    return joined.select(
        "rental_id",
        "amount",
        success.alias("success"),
        F.when(~noop & ~known_c, missing)
        .when(~success, F.coalesce("_err", F.lit(NO_ANSWER)))
        .alias("error"),
        (~noop & known_c).alias("attempt_recorded"),
        F.when(success & ~noop, F.col("amount")).otherwise(0).cast("bigint").alias("rental_delta"),
        F.when(~success, F.col("amount")).otherwise(0).cast("bigint").alias("debt_delta"),
    )
