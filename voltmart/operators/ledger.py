"""Keyed state changes of debts and rentals as joins.

Built-in Parquet tables have no MERGE. Each function returns the complete next version of
its table. Change frames are reduced to one row per key first, so keys are unique on both
sides of every join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import BillingConfig, backoff_seconds, retry_due

DEBT_COLUMNS = ["rental_id", "amount_total", "updated_at", "attempts", "last_attempt_at"]


def retry_states(debts: DataFrame, now: Column, cfg: BillingConfig) -> DataFrame:
    """Backoff and retry eligibility of every debt."""
    wait = backoff_seconds("attempts", cfg.debt_retry_base_sec, cfg.debt_retry_max_sec)
    return debts.select(
        "rental_id",
        "attempts",
        wait.alias("backoff_seconds"),
        retry_due("amount_total", "last_attempt_at", wait, now).alias("should_retry"),
    )


def attach_debt(debts: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add ``deltas(rental_id, amount, now)`` to debts, creating missing rows.

    New rows start with 0 attempts. Several deltas of one rental are summed before the join
    and stamped with the latest time.
    """
    add = deltas.groupBy(F.col("rental_id").alias("_k")).agg(
        F.sum("amount").alias("_add"), F.max("now").alias("_now")
    )
    joined = debts.join(add, debts.rental_id == F.col("_k"), "full_outer")
    old = F.coalesce(F.col("amount_total"), F.lit(0)).cast("bigint")
    return joined.select(
        F.coalesce("rental_id", "_k").alias("rental_id"),
        (old + F.coalesce("_add", F.lit(0))).cast("int").alias("amount_total"),
        F.coalesce("_now", "updated_at").alias("updated_at"),
        F.when(F.col("rental_id").isNull(), 0).otherwise(F.col("attempts")).cast("int").alias("attempts"),
        "last_attempt_at",
    )


def add_debt(debts: DataFrame, deltas: DataFrame, now: Column) -> DataFrame:
    """The same with one time for all deltas."""
    return attach_debt(debts, deltas.withColumn("now", now))


def reduce_debt(debts: DataFrame, payments: DataFrame) -> DataFrame:
    """Take ``payments(rental_id, amount, now)`` off debts that cover them.

    A success resets the attempts; a row at 0 stays. The extra column ``changed`` tells which
    rows were reduced. Which of several payments a debt covers depends on their order, so two
    payments of one rental in one call are an error.
    """
    pay = payments.groupBy(F.col("rental_id").alias("_k")).agg(
        F.sum("amount").alias("_sub"), F.max("now").alias("_now"), F.count(F.lit(1)).alias("_n")
    )
    twice = F.raise_error(F.concat(F.lit("more than one payment for rental "), F.col("_k")))
    pay = pay.withColumn("_sub", F.when(F.col("_n") == 1, F.col("_sub")).otherwise(twice.cast("bigint"))).drop("_n")
    joined = debts.join(pay, debts.rental_id == F.col("_k"), "left")
    hit = F.coalesce(F.col("amount_total") >= F.col("_sub"), F.lit(False))
    return joined.select(
        "rental_id",
        F.when(hit, F.col("amount_total") - F.col("_sub")).otherwise(F.col("amount_total")).cast("int")
        .alias("amount_total"),
        F.when(hit, F.col("_now")).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(hit, 0).otherwise(F.col("attempts")).cast("int").alias("attempts"),
        F.when(~hit, F.col("last_attempt_at")).alias("last_attempt_at"),
        hit.alias("changed"),
    )


def increment_attempts(debts: DataFrame, failures: DataFrame) -> DataFrame:
    """Count ``failures(rental_id, now)`` on existing debts and stamp the time."""
    bad = failures.groupBy(F.col("rental_id").alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("now").alias("_now")
    )
    joined = debts.join(bad, debts.rental_id == F.col("_k"), "left")
    n = F.coalesce(F.col("attempts"), F.lit(0)) + F.col("_n")
    return joined.select(
        "rental_id",
        "amount_total",
        "updated_at",
        F.when(F.col("_n").isNotNull(), n).otherwise(F.col("attempts")).cast("int").alias("attempts"),
        F.coalesce("_now", "last_attempt_at").alias("last_attempt_at"),
        F.col("_n").isNotNull().alias("changed"),
    )


def finish_rentals(rentals: DataFrame, requests: DataFrame) -> DataFrame:
    """Give ACTIVE rentals the status of ``requests(rental_id, status, now)``.

    The first request of a rental wins; other rentals stay. ``changed`` marks the winners.
    """
    first = requests.groupBy(F.col("rental_id").alias("_k")).agg(
        F.min(F.struct("now", "status")).alias("_r")
    )
    joined = rentals.join(first, rentals.id == F.col("_k"), "left")
    hit = (F.col("status") == "ACTIVE") & F.col("_k").isNotNull()
    return joined.withColumns(
        {
            "changed": hit,
            "finished_at": F.when(hit, F.col("_r.now")).otherwise(F.col("finished_at")),
            "status": F.when(hit, F.col("_r.status")).otherwise(F.col("status")),
        }
    ).drop("_k", "_r")


def add_to_totals(rentals: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add the summed ``deltas(rental_id, amount)`` to rental totals, NULL counting as 0."""
    add = deltas.groupBy(F.col("rental_id").alias("_k")).agg(F.sum("amount").alias("_add"))
    joined = rentals.join(add, rentals.id == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    total = F.coalesce(F.col("total_amount"), F.lit(0)) + F.col("_add")
    return joined.withColumns(
        {
            "total_amount": F.when(hit, total).otherwise(F.col("total_amount")).cast("int"),
            "changed": hit,
        }
    ).drop("_k", "_add")


def unknown_rentals(deltas: DataFrame, rentals: DataFrame) -> DataFrame:
    """Changes whose rental does not exist: the ``False`` answers of G24."""
    return deltas.join(rentals.select(F.col("id").alias("rental_id")), "rental_id", "left_anti")
