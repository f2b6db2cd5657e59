"""Billing measures per rental.

Payments are always reduced per rental before they meet another table: the sums combine
before the shuffle, so a rental with very many attempts never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import amount_due, minutes_to_buyout


def active_rentals(rentals: DataFrame) -> DataFrame:
    return rentals.filter(F.col("status") == "ACTIVE")


def amounts_due(rentals: DataFrame, now: Column) -> DataFrame:
    """Amount due per rental at ``now``, a column of the frame or a literal."""
    due = amount_due("price_per_hour", "free_period_min", "started_at", now)
    return rentals.select(F.col("id").alias("rental_id"), due.alias("due_amount"))


def paid_totals(payments: DataFrame) -> DataFrame:
    """Sum of successful payments per rental that has one."""
    return (
        payments.filter(F.col("success")).groupBy("rental_id").agg(F.sum("amount").alias("paid"))
    )


def total_paid(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Total paid for every rental, 0 without a successful payment."""
    return rentals.select(F.col("id").alias("rental_id")).join(
        paid_totals(payments), "rental_id", "left"
    ).select("rental_id", F.coalesce("paid", F.lit(0)).alias("paid"))


def payment_history(payments: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """All attempts, newest first within a rental (G4); ``of`` limits it to some rentals.

    A global sort: its range partitions split on time and id too, so the attempts of one
    rental may spread over many tasks.
    """
    rows = payments if of is None else payments.join(of.select("rental_id"), "rental_id", "left_semi")
    return rows.orderBy("rental_id", F.desc("created_at"), F.desc("id"))


def successful_payments(payments: DataFrame, of: DataFrame | None = None) -> DataFrame:
    return payment_history(payments.filter(F.col("success")), of)


def current_debt(rentals: DataFrame, debts: DataFrame) -> DataFrame:
    """Debt of every rental, 0 without a debt row."""
    return (
        rentals.select(F.col("id").alias("rental_id"))
        .join(debts.select("rental_id", "amount_total"), "rental_id", "left")
        .select("rental_id", F.coalesce("amount_total", F.lit(0)).alias("debt"))
    )


def total_debt(debts: DataFrame) -> DataFrame:
    return debts.agg(F.coalesce(F.sum("amount_total"), F.lit(0)).alias("total_debt"))


def payment_stats(payments: DataFrame) -> DataFrame:
    """Attempts, successes and successful amount per rental."""
    return payments.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("attempts_total"),
        F.count_if("success").alias("attempts_ok"),
        F.sum(F.when(F.col("success"), F.col("amount")).otherwise(0)).alias("amount_sum"),
    )


def attempted_amounts(payments: DataFrame) -> DataFrame:
    """Sum of all attempts per rental, successful or not."""
    return payments.groupBy("rental_id").agg(F.sum("amount").alias("attempted_amount"))


def buyout_minutes(quotes: DataFrame, r_buyout: int) -> DataFrame:
    """Estimated minutes until a rental on this quote is bought out."""
    return quotes.select(
        F.col("id").alias("quote_id"),
        minutes_to_buyout("price_per_hour", "free_period_min", r_buyout).alias("minutes_needed"),
    )


def with_exposure(rentals: DataFrame, payments: DataFrame, debts: DataFrame) -> DataFrame:
    """Rentals with what is paid, what is owed and their sum.

    Both joined frames have one row per rental; all three are shuffled on the rental id.
    """
    owed = debts.select(
        F.col("rental_id").alias("_d"),
        F.col("amount_total").cast("bigint").alias("debt_amount"),
        F.coalesce("attempts", F.lit(0)).alias("debt_attempts"),
        "last_attempt_at",
    )
    paid = paid_totals(payments).withColumnRenamed("rental_id", "_p")
    out = rentals.join(paid, rentals.id == F.col("_p"), "left").join(owed, rentals.id == F.col("_d"), "left")
    zero = F.lit(0).cast("bigint")
    return (
        out.withColumn("has_debt_row", F.col("_d").isNotNull())
        .withColumn("paid", F.coalesce("paid", zero))
        .withColumn("debt_amount", F.coalesce("debt_amount", zero))
        .withColumn("exposure", F.col("paid") + F.col("debt_amount"))
        .drop("_p", "_d")
    )
