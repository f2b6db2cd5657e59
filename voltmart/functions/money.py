"""Billing arithmetic on unit-less integers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltmart.functions.time import MICROS, col, div, micros_between, whole_seconds_between


@dataclass(frozen=True)
class BillingConfig:
    """The billing defaults."""

    r_buyout: int = 5000
    debt_charge_step: int = 100
    debt_retry_base_sec: int = 60
    debt_retry_max_sec: int = 3600
    billing_tick_sec: int = 30


def amount_due(price: Column | str, free_min: Column | str, started: Column | str, now: Column) -> Column:
    """Hourly price on the seconds past the free period, rounded up; 0 without a start.

    The ceiling is integer arithmetic, so no amount is rounded through a float.
    """
    seconds = whole_seconds_between(started, now) - col(free_min).cast("bigint") * 60
    billable = F.greatest(F.lit(0).cast("bigint"), seconds)
    due = div(col(price).cast("bigint") * billable + 3599, 3600)
    return F.when(col(started).isNull(), F.lit(0).cast("bigint")).otherwise(due)


def charge_amount(due: Column, exposure: Column, r_buyout: int) -> Column:
    """What a tick may charge: unbilled usage, no further than the buyout limit."""
    zero = F.lit(0).cast("bigint")
    return F.least(F.greatest(zero, due - exposure), F.greatest(zero, F.lit(r_buyout) - exposure))


def backoff_seconds(attempts: Column | str, base: int, maximum: int) -> Column:
    """``base * 2^attempts`` capped at ``maximum``; the exponent stops at 8."""
    exponent = F.least(F.coalesce(col(attempts), F.lit(0)).cast("int"), F.lit(8))
    power = F.element_at(F.array(*[F.lit(1 << i).cast("bigint") for i in range(9)]), exponent + 1)
    return F.least(power * F.lit(base), F.lit(maximum).cast("bigint"))


def retry_due(
    debt: Column | str, last_attempt: Column | str, backoff: Column, now: Column
) -> Column:
    """Positive debt that was never tried, or whose backoff has elapsed. Never NULL."""
    waited = micros_between(last_attempt, now) >= backoff * F.lit(MICROS)
    return F.coalesce(col(debt) > 0, F.lit(False)) & (col(last_attempt).isNull() | waited)


def minutes_to_buyout(price: Column | str, free_min: Column | str, r_buyout: int) -> Column:
    """Estimated minutes until usage passes the buyout limit, with a 1.5 safety factor."""
    floor_price = F.greatest(col(price).cast("int"), F.lit(1))
    minutes = (F.lit(r_buyout * 1.5) / floor_price * F.lit(60)).cast("bigint")
    free = col(free_min).cast("bigint")
    return F.greatest(free + minutes, free + 10)


def quote_deposit(default_deposit: Column | str, trusted: Column | str) -> Column:
    """Trusted users pay half the deposit, rounded down, never below zero."""
    base = col(default_deposit)
    half = F.greatest(F.lit(0), F.floor(base / F.lit(2)).cast("int"))
    return F.when(F.coalesce(col(trusted), F.lit(False)), half).otherwise(base)


def deposit_refund(deposit: Column | str, total: Column | str, debt: Column | str) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), col(deposit) - (col(total) + col(debt)))


def round_half_away(numerator: Column, denominator: Column) -> Column:
    """Exact ``round(numerator / denominator)`` for a positive denominator."""
    two = F.lit(2)
    size = div(two * F.abs(numerator) + denominator, two * denominator)
    return F.when(numerator < 0, -size).otherwise(size)


def average_minutes(total_micros: Column, n: Column) -> Column:
    """Mean of microsecond durations as minutes in ``decimal(12,2)``, exact half-up.

    Works in integer hundredths of a minute on decimals, because a double average rounds
    differently from one engine to the next.
    """
    total = total_micros.cast("decimal(30,0)") * F.lit(100).cast("decimal(3,0)")
    width = n.cast("decimal(18,0)") * F.lit(60 * MICROS).cast("decimal(8,0)")
    hundredths = round_half_away(total, width)
    return F.when(n > 0, (hundredths.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)"))).cast("decimal(12,2)")
