"""Billing arithmetic: literal cases and boundaries."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import DEBT_COLS, T0, at, rental, rentals
from voltmart.functions import money
from voltmart.functions.money import BillingConfig
from voltmart.operators import billing, ledger

CFG = BillingConfig()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "price, free, seconds, due",
    [
        (360, 5, 300, 0),
        (360, 5, 600, 30),
        (60, 0, 90, 2),
        (60, 5, 420, 2),
        (60, 0, -50, 0),
        (60, 0, 0.999, 0),
        (60, 0, 1, 1),
    ],
)
def test_amount_due(spark, price, free, seconds, due):
    df = billing.amounts_due(rentals(spark, rental(price=price, free=free)), F.lit(at(seconds)))
    assert df.first()["due_amount"] == due


def test_amount_due_without_start(spark):
    df = billing.amounts_due(rentals(spark, rental(started=None)), F.lit(T0))
    assert df.first()["due_amount"] == 0


def test_amount_due_does_not_overflow_int(spark):
    df = billing.amounts_due(rentals(spark, rental(price=2_000_000_000, free=0)), F.lit(T0 + dt.timedelta(days=3650)))
    assert df.first()["due_amount"] == 2_000_000_000 * 24 * 3650


@pytest.mark.parametrize("attempts, base, top, seconds", [
    (0, 60, 600, 60), (1, 60, 600, 120), (4, 60, 600, 600), (8, 60, 3600, 3600), (50, 1, 10**6, 256), (None, 60, 600, 60),
])
def test_backoff(spark, attempts, base, top, seconds):
    assert one(spark, money.backoff_seconds(F.lit(attempts).cast("int"), base, top)) == seconds


@pytest.mark.parametrize(
    "amount, last, expected",
    [
        (0, None, False),
        (-5, None, False),
        (50, None, True),
        (50, at(-60), True),
        (50, at(-59.999999), False),
        (50, at(10), False),
    ],
)
def test_retry_due(spark, amount, last, expected):
    df = spark.createDataFrame([("r", amount, T0, 0, last)], DEBT_COLS)
    assert ledger.retry_states(df, F.lit(T0), CFG).first()["should_retry"] is expected


@pytest.mark.parametrize(
    "due, exposure, charge",
    [(100, 0, 100), (100, 100, 0), (100, 150, 0), (9000, 0, 5000), (9000, 4999, 1), (9000, 5000, 0), (9000, 5001, 0)],
)
def test_charge_amount(spark, due, exposure, charge):
    assert one(spark, money.charge_amount(F.lit(due), F.lit(exposure), 5000)) == charge


@pytest.mark.parametrize("price, free, minutes", [(60, 0, 7500), (0, 5, 450005), (10**9, 3, 13), (7, 0, 64285)])
def test_minutes_to_buyout(spark, price, free, minutes):
    assert one(spark, money.minutes_to_buyout(F.lit(price), F.lit(free), 5000)) == minutes


@pytest.mark.parametrize("deposit, trusted, paid", [(301, True, 150), (301, False, 301), (301, None, 301), (-3, True, 0)])
def test_quote_deposit(spark, deposit, trusted, paid):
    assert one(spark, money.quote_deposit(F.lit(deposit), F.lit(trusted).cast("boolean"))) == paid


@pytest.mark.parametrize("total, debt, refund", [(100, 50, 350), (400, 100, 0), (900, 0, 0)])
def test_deposit_refund(spark, total, debt, refund):
    assert one(spark, money.deposit_refund(F.lit(500), F.lit(total), F.lit(debt))) == refund


@settings(max_examples=40, deadline=None, derandomize=True)
@given(total=st.integers(-5 * 10**17, 5 * 10**17), n=st.integers(1, 10**9))
def test_average_minutes_is_exact_half_up(spark, total, n):
    got = one(spark, money.average_minutes(F.lit(decimal.Decimal(total)).cast("decimal(20,0)"), F.lit(n).cast("bigint")))
    exact = decimal.Context(prec=60).divide(decimal.Decimal(total), decimal.Decimal(60_000_000 * n))
    wanted = exact.quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP, context=decimal.Context(prec=60))
    assert got == wanted


def test_average_minutes_without_rows(spark):
    assert one(spark, money.average_minutes(F.lit(None).cast("decimal(20,0)"), F.lit(0).cast("bigint"))) is None
