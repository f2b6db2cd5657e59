"""Debt and rental changes with literal numbers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import T0, at, debts, payments, rental, rentals
from voltmart.operators import billing, ledger


def change(spark, *items, cols="rental_id string, amount int, now timestamp"):
    return spark.createDataFrame(list(items), cols)


def test_payment_measures(spark):
    p = payments(spark, ("r1", 100, True), ("r1", 200, True), ("r1", 300, False), ("r2", 5, False))
    r = rentals(spark, rental("r1"), rental("r2"), rental("r3"))
    assert rows(billing.total_paid(r, p)) == [("r1", 300), ("r2", 0), ("r3", 0)]
    assert rows(billing.payment_stats(p)) == [("r1", 3, 2, 300), ("r2", 1, 0, 0)]
    assert rows(billing.attempted_amounts(p)) == [("r1", 600), ("r2", 5)]
    assert [x["id"] for x in billing.payment_history(p).collect()] == [3, 2, 1, 4]
    only = spark.createDataFrame([("r1",)], "rental_id string")
    assert [x["id"] for x in billing.successful_payments(p, only).collect()] == [2, 1]


def test_debt_measures(spark):
    d = debts(spark, ("r1", 40, T0, 0, None), ("r2", 2, T0, 0, None))
    r = rentals(spark, rental("r1"), rental("r3"))
    assert rows(billing.current_debt(r, d)) == [("r1", 40), ("r3", 0)]
    assert billing.total_debt(d).first()[0] == 42
    assert billing.total_debt(d.limit(0)).first()[0] == 0


def test_attach_debt_creates_and_adds(spark):
    none = debts(spark)
    first = ledger.attach_debt(none, change(spark, ("r1", 50, at(0))))
    assert rows(first) == [("r1", 50, at(0), 0, None)]
    second = ledger.attach_debt(first, change(spark, ("r1", 70, at(60))))
    assert rows(second) == [("r1", 120, at(60), 0, None)]


def test_attach_debt_sums_deltas_and_keeps_others(spark):
    old = debts(spark, ("r1", 10, at(-5), 3, at(-9)), ("r2", 7, at(-5), 1, None))
    out = ledger.attach_debt(old, change(spark, ("r1", 5, at(1)), ("r1", 6, at(2)), ("r9", 1, at(3))))
    assert rows(out, "rental_id") == [
        ("r1", 21, at(2), 3, at(-9)),
        ("r2", 7, at(-5), 1, None),
        ("r9", 1, at(3), 0, None),
    ]


def test_add_debt_upsert(spark):
    d = debts(spark)
    for _ in range(2):
        d = ledger.add_debt(d, change(spark, ("r1", 50), cols="rental_id string, amount int"), F.lit(T0))
    assert rows(d) == [("r1", 100, T0, 0, None)]


def test_reduce_debt(spark):
    d = debts(spark, ("r1", 300, at(-1), 2, at(-1)))
    refused = ledger.reduce_debt(d, change(spark, ("r1", 400, T0)))
    assert rows(refused) == [("r1", 300, at(-1), 2, at(-1), False)]
    reduced = ledger.reduce_debt(d, change(spark, ("r1", 200, T0)))
    assert rows(reduced) == [("r1", 100, T0, 0, None, True)]
    gone = ledger.reduce_debt(d, change(spark, ("r1", 300, T0)))
    assert rows(gone)[0][1] == 0
    assert rows(ledger.reduce_debt(d, change(spark, ("r7", 1, T0))))[0][5] is False


def test_two_payments_of_one_debt_are_refused(spark):
    d = debts(spark, ("r1", 300, at(-1), 2, at(-1)))
    with pytest.raises(Exception, match="more than one payment"):
        ledger.reduce_debt(d, change(spark, ("r1", 200, T0), ("r1", 200, T0))).collect()


def test_increment_attempts(spark):
    d = debts(spark, ("r1", 70, at(-1), 0, None), ("r2", 1, at(-1), 4, at(-3)))
    f = change(spark, ("r1", T0), ("r8", T0), cols="rental_id string, now timestamp")
    assert rows(ledger.increment_attempts(d, f)) == [
        ("r1", 70, at(-1), 1, T0, True),
        ("r2", 1, at(-1), 4, at(-3), False),
    ]


def test_finish_twice(spark):
    ask = change(spark, ("r1", "FINISHED", T0), cols="rental_id string, status string, now timestamp")
    once = ledger.finish_rentals(rentals(spark, rental("r1"), rental("r2")), ask)
    got = {r["id"]: r for r in once.collect()}
    assert got["r1"]["changed"] and got["r1"]["status"] == "FINISHED" and got["r1"]["finished_at"] == T0
    assert not got["r2"]["changed"] and got["r2"]["status"] == "ACTIVE"
    again = ledger.finish_rentals(
        once.drop("changed"),
        change(spark, ("r1", "BUYOUT", at(9)), cols="rental_id string, status string, now timestamp"),
    ).filter("id = 'r1'").first()
    assert not again["changed"] and again["status"] == "FINISHED" and again["finished_at"] == T0


def test_add_to_totals(spark):
    r = rentals(spark, rental("r1", total=5), rental("r2", total=None), rental("r3", total=1))
    d = change(spark, ("r1", 10), ("r2", 3), ("r2", 4), ("zz", 1), cols="rental_id string, amount int")
    out = ledger.add_to_totals(r, d)
    assert rows(out.select("id", "total_amount", "changed")) == [("r1", 15, True), ("r2", 7, True), ("r3", 1, False)]
    assert rows(ledger.unknown_rentals(d, r)) == [("zz", 1)]
