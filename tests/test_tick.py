"""Billing ticks: branches, boundaries, invariants, replay and stream equality."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import PAYMENT_COLS, T0, at, debts, land, payments, rental, rentals
from voltmart.functions.money import BillingConfig
from voltmart.plans import billing_tick, replay
from voltmart.plans.billing_tick import run_tick
from voltmart.session import scratch_path
from voltmart.streaming import billing as stream_billing
from voltmart.streaming.run import folder_stream

OUT = "rental_id string, success boolean, error string"


def tick(spark, rental_rows, payment_rows=(), debt_rows=(), answers=(), now=at(3600), cfg=BillingConfig()):
    return run_tick(
        rentals(spark, *rental_rows), payments(spark, *payment_rows), debts(spark, *debt_rows),
        spark.createDataFrame(list(answers), OUT), F.lit(now), cfg,
    )


def summary(t):
    return tuple(t.summary.first())


def test_new_usage_is_charged(spark):
    t = tick(spark, [rental(price=60, free=0)], answers=[("r1", True, None)])
    assert summary(t) == (1, 60, 0)
    assert rows(t.attempts) == [("r1", 60, True, None, at(3600))]
    assert t.rentals.first()["total_amount"] == 60
    assert t.debts.count() == 0


def test_failed_usage_becomes_debt(spark):
    t = tick(spark, [rental(price=60, free=0)], answers=[("r1", False, "declined")])
    assert summary(t) == (1, 0, 60)
    assert rows(t.attempts) == [("r1", 60, False, "declined", at(3600))]
    assert rows(t.debts) == [("r1", 60, at(3600), 0, None)]


def test_no_answer_is_a_failure(spark):
    t = tick(spark, [rental(price=60, free=0)])
    attempt = t.attempts.first()
    assert attempt["success"] is False and "No answer" in attempt["error"]


def test_debt_collection_success(spark):
    old = [("r1", 250, at(-7200), 2, at(-7200))]
    t = tick(spark, [rental(price=60, free=0, total=7)], debt_rows=old, answers=[("r1", True, None)], now=at(60))
    assert summary(t) == (1, 100, -100)
    assert rows(t.debts) == [("r1", 150, at(60), 0, None)]
    assert t.rentals.first()["total_amount"] == 107


def test_debt_collection_failure(spark):
    old = [("r1", 70, at(-7200), 0, at(-7200))]
    t = tick(spark, [rental(price=60, free=0)], debt_rows=old, answers=[("r1", False, "x")], now=at(60))
    assert summary(t) == (1, 0, 0)
    assert rows(t.debts) == [("r1", 70, at(-7200), 1, at(60))]
    assert rows(t.attempts) == [("r1", 70, False, "x", at(60))]


def test_debt_in_backoff_is_left(spark):
    old = [("r1", 70, at(-7200), 3, at(0))]
    t = tick(spark, [rental(price=60, free=0)], debt_rows=old, answers=[("r1", True, None)], now=at(60))
    assert summary(t) == (1, 0, 0) and t.attempts.count() == 0


def test_debt_waits_while_usage_is_charged(spark):
    old = [("r1", 30, at(-7200), 0, None)]
    t = tick(spark, [rental(price=60, free=0)], debt_rows=old, answers=[("r1", True, None)])
    assert t.decisions.first()["branch"] == "usage"
    assert summary(t) == (1, 30, 0)


@pytest.mark.parametrize("paid, branch, status", [(4999, "usage", "BUYOUT"), (5000, "buyout", "BUYOUT"), (5001, "buyout", "BUYOUT")])
def test_buyout_boundary(spark, paid, branch, status):
    t = tick(spark, [rental(price=60000, free=0)], [("r1", paid, True)], answers=[("r1", True, None)])
    d = t.decisions.first()
    assert d["branch"] == branch
    assert d["attempt_amount"] == (1 if branch == "usage" else 0)
    r = t.rentals.first()
    assert r["status"] == status and r["finished_at"] == at(3600)


def test_failed_charge_up_to_the_limit_is_a_buyout_too(spark):
    t = tick(spark, [rental(price=60000, free=0)])
    assert t.rentals.first()["status"] == "BUYOUT"
    assert t.debts.first()["amount_total"] == 5000


def test_other_statuses_are_untouched(spark):
    t = tick(spark, [rental("a", status="FINISHED"), rental("b", status=None), rental("c", status="BUYOUT")])
    assert summary(t) == (0, 0, 0)
    assert rows(t.rentals.select("id", "status"), "id") == [("a", "FINISHED"), ("b", None), ("c", "BUYOUT")]


def test_bad_rows_do_not_stop_the_tick(spark):
    t = tick(
        spark, [rental("bad", price=None), rental("good", price=60, free=0)], answers=[("good", True, None)]
    )
    assert rows(t.rejects) == [("bad", "price_per_hour is missing")]
    assert summary(t) == (2, 60, 0)
    assert t.rentals.count() == 2


def test_invariants_on_test_data(views):
    timed = views.rentals().join(views.clock().withColumnRenamed("rental_id", "id"), "id")
    t = run_tick(timed, views.payment_attempts(), views.debts(), views.outcomes(), F.col("now_ts"))
    after = t.decisions.withColumn("after", F.col("exposure") + F.col("charged_amount") + F.col("debt_delta"))
    assert after.filter("exposure < 5000 AND after > 5000").count() == 0
    assert after.filter("after >= 5000 AND NOT bought_out").count() == 0
    charged = t.attempts.filter("success").agg(F.coalesce(F.sum("amount"), F.lit(0))).first()[0]
    assert charged == t.summary.first()["total_charged"]
    before = views.debts().agg(F.sum("amount_total")).first()[0]
    assert t.debts.agg(F.sum("amount_total")).first()[0] - before == t.summary.first()["total_debt_delta"]
    assert t.rentals.count() == views.rentals().count()


TICKS = "rental_id string, tick int, now_ts timestamp, success boolean, error string"


def scenario(spark):
    base = [rental("a", price=60, free=0), rental("b", price=600000, free=1), rental("c", price=30, free=0), rental("d", status="FINISHED")]
    paid = [("a", 10, True), ("c", 40, True)]
    owed = [("c", 250, at(-9000), 2, at(-9000)), ("a", 5, at(-9000), 0, None)]
    answers = {"a": [1, 0, 0, 1, 1, 1], "b": [0, 1, 1, 1, 1, 1], "c": [0, 0, 1, 1, 0, 1]}
    ticks = [
        (r, i, at(400 * (i + 1)), bool(ok), None if ok else "no")
        for r, oks in answers.items()
        for i, ok in enumerate(oks, start=1)
    ]
    return base, paid, owed, ticks


def by_single_ticks(spark, base, paid, owed, ticks):
    """The same ticks as repeated single passes over growing tables."""
    r, p, d = rentals(spark, *base), payments(spark, *paid), debts(spark, *owed)
    for i in sorted({t[1] for t in ticks}):
        now = [t for t in ticks if t[1] == i]
        answers = spark.createDataFrame([(t[0], t[3], t[4]) for t in now], OUT)
        t = run_tick(r, p, d, answers, F.lit(now[0][2]))
        attempts = t.attempts.selectExpr("CAST(0 AS BIGINT) AS id", "*").select("id", "rental_id", "amount", "success", "error", "created_at")
        r = spark.createDataFrame(t.rentals.collect(), r.schema)
        d = spark.createDataFrame(t.debts.collect(), d.schema)
        p = spark.createDataFrame(p.collect() + attempts.collect(), PAYMENT_COLS)
    paid_now = {x["rental_id"]: x["s"] for x in p.filter("success").groupBy("rental_id").agg(F.sum("amount").alias("s")).collect()}
    owed_now = {x["rental_id"]: (x["amount_total"], x["attempts"], x["last_attempt_at"]) for x in d.collect()}
    out = []
    for x in sorted(r.collect(), key=lambda x: x["id"]):
        if x["id"] != "d":
            debt, n, last = owed_now.get(x["id"], (0, 0, None))
            out.append((x["id"], x["status"], x["finished_at"], paid_now.get(x["id"], 0), debt, n, last))
    return out


def test_replay_equals_single_ticks(spark):
    base, paid, owed, ticks = scenario(spark)
    out = replay.replay_ticks(
        rentals(spark, *base), payments(spark, *paid), debts(spark, *owed),
        spark.createDataFrame(ticks + ticks[:3], TICKS),
    )
    got = rows(out.select("rental_id", "status", "finished_at", "paid", "debt", "attempts", "last_attempt_at"), "rental_id")
    assert got == by_single_ticks(spark, base, paid, owed, ticks)
    assert got[1][1] == "BUYOUT"


def test_stream_of_ticks_equals_replay(spark):
    """Ticks in three files, one micro-batch each, against the replay of all."""
    base, paid, owed, ticks = scenario(spark)
    r, p, d = rentals(spark, *base), payments(spark, *paid), debts(spark, *owed)
    folder = scratch_path(spark, "ticks")
    parts = [[t for t in ticks if t[1] in part] for part in ([1, 2], [3], [4, 5, 6])]
    frames = [spark.createDataFrame(part, TICKS) for part in parts]
    land(folder, *frames)
    stream = folder_stream(spark, folder, frames[0].schema, files_per_trigger=1)
    got = stream_billing.bill_ticks(stream, replay.opening_state(r, p, d), scratch_path(spark, "state"))
    wanted = replay.replay_ticks(r, p, d, spark.createDataFrame(ticks, TICKS))
    assert rows(got, "rental_id") == rows(wanted, "rental_id")


def test_long_histories_are_replayed(spark):
    """10,000 ticks of one rental; every tick charges what is due since the one before."""
    ticks = spark.range(10_000).selectExpr(
        "'r1' AS rental_id", "CAST(id AS INT) AS tick",
        "TIMESTAMP '2025-01-01 12:00:00' + make_dt_interval(0, 0, 0, 30 * id) AS now_ts", "true AS success",
    )
    r = rentals(spark, rental(price=1, free=0))
    cfg = BillingConfig(r_buyout=10**9)
    got = replay.replay_ticks(r, payments(spark), debts(spark), ticks, cfg).first()
    last = dt.timedelta(seconds=30 * 9_999)
    assert got["status"] == "ACTIVE" and got["paid"] == got["charged"] > 0
    assert abs(got["paid"] - last / dt.timedelta(hours=1)) <= 1


def test_late_ticks_of_a_stream_are_reported(spark):
    base, paid, owed, ticks = scenario(spark)
    r, p, d = rentals(spark, *base), payments(spark, *paid), debts(spark, *owed)
    folder, target = scratch_path(spark, "ticks"), scratch_path(spark, "state")
    frames = [spark.createDataFrame([t for t in ticks if t[1] in part], TICKS) for part in ([1, 3], [2], [4, 5, 6])]
    land(folder, *frames)
    stream = folder_stream(spark, folder, frames[0].schema, files_per_trigger=1)
    got = stream_billing.bill_ticks(stream, replay.opening_state(r, p, d), target)
    on_time = [t for t in ticks if t[1] != 2]
    wanted = replay.replay_ticks(r, p, d, spark.createDataFrame(on_time, TICKS))
    assert rows(got, "rental_id") == rows(wanted, "rental_id")
    late = {(x["rental_id"], x["tick"]) for x in stream_billing.late_ticks(stream, target).collect()}
    assert late and late <= {(t[0], 2) for t in ticks}


def test_a_batch_writes_the_rentals_it_ticks(spark):
    base, paid, owed, ticks = scenario(spark)
    r, p, d = rentals(spark, *base), payments(spark, *paid), debts(spark, *owed)
    one_id = ticks[0][0]
    folder, target = scratch_path(spark, "ticks"), scratch_path(spark, "state")
    parts = [[t for t in ticks if t[1] == 1], [t for t in ticks if t[1] == 2 and t[0] == one_id], [t for t in ticks if t[1] == 3]]
    frames = [spark.createDataFrame(part, TICKS) for part in parts]
    land(folder, *frames)
    stream = folder_stream(spark, folder, frames[0].schema, files_per_trigger=1)
    got = stream_billing.bill_ticks(stream, replay.opening_state(r, p, d), target, fold_every=2)
    wanted = replay.replay_ticks(r, p, d, spark.createDataFrame(sum(parts, []), TICKS))
    assert rows(got, "rental_id") == rows(wanted, "rental_id")
    tables = stream_billing.StateTables(stream, target, 2)
    assert [x["rental_id"] for x in tables.states.of(1).collect()] == [one_id]


def test_ticks_are_folded_in_pieces(spark):
    """Pieces of three ticks, and none for the empty stretch between ticks 6 and 1000."""
    base, paid, owed, ticks = scenario(spark)
    r, p, d = rentals(spark, *base), payments(spark, *paid), debts(spark, *owed)
    later = [(t[0], t[1] + 1000, *t[2:]) for t in ticks]
    frame = spark.createDataFrame(ticks + later, TICKS)
    opening = replay.opening_state(r, p, d)
    whole = replay.flat_states(replay.fold_ticks(opening, frame, BillingConfig(), piece=10**6))
    pieces = replay.flat_states(replay.fold_ticks(opening, frame, BillingConfig(), piece=3))
    assert rows(pieces, "rental_id") == rows(whole, "rental_id")


def test_overflow_is_rejected_and_others_are_billed(spark):
    big = rental("big", price=2_000_000_000, free=0, total=2_000_000_000, started=at(-36_000))
    tick = billing_tick.run_tick(
        rentals(spark, big, rental("ok", free=0, started=at(-3600))), payments(spark), debts(spark),
        spark.createDataFrame([("ok", True, None), ("big", True, None)], "rental_id string, success boolean, error string"),
        F.lit(T0).cast("timestamp"), BillingConfig(r_buyout=2**40),
    )
    assert rows(tick.rejects) == [("big", "amount is out of range")]
    after = {x["id"]: x["total_amount"] for x in tick.rentals.collect()}
    assert after == {"big": 2_000_000_000, "ok": 120}
    assert [x["rental_id"] for x in tick.attempts.collect()] == ["ok"]


def test_rental_without_ticks_keeps_its_state(spark):
    out = replay.replay_ticks(
        rentals(spark, rental()), payments(spark, ("r1", 3, True)), debts(spark), spark.createDataFrame([], TICKS)
    )
    assert rows(out) == [("r1", "ACTIVE", None, 3, 0, 0, None, 0, 0)]
