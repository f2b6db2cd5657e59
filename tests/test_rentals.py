"""Quotes, starts and stops."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import QUOTE_COLS, T0, at, debts, rental, rentals
from voltmart.functions.text import derived_id, parse_start_response
from voltmart.operators import quotes, rentals as ops
from voltmart.plans import claims

REQ = "request_id string, quote_id string, idempotency_key string, requested_at timestamp"
EJECT = "station_id string, success boolean, powerbank_id string"
SLOT = "id string, tariff_id string, location string, slots array<struct<index:int,empty:boolean,charge:int>>"


def quote_rows(spark, *items):
    """Items are (id, expires_at) or (id, expires_at, station)."""
    full = [(i[0], "u1", i[2] if len(i) > 2 else "st", 150, 10, 500, i[1], T0) for i in items]
    return spark.createDataFrame(full, QUOTE_COLS)


def ejects(spark, *items):
    return spark.createDataFrame(list(items) or [("st", True, "pb-7")], EJECT)


def requests(spark, *items):
    return spark.createDataFrame(list(items), REQ)


def outcome(df):
    return {r["request_id"]: r["outcome"] for r in df.collect()}


def test_quote_validity_boundaries(spark):
    q = quote_rows(spark, ("q1", at(60)), ("q2", None))
    r = requests(spark, ("a", "q1", "k", at(60)), ("b", "q1", "k", at(60.000001)), ("c", "q2", "k", at(9e6)), ("d", "qx", "k", T0))
    got = {x["request_id"]: x["validity"] for x in quotes.quote_validity(r, q).collect()}
    assert got == {"a": "valid", "b": "expired", "c": "valid", "d": "not_found"}


def test_unreadable_expiry_counts_as_valid(spark):
    q = spark.createDataFrame([("q1", "not a time"), ("q2", "2025-01-01 12:00:10")], "id string, expires_at string")
    r = requests(spark, ("a", "q1", "k", at(9e6)), ("b", "q2", "k", at(11)))
    got = {x["request_id"]: x["validity"] for x in quotes.quote_validity(r, q).collect()}
    assert got == {"a": "valid", "b": "expired"}


def test_start_outcomes_in_order(spark):
    q = quote_rows(spark, ("q1", at(60)), ("q2", at(-1)), ("q3", at(60), "empty"), ("q4", at(60)))
    r = requests(
        spark,
        ("1", "q1", "k1", at(1)),   # starts
        ("2", "q9", "k1", at(2)),   # replay, whatever it asks for
        ("3", "q1", "k2", at(3)),   # quote already used
        ("4", "q2", "k3", at(4)),   # expired
        ("5", "q3", "k4", at(5)),   # station cannot eject
        ("6", "q4", "k4", at(6)),   # the failed start left the key free
        ("7", "q4", None, at(7)),
        ("8", "q4", "", at(8)),
        ("9", "q1", "k5", at(0)),   # earliest on q1, starts instead of 1
    )
    out = claims.decide_starts(r, q, ejects(spark, ("st", True, "pb-7"), ("empty", False, "")))
    assert outcome(out) == {
        "9": "started", "1": "quote_not_found", "2": "quote_not_found", "3": "quote_not_found", "4": "quote_expired",
        "5": "eject_failed", "6": "started", "7": "key_missing", "8": "key_missing",
    }
    codes = {x["request_id"]: x["http_code"] for x in out.collect()}
    assert codes["9"] == 200 and codes["5"] == 409 and codes["7"] == 400
    new = {x["status"]: x for x in ops.new_rentals(out).filter("id != ''").collect()}
    assert new["FAILED"]["powerbank_id"] == "PENDING"
    assert new["ACTIVE"]["powerbank_id"] == "pb-7" and new["ACTIVE"]["total_amount"] == 0
    left = quotes.consume_quotes(q, out.filter("outcome = 'started'"))
    assert [x["id"] for x in left.orderBy("id").collect()] == ["q2", "q3"]


def test_replay_returns_the_first_order(spark):
    q = quote_rows(spark, ("q1", at(60)), ("q2", at(60)))
    r = requests(spark, ("a", "q1", "k", at(1)), ("b", "q2", "k", at(2)), ("c", "q1", "k", at(3)))
    got = {x["request_id"]: (x["outcome"], x["response_order_id"]) for x in claims.decide_starts(r, q, ejects(spark)).collect()}
    first = spark.range(1).select(derived_id("rental", F.lit("a"))).first()[0]
    assert got == {"a": ("started", first), "b": ("cached", first), "c": ("cached", first)}


def test_stored_keys_answer_first(spark):
    q = quote_rows(spark, ("q1", at(60)))
    stored = spark.createDataFrame([("k", '{"order_id":"o-123","status":"ok"}')], "key string, response_json string")
    r = requests(spark, ("a", "q1", "k", at(1)), ("b", "q1", "k2", at(2)))
    got = {x["request_id"]: (x["outcome"], x["response_order_id"]) for x in claims.decide_starts(r, q, ejects(spark), stored).collect()}
    assert got["a"] == ("cached", "o-123")
    assert got["b"][0] == "started"


def in_time_order(eligible):
    """The rule itself: one request after the other."""
    keys, used, won = set(), set(), set()
    for turn, key, quote in sorted(eligible):
        if key not in keys and quote not in used:
            keys.add(key)
            used.add(quote)
            won.add(turn)
    return won


@pytest.mark.parametrize("seed", range(4))
def test_claims_equal_time_order(spark, seed):
    """Long chains of shared keys and quotes, with one hot key and one hot quote."""
    rng = random.Random(seed)
    n = 60
    eligible = []
    for i in range(n):
        key = "hot" if rng.random() < 0.3 else f"k{rng.randrange(15)}"
        quote = "hot" if rng.random() < 0.3 else f"q{rng.randrange(15)}"
        eligible.append((f"{rng.randrange(20):03d}-{i:03d}", key, quote))
    df = spark.createDataFrame(
        [(k, q, at(int(t[:3])), t, "o" + t) for t, k, q in eligible],
        "key string, quote_id string, requested_at timestamp, request_id string, order_id string",
    ).select("key", "quote_id", F.struct("requested_at", "request_id").alias("turn"), "order_id")
    got = {r["turn"]["request_id"] for r in claims.first_claims(df).collect()}
    assert got == in_time_order(eligible)


def test_chain_needs_several_rounds(spark):
    """Each request blocks the next through a key or a quote in turn."""
    chain = [(f"{i:03d}", f"k{i // 2}", f"q{(i + 1) // 2}") for i in range(8)]
    df = spark.createDataFrame(
        [(k, q, at(int(t)), t, t) for t, k, q in chain],
        "key string, quote_id string, requested_at timestamp, request_id string, order_id string",
    ).select("key", "quote_id", F.struct("requested_at", "request_id").alias("turn"), "order_id")
    got = {r["order_id"] for r in claims.first_claims(df).collect()}
    assert got == in_time_order(chain) == {"000", "002", "004", "006"}


def claim_rows(spark, chain):
    df = spark.createDataFrame(
        [(k, q, at(int(t)), t, t) for t, k, q in chain],
        "key string, quote_id string, requested_at timestamp, request_id string, order_id string",
    )
    return df.select("key", "quote_id", F.struct("requested_at", "request_id").alias("turn"), "order_id")


def test_a_long_chain_takes_few_rounds(spark):
    """A thousand requests that each wait for the one before, and some that wait for two."""
    chain = [(f"{i:04d}", f"k{i // 2}", f"q{(i + 1) // 2}") for i in range(1000)]
    chain += [("2000", "k10", "q900"), ("2001", "k499", "q499"), ("2002", "k500", "q500"), ("2003", "new", "q500")]
    took = []
    got = {r["order_id"] for r in claims.first_claims(claim_rows(spark, chain), took).collect()}
    assert got == in_time_order(chain)
    assert len(took) + sum(took) + 1 <= 25


@pytest.mark.parametrize("block", [1, 4, 64, 1 << 16])
def test_chains_pass_blocks_once(spark, block):
    """Jumps by joins follow the number of blocks, not the length of chains, whatever the block."""
    chain = [(f"{i:04d}", f"k{i // 2}", f"q{(i + 1) // 2}") for i in range(300)]
    chain += [(f"{i * 7:04d}x", f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(40)]
    # Behind a request that waits for two, and behind a pair on one key and quote.
    chain += [("1000", "a10", "q90"), ("1001", "z1", "q90"), ("1002", "z1", "z2"), ("1003", "y", "y"), ("1004", "y", "x"), ("1005", "w", "x")]
    df = spark.createDataFrame(
        [(k, q, at(int(t[:4])), t, t) for t, k, q in chain],
        "key string, quote_id string, requested_at timestamp, request_id string, order_id string",
    ).select("key", "quote_id", F.struct("requested_at", "request_id").alias("turn"), "order_id")
    took = []
    got = {r["order_id"] for r in claims.first_claims(df, took, block).collect()}
    assert got == in_time_order(chain)
    if block == 1 << 16:
        assert not any(took)
    assert all(j <= (len(chain) // block + 4).bit_length() + 1 for j in took)


def test_chains_that_meet(spark):
    """Falling and rising stretches: requests that wait for two chains at once."""
    rng = random.Random(2)
    turns = list(range(120))
    rng.shuffle(turns)
    path = [(f"{t:04d}", f"k{i // 2}", f"q{(i + 1) // 2}") for i, t in enumerate(turns)]
    ring = [(f"{200 + t:04d}", f"rk{i // 2}", f"rq{(i + 1) // 2 % 20}") for i, t in enumerate(rng.sample(range(40), 40))]
    took = []
    got = {r["order_id"] for r in claims.first_claims(claim_rows(spark, path + ring), took).collect()}
    assert got == in_time_order(path + ring) and len(took) <= 4


def test_no_requests(spark):
    out = claims.decide_starts(requests(spark), quote_rows(spark), ejects(spark))
    assert out.count() == 0


def test_pricing(spark):
    stations = spark.createDataFrame([("s1", "t1", "x", []), ("s2", "t9", "x", [])], SLOT)
    tariffs = spark.createDataFrame([("t1", 60, 5, 301)], "id string, price_per_hour int, free_period_min int, default_deposit int")
    profiles = spark.createDataFrame([("u1", True, False), ("u2", False, True)], "id string, trusted boolean, has_subscribtion boolean")
    req = spark.createDataFrame(
        [("a", "u1", "s1", at(0.75)), ("b", "u2", "s1", T0), ("c", "u3", "s1", T0), ("d", "u1", "s2", T0), ("e", "u1", "sx", T0)],
        "request_id string, user_id string, station_id string, requested_at timestamp",
    )
    got = {r["request_id"]: r for r in quotes.price_quotes(req, stations, tariffs, profiles).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert [got[x]["deposit"] for x in "abc"] == [150, 301, 301]
    assert [got[x]["from_fallback"] for x in "abc"] == [False, False, True]
    assert got["a"]["expires_at"] == at(60) and got["a"]["created_at"] == at(0.75)
    failed = quotes.failed_quote_requests(req, stations, tariffs)
    assert rows(failed.select("request_id", "reason")) == [("d", "tariff not found"), ("e", "station not found")]


def test_quote_upkeep_is_repeatable(spark):
    q = quote_rows(spark, ("q1", at(60)))
    made = quotes.create_quotes(q, quote_rows(spark, ("q2", at(60))).withColumn("created_at", F.lit(None).cast("timestamp")), "2025-01-02 00:00:00")
    assert made.filter("id = 'q2' AND created_at = '2025-01-02'").count() == 1
    drop = spark.createDataFrame([("q1",), ("q1",)], "quote_id string")
    once = quotes.consume_quotes(made, drop)
    assert [x["id"] for x in quotes.consume_quotes(once, drop).collect()] == ["q2"]
    assert quotes.get_quotes(made, drop).count() == 1


def test_station_slots_and_eject(spark):
    s = spark.createDataFrame([("st_1", "t", "x", [(1, True, 0), (2, False, 100)]), ("st_2", "t", "x", [])], SLOT)
    assert rows(quotes.station_slots(s)) == [("st_1", 2, 1, 1, 100), ("st_2", 0, 0, 0, None)]
    assert rows(quotes.eject_responses(s)) == [("st_1", True, "powerbank_1"), ("st_2", False, "")]
    assert quotes.slot_rows(s).count() == 2


def test_hold_failure_becomes_debt(spark):
    q = quote_rows(spark, ("q1", at(60)), ("q2", at(60)))
    out = claims.decide_starts(requests(spark, ("a", "q1", "k1", at(1)), ("b", "q2", "k2", at(2))), q, ejects(spark))
    holds = spark.createDataFrame([("a", False), ("b", True)], "request_id string, success boolean")
    owed = ops.attach_hold_debts(debts(spark), out, holds)
    assert rows(owed.select("amount_total", "attempts", "updated_at")) == [(500, 0, at(1))]
    bodies = {r["key"]: json.loads(r["response_json"]) for r in ops.start_responses(out, holds).collect()}
    assert bodies["k1"]["debt"] == 500 and bodies["k2"]["debt"] == 0
    assert list(bodies["k1"]) == ["order_id", "status", "powerbank_id", "total_amount", "debt"]
    parsed = ops.start_responses(out, holds).select(parse_start_response("response_json").alias("r")).select("r.*")
    assert set(parsed.toPandas()["status"]) == {"ACTIVE"}


def test_stop(spark):
    r = rentals(
        spark,
        rental("a", total=100),
        rental("b", status="BUYOUT", finished=at(5)),
        rental("c", status="FINISHED", total=450, finished=at(5)),
    )
    d = debts(spark, ("a", 50, T0, 0, None), ("c", 100, T0, 0, None))
    ask = spark.createDataFrame(
        [(n, n, at(9)) for n in ("a", "b", "c", "zz")], "request_id string, order_id string, stopped_at timestamp"
    )
    got = {x["order_id"]: x for x in ops.stop_rentals(r, d, ask).collect()}
    assert (got["a"]["outcome"], got["a"]["deposit_refund"], got["a"]["debt"]) == ("finished", 350, 50)
    assert (got["b"]["outcome"], got["b"]["finished_at"]) == ("finished", at(9))
    assert (got["c"]["outcome"], got["c"]["deposit_refund"], got["c"]["finished_at"]) == ("already_finished", 0, at(5))
    assert (got["zz"]["outcome"], got["zz"]["http_code"], got["zz"]["status"]) == ("not_found", 404, None)
    after = {x["id"]: (x["status"], x["finished_at"]) for x in ops.rentals_after_stop(r, ask).collect()}
    assert after == {"a": ("FINISHED", at(9)), "b": ("FINISHED", at(9)), "c": ("FINISHED", at(5))}
    view = ops.status_view(r, d)
    assert rows(view.select("order_id", "debt")) == [("a", 50), ("b", 0), ("c", 100)]


def test_second_stop_of_one_batch_finds_the_first(spark):
    r = rentals(spark, rental("a"), rental("b"))
    ask = spark.createDataFrame(
        [("2", "a", at(5)), ("1", "a", at(9)), ("4", "b", at(7)), ("3", "b", at(7))],
        "request_id string, order_id string, stopped_at timestamp",
    )
    out = ops.stop_rentals(r, debts(spark), ask)
    got = sorted((x["order_id"], x["outcome"], x["finished_at"]) for x in out.collect())
    assert got == [
        ("a", "already_finished", at(5)), ("a", "finished", at(5)), ("b", "already_finished", at(7)), ("b", "finished", at(7)),
    ]
