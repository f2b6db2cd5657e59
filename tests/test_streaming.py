"""Streams in several micro-batches: lateness, closing of windows, salted keys."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import QUOTE_COLS, at, land, rental, rentals
from voltmart.operators import mart
from voltmart.session import scratch_path
from voltmart.streaming import batches, starts, windows
from voltmart.streaming.run import BatchTable, drain, folder_stream

EV = "ts timestamp, kind string, amount int"
DAY = 86400


def derived(text):
    return hashlib.sha256(text.encode()).hexdigest()


def stream_of(spark, schema, *parts):
    """One file and one micro-batch per part."""
    folder = scratch_path(spark, "in")
    frames = [spark.createDataFrame(list(part), schema) for part in parts]
    land(folder, *frames)
    return folder_stream(spark, folder, frames[0].schema, files_per_trigger=1)


def test_late_rows_are_dropped_and_open_days_wait(spark):
    """The watermark of one batch closes days in the next and drops late rows after that."""
    stream = stream_of(
        spark, EV,
        [(at(0), "quote", 0), (at(60), "paid", 5)],
        [(at(DAY + 3600), "quote", 0)],
        [(at(DAY + 3700), "unpaid", 4)],
        [(at(30), "quote", 0), (at(2 * DAY), "unpaid", 9)],
    )
    out = drain(windows.daily_counts(stream), scratch_path(spark, "out"))
    got = rows(out, "day")
    assert [(r[0].day, r[1], r[4], r[5], r[6]) for r in got] == [(1, 1, 1, 1, 5), (2, 1, 1, 0, 0)]


def test_lateness_is_a_parameter(spark):
    stream = stream_of(
        spark, EV, [(at(0), "quote", 0)], [(at(DAY + 3600), "quote", 0)], [(at(30), "quote", 0), (at(3 * DAY), "quote", 0)]
    )
    out = drain(windows.daily_counts(stream, "2 days"), scratch_path(spark, "out"))
    assert rows(out.select("day", "quotes_cnt"), "day")[0] == (dt.date(2025, 1, 1), 2)


def test_first_per_key_across_batches(spark):
    schema = "key string, request_id string, ts timestamp"
    hot = [("hot", f"r{i}", at(i % 60)) for i in range(200)]
    stream = stream_of(spark, schema, hot + [("a", "x", at(1))], [("hot", "late", at(70)), ("b", "y", at(71))])
    out = drain(windows.first_per_key(stream, "key", "request_id"), scratch_path(spark, "out"))
    assert rows(out.select("key")) == [("a",), ("b",), ("hot",)]


def test_start_meets_its_quote_across_batches(spark):
    quotes = stream_of(
        spark, QUOTE_COLS,
        [("q1", "u", "s", 60, 0, 300, at(60), at(0))],
        [("q2", "u", "s", 60, 0, 300, at(160), at(100))],
    )
    starts = stream_of(
        spark, "request_id string, quote_id string, requested_at timestamp",
        [("early", "q2", at(99))],
        [("edge", "q1", at(60)), ("late", "q1", at(61)), ("ok", "q2", at(130)), ("none", "qx", at(100))],
    )
    out = drain(windows.starts_with_quotes(starts, quotes), scratch_path(spark, "out"))
    assert rows(out.select("request_id")) == [("edge",), ("ok",)]


@pytest.mark.parametrize("fold_every", [50, 1])
def test_quote_join_keeps_and_drops_by_the_watermark(spark, fold_every):
    """What a batch leaves lies in tables: no copies of quotes, no state in memory; late rows go one batch after the mark."""
    hot = [("q1", "u", "s", 60, 0, 300, at(60), at(0))]
    quotes = stream_of(
        spark, QUOTE_COLS,
        hot,
        [("q2", "u", "s", 90, 0, 400, at(5060), at(5000)), ("q2", "u", "s", 90, 0, 500, at(5060), at(5000))],
        [("q3", "u", "s", 60, 0, 300, at(9060), at(9000))],
        [("q4", "u", "s", 60, 0, 300, at(61), at(1)), ("q5", "u", "s", 60, 0, 300, at(9160), at(9100))],
    )
    starts = stream_of(
        spark, "request_id string, quote_id string, requested_at timestamp",
        [(f"h{i}", "q1", at(i % 61)) for i in range(300)] + [("null", None, at(5)), ("untimed", "q1", None)],
        [("second", "q2", at(5060)), ("behind", "q1", at(30)), ("early", "q5", at(9130))],
        [("again", "q1", at(31)), ("third", "q3", at(9000))],
        [("gone", "q1", at(32)), ("none", "q4", at(2)), ("fifth", "q5", at(9101))],
    )
    target = scratch_path(spark, "out")
    out = drain(windows.starts_with_quotes(starts, quotes, fold_every=fold_every), target)
    got = sorted(r["request_id"] for r in out.collect() if not r["request_id"].startswith("h"))
    assert got == ["again", "behind", "early", "fifth", "second", "second", "third"]
    assert out.filter("request_id LIKE 'h%'").count() == 300
    kept = spark.read.parquet(f"{target}/kept/batch-0")
    assert kept.filter("made").count() == 1
    assert not spark.read.option("recursiveFileLookup", True).format("binaryFile").load(target).filter("path LIKE '%/state/%'").count()


def test_sliding_rate_matches_batch_for_closed_windows(spark):
    from voltmart.operators import rates

    items = [("a", at(i * 37)) for i in range(100)]
    schema = "service string, ts timestamp"
    out = drain(
        windows.sliding_rate(stream_of(spark, schema, items), ["service"], 300, 60), scratch_path(spark, "out")
    )
    batch = rates.rate(spark.createDataFrame(items, schema), ["service"], "ts", 300, 60)
    closed = batch.filter(F.col("t") <= F.lit(at(99 * 37 - 600))).select("service", "t", "increase", "per_second")
    assert rows(out) == rows(closed) and out.count() > 10


def test_mart_refresh_over_batches_and_again(spark):
    """Three micro-batches against one batch build; running a batch again changes nothing."""
    items = [rental(str(i), started=at(i * DAY), finished=at(i * DAY + 90), status="FINISHED") for i in range(4)]
    none = spark.createDataFrame([], QUOTE_COLS)
    no_payments = spark.createDataFrame([], "success boolean, amount int, created_at timestamp")
    schema = rentals(spark).schema
    stream = stream_of(spark, schema, items[:1], items[1:3], items[3:])
    target = scratch_path(spark, "mart")
    kpi = batches.refresh_mart(mart.rental_parts(stream), target)
    wanted = rows(mart.kpi_daily(none, rentals(spark, *items), no_payments))
    assert rows(kpi) == wanted and len(wanted) == 4
    again = mart.daily_partials(mart.rental_parts(rentals(spark, *items[1:3])))
    batches.kept_sums(mart.rental_parts(stream), target, 50).write(batches._wide(again), 1)
    assert rows(batches.current_kpi(mart.rental_parts(stream), target)) == wanted
    folding = batches.refresh_mart(mart.rental_parts(stream), scratch_path(spark, "mart"), fold_every=1)
    assert rows(folding) == wanted


@pytest.mark.parametrize("fold_every", [50, 1])
def test_starts_are_answered_for_good(spark, fold_every):
    """Three micro-batches: late repeats get the first response, a failed start leaves its key free."""
    quote_rows = [(f"q{i}", "u", "st" if i < 8 else "empty", 60, 5, 300, at(10**7), at(0)) for i in range(10)]
    quotes = spark.createDataFrame(quote_rows, QUOTE_COLS)
    ejects = spark.createDataFrame([("st", True, "pb-1"), ("empty", False, "")], "station_id string, success boolean, powerbank_id string")
    holds = spark.createDataFrame([("a2", False)], "request_id string, success boolean")
    ask = "request_id string, quote_id string, idempotency_key string, requested_at timestamp"
    parts = [
        [("a1", "q9", "ka", at(10)), ("b1", "q1", "kb", at(11)), ("b2", "q2", "kb", at(12)), ("n1", "q3", None, at(13))],
        # ka failed at an empty station, so it is free; kb is taken, and so is q1.
        [("a2", "q4", "ka", at(50)), ("b3", "q5", "kb", at(51)), ("c1", "q1", "kc", at(52)), ("n2", "q3", "", at(53))],
        # Hours later, one of them with a time long before, one request given twice.
        [("a3", "q6", "ka", at(50_000)), ("b4", "q6", "kb", at(2)), ("c2", "q7", "kc", at(60_000)), ("b1", "q1", "kb", at(11))],
    ]
    stream = stream_of(spark, ask, *parts)
    out = starts.answer_starts(stream, quotes, ejects, holds, scratch_path(spark, "starts"), fold_every)
    got = {}
    for r in out.collect():
        got.setdefault(r.request_id, []).append((r.outcome, r.response_order_id, json.loads(r.response_json)["order_id"] if r.response_json else None))
    ids = {x: derived(f"rental:{x}") for x in ("b1", "a2", "c2")}
    own = lambda outcome, x: (outcome, ids[x], ids[x])
    assert sorted(got.pop("b1")) == [own("cached", "b1"), own("started", "b1")]
    assert {k: v for k, [v] in got.items()} == {
        "a1": ("eject_failed", None, None), "b2": own("cached", "b1"), "n1": ("key_missing", None, None),
        "a2": own("started", "a2"), "b3": own("cached", "b1"), "c1": ("quote_not_found", None, None), "n2": ("key_missing", None, None),
        "a3": own("cached", "a2"), "b4": own("cached", "b1"), "c2": own("started", "c2"),
    }


def test_batch_tables_fold_and_miss_what_is_lost(spark):
    table = BatchTable(spark, scratch_path(spark, "table"), spark.range(0).schema, lambda rows: rows.distinct(), every=2)
    for batch in range(5):
        table.begin(batch)
        assert sorted(r["id"] for r in table.before(batch).collect()) == list(range(batch))
        table.write(spark.range(batch, batch + 1), batch)
    assert table.before(5).count() == 5 and table.of(3).first()["id"] == 3
    # The same batch again.
    table.begin(4)
    table.write(spark.range(4, 5), 4)
    assert table.before(5).count() == 5
    lost = BatchTable(spark, table.path, spark.range(0).schema, every=2)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lost.before(9).count()
