"""Metrics, rates and alerts, with skewed keys and forced bucket splits."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import at, land
from voltmart.functions.buckets import API_DURATION_BOUNDS
from voltmart.operators import alerts, metrics, quantiles, rates
from voltmart.session import scratch_path
from voltmart.streaming import batches
from voltmart.streaming.run import folder_stream

EV = "id bigint, circuit string, ts timestamp, bad boolean"


def series_of(text, circuit="payment", step=1):
    """``F`` and ``S`` as events one step apart."""
    return [(i, circuit, at(i * step), c == "F") for i, c in enumerate(text)]


def runs_by_hand(events, limits):
    out = []
    for circuit in sorted({e[1] for e in events}):
        ok, run = 0, None
        for _, _, ts, bad in sorted((e for e in events if e[1] == circuit), key=lambda e: (e[2], e[0])):
            if bad:
                run = run or [circuit, ok, 0, ts, ts, None, None]
                run[2] += 1
                run[4] = ts
                if run[2] == limits[circuit]:
                    run[5] = ts
            else:
                if run:
                    run[6] = ts
                    out.append(tuple(run))
                ok, run = ok + 1, None
        if run:
            out.append(tuple(run))
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("text, failures, opened", [("FF", [2], [1]), ("FFS", [2], [1]), ("FSF", [1, 1], [None, None]), ("SSS", [], [])])
def test_failure_runs_literal(spark, text, failures, opened):
    df = spark.createDataFrame(series_of(text), EV)
    got = rows(metrics.failure_runs(df, F.col("bad"), ["circuit"], limits={"payment": 2}), "run")
    assert [r[2] for r in got] == failures
    assert [r[5] for r in got] == [None if o is None else at(o) for o in opened]


@pytest.mark.parametrize("max_rows", [None, 3])
def test_failure_runs_with_hot_circuit(spark, max_rows):
    """Most events in one circuit, long runs over hours without success, equal times."""
    rng = random.Random(5)
    events, t = [], 0
    for i in range(900):
        t += rng.choice([0, 0, 0.4, 3, 700])
        circuit = "payment" if rng.random() < 0.8 else "station"
        bad = rng.random() < (0.97 if 200 < i < 500 else 0.5)
        events.append((i, circuit, at(t), bad))
    limits = {"payment": 3, "station": 5}
    df = spark.createDataFrame(events, EV)
    got = rows(metrics.failure_runs(df, F.col("bad"), ["circuit"], limits=limits, max_bucket_rows=max_rows), "circuit", "run")
    assert got == runs_by_hand(events, limits)
    assert max(r[2] for r in got) > 20


def test_outages(spark):
    df = spark.createDataFrame(series_of("FFFFS") + [(9, "payment", at(100), True)], EV)
    got = rows(metrics.outages(metrics.failure_runs(df, F.col("bad"), ["circuit"]), ["circuit"]))
    assert got == [("payment", 0, 4, at(2), at(62), at(3), at(4))]


def test_services_have_breakers_of_their_own(spark):
    """Failures of one service in a row, with successes of another between them."""
    ev = [(i, "core" if i % 2 else "worker", "payment", at(i), bool(i % 2)) for i in range(8)]
    df = spark.createDataFrame(ev, "id bigint, service string, circuit string, ts timestamp, bad boolean")
    runs = metrics.failure_runs(df, F.col("bad"), limits={"payment": 3})
    assert rows(runs.select("service", "circuit", "run", "failures", "opened_at")) == [("core", "payment", 0, 4, at(5))]
    assert metrics.outages(runs).first()["service"] == "core"


@pytest.mark.parametrize("fold_every", [50, 1])
def test_stream_of_failures_takes_late_events(spark, fold_every):
    """Five micro-batches over days: late successes cut runs, late failures lengthen them, over day ends too."""
    limits = {"payment": 3, "station": 5}
    day = 86_400
    batches_ = [
        [(i, "payment", at(i * day // 3), True) for i in range(12)],  # one run over four days
        [(100, "station", at(0), True), (101, "payment", at(20 * day), True)],
        [(102, "payment", at(day + 5), False), (103, "station", at(-3 * day), True)],  # cuts the run two days back
        [(104 + i, "station", at(-day + i), True) for i in range(4)] + [(120, "payment", at(day + 4), True)],
        [(130, "payment", at(30 * day), False), (131, "station", at(-3 * day + 1), False)],
    ]
    folder = scratch_path(spark, "events")
    land(folder, *[spark.createDataFrame(part, EV) for part in batches_])
    stream = folder_stream(spark, folder, spark.createDataFrame([], EV).schema, files_per_trigger=1)
    got = batches.detect_failures(stream, scratch_path(spark, "runs"), F.col("bad"), ["circuit"], fold_every)
    assert rows(got, "circuit", "run") == runs_by_hand(sum(batches_, []), limits)


def test_stream_of_failures_continues_runs(spark):
    """A run cut by two batch ends, one batch of failures only, one circuit missing in a batch."""
    texts = ["SFFSFF", "FFF", "FSFFF"]
    limits = {"payment": 3, "station": 5}
    folder, events, frames, t, n = scratch_path(spark, "events"), [], [], 0, 0
    for i, text in enumerate(texts):
        part = []
        for c in text:
            part.append((n, "payment", at(t), c == "F"))
            n, t = n + 1, t + 1800
        if i != 1:
            part += [(n, "station", at(t), True), (n + 1, "station", at(t + 1), False)]
            n, t = n + 2, t + 2
        frames.append(spark.createDataFrame(part, EV))
        events += part
    land(folder, *frames)
    stream = folder_stream(spark, folder, frames[0].schema, files_per_trigger=1)
    got = batches.detect_failures(stream, scratch_path(spark, "runs"), F.col("bad"), ["circuit"])
    assert rows(got, "circuit", "run") == runs_by_hand(events, limits)


def test_gauge_over_days_and_equal_times(spark):
    items = [(at(0), 5), (at(0), -2), (at(86400), 10), (at(86401), -1), (at(3 * 86400), 4)]
    df = spark.createDataFrame([("s", t, v) for t, v in items], "service string, ts timestamp, change bigint")
    got = rows(metrics.gauge(df, ["service"], "ts", F.col("change")), "ts")
    assert [(r[1], r[3]) for r in got] == [(at(0), 3), (at(86400), 13), (at(86401), 12), (at(3 * 86400), 16)]


def test_breaker_state_codes(spark):
    df = spark.createDataFrame([("closed",), ("open",), ("half_open",), ("odd",), (None,)], "s string")
    got = [r[0] for r in df.select(metrics.breaker_state_code("s")).collect()]
    assert got == [0, 1, 2, 0, 0]


def test_histogram_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.10001), ("a", 99.0), ("a", None)], "s string, v double")
    wide = metrics.histogram(df, ["s"], "v", [0.1, 1.0])
    assert rows(metrics.histogram_rows(wide, ["s"], [0.1, 1.0]), "cumulative") == [("a", "0.1", 1), ("a", "1.0", 2), ("a", "+Inf", 3)]


def test_rate_range_is_half_open(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(59.999)), ("a", at(60))], "s string, ts timestamp")
    got = {r["t"]: r["increase"] for r in rates.rate(df, ["s"], "ts", 120, 60).collect()}
    assert got == {at(60): 2, at(120): 3, at(180): 1}
    with pytest.raises(ValueError):
        rates.rate(df, ["s"], "ts", 100, 60)


def test_increase_is_dense(spark):
    df = spark.createDataFrame([("a", at(0)), ("b", at(240))], "s string, ts timestamp")
    got = {(r["s"], r["t"]): r["increase"] for r in rates.increase(df, ["s"], "ts", 60, 60).collect()}
    assert len(got) == 10 and sum(got.values()) == 2
    wide = rates.increase(df, ["s"], "ts", 60, 60, start="2025-01-01 11:59:00", end="2025-01-01 12:05:00")
    assert wide.count() == 14


@pytest.mark.parametrize("max_rows", [None, 2])
def test_counter_increase_with_resets(spark, max_rows):
    values = [5, 7, 7, 2, 3, 1, 10]
    items = [(i, "a", at(i * 1900), v) for i, v in enumerate(values)] + [(99, "b", at(0), 1000)]
    df = spark.createDataFrame(items, "id bigint, s string, ts timestamp, v bigint")
    got = rates.counter_increase(df, ["s"], "ts", "id", "v", 3600, 3600, max_bucket_rows=max_rows)
    total = {r["s"]: r["n"] for r in got.groupBy("s").agg(F.sum("increase").alias("n")).collect()}
    assert total == {"a": 2 + 0 + 2 + 1 + 1 + 9, "b": 0}


def quantile_by_hand(values, bounds, q):
    cum = [sum(v <= b for v in values) for b in bounds] + [len(values)]
    rank = q * len(values)
    i = next(k for k, c in enumerate(cum) if c >= rank)
    if i == len(bounds):
        return bounds[-1]
    low, below = (bounds[i - 1], cum[i - 1]) if i else (0.0, 0)
    return low + (bounds[i] - low) * (rank - below) / (cum[i] - below)


@pytest.mark.parametrize("values", [[0.05], [0.3] * 9 + [20.0], [20.0, 30.0], [0.1, 0.2, 0.3, 0.4, 4.0]])
def test_bucket_quantile(spark, values):
    df = spark.createDataFrame([("a", at(i), v) for i, v in enumerate(values)], "s string, ts timestamp, v double")
    out = rates.quantile(df, ["s"], "ts", "v", API_DURATION_BOUNDS, 60, 60)
    assert out.first()["value"] == pytest.approx(quantile_by_hand(values, API_DURATION_BOUNDS, 0.95))


@pytest.mark.parametrize("most", [1, 20, 65_536])
def test_exact_quantile_with_hot_value(spark, monkeypatch, most):
    monkeypatch.setattr(quantiles, "SKETCH", 16)  # a poor sketch costs rounds, never the result
    rng = np.random.default_rng(3)
    values = np.round(np.concatenate([rng.exponential(2, 400), np.full(300, 1.25), [0.0, -3.0, 1e6]]), 4)
    halves = [1.0] * 50 + [2.0] * 50
    data = [("a", float(v)) for v in values] + [("b", 7.5)] + [("c", v) for v in halves] + [("b", None), ("d", None), ("d", float("nan"))]
    df = spark.createDataFrame(data, "s string, v double")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r["s"]: (r["samples"], r["value"]) for r in quantiles.exact_quantile(df, ["s"], "v", q, most).collect()}
        assert got == {
            "a": (703, pytest.approx(np.quantile(values, q))), "b": (1, 7.5), "c": (100, pytest.approx(np.quantile(halves, q)))
        }


def test_exact_quantile_without_labels_and_rows(spark):
    df = spark.createDataFrame([(None, 3), ("x", 1), ("", 2)], "s string, v int")
    assert [tuple(r) for r in quantiles.exact_quantile(df, [], "v", 0.5).collect()] == [(3, 2.0)]
    assert sorted(tuple(r) for r in quantiles.exact_quantile(df, ["s"], "v", 1.0).collect()) == [("", 2, 3.0), ("x", 1, 1.0)]
    assert quantiles.exact_quantile(df.limit(0), ["s"], "v").count() == 0
    assert quantiles.exact_quantile(df.limit(0), [], "v").count() == 0


def test_exact_quantile_per_window(spark):
    rng = np.random.default_rng(4)
    data = [(str(k % 2), at(int(k)), float(rng.normal())) for k in range(0, 400, 3)] + [("0", None, 1.0)]
    df = spark.createDataFrame(data, "s string, ts timestamp, v double")
    got = {(r["s"], r["t"]): r["value"] for r in quantiles.exact_quantile_per_window(df, ["s"], "ts", "v", 60, 0.9, most=4).collect()}
    want = {}
    for s, ts, v in data[:-1]:
        want.setdefault((s, (ts - at(0)).total_seconds() // 60), []).append(v)
    assert got == {(s, at(60 * int(w + 1))): pytest.approx(np.quantile(v, 0.9)) for (s, w), v in want.items()}


def points(spark, *minutes, series="s"):
    return spark.createDataFrame([("r", series, at(60 * m), 1.0) for m in minutes], "rule string, series string, t timestamp, value double")


def test_hold(spark):
    got = rows(alerts.hold(points(spark, 0, 1, 2, 4, 5, 9), 60, 120), "pending_since")
    assert [(r[2], r[3], r[4], r[6]) for r in got] == [
        (at(0), at(120), 3, at(120)),
        (at(240), at(300), 2, None),
        (at(540), at(540), 1, None),
    ]


def test_hold_not_a_multiple_of_the_step(spark):
    got = alerts.hold(points(spark, 0, 1, 2), 60, 90).first()
    assert got["firing_since"] == at(120)


def test_gauge_at_grid_carries_forward(spark):
    df = spark.createDataFrame(
        [("a", at(10), 1, 5.0), ("a", at(20), 2, 6.0), ("a", at(200), 3, 0.0)], "service string, ts timestamp, tie bigint, value double"
    )
    got = rows(rates.gauge_at_grid(df, ["service"], "ts", "tie", "value", 60), "t")
    assert [(r[1], r[2]) for r in got] == [(at(60), 6.0), (at(120), 6.0), (at(180), 6.0), (at(240), 0.0)]


def test_ratio_has_no_value_without_denominator(spark):
    df = spark.createDataFrame([(at(0), "start"), (at(60), "quote"), (at(61), "start")], "ts timestamp, kind string")
    out = rates.ratio(df, [], "ts", F.expr("kind = 'start'"), F.expr("kind = 'quote'"), 60, 60)
    assert rows(out.select("t", "value")) == [(at(120), 1.0)]


def test_rule_table_with_reference_values(spark):
    """All rules run with their original thresholds; a dead worker and a silent service fire."""
    beats = [(i, "rental-core", at(i * 15)) for i in range(80)] + [(900, "billing-worker", at(0)), (901, "billing-worker", at(1185))]
    ev = spark.createDataFrame(beats, "id bigint, service string, ts timestamp").withColumns(
        {"duration_s": F.lit(9.0), "circuit": F.lit("payment"), "error_type": F.lit("x"), "success": F.lit(False),
         "kind": F.lit("quote"), "tie": F.col("id"), "value": F.lit(0.0),
         **{c: F.lit("x") for c in ("handler", "database", "operation", "api_service", "endpoint")}}
    )
    runs = metrics.failure_runs(ev, F.lit(True))
    sources = {r.source: ev for r in alerts.RULES.values()} | {
        "outages": metrics.outages(runs), "billing_cycles": ev.filter("id = 900 OR id = 901"),
    }
    out = alerts.evaluate(list(alerts.RULES.values()), sources)
    firing = {r["rule"] for r in out.filter("firing_since IS NOT NULL").collect()}
    assert {"ServiceDown", "HighResponseTime", "ExternalAPIHighLatency", "HighPaymentFailureRate",
            "CircuitBreakerOpen", "LowRentalConversionRate"} <= firing
    assert not firing & {"HighDatabaseConnections", "HighErrorRate", "SlowDatabaseQueries"}
    assert set(alerts.RULES) >= firing and len(alerts.RULES) == 13


def test_outlier_times_do_not_stretch_the_grid(spark):
    """A sample in the year 9999: alerts keep one row per change, and the dense series is cut in pieces."""
    ev = spark.createDataFrame(
        [(1, "core", at(0), 80.0), (2, "core", at(60), 10.0), (3, "core", dt.datetime(9999, 1, 1), 90.0)],
        "id bigint, service string, ts timestamp, value double",
    ).withColumns({"tie": F.col("id"), "database": F.lit("main")})
    got = rows(alerts.alert(alerts.RULES["HighDatabaseConnections"], ev), "pending_since")
    assert [(r[2], r[3]) for r in got] == [(at(15), at(60)), (dt.datetime(9999, 1, 1, 0, 0, 15),) * 2]
    down = alerts.alert(alerts.RULES["ServiceDown"], ev).collect()
    assert len(down) == 2 and max(r["points"] for r in down) > 10**10
    wide = rates.increase(ev, ["service"], "ts", 86_400 * 30, 86_400 * 30)
    assert wide.count() > 90_000


def test_stretches_equal_the_dense_series(spark):
    rng = random.Random(11)
    ev = [(i, rng.choice("ab"), at(rng.choice([0, 3, 900, 4000, 20000]) + rng.randrange(600))) for i in range(60)]
    df = spark.createDataFrame(ev, "id bigint, service string, ts timestamp").withColumns(
        {"tie": F.col("id"), "value": (F.col("id") % 5).cast("double")}
    )
    for window in (60, 300):
        dense = rates.increase(df, ["service"], "ts", window, 60).filter("increase = 0")
        got = rates.silent_stretches(df, ["service"], "ts", window, 60)
        points = got.select("service", F.explode(F.expr("sequence(first, last, interval 60 second)")).alias("t"))
        assert rows(points) == rows(dense.select("service", "t"))
    dense = rates.gauge_at_grid(df, ["service"], "ts", "tie", "value", 60)
    got = rates.gauge_stretches(df, ["service"], "ts", "tie", "value", 60)
    points = got.select("service", F.explode(F.expr("sequence(first, last, interval 60 second)")).alias("t"), "value")
    assert rows(points) == rows(dense.select("service", "t", "value"))
