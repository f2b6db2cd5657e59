"""Scans over buckets of the whole sort key, and range sums by differences."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import T0, at
from voltmart.functions import ordered
from voltmart.operators import alerts, metrics, rates


def crowd(spark, n):
    """n changes of one service within one second, of -1 or +1 by turns of three."""
    return spark.range(n).select(
        "id", F.lit("s").alias("service"), F.lit(T0).cast("timestamp").alias("ts"), (F.col("id") % 3 - 1).alias("change")
    )


def test_a_million_rows_of_one_second_are_spread(spark):
    df = crowd(spark, 1_000_000)
    cut = ordered.with_buckets(df, ["service"], "ts", "id", max_rows=50_000)
    sizes = [r["count"] for r in cut.groupBy(*ordered.PLACE).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 100_000 and sum(sizes) == 1_000_000
    got = metrics.gauge_changes(df, ["service"], "ts", ["id"], F.col("change"), 50_000)
    # -1, 0, 1 and so on: the total after row i is known.
    wrong = got.filter(F.col("value") != F.when(F.col("id") % 3 == 2, 0).otherwise(-1))
    assert wrong.count() == 0 and got.count() == 1_000_000


def test_runs_and_resets_inside_one_second(spark):
    n = 20_000
    df = spark.range(n).select(
        "id", F.lit("payment").alias("circuit"), F.lit(T0).cast("timestamp").alias("ts"), (F.col("id") % 5000 != 0).alias("bad"),
        (F.col("id") % 100).alias("v"),
    )
    runs = metrics.failure_runs(df, F.col("bad"), ["circuit"], limits={"payment": 4999}, max_bucket_rows=700)
    got = [(r.failures, r.opened_at is not None) for r in runs.orderBy("run").collect()]
    assert got == [(4999, True)] * 4
    up = rates.counter_increase(df, ["circuit"], "ts", "id", "v", 60, 60, max_bucket_rows=700).first()
    assert up["increase"] == (n // 100) * 99  # a reset to 0 adds nothing


@pytest.mark.parametrize("kind", ["text", "number"])
def test_scan_equals_plain_loops(spark, kind):
    """Ties as texts with common beginnings, negative numbers, nulls and several keys."""
    rng = random.Random(3)
    items = []
    for i in range(400):
        tie = f"k{'x' * rng.randrange(9)}{i}" if kind == "text" else rng.randrange(-10**9, 10**9)
        items.append((rng.choice("ab"), at(rng.choice([0, 0, 0, 1, 5000])), tie, rng.randrange(-5, 6)))
    df = spark.createDataFrame(items, f"k string, ts timestamp, tie {'string' if kind == 'text' else 'bigint'}, v bigint")
    cut = ordered.with_buckets(df, ["k"], "ts", "tie", max_rows=20)
    got = ordered.scan(cut, ["k"], ["ts", "tie", "v"], {"total": F.col("v")}, before={"prev": "v"}, after={"next": "v"})
    wanted = []
    for key in "ab":
        mine = sorted(r for r in items if r[0] == key)
        total = 0
        for i, r in enumerate(mine):
            total += r[3]
            wanted.append((*r, total, mine[i - 1][3] if i else None, mine[i + 1][3] if i + 1 < len(mine) else None))
    out = got.select("k", "ts", "tie", "v", "total", "prev", "next")
    assert rows(out, "k", "ts", "tie", "v") == wanted
    assert cut.select(*ordered.PLACE).distinct().count() > 8


def test_long_heavy_lists_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", 1)
    df = spark.range(900).select("id", F.lit("s").alias("service"), F.timestamp_seconds(F.col("id") % 3).alias("ts"), F.lit(1).alias("change"))
    got = metrics.gauge_changes(df, ["service"], "ts", ["id"], F.col("change"), 50)
    assert [r["value"] for r in got.orderBy("ts", "id").collect()] == list(range(1, 901))


@pytest.mark.parametrize("window,step", [(60, 60), (300, 60), (3600, 15)])
def test_range_sums_equal_counting(spark, window, step):
    rng = random.Random(window)
    events = [(rng.choice(["a", "b", None]), at(rng.choice([0, 90_000, 500_000]) + rng.randrange(900)), rng.randrange(-2, 3)) for _ in range(80)]
    df = spark.createDataFrame(events, "k string, ts timestamp, v bigint")
    per_pane = rates.panes(df, ["k"], "ts", step, [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")])
    held = rates.range_stretches(per_pane, ["k"], ["n", "s"], window, step)
    assert held.count() <= 2 * per_pane.count()
    got = rows(rates.grid_points(held, step).select("k", "t", "n", "s"), "k", "t")
    wanted = {}
    for k, ts, v in events:
        pane = T0 + dt.timedelta(seconds=(ts - T0).total_seconds() // step * step)
        for i in range(1, window // step + 1):
            n, s = wanted.get((k or "", pane + dt.timedelta(seconds=i * step)), (0, 0))
            wanted[k or "", pane + dt.timedelta(seconds=i * step)] = (n + 1, s + v)
    assert got == [(*key, *value) for key, value in sorted(wanted.items())]


def test_range_sums_refuse_inexact_measures(spark):
    df = spark.createDataFrame([("a", at(0), 1.5)], "k string, pane timestamp, v double")
    with pytest.raises(ValueError, match="exact"):
        rates.range_stretches(df, ["k"], ["v"], 60, 60)
    with pytest.raises(ValueError, match="multiple"):
        rates.range_stretches(df, ["k"], [], 60, 50)


def test_episodes_go_over_days(spark):
    """Stretches of several days, touching at midnight or not, of two series."""
    day = 86_400
    items = [
        ("r", "x", at(0), at(day), 1.0), ("r", "x", at(day + 15), at(2 * day), 2.0), ("r", "x", at(2 * day + 30), at(2 * day + 30), 3.0),
        ("r", "x", at(5 * day), at(9 * day), 1.0), ("r", "x", at(9 * day + 15), at(9 * day + 15), 7.0), ("r", "y", at(0), at(0), 4.0),
    ]
    df = spark.createDataFrame(items, "rule string, series string, first timestamp, last timestamp, value double")
    got = rows(alerts.hold_stretches(df, 15, 60).select("series", "pending_since", "last_at", "points", "highest", "firing_since"), "series", "pending_since")
    assert got == [
        ("x", at(0), at(2 * day), 2 * day // 15 + 1, 2.0, at(60)),
        ("x", at(2 * day + 30), at(2 * day + 30), 1, 3.0, None),
        ("x", at(5 * day), at(9 * day + 15), 4 * day // 15 + 2, 7.0, at(5 * day + 60)),
        ("y", at(0), at(0), 1, 4.0, None),
    ]
