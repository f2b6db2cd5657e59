"""Captured changes and the KPI kept up to date by them."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest

from tests.conftest import rows
from tests.helpers import PAYMENT_COLS, QUOTE_COLS, at, sorted_rows
from tests.helpers import rental as one
from tests.helpers import rentals as rental_frame
from voltmart.operators import changes, mart
from voltmart.plans import capture
from voltmart.schemas import TABLES

DAY = 86_400
NAMES = ["rentals", "payment_attempts", "quotes"]
COLUMNS = ["id", "user_id", "powerbank_id", "price_per_hour", "free_period_min", "deposit", "status", "total_amount", "started_at", "finished_at"]


def on(day, **more):
    """Start on a day from T0."""
    return {"started": at(day * DAY), **more}


def found(table, run):
    """(op, key, status before, status after) of one run."""
    out = table.changes_since(1, run).filter(f"run = {run}").collect()
    status = lambda row: row["status"] if row else None
    return sorted((r.op, r.key, status(r.before), status(r.after)) for r in out)


def content(df):
    return sorted_rows([tuple(r) for r in df.select(*COLUMNS).collect()])


def held_rentals(spark, tmp_path, tokens=4):
    return capture.CapturedTable(spark, f"file:{tmp_path}", TABLES["rentals"], tokens)


def test_inserts_updates_and_deletes(spark, tmp_path):
    table = held_rentals(spark, tmp_path)
    assert table.last() is None and table.current().count() == 0
    first = rental_frame(spark, one("a", **on(0)), one("b", **on(1)), one("c", **on(2)), one("d", **on(3)))
    assert table.capture(1, first) == (1, 1)
    # a ends (its bookmark stays), b goes, c stays, e comes; d starts on another day.
    second = rental_frame(
        spark, one("a", status="FINISHED", finished=at(5 * DAY), **on(0)), one("c", **on(2)), one("d", **on(9)), one("e", **on(1))
    )
    assert table.capture(2, second) == (2, 1)
    assert found(table, 2) == [
        ("delete", "b", "ACTIVE", None), ("insert", "e", None, "ACTIVE"),
        ("update", "a", "ACTIVE", "FINISHED"), ("update", "d", "ACTIVE", "ACTIVE"),
    ]
    assert content(table.current()) == content(second)
    assert content(table.current(capture.Run(1, 1))) == content(first)
    # Nothing new; then what went comes back as it was, and an end is taken back.
    table.capture(3, second)
    assert found(table, 3) == []
    table.capture(4, first)
    assert found(table, 4) == [
        ("delete", "e", "ACTIVE", None), ("insert", "b", None, "ACTIVE"),
        ("update", "a", "FINISHED", "ACTIVE"), ("update", "d", "ACTIVE", "ACTIVE"),
    ]
    assert content(table.current()) == content(first)
    table.capture(5, first.limit(0))
    assert table.current().count() == 0
    table.capture(6, second)
    assert content(table.current()) == content(second)
    got = rows(table.reports().select("run", "base", "inserted", "updated", "deleted"), "run")
    assert got == [(1, 1, 4, 0, 0), (2, 1, 1, 2, 1), (3, 1, 0, 0, 0), (4, 1, 1, 2, 1), (5, 1, 0, 0, 4), (6, 1, 4, 0, 0)]
    with pytest.raises(ValueError):
        table.capture(6, second)


def test_a_run_without_a_report_is_written_anew(spark, tmp_path):
    table = held_rentals(spark, tmp_path)
    first, second = rental_frame(spark, one("a")), rental_frame(spark, one("a", status="FINISHED"), one("b"))
    table.load(1, first)
    # A run that stopped before its report.
    table._write(table._digested(first.limit(0)), "digests", 2)
    changes.keyed_diff(first, first.limit(0), "id", table.columns).write.parquet(table._path("changes", 2))
    assert content(table.current()) == content(first)
    table.capture(2, second)
    assert content(table.current()) == content(second) and len(found(table, 2)) == 2


def test_rebase_folds_the_changes(spark, tmp_path):
    table = held_rentals(spark, tmp_path)
    table.load(1, rental_frame(spark, one("a"), one("b")))
    second = rental_frame(spark, one("a", total=5), one("c"))
    table.capture(2, second)
    assert table.rebase(3) == (3, 3)
    assert content(table.current()) == content(second)
    assert table.shares().groupBy().sum("s").first()[0] == 2
    third = rental_frame(spark, one("c"))
    table.capture(4, third)
    assert content(table.current()) == content(third) and table.changes_since(3, 4).count() == 1
    assert table.shares().groupBy().sum("s").first()[0] == 1


def test_nulls_are_values(spark):
    cols = "id string, t timestamp, x string, y string"
    a = spark.createDataFrame([("k", at(0), None, "v"), ("n", None, "p", None)], cols)
    b = spark.createDataFrame([("k", at(0), "v", None), ("n", None, None, None)], cols)
    names = ["id", "t", "x", "y"]
    one_side = changes.range_digests(a, "id", "t", names)
    other = changes.range_digests(b, "id", "t", names)
    ranges = changes.compared_ranges(one_side, other)
    assert ranges.filter("changed").count() == 2 and changes.compared_ranges(other, other).filter("changed").count() == 0
    days = [r.range_day for r in ranges.collect()]
    assert changes.rows_in(a, ranges, days, "id", "t").count() == 2
    assert changes.keyed_diff(a, b, "id", names).filter("op = 'update'").count() == 2


def test_digests_tell_copies_apart(spark):
    a = rental_frame(spark, one("a"))
    twice = a.union(a)
    key, ts = "id", "started_at"
    digest = lambda df: changes.range_digests(df, key, ts, COLUMNS)
    assert changes.compared_ranges(digest(a), digest(twice)).first().changed
    assert changes.compared_ranges(digest(a.limit(0)), digest(a)).first().rows_before == 0


def test_spans():
    day = dt.date(2025, 1, 1)
    days = [day + dt.timedelta(days=d) for d in (0, 1, 2, 10, 11, 400)]
    assert changes.spans_of([]) == []
    assert changes.spans_of(days) == [(days[0], days[2]), (days[3], days[4]), (days[5], days[5])]
    assert changes.spans_of(days, 2) == [(days[0], days[4]), (days[5], days[5])]
    assert changes.spans_of(days, 1) == [(days[0], days[5])]


def test_unchanged_ranges_are_not_read(spark, tmp_path):
    """Data pages of files without a changed day are destroyed; the run does not notice."""
    table = held_rentals(spark, tmp_path)
    start = [one(f"r{i}", **on(i % 40)) for i in range(400)]
    # As many files as partitions: the planner would join such small ones.
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(small, "1b")
    table.load(1, rental_frame(spark, *start))
    spark.conf.unset(small)
    spoiled = 0
    for path in glob.glob(f"{tmp_path}/rentals/base/run=1/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at_column = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index("started_at")
        newest = max(meta.row_group(g).column(at_column).statistics.max for g in range(meta.num_row_groups))
        if newest.replace(tzinfo=None) < at(25 * DAY):
            with open(path, "r+b") as file:
                # All but the last pages, whose checksum block may hold the footer's beginning.
                size = sum(meta.row_group(g).column(c).total_compressed_size for g in range(meta.num_row_groups) for c in range(meta.num_columns))
                file.seek(4)
                file.write(b"\xff" * (size - 1024))
            spoiled += 1
    assert spoiled
    after = [r for r in start if r[0] != "r38"]
    after[38] = one("r39", status="FINISHED", finished=at(41 * DAY), **on(39))
    changed = {r[0] for r in start} - {r[0] for r in after}
    assert changed == {"r38"}
    table.capture(2, rental_frame(spark, *after))
    assert [(op, key) for op, key, _, _ in found(table, 2)] == [("delete", "r38"), ("update", "r39")]
    report = table.reports().filter("run = 2").first()
    assert report.changed_ranges == 2 < report.ranges
    with pytest.raises(Exception):
        table.current().agg({"user_id": "max"}).collect()


def _random_state(rng, state):
    """Some rows ended, moved, removed or added."""
    out = {}
    for key, (start, minutes) in state.items():
        luck = rng.random()
        if luck < 0.1:
            continue
        if luck < 0.3:
            minutes = None if minutes else rng.randint(1, 3000)
        elif luck < 0.4:
            start = rng.randint(0, 12 * DAY)
        out[key] = (start, minutes)
    for _ in range(rng.randint(0, 6)):
        out[f"n{rng.random()}"] = (rng.randint(0, 12 * DAY), None)
    return out


def test_kept_kpi_equals_the_rebuild(spark, tmp_path):
    rng = random.Random(7)
    held = capture.tables(spark, f"file:{tmp_path}", NAMES, 3)
    state = {f"r{i}": (rng.randint(0, 10 * DAY), None) for i in range(40)}
    payments = {}
    for run in range(1, 5):
        state = _random_state(rng, state)
        payments = {k: (rng.random() < 0.5, p[1]) for k, p in payments.items() if rng.random() < 0.8}
        payments |= {run * 100 + i: (rng.random() < 0.5, rng.randint(0, 14 * DAY)) for i in range(rng.randint(0, 9))}
        rentals = rental_frame(
            spark, *[one(k, started=at(s), finished=at(s + 60 * m) if m else None, status="FINISHED" if m else "ACTIVE") for k, (s, m) in state.items()]
        )
        paid = spark.createDataFrame([(k, "r", 10 + k, ok, None if ok else "no", at(s)) for k, (ok, s) in payments.items()], PAYMENT_COLS)
        quotes = spark.createDataFrame([(f"q{i}", "u", "s", 1, 1, 1, at(i), at(i)) for i in range(run)], QUOTE_COLS)
        sources = dict(zip(NAMES, (rentals, paid, quotes)))
        capture.capture_all(held, sources, run)
        assert rows(capture.kpi(held), "day") == rows(mart.kpi_daily(quotes, rentals, paid), "day")
    held["rentals"].rebase(5)
    assert rows(capture.kpi(held), "day") == rows(mart.kpi_daily(quotes, rentals, paid), "day")
