"""Ingest, layers, mart, reports, export and run control."""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.helpers import PAYMENT_COLS, QUOTE_COLS, RENTAL_COLS, T0, at, debts, payments, rental, rentals
from voltmart.checks.warehouse_checks import sources
from voltmart.operators import bi, constraints, core, mart, meta
from voltmart.plans import warehouse
from voltmart.schemas import FCT_PAYMENTS, FCT_RENTALS, KPI_DAILY, LAYERS, PAYMENT_ATTEMPTS, QUOTES, RENTALS, TABLES
from voltmart.session import lent_options, scratch_path
from voltmart.sources import export, extract
from voltmart.sources.store import LayerStore

NOW = "2025-12-18 22:40:15"


# ----- golden run: 4 rentals, 1 quote, 41 payments of 1 on one day


def golden(spark):
    day = dt.datetime(2025, 12, 18, 22, 29, 54, 440494)
    users = [("u1", 11), ("user-1", 10), ("user-2", 10), ("user-3", 10)]
    r = spark.createDataFrame(
        [(f"r{i}", u, "powerbank_638", 60, 0, 300, "ACTIVE", n, day, None) for i, (u, n) in enumerate(users)], RENTAL_COLS
    )
    p = [(f"r{i}",) for i, (_, n) in enumerate(users) for _ in range(n)]
    pay = spark.createDataFrame(
        [(i, r_[0], 1, True, None, day + dt.timedelta(seconds=i)) for i, r_ in enumerate(p, start=1)], PAYMENT_COLS
    )
    q = spark.createDataFrame([("q1", "u1", "s", 60, 0, 300, day, day)], QUOTE_COLS)
    return q, r, pay


def test_golden_kpi(spark):
    kpi = mart.kpi_daily(*golden(spark))
    assert rows(kpi) == [(dt.date(2025, 12, 18), 1, 4, 0, 41, 41, 41, None)]
    assert [(f.name, f.dataType) for f in kpi.schema] == [(f.name, f.dataType) for f in KPI_DAILY]


def test_golden_run_end_to_end(spark):
    root = scratch_path(spark, "golden")
    counts = warehouse.run_warehouse(spark, few(spark, 4), root, "run-1", NOW, f"{root}/out")
    assert counts["core"] == {"quotes": 1, "rentals": 4, "idempotency_keys": 0, "debts": 0, "payment_attempts": 41}
    name = export.export_name("mart", "kpi_daily", NOW)
    assert name == "mart_kpi_daily_20251218T224015Z.csv"
    lines = sorted(x[0] for x in spark.read.text(f"{root}/out/{name}").collect())
    assert lines == ["2025-12-18,1,4,0,41,41,41,", ",".join(KPI_DAILY.names)]
    pay = spark.read.text(f"{root}/out/{export.export_name('mart', 'fct_payments', NOW)}").collect()
    assert "1,r0,1,t,,2025-12-18 22:29:55.440494+00" in {x[0] for x in pay}
    audit = warehouse.read_audit(spark, root).first()
    assert audit["status"] == "SUCCESS" and json.loads(audit["details"])["mart"]["fct_payments"] == 41


def test_empty_run(spark):
    root = scratch_path(spark, "empty")
    none = {s: {t: df.limit(0) for t, df in tables.items()} for s, tables in few(spark, 0).items()}
    counts = warehouse.run_warehouse(spark, none, root, "run-1", NOW, f"{root}/out")
    assert set(counts["mart"].values()) == {0}
    for table in ("kpi_daily", "fct_rentals", "fct_payments"):
        text = spark.read.text(f"{root}/out/{export.export_name('mart', table, NOW)}").collect()
        assert [x[0] for x in text] == [",".join(LAYERS["mart"][table].names)]


def test_failed_run_is_audited_and_keeps_the_old_version(spark):
    q, r, p = golden(spark)
    root = scratch_path(spark, "failed")
    src = few(spark, 4)
    warehouse.run_warehouse(spark, src, root, "run-1", NOW)
    broken = r.withColumn("price_per_hour", F.raise_error(F.lit("source lost")).cast("int"))
    with pytest.raises(Exception, match="source lost"):
        src["rental"]["rentals"] = broken
        warehouse.run_warehouse(spark, src, root, "run-2", "2025-12-19 00:00:00")
    state = {x["run_id"]: x["status"] for x in warehouse.read_audit(spark, root).collect()}
    assert state == {"run-1": "SUCCESS", "run-2": "FAILED"}
    assert LayerStore(spark, root).read("raw_rental", "rentals").count() == 4
    assert LayerStore(spark, root).read("mart", "fct_rentals").count() == 4


def test_rerun_gives_the_same_tables(spark):
    q, r, p = golden(spark)
    root = scratch_path(spark, "rerun")
    src = few(spark, 4)
    for _ in range(2):
        warehouse.run_warehouse(spark, src, root, "run-1", NOW)
    assert LayerStore(spark, root).read("core", "payment_attempts").count() == 41


# ----- mart details


def test_calendar_ignores_quotes_and_finishes(spark):
    """Only starts and payments span the calendar; rows outside it vanish."""
    d = dt.timedelta(days=1)
    r = rentals(spark, rental(started=T0, finished=T0 + 9 * d, status="FINISHED"))
    q = spark.createDataFrame([("q1", "u", "s", 1, 1, 1, T0, T0 - 5 * d), ("q2", "u", "s", 1, 1, 1, T0, T0)], QUOTE_COLS)
    p = spark.createDataFrame([(1, "r1", 5, True, None, T0 + 2 * d)], PAYMENT_COLS)
    kpi = mart.kpi_daily(q, r, p)
    assert [x[0].day for x in rows(kpi)] == [1, 2, 3]
    assert kpi.agg(F.sum("quotes_cnt"), F.sum("rentals_finished_cnt")).first() == (1, 0)


def test_one_pass_kpi_equals_join_form(views):
    q, r, p = views.quotes(), views.rentals(), views.payment_attempts()
    joined = mart.join_daily(
        mart.day_calendar(mart.calendar_bounds(r, p)), mart.quotes_per_day(q), mart.rentals_started_per_day(r),
        mart.rentals_finished_per_day(r), mart.payments_per_day(p),
    )
    assert rows(mart.kpi_daily(q, r, p)) == rows(joined)


def test_empty_sources_give_no_days(spark):
    q, r, p = spark.createDataFrame([], QUOTE_COLS), rentals(spark), payments(spark)
    assert mart.kpi_daily(q, r, p).count() == 0
    assert mart.day_calendar(mart.calendar_bounds(r, p)).count() == 0
    only_quotes = spark.createDataFrame([("q", "u", "s", 1, 1, 1, T0, T0)], QUOTE_COLS)
    assert mart.kpi_daily(only_quotes, r, p).count() == 0


def test_one_sided_calendar(spark):
    out = mart.calendar_bounds(rentals(spark), payments(spark, ("r", 1, True)))
    assert rows(out) == [(T0.date(), T0.date())]


def test_average_rounds_half_up_with_microseconds(spark):
    """0.005 minutes are 0.3 s: exactly half a hundredth goes up."""
    items = [rental(str(i), started=T0, finished=at(s), status="FINISHED") for i, s in enumerate([0.3, 0.3])]
    out = mart.rentals_finished_per_day(rentals(spark, *items)).first()
    assert out["avg_rental_duration_min"] == decimal.Decimal("0.01")
    below = [rental("x", started=T0, finished=at(0.299999), status="FINISHED")]
    assert mart.rentals_finished_per_day(rentals(spark, *below)).first()[2] == decimal.Decimal("0.00")


def kpi_rows(spark, *items):
    """Items are (day number, attempts, successes)."""
    full = [(dt.date(2025, 1, d), 1, 2, 3, n, ok, 10, decimal.Decimal("1.25")) for d, n, ok in items]
    return spark.createDataFrame(full, KPI_DAILY)


def test_success_rates_differ_without_attempts(spark):
    k = kpi_rows(spark, (1, 0, 0))
    assert bi.success_rate(k).first()[0] == 0
    assert bi.success_rate(k.limit(0)).first()[0] == 0
    assert bi.success_rate_on_day(k, "2025-01-01").first()[0] is None
    assert bi.success_rate_on_day(k, "2025-01-09").count() == 0
    assert mart.kpi_documented(k).first()["payment_success_rate"] is None


def test_success_rate_rounds_half_up(spark):
    assert bi.success_rate(kpi_rows(spark, (1, 2000, 1001))).first()[0] == decimal.Decimal("50.1")
    assert bi.success_rate(kpi_rows(spark, (1, 3, 2))).first()[0] == decimal.Decimal("66.7")


@pytest.mark.parametrize("value, band", [(49.9, "red"), (50, "yellow"), (79.9, "yellow"), (80, "green")])
def test_success_band(spark, value, band):
    assert spark.range(1).select(bi.success_band(F.lit(value))).first()[0] == band


def test_report_order_and_limits(spark):
    k = kpi_rows(spark, *[(d, 1, 1) for d in range(1, 13)])
    assert [r["day"].day for r in bi.detail_table(k).collect()][:2] == [12, 11]
    assert [r["day"].day for r in bi.latest(k, 10).collect()] == list(range(12, 2, -1))
    assert [r["day"].day for r in bi.latest_rounded(k, 5).collect()] == [12, 11, 10, 9, 8]
    assert bi.detail_table(k).first()["avg_rental_duration_min"] == decimal.Decimal("1.3")
    assert [r["day"].day for r in mart.kpi_in_order(k).collect()] == list(range(1, 13))
    assert bi.last_days(k, "2025-01-10", 7).count() == 8
    assert "TakeOrderedAndProject" in bi.latest(k, 10)._jdf.queryExecution().executedPlan().toString()


# ----- ingest


def test_common_columns_keep_source_order(spark):
    src = spark.createDataFrame([("s", "i", 1, 2)], "station_id string, id string, extra int, _hidden int")
    assert extract.common_columns(src, QUOTES) == ["station_id", "id"]
    with pytest.raises(ValueError):
        extract.common_columns(src.select("extra", "_hidden"), QUOTES)


def test_full_load_stamps_and_types(spark):
    out = extract.full_load(payments(spark, ("r", 1, True)).withColumn("amount", F.lit("12")), PAYMENT_ATTEMPTS, NOW)
    assert out.columns == PAYMENT_ATTEMPTS.names
    r = out.first()
    assert r["amount"] == 12 and r["_ingested_at"] == dt.datetime.fromisoformat(NOW)


def test_debts_come_from_billing_only(spark):
    good, bad = debts(spark, ("r", 1, T0, 0, None)), debts(spark, ("x", 9, T0, 0, None))
    raw = {"raw_rental": {"debts": bad}, "raw_billing": {"debts": good}}
    assert core.core_table("debts", raw).first()["rental_id"] == "r"
    assert {t: core.source_of_truth(t) for t in TABLES}["payment_attempts"] == "raw_billing"


def test_constraint_reports(spark):
    r = rentals(spark, rental("a"), rental("a"), rental("b", price=None), ("c" * 65,) + rental()[1:])
    assert rows(constraints.duplicate_keys(r, "id", "rentals")) == [("rentals", "a", 2)]
    got = {x["column_name"]: x for x in constraints.column_constraints(r, RENTALS, TABLES["rentals"].max_len, "rentals").collect()}
    assert got["price_per_hour"]["null_rows"] == 1
    assert (got["id"]["over_limit_rows"], got["id"]["longest"]) == (1, 65)
    assert got["finished_at"]["null_rows"] == 0


def test_jdbc_options(spark):
    plain = extract.jdbc_options("jdbc:x", "public.rentals", ["id", "status"])
    assert plain["fetchsize"] == "20000" and plain["dbtable"] == "(SELECT id, status FROM public.rentals) AS src"
    split = extract.jdbc_options("jdbc:x", "t", split_column="started_at", bounds=("2025-01-01", "2025-02-01"), partitions=8)
    assert (split["partitionColumn"], split["numPartitions"]) == ("started_at", "8")
    with pytest.raises(ValueError):
        extract.jdbc_options("jdbc:x", "t", split_column="started_at")


@pytest.mark.parametrize("time, text", [
    (dt.datetime(2025, 12, 18, 22, 29, 56, 735935), "2025-12-18 22:29:56.735935+00"),
    (dt.datetime(2025, 12, 18, 22, 29, 50, 120000), "2025-12-18 22:29:50.12+00"),
    (dt.datetime(2025, 12, 18, 22, 20, 0), "2025-12-18 22:20:00+00"),
])
def test_csv_timestamp_text(spark, time, text):
    from voltmart.functions.text import utc_text

    assert spark.createDataFrame([(time,)], "t timestamp").select(utc_text("t")).first()[0] == text


def test_export_round_trip_with_awkward_text(spark):
    items = [(1, "r,1", 5, False, 'say "no", twice', at(0.5)), (2, "r2", 6, True, None, T0), (3, " r3 ", 7, True, "", T0)]
    fact = mart.fct_payments(spark.createDataFrame(items, PAYMENT_COLS))
    folder = export.export_csv(fact, scratch_path(spark, "csv"))
    back = export.parse_export(export.read_export(spark, folder, fact.columns), FCT_PAYMENTS)
    got, wanted = rows(back, "payment_attempt_id"), rows(fact, "payment_attempt_id")
    assert got[:2] == wanted[:2]
    assert got[2][1] == " r3 "


# ----- store and run control


def test_store_reads_whole_versions_only(spark):
    store = LayerStore(spark, scratch_path(spark, "store"))
    store.bootstrap()
    assert store.read("core", "rentals").count() == 0
    q, r, p = golden(spark)
    loads = {"rentals": extract.full_load(r, RENTALS, NOW)}
    rest = ("quotes", "idempotency_keys")
    first = store.publish("raw_rental", "v1", loads, NOW, absent=rest)
    assert first.rows["rentals"] == 4
    store.stage(loads["rentals"].limit(1), "raw_rental", "v2-unfinished", "rentals")
    assert store.read("raw_rental", "rentals").count() == 4
    # A later commit counts, whatever time it is for.
    store.publish("raw_rental", "v2", {"rentals": loads["rentals"].limit(1)}, "2001-01-01 00:00:00", absent=rest)
    assert store.read("raw_rental", "rentals").count() == 1
    assert store.read("raw_rental", "rentals", first.folder).count() == 4
    store.bootstrap()
    assert store.current_version("raw_rental") == "v2"


def test_missing_tables_are_errors(spark):
    store = LayerStore(spark, scratch_path(spark, "store"))
    store.bootstrap()
    q, r, p = golden(spark)
    with pytest.raises(ValueError, match="idempotency_keys"):
        warehouse.extract_source(store, "rental", {"rentals": r, "quotes": q}, "v1", NOW)
    assert store.current_version("raw_rental") is None
    with pytest.raises(AnalysisException):
        store.read("raw_rental", "rentals", "no-such-folder").count()


def few(spark, n):
    """Sources with ``n`` rentals."""
    q, r, p = golden(spark)
    keys = spark.createDataFrame([], TABLES["idempotency_keys"].schema).drop("_ingested_at")
    return {
        "rental": {"quotes": q, "rentals": r.limit(n), "idempotency_keys": keys},
        "billing": {"debts": debts(spark), "payment_attempts": p},
    }


def test_failing_rerun_leaves_the_old_rows(spark):
    root = scratch_path(spark, "rerun")
    warehouse.run_warehouse(spark, few(spark, 2), root, "run-1", NOW)
    bad = few(spark, 2)
    bad["rental"]["rentals"] = bad["rental"]["rentals"].withColumn("price_per_hour", F.expr("1 DIV (deposit - deposit)"))
    with pytest.raises(Exception):
        warehouse.run_warehouse(spark, bad, root, "run-1", NOW)
    store = LayerStore(spark, root)
    assert store.read("raw_rental", "rentals").count() == 2
    assert store.read("core", "rentals").count() == 2
    assert warehouse.read_audit(spark, root).first()["status"] == "FAILED"


def test_backfill_builds_from_its_own_raw(spark):
    root = scratch_path(spark, "backfill")
    warehouse.run_warehouse(spark, few(spark, 4), root, "june", "2025-06-01 00:00:00")
    counts = warehouse.run_warehouse(spark, few(spark, 2), root, "may", "2025-05-01 00:00:00")
    assert counts["core"]["rentals"] == counts["mart"]["fct_rentals"] == 2
    assert LayerStore(spark, root).read("core", "rentals").count() == 2


def test_incremental_run_reads_from_its_bookmarks(spark):
    root = scratch_path(spark, "increment")
    src = few(spark, 4)
    src["billing"]["debts"] = debts(spark, ("a", 1, at(0), 0, None), ("b", 2, at(5), 0, None))
    warehouse.run_warehouse(spark, src, root, "run-1", NOW, incremental=True)
    # A row before the bookmark, which must not be read; one at it, one changed, one new.
    src["billing"]["debts"] = debts(
        spark, ("a", 99, at(0), 0, None), ("c", 3, at(5), 0, None), ("b", 7, at(6), 1, None), ("d", 4, at(9), 0, None)
    )
    warehouse.run_warehouse(spark, src, root, "run-2", "2025-12-19 00:00:00", incremental=True)
    got = LayerStore(spark, root).read("core", "debts").select("rental_id", "amount_total")
    assert rows(got) == [("a", 1), ("b", 7), ("c", 3), ("d", 4)]
    marks = {r["entity"]: r["watermark_value"] for r in LayerStore(spark, root).read("meta", "etl_watermark").collect()}
    assert marks["raw_billing.debts"] == "2025-01-01 12:00:09.000000"
    assert LayerStore(spark, root).read("core", "payment_attempts").count() == 41


def test_run_with_export_twice(spark):
    root = scratch_path(spark, "twice")
    for n in (4, 2):
        warehouse.run_warehouse(spark, few(spark, n), root, "run-1", NOW, f"{root}/export")
    name = export.export_name("mart", "fct_rentals", NOW)
    assert export.read_export(spark, f"{root}/export/{name}", FCT_RENTALS.names).count() == 2
    audit = warehouse.read_audit(spark, root).first()
    assert audit["status"] == "SUCCESS" and audit["finished_at"] > audit["started_at"]
    store = LayerStore(spark, root)
    assert store.read("meta", "etl_run_audit").count() == 1
    assert store.read("meta", "etl_watermark").count() == 3


def test_run_with_export_keeps_no_exchange_files(spark, views):
    """What is left of a run is its tables and its exports, plain text as before."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left() -> set[str]:
        return {x for x in blocks.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}

    root, before = scratch_path(spark, "tidy"), left()
    # Small results (audit rows, bookmarks) may leave theirs until the driver collects its garbage.
    counts = warehouse.run_warehouse(spark, sources(views), root, "run-1", NOW, f"{root}/export")
    folder = f"{root}/export/{export.export_name('mart', 'fct_payments', NOW)}"
    assert counts["mart"]["fct_payments"] == export.read_export(spark, folder, FCT_PAYMENTS.names).count()
    names = spark.read.format("binaryFile").load(folder).select("path").collect()
    assert names and all(r["path"].endswith(".csv") for r in names)
    size = sum(os.path.getsize(f) for x in left() - before for f in [blocks.getFile(x).getPath()] if os.path.exists(f))
    assert size < 100_000


def test_snapshot_and_restore(spark, views):
    root = scratch_path(spark, "snap")
    warehouse.run_warehouse(spark, sources(views), root, "run-1", NOW)
    store = LayerStore(spark, root)
    kept = rows(store.read("mart", "kpi_daily"))
    store.snapshot(f"{root}/snapshot")
    store.publish("mart", "oops", {}, "2025-12-19 00:00:00", absent=("fct_rentals", "fct_payments", "kpi_daily"))
    assert store.read("mart", "kpi_daily").count() == 0
    store.restore(f"{root}/snapshot", "back", "2025-12-18 00:00:00", warehouse.ORDER)
    assert rows(store.read("mart", "kpi_daily")) == kept


def test_stored_tables_are_exchanged_once_and_leave_nothing(spark):
    """Only the load exchanges rows; core and restored files hold the ranges of the raw ones, and no exchange's files stay."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left() -> set[str]:
        names = (str(x) for x in blocks.getAllBlocks().mkString(" ").split())
        return {x for x in names if x.startswith("shuffle_")}

    def ranges(folder: str) -> list[tuple]:
        files = spark.read.parquet(folder).groupBy(F.input_file_name().alias("f")).agg(F.min("created_at").alias("a"), F.max("created_at").alias("b"), F.count("*").alias("n"))
        return sorted((r.a, r.b, r.n) for r in files.collect())

    n, root = 4000, scratch_path(spark, "ranges")
    ids = F.col("id")
    paid = spark.range(0, n, 1, 7).select(
        ids, F.concat(F.lit("r"), ids % 50).alias("rental_id"), F.lit(5).alias("amount"), F.lit(True).alias("success"),
        F.lit(None).cast("string").alias("error"), F.timestamp_seconds(1_700_000_000 + F.xxhash64("id") % 90_000).alias("created_at"),
    )
    src = few(spark, 4)
    src["billing"]["payment_attempts"] = paid
    before = left()
    store = LayerStore(spark, root)
    store.bootstrap()
    conf = {k: spark.conf.get(k, None) for k in ("spark.sql.files.openCostInBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    with_small_files = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with lent_options(spark, with_small_files):
        raw = {f"raw_{s}": warehouse.extract_source(store, s, tables, "v1", NOW) for s, tables in src.items()}
        core = warehouse.build_core(store, "v1", NOW, raw)
        store.snapshot(f"{root}/snapshot")
    # Looking up the newest commit leaves a few bytes until the driver collects its garbage.
    assert sum(os.path.getsize(f) for x in left() - before for f in [blocks.getFile(x).getPath()] if os.path.exists(f)) < 20_000
    first = ranges(f"{root}/raw_billing/{raw['raw_billing'].folder}/payment_attempts")
    assert len(first) > 1 and sum(r[2] for r in first) == n and all(a[1] <= b[0] for a, b in zip(first, first[1:]))
    assert ranges(f"{root}/core/{core.folder}/payment_attempts") == ranges(f"{root}/snapshot/core/payment_attempts") == first
    assert conf == {k: spark.conf.get(k, None) for k in conf}


def test_watermark_log(spark):
    log = spark.createDataFrame(
        [("a", "1", at(0)), ("a", "2", at(5)), ("b", "9", at(1))], "entity string, watermark_value string, updated_at timestamp"
    )
    assert rows(meta.latest_watermarks(log)) == [("a", "2", at(5)), ("b", "9", at(1))]
    assert meta.watermark_row(rentals(spark), "x", "started_at", NOW).count() == 0


def test_merge_latest(spark):
    old = debts(spark, ("a", 1, at(0), 0, None), ("b", 2, at(0), 0, None))
    new = debts(spark, ("a", 5, at(3), 1, None), ("a", 4, at(2), 9, None), ("c", 7, at(1), 0, at(1)))
    out = meta.merge_latest(old, new, "rental_id", "updated_at")
    assert rows(out, "rental_id") == [("a", 5, at(3), 1, None), ("b", 2, at(0), 0, None), ("c", 7, at(1), 0, at(1))]
    assert rows(meta.merge_latest(out, new, "rental_id", "updated_at"), "rental_id") == rows(out, "rental_id")
    assert meta.rows_since(new, "updated_at", "2025-01-01 12:00:02").count() == 2
    assert meta.rows_since(new, "updated_at", None).count() == 3


def test_running_row_until_finished(spark):
    opening = meta.run_started(spark, "r1", "warehouse_daily", NOW)
    assert meta.latest_runs(opening).first()["status"] == "RUNNING"
    closing = meta.run_finished(opening, NOW, "SUCCESS", "{}")
    assert meta.latest_runs(opening.unionByName(closing)).first()["status"] == "SUCCESS"
