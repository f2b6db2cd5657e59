"""Registered queries over captured changes: updates and deletes that no bookmark shows (F2, C11, D)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.checks.registry import query
from voltmart.checks.sqlviews import sql
from voltmart.checks.warehouse_checks import KPI_DETAIL, KPI_ROWS, SUCCESS_RATE, kpi_text
from voltmart.functions.time import add_seconds
from voltmart.operators import bi, changes
from voltmart.plans import capture
from voltmart.plans.capture import CapturedTable
from voltmart.session import scratch_path
from voltmart.sources.testviews import TestViews

# What has happened since the first load: rentals of this year have ended, appeared or gone, and
# payments have succeeded late, appeared or gone. Earlier years and all quotes are as they were.
SINCE = "2001-01-01"
_NEW = f">= TIMESTAMP '{SINCE}'"

STATES = f"""
rentals_then AS (
  SELECT * FROM rentals WHERE NOT (started_at {_NEW} AND price_per_hour = 150)
),
rentals_now AS (
  SELECT id, user_id, powerbank_id, price_per_hour, free_period_min, deposit,
         CASE WHEN ended THEN 'FINISHED' ELSE status END AS status, total_amount, started_at,
         CASE WHEN ended THEN started_at + to_seconds(259200) ELSE finished_at END AS finished_at
  FROM (SELECT *, started_at {_NEW} AND status = 'ACTIVE' AND deposit = 400 AS ended FROM rentals)
  WHERE NOT (started_at {_NEW} AND status = 'FAILED')
),
payments_then AS (
  SELECT * FROM payment_attempts WHERE NOT (created_at {_NEW} AND amount > 500)
),
payments_now AS (
  SELECT id, rental_id, amount, success OR late AS success, CASE WHEN NOT late THEN error END AS error, created_at
  FROM (SELECT *, created_at {_NEW} AND NOT success AND amount > 200 AS late FROM payment_attempts)
  WHERE NOT (created_at {_NEW} AND amount < 100)
)"""
_NEEDS = ("rentals", "payment_attempts", "quotes")


def states(v: TestViews) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The tables of the first load and of the next run."""
    since = F.lit(SINCE).cast("timestamp")
    rentals, payments, quotes = v.rentals(), v.payment_attempts(), v.quotes()
    new = F.col("started_at") >= since
    ended = new & (F.col("status") == "ACTIVE") & (F.col("deposit") == 400)
    rentals_now = rentals.filter(~(new & (F.col("status") == "FAILED"))).withColumns(
        {
            "finished_at": F.when(ended, add_seconds("started_at", 259200)).otherwise(F.col("finished_at")),
            "status": F.when(ended, "FINISHED").otherwise(F.col("status")),
        }
    )
    fresh = F.col("created_at") >= since
    late = fresh & ~F.col("success") & (F.col("amount") > 200)
    payments_now = payments.filter(~(fresh & (F.col("amount") < 100))).withColumns(
        {"error": F.when(~late, F.col("error")), "success": F.col("success") | late}
    )
    before = {
        "rentals": rentals.filter(~(new & (F.col("price_per_hour") == 150))),
        "payment_attempts": payments.filter(~(fresh & (F.col("amount") > 500))),
        "quotes": quotes,
    }
    return before, {"rentals": rentals_now, "payment_attempts": payments_now, "quotes": quotes}


def captured(v: TestViews, names: list[str]) -> dict[str, CapturedTable]:
    """First load and one run with changes."""
    before, after = states(v)
    held = capture.tables(v.spark, scratch_path(v.spark, "captured"), names)
    capture.capture_all(held, before, 1)
    capture.capture_all(held, after, 2)
    return held


def states_sql(body: str) -> str:
    return sql(f"WITH {STATES.strip()}{body}", *_NEEDS)


def _differ(columns: str) -> str:
    """Changes between rentals_then and rentals_now."""
    return f"""
SELECT CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END AS op,
       {columns}
FROM rentals_then b FULL JOIN rentals_now a ON a.id = b.id
WHERE (b.id IS NULL) <> (a.id IS NULL) OR a.status <> b.status OR a.finished_at IS DISTINCT FROM b.finished_at"""


@query(
    "f2_captured_changes",
    states_sql(
        _differ(
            "coalesce(b.id, a.id) AS id, b.status AS status_before, a.status AS status_after, "
            "b.finished_at AS finished_before, a.finished_at AS finished_after"
        )
    ),
)
def captured_changes(v):
    """Inserted, ended and deleted rentals, found without a bookmark."""
    table = captured(v, ["rentals"])["rentals"]
    return table.changes_since(1, 2).select(
        "op", F.col("key").alias("id"), F.col("before.status").alias("status_before"),
        F.col("after.status").alias("status_after"), F.col("before.finished_at").alias("finished_before"),
        F.col("after.finished_at").alias("finished_after"),
    )


@query(
    "f2_changed_ranges",
    states_sql(
        f""",
changed AS ({_differ("CAST(coalesce(b.started_at, a.started_at) AS DATE) AS on_day")}),
days AS (
  SELECT CAST(started_at AS DATE) AS on_day, count(*) AS b, 0 AS a FROM rentals_then GROUP BY 1
  UNION ALL SELECT CAST(started_at AS DATE), 0, count(*) FROM rentals_now GROUP BY 1
)
SELECT CAST(on_day AS VARCHAR) AS day, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS rows_after,
       on_day IN (SELECT on_day FROM changed) AS changed
FROM days GROUP BY on_day"""
    ),
)
def changed_ranges(v):
    """Days of both states with their rows, and whether any range of the day differs."""
    table = captured(v, ["rentals"])["rentals"]
    ranges = changes.compared_ranges(table.digests(1), table.digests(2))
    return ranges.groupBy(F.col("range_day").alias("day")).agg(
        F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"), F.bool_or("changed").alias("changed")
    )


@query("f2_captured_table", states_sql("\nSELECT * FROM rentals_now"))
def captured_table(v):
    """The table put together from its full load and the changes."""
    return captured(v, ["rentals"])["rentals"].current()


_TWO = {"rentals": ("rentals_then", "rentals_now"), "payment_attempts": ("payments_then", "payments_now"), "quotes": ("quotes", "quotes")}


@query(
    "f2_capture_report",
    states_sql(
        "\nUNION ALL ".join(
            f"""
SELECT '{name}' AS table_name, count(*) FILTER (b.id IS NULL) AS inserted,
       count(*) FILTER (a.id IS NOT NULL AND b.id IS NOT NULL AND to_json(a) <> to_json(b)) AS updated,
       count(*) FILTER (a.id IS NULL) AS deleted
FROM {then} b FULL JOIN {now} a ON a.id = b.id"""
            for name, (then, now) in _TWO.items()
        )
    ),
)
def capture_report(v):
    """Changes of three tables in one run; quotes have none."""
    held = captured(v, list(_TWO))
    reports = [
        t.reports().filter("run = 2").select(F.lit(n).alias("table_name"), "inserted", "updated", "deleted")
        for n, t in held.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def _kpi_now(body: str) -> str:
    kpi = kpi_text(rentals="rentals_now", payments="payments_now")
    return sql(f"WITH {STATES.strip()},\n{kpi}\n{body}", *_NEEDS)


def kept_kpi(v: TestViews) -> DataFrame:
    return capture.kpi(captured(v, list(_TWO)))


@query("c11_kpi_from_changes", _kpi_now(KPI_ROWS))
def kpi_from_changes(v):
    """KPI from the first load's sums and the changes' signed shares; equals a rebuild from the tables as they are now."""
    return kept_kpi(v)


@query("d7_success_rate_from_changes", _kpi_now(SUCCESS_RATE))
def success_rate_from_changes(v):
    return bi.success_rate(kept_kpi(v)).withColumn("band", bi.success_band(F.col("value")))


@query("d9_detail_from_changes", _kpi_now(KPI_DETAIL))
def detail_from_changes(v):
    return bi.detail_table(kept_kpi(v))
