"""Registered queries of section S: each drains a stream of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.checks.billing_checks import CFG, REPLAY_SQL
from voltmart.checks.monitoring_checks import _RUNS, HOUR, slide_sql
from voltmart.checks.registry import query
from voltmart.checks.rental_checks import starts_sql
from voltmart.checks.sqlviews import sql
from voltmart.checks.warehouse_checks import KPI_ROWS, kpi_sql
from voltmart.operators import mart, quotes
from voltmart.plans.replay import opening_state
from voltmart.session import scratch_path
from voltmart.sources.testviews import TestViews
from voltmart.streaming import batches, billing, starts, windows
from voltmart.streaming.run import drain, folder_stream


class StreamViews(TestViews):
    """The row-wise domain views over streams of the base tables."""

    def table(self, name: str) -> DataFrame:
        return folder_stream(self.spark, self.dir, self.schema_of(name), f"{name}.parquet")


def live(v: TestViews) -> StreamViews:
    return StreamViews(v.spark, v.dir)


def landed(v: TestViews, df: DataFrame) -> DataFrame:
    """A derived table written to a folder and read back as a stream."""
    folder = scratch_path(v.spark, "landing")
    df.write.parquet(folder)
    return folder_stream(v.spark, folder, df.schema)


_EVENTS = """
ev AS (SELECT created_at AS ts, 'quote' AS kind, 0 AS amount FROM quotes
       UNION ALL SELECT started_at, 'start', 0 FROM rentals_base
       UNION ALL SELECT finished_at, 'finish', 0 FROM rentals_base WHERE finished_at IS NOT NULL
       UNION ALL SELECT created_at, CASE WHEN success THEN 'paid' ELSE 'unpaid' END, amount FROM payment_attempts)"""


@query(
    "s1_daily_counts",
    sql(
        f"""
        WITH {_EVENTS.strip()}
        SELECT CAST(ts::DATE AS VARCHAR) AS day, count(*) FILTER (WHERE kind = 'quote') AS quotes_cnt,
               count(*) FILTER (WHERE kind = 'start') AS rentals_started_cnt,
               count(*) FILTER (WHERE kind = 'finish') AS rentals_finished_cnt,
               count(*) FILTER (WHERE kind IN ('paid', 'unpaid')) AS payments_attempts_cnt,
               count(*) FILTER (WHERE kind = 'paid') AS payments_success_cnt,
               CAST(sum(CASE WHEN kind = 'paid' THEN amount ELSE 0 END) AS BIGINT) AS revenue_amount
        FROM ev GROUP BY ts::DATE""",
        "quotes",
        "rentals_base",
        "payment_attempts",
    ),
)
def s1(v):
    """Days closed by the watermark, and the open ones once the source is drained."""

    def events(s: TestViews, payments: DataFrame) -> DataFrame:
        parts = windows.quote_events(s.quotes()).unionByName(windows.rental_events(s.rentals_base()))
        return parts.unionByName(windows.payment_events(payments))

    closed = drain(
        windows.daily_counts(events(live(v), landed(v, v.payment_attempts()))), scratch_path(v.spark, "s1")
    )
    return windows.with_open_windows(closed, events(v, v.payment_attempts()), windows.daily_counts, "day", 86_400)


@query(
    "s2_sliding_rate",
    sql(
        f"SELECT service, status, t, increase, increase / {3 * HOUR} AS per_second FROM ("
        + slide_sql("api_events", ["service", "status"], {"increase": "count(*)"}, 3 * HOUR, HOUR)
        + ")",
        "api_events",
    ),
)
def s2(v):
    """Ranges closed by the watermark, and the open ones once the source is drained."""

    def rate(events: DataFrame) -> DataFrame:
        return windows.sliding_rate(events, ["service", "status"], 3 * HOUR, HOUR)

    closed = drain(rate(live(v).api_events()), scratch_path(v.spark, "s2"))
    return windows.with_open_windows(closed, v.api_events(), rate, "t", 3 * HOUR)


@query(
    "s3_first_per_key",
    sql(
        "SELECT DISTINCT idempotency_key FROM start_requests WHERE idempotency_key IS NOT NULL",
        "start_requests",
    ),
)
def s3(v):
    requests = live(v).start_requests().filter(F.col("idempotency_key").isNotNull())
    requests = requests.withColumnRenamed("requested_at", "ts")
    once = windows.first_per_key(requests, "idempotency_key", "request_id")
    return drain(once, scratch_path(v.spark, "s3")).select("idempotency_key")


@query(
    "s3_answered_starts",
    starts_sql("SELECT request_id, outcome, CASE outcome WHEN 'started' THEN order_id WHEN 'cached' THEN cached_order END AS response_order_id FROM started"),
)
def s3_answered(v):
    """Every start request with its outcome; keys that have started are kept for all later batches."""
    out = starts.answer_starts(
        live(v).start_requests(), v.quotes(), quotes.eject_responses(v.stations()), v.holds(), scratch_path(v.spark, "s3")
    )
    return out.select("request_id", "outcome", "response_order_id")


@query(
    "s4_starts_with_quotes",
    sql(
        "SELECT r.request_id, q.id AS quote_id, r.requested_at, q.expires_at, q.price_per_hour, q.deposit "
        "FROM start_requests r JOIN quotes q ON q.id = r.quote_id "
        "WHERE r.requested_at BETWEEN q.created_at AND q.expires_at",
        "start_requests",
        "quotes",
    ),
)
def s4(v):
    s = live(v)
    return drain(windows.starts_with_quotes(s.start_requests(), s.quotes()), scratch_path(v.spark, "s4"))


@query("s5_stateful_billing", REPLAY_SQL)
def s5(v):
    opening = opening_state(v.rentals(), v.payment_attempts(), v.debts())
    return billing.bill_ticks(live(v).ticks(), opening, scratch_path(v.spark, "s5"), CFG)


@query("s6_failure_runs", sql(f"WITH {_RUNS.strip()}\nSELECT * FROM runs", "api_events"))
def s6(v):
    return batches.detect_failures(live(v).api_events(), scratch_path(v.spark, "s6"), F.col("status") == "error")


@query("s7_mart_refresh", kpi_sql(KPI_ROWS))
def s7(v):
    s = live(v)
    parts = mart.quote_parts(s.quotes()).unionByName(mart.rental_parts(s.rentals_base())).unionByName(
        mart.payment_parts(landed(v, v.payment_attempts()))
    )
    return batches.refresh_mart(parts, scratch_path(v.spark, "s7"))
