"""DuckDB definitions of the domain views in ``sources/testviews.py``."""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, body: str, *needs: str) -> None:
    VIEWS[name] = (needs, body.strip())


_view("ord", """
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS prio,
         o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS start_ts
  FROM orders
""")
_view("rentals_base", """
  SELECT CAST(k AS VARCHAR) AS id, CAST(cust AS VARCHAR) AS user_id,
         'pb_' || CAST(k % 500 AS VARCHAR) AS powerbank_id,
         CAST(60 + 30 * (k % 4) AS INTEGER) AS price_per_hour,
         CAST(5 * (k % 3) AS INTEGER) AS free_period_min,
         CAST(300 + 100 * (k % 2) AS INTEGER) AS deposit,
         CASE WHEN k % 50 = 0 THEN 'FAILED' WHEN st = 'F' THEN 'FINISHED'
              WHEN st = 'P' THEN 'BUYOUT' ELSE 'ACTIVE' END AS status,
         start_ts AS started_at,
         CASE WHEN k % 50 <> 0 AND st IN ('F', 'P')
              THEN start_ts + to_seconds(1800 + k * 37 % 20000) END AS finished_at
  FROM ord
""", "ord")
_view("payment_attempts", """
  SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS rental_id,
         CAST(round(max(l_extendedprice) / 100) AS INTEGER) AS amount,
         min(l_returnflag) <> 'R' AS success,
         CASE WHEN min(l_returnflag) = 'R' THEN 'Payment failed' END AS error,
         min(l_shipdate) AS created_at
  FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
_view("rentals", """
  SELECT b.id, b.user_id, b.powerbank_id, b.price_per_hour, b.free_period_min, b.deposit, b.status,
         CAST(coalesce(p.paid, 0) AS INTEGER) AS total_amount, b.started_at, b.finished_at
  FROM rentals_base b
  LEFT JOIN (SELECT rental_id, sum(CASE WHEN success THEN amount END) AS paid
             FROM payment_attempts GROUP BY rental_id) p ON p.rental_id = b.id
""", "rentals_base", "payment_attempts")
_view("quotes", """
  SELECT 'q' || CAST(k AS VARCHAR) AS id, CAST(cust AS VARCHAR) AS user_id,
         'st_' || CAST(cust // 14 AS VARCHAR) AS station_id,
         CAST(60 + 30 * (k % 4) AS INTEGER) AS price_per_hour,
         CAST(5 * (k % 3) AS INTEGER) AS free_period_min,
         CAST(300 + 100 * (k % 2) AS INTEGER) AS deposit,
         start_ts - to_seconds(k % 90) + to_seconds(60) AS expires_at,
         start_ts - to_seconds(k % 90) AS created_at
  FROM ord WHERE prio <> '1-URGENT'
""", "ord")
_view("idempotency_keys", """
  SELECT 'old-' || CAST(k AS VARCHAR) AS key, 'start' AS scope, CAST(cust AS VARCHAR) AS user_id,
         '{"order_id":"' || CAST(k AS VARCHAR) || '","status":"ok"}' AS response_json,
         start_ts AS created_at
  FROM ord WHERE st = 'F'
""", "ord")
_view("debts", """
  SELECT rental_id, CAST(sum(amount) AS INTEGER) AS amount_total, max(created_at) AS updated_at,
         CAST(count(*) AS INTEGER) AS attempts,
         CASE WHEN CAST(rental_id AS BIGINT) % 7 <> 0 THEN max(created_at) END AS last_attempt_at
  FROM payment_attempts WHERE NOT success GROUP BY rental_id
""", "payment_attempts")
_view("outcomes", """
  SELECT CAST(k AS VARCHAR) AS rental_id, k % 10 <> 0 AS success,
         CASE WHEN k % 10 = 0 THEN 'Payment failed' END AS error
  FROM ord
""", "ord")
_view("clock", """
  SELECT CAST(k AS VARCHAR) AS rental_id, start_ts + to_seconds(k * 53 % 400000) AS now_ts FROM ord
""", "ord")
_view("ticks", """
  SELECT CAST(k AS VARCHAR) AS rental_id, tick, start_ts + to_seconds(tick * (k * 53 % 90000)) AS now_ts,
         (k + tick) % 4 <> 0 AS success,
         CASE WHEN (k + tick) % 4 = 0 THEN 'Payment failed' END AS error
  FROM ord, (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS tick)
""", "ord")
_view("stations", """
  SELECT 'st_' || CAST(s_suppkey AS VARCHAR) AS id, 'tariff' || CAST(s_nationkey AS VARCHAR) AS tariff_id,
         s_name AS location, s_nationkey <> 3 AS has_slots,
         CAST(s_suppkey * 7 % 101 AS INTEGER) AS charge
  FROM supplier
""")
_view("tariffs", """
  SELECT 'tariff' || CAST(n_nationkey AS VARCHAR) AS id,
         CAST(60 + 10 * (n_nationkey % 5) AS INTEGER) AS price_per_hour,
         CAST(5 * n_regionkey AS INTEGER) AS free_period_min,
         CAST(301 + n_nationkey AS INTEGER) AS default_deposit
  FROM nation
""")
_view("profiles", """
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment = 'BUILDING' AS has_subscribtion,
         c_acctbal > 5000 AS trusted
  FROM customer WHERE c_acctbal >= 0
""")
_view("quote_requests", """
  SELECT CAST(k AS VARCHAR) AS request_id, CAST(cust AS VARCHAR) AS user_id,
         'st_' || CAST(cust // 14 AS VARCHAR) AS station_id, start_ts AS requested_at
  FROM ord
""", "ord")
_view("start_requests", """
  SELECT CAST(k AS VARCHAR) AS request_id,
         'q' || CAST(CASE WHEN k % 10 = 5 THEN k - 1 ELSE k END AS VARCHAR) AS quote_id,
         CASE WHEN k % 100 <> 7
              THEN 'k' || CAST(CASE WHEN k % 10 = 9 THEN k - 1 ELSE k END AS VARCHAR) END AS idempotency_key,
         start_ts AS requested_at
  FROM ord
""", "ord")
_view("holds", """
  SELECT CAST(k AS VARCHAR) AS request_id, k % 8 <> 0 AS success FROM ord
""", "ord")
_view("stop_requests", """
  SELECT k || '-' || n AS request_id, CASE WHEN prio = '1-URGENT' THEN 'x' ELSE '' END || CAST(k AS VARCHAR) AS order_id,
         start_ts + to_seconds(3600 + (n - 1) * (k % 2) * 600) AS stopped_at
  FROM ord, (VALUES (1), (2)) AS twice(n)
""", "ord")
_view("api_events", """
  SELECT event_id AS id, ts,
         CASE WHEN user_id % 2 = 0 THEN 'rental-core' ELSE 'billing-worker' END AS service,
         CASE user_id % 3 WHEN 0 THEN 'station' WHEN 1 THEN 'payment' ELSE 'profile' END AS circuit,
         event_type AS kind,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         CAST(round(value * 100) AS BIGINT) AS value_c,
         CAST(round(value * 100) AS BIGINT) / 10000 AS duration_s
  FROM events
""")
_view("debt_operations", """
  SELECT l_orderkey * 10 + l_linenumber AS id, 'billing-worker' AS service,
         CASE min(l_returnflag) WHEN 'A' THEN 'add' WHEN 'R' THEN 'reduce' ELSE 'retry' END AS operation,
         CAST(round(max(l_extendedprice) / 100) AS BIGINT) AS amount,
         min(l_shipdate) + to_seconds((l_orderkey * 10 + l_linenumber) * 613 % 86400) AS ts
  FROM lineitem GROUP BY l_orderkey, l_linenumber
""")


def sql(body: str, *views: str) -> str:
    """Put the named views (and what they need) in front of ``body`` as WITH clauses."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in VIEWS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        visit(view)
    body = body.strip()
    clauses = ",\n".join(f"{name} AS (\n  {VIEWS[name][1]}\n)" for name in ordered)
    if not clauses:
        return body
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        head = body[len("WITH RECURSIVE"):] if recursive else body[len("WITH"):]
        return f"WITH {'RECURSIVE ' if recursive else ''}{clauses},{head}"
    return f"WITH {clauses}\n{body}"
