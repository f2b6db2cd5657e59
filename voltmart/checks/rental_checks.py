"""Registered queries of section H."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltmart.checks.registry import query
from voltmart.checks.sqlviews import sql
from voltmart.functions import ordered
from voltmart.functions.text import parse_start_response
from voltmart.operators import quotes, rentals
from voltmart.plans import claims
from voltmart.sources.testviews import TestViews

_PRICED = """
SELECT sha256('quote:' || r.request_id) AS id, r.request_id, r.user_id, r.station_id, t.price_per_hour, t.free_period_min,
       CAST(CASE WHEN coalesce(p.trusted, FALSE) THEN greatest(0, t.default_deposit // 2) ELSE t.default_deposit END AS INTEGER) AS deposit,
       date_trunc('second', r.requested_at) + to_seconds(60) AS expires_at, r.requested_at AS created_at,
       p.id IS NULL AS from_fallback
FROM quote_requests r JOIN stations s ON s.id = r.station_id JOIN tariffs t ON t.id = s.tariff_id
LEFT JOIN profiles p ON p.id = r.user_id"""
_PRICE_NEEDS = ("quote_requests", "stations", "tariffs", "profiles")


def priced(v: TestViews):
    return quotes.price_quotes(v.quote_requests(), v.stations(), v.tariffs(), v.profiles())


@query("h1_price_quotes", sql(_PRICED, *_PRICE_NEEDS))
def h1(v):
    return priced(v)


@query(
    "h1_failed_quote_requests",
    sql(
        "SELECT r.request_id, r.station_id, 'station not found' AS reason FROM quote_requests r "
        "LEFT JOIN stations s ON s.id = r.station_id WHERE s.id IS NULL",
        "quote_requests",
        "stations",
    ),
)
def h1_failed(v):
    return quotes.failed_quote_requests(v.quote_requests(), v.stations(), v.tariffs())


@query("h2_deposit", sql(f"SELECT request_id, deposit FROM ({_PRICED})", *_PRICE_NEEDS))
def h2(v):
    return priced(v).select("request_id", "deposit")


@query(
    "h3_profile_fallback",
    sql(
        "SELECT r.request_id, r.user_id, coalesce(p.trusted, FALSE) AS trusted, "
        "coalesce(p.has_subscribtion, FALSE) AS has_subscribtion, p.id IS NULL AS from_fallback "
        "FROM quote_requests r LEFT JOIN profiles p ON p.id = r.user_id",
        "quote_requests",
        "profiles",
    ),
)
def h3(v):
    return quotes.with_profiles(v.quote_requests(), v.profiles()).select(
        "request_id", "user_id", "trusted", "has_subscribtion", "from_fallback"
    )


@query("h4_quote_expiry", sql(f"SELECT request_id, created_at, expires_at FROM ({_PRICED})", *_PRICE_NEEDS))
def h4(v):
    return priced(v).select("request_id", "created_at", "expires_at")


@query(
    "h5_quote_validity",
    sql(
        "SELECT r.request_id, r.quote_id, CASE WHEN q.id IS NULL THEN 'not_found' WHEN r.requested_at > q.expires_at "
        "THEN 'expired' ELSE 'valid' END AS validity FROM start_requests r LEFT JOIN quotes q ON q.id = r.quote_id",
        "start_requests",
        "quotes",
    ),
)
def h5(v):
    return quotes.quote_validity(v.start_requests(), v.quotes())


# In this data a request contends for its key or for its quote, never in longer chains, so
# being first in both is the same as winning in time order.
_STARTS = """
checked AS (
  SELECT r.*, coalesce(r.idempotency_key, '') <> '' AS has_key, q.id IS NOT NULL AS quote_found, q.user_id AS quote_user,
         q.price_per_hour, q.free_period_min, q.deposit, q.station_id,
         q.id IS NOT NULL AND r.requested_at > q.expires_at AS quote_expired,
         coalesce(s.has_slots, FALSE) AS ejected, 'powerbank_' || replace(q.station_id, 'st_', '') AS ejected_id,
         sha256('rental:' || r.request_id) AS order_id
  FROM start_requests r LEFT JOIN quotes q ON q.id = r.quote_id LEFT JOIN stations s ON s.id = q.station_id
),
eligible AS (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY requested_at, request_id) AS nk,
                    row_number() OVER (PARTITION BY quote_id ORDER BY requested_at, request_id) AS nq
             FROM checked WHERE has_key AND quote_found AND NOT quote_expired AND ejected),
won AS (SELECT * FROM eligible WHERE nk = 1 AND nq = 1),
started AS (
  SELECT c.*, k.order_id AS cached_order,
         CASE WHEN NOT c.has_key THEN 'key_missing'
              WHEN (k.requested_at, k.request_id) < (c.requested_at, c.request_id) THEN 'cached'
              WHEN NOT c.quote_found OR (u.requested_at, u.request_id) < (c.requested_at, c.request_id) THEN 'quote_not_found'
              WHEN c.quote_expired THEN 'quote_expired' WHEN NOT c.ejected THEN 'eject_failed' ELSE 'started' END AS outcome
  FROM checked c LEFT JOIN won k ON k.idempotency_key = c.idempotency_key LEFT JOIN won u ON u.quote_id = c.quote_id
)"""
_START_NEEDS = ("start_requests", "quotes", "stations", "holds")


def starts_sql(body: str, *more: str) -> str:
    return sql(f"WITH {_STARTS.strip()}\n{body}", *_START_NEEDS, *more)


def decided(v: TestViews):
    return claims.decide_starts(v.start_requests(), v.quotes(), quotes.eject_responses(v.stations()))


@query(
    "h6_idempotent_replay",
    starts_sql("SELECT request_id, idempotency_key, cached_order AS response_order_id FROM started WHERE outcome = 'cached'"),
)
def h6(v):
    return decided(v).filter(F.col("outcome") == "cached").select("request_id", "idempotency_key", "response_order_id")


@query(
    "h6_stored_keys",
    sql(
        """
        WITH stored AS (SELECT 'k' || CAST(k AS VARCHAR) AS key, CAST(k AS VARCHAR) AS old_order FROM ord WHERE st = 'F')
        SELECT r.request_id, s.old_order AS response_order_id FROM start_requests r JOIN stored s ON s.key = r.idempotency_key""",
        "ord",
        "start_requests",
    ),
)
def h6_stored(v):
    """Requests whose key an earlier batch stored get that response."""
    stored = v.idempotency_keys().withColumn("key", F.regexp_replace("key", "^old-", "k"))
    out = claims.decide_starts(v.start_requests(), v.quotes(), quotes.eject_responses(v.stations()), stored)
    by_store = F.length("response_order_id") < 64
    return out.filter((F.col("outcome") == "cached") & by_store).select("request_id", "response_order_id")


@query(
    "h7_key_missing",
    sql("SELECT request_id FROM start_requests WHERE coalesce(idempotency_key, '') = ''", "start_requests"),
)
def h7(v):
    return rentals.key_missing(v.start_requests())


@query(
    "h8_start_outcome",
    starts_sql(
        "SELECT request_id, outcome, CASE outcome WHEN 'cached' THEN 200 WHEN 'started' THEN 200 WHEN 'eject_failed' "
        "THEN 409 ELSE 400 END AS http_code, CASE outcome WHEN 'started' THEN order_id WHEN 'cached' THEN cached_order END "
        "AS response_order_id FROM started"
    ),
)
def h8(v):
    return decided(v).select("request_id", "outcome", "http_code", "response_order_id")


@query(
    "h8_claim_chains",
    sql(
        """
        SELECT id AS request_id
        FROM (SELECT id, row_number() OVER (PARTITION BY service, circuit ORDER BY ts, id) - 1 AS n FROM api_events)
        WHERE n % 2 = 0""",
        "api_events",
    ),
)
def h8_chains(v):
    """Every event of a circuit wants the key that the one before wants, or its quote: chains of thousands."""
    keys = ["service", "circuit"]
    rows = ordered.with_buckets(v.api_events(), keys, "ts", "id")
    n = ordered.scan(rows, keys, ["ts", "id"], {"n": F.lit(1)}).withColumn("n", F.col("n") - 1)

    def part(kind: str, number):
        return F.concat_ws("/", *keys, F.lit(kind), number.cast("string"))

    wanted = n.select(
        part("key", F.floor(F.col("n") / 2)).alias("key"),
        part("quote", F.floor((F.col("n") + 1) / 2)).alias("quote_id"),
        F.struct(F.col("ts").alias("requested_at"), F.col("id").alias("request_id")).alias("turn"),
        F.col("id").alias("order_id"),
    )
    return claims.first_claims(wanted).select(F.col("order_id").alias("request_id"))


@query(
    "h8_contested_starts",
    """
    WITH RECURSIVE asked AS (
      SELECT id, k, q, row_number() OVER (ORDER BY ts, id) AS turn
      FROM (SELECT l_orderkey * 10 + l_linenumber AS id, min(l_shipdate) AS ts, min(l_orderkey) AS k, min(l_partkey) AS q FROM lineitem GROUP BY 1)
    ),
    open(id, k, q, turn, won) AS (
      SELECT id, k, q, turn, FALSE FROM asked
      UNION ALL
      SELECT id, k, q, turn, first
      FROM (
        SELECT *, bool_or(first) OVER (PARTITION BY k) OR bool_or(first) OVER (PARTITION BY q) AS settled
        FROM (SELECT *, turn = min(turn) OVER (PARTITION BY k) AND turn = min(turn) OVER (PARTITION BY q) AS first
              FROM open WHERE NOT won)
      )
      WHERE first OR NOT settled
    )
    SELECT id AS request_id FROM open WHERE won""",
)
def h8_contested(v):
    """Order lines in time order, each wanting its order (as a key) and its part (as a quote)."""
    line = v.table("lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).agg(
        F.min("l_shipdate").cast("timestamp").alias("ts"), F.min("l_orderkey").alias("key"), F.min("l_partkey").alias("quote_id")
    )
    turn = F.struct(F.col("ts").alias("requested_at"), F.col("id").alias("request_id")).alias("turn")
    wanted = line.select("key", "quote_id", turn, F.col("id").alias("order_id"))
    return claims.first_claims(wanted).select(F.col("order_id").alias("request_id"))


@query(
    "h9_new_rentals",
    starts_sql(
        "SELECT order_id AS id, quote_user AS user_id, CASE outcome WHEN 'started' THEN ejected_id ELSE 'PENDING' END AS powerbank_id, "
        "price_per_hour, free_period_min, deposit, CASE outcome WHEN 'started' THEN 'ACTIVE' ELSE 'FAILED' END AS status, "
        "0 AS total_amount, requested_at AS started_at, CAST(NULL AS TIMESTAMP) AS finished_at "
        "FROM started WHERE outcome IN ('started', 'eject_failed')"
    ),
)
def h9(v):
    return rentals.new_rentals(decided(v))


@query(
    "h10_hold_debts",
    starts_sql(
        """
        , f AS (SELECT s.order_id, s.deposit, s.requested_at FROM started s JOIN holds h ON h.request_id = s.request_id
                WHERE s.outcome = 'started' AND NOT h.success)
        SELECT rental_id, amount_total, updated_at, attempts, last_attempt_at FROM debts
        UNION ALL SELECT order_id, deposit, requested_at, 0, NULL FROM f""",
        "debts",
    ),
)
def h10(v):
    return rentals.attach_hold_debts(v.debts(), decided(v), v.holds())


@query(
    "h11_consume_quotes",
    starts_sql("SELECT * FROM quotes WHERE id NOT IN (SELECT quote_id FROM started WHERE outcome = 'started')"),
)
def h11(v):
    return quotes.consume_quotes(v.quotes(), decided(v).filter(F.col("outcome") == "started"))


@query(
    "h12_quote_upkeep",
    sql(
        f"""
        WITH made AS ({_PRICED}),
        every AS (SELECT id, user_id, station_id, price_per_hour, free_period_min, deposit, expires_at, created_at FROM quotes
                  UNION ALL
                  SELECT id, user_id, station_id, price_per_hour, free_period_min, deposit, expires_at, created_at FROM made)
        SELECT * FROM every WHERE id NOT IN (SELECT quote_id FROM start_requests)""",
        *_PRICE_NEEDS,
        "quotes",
        "start_requests",
    ),
)
def h12(v):
    """Create the priced quotes, then delete the requested ones twice."""
    every = quotes.create_quotes(v.quotes(), priced(v), "2001-12-01 00:00:00")
    once = quotes.consume_quotes(every, v.start_requests())
    return quotes.consume_quotes(once, v.start_requests())


@query(
    "h12_get_quotes",
    sql("SELECT * FROM quotes WHERE id IN (SELECT quote_id FROM start_requests)", "quotes", "start_requests"),
)
def h12_get(v):
    return quotes.get_quotes(v.quotes(), v.start_requests())


_STOPS = """
SELECT s.order_id, CASE WHEN r.id IS NULL THEN 'not_found' WHEN r.status = 'FINISHED' OR s.turn > 1 THEN 'already_finished' ELSE 'finished' END AS outcome,
       CASE WHEN r.id IS NULL THEN 404 ELSE 200 END AS http_code, CASE WHEN r.id IS NOT NULL THEN 'FINISHED' END AS status,
       r.powerbank_id, r.total_amount, CASE WHEN r.id IS NOT NULL THEN coalesce(d.amount_total, 0) END AS debt,
       CASE WHEN r.id IS NOT NULL THEN greatest(0, CAST(r.deposit AS BIGINT) - (r.total_amount + coalesce(d.amount_total, 0))) END AS deposit_refund,
       CASE WHEN r.status = 'FINISHED' THEN r.finished_at WHEN r.id IS NOT NULL THEN s.first_at END AS finished_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY stopped_at, request_id) AS turn,
             min(stopped_at) OVER (PARTITION BY order_id) AS first_at FROM stop_requests) s LEFT JOIN rentals r ON r.id = s.order_id LEFT JOIN debts d ON d.rental_id = r.id"""


@query("h13_stop_rentals", sql(_STOPS, "stop_requests", "rentals", "debts"))
def h13(v):
    return rentals.stop_rentals(v.rentals(), v.debts(), v.stop_requests())


@query(
    "h13_rentals_after_stop",
    sql(
        """
        SELECT r.* EXCLUDE (status, finished_at),
               CASE WHEN s.order_id IS NOT NULL THEN 'FINISHED' ELSE r.status END AS status,
               CASE WHEN s.order_id IS NOT NULL AND r.status <> 'FINISHED' THEN s.stopped_at ELSE r.finished_at END AS finished_at
        FROM rentals r LEFT JOIN (SELECT order_id, min(stopped_at) AS stopped_at FROM stop_requests GROUP BY 1) s
          ON s.order_id = r.id""",
        "stop_requests",
        "rentals",
    ),
)
def h13_after(v):
    return rentals.rentals_after_stop(v.rentals(), v.stop_requests())


@query(
    "h14_deposit_refund",
    sql(f"SELECT order_id, deposit_refund FROM ({_STOPS}) WHERE outcome <> 'not_found'", "stop_requests", "rentals", "debts"),
)
def h14(v):
    out = rentals.stop_rentals(v.rentals(), v.debts(), v.stop_requests())
    return out.filter(F.col("outcome") != "not_found").select("order_id", "deposit_refund")


@query(
    "h15_status_view",
    sql(
        "SELECT r.id AS order_id, r.status, r.powerbank_id, r.total_amount, coalesce(d.amount_total, 0) AS debt "
        "FROM rentals r LEFT JOIN debts d ON d.rental_id = r.id",
        "rentals",
        "debts",
    ),
)
def h15(v):
    return rentals.status_view(v.rentals(), v.debts())


@query(
    "h16_station_slots",
    sql(
        "SELECT id AS station_id, CASE WHEN has_slots THEN 2 ELSE 0 END AS slots_total, "
        "CASE WHEN has_slots THEN 1 ELSE 0 END AS slots_free, CASE WHEN has_slots THEN 1 ELSE 0 END AS slots_filled, "
        "CASE WHEN has_slots THEN charge END AS best_charge FROM stations",
        "stations",
    ),
)
def h16(v):
    return quotes.station_slots(v.stations())


@query(
    "h16_slot_rows",
    sql(
        "SELECT id AS station_id, 1 AS index, TRUE AS empty, 0 AS charge FROM stations WHERE has_slots "
        "UNION ALL SELECT id, 2, FALSE, charge FROM stations WHERE has_slots",
        "stations",
    ),
)
def h16_rows(v):
    return quotes.slot_rows(v.stations())


@query(
    "h17_eject_responses",
    sql(
        "SELECT id AS station_id, has_slots AS success, CASE WHEN has_slots THEN 'powerbank_' || replace(id, 'st_', '') "
        "ELSE '' END AS powerbank_id FROM stations",
        "stations",
    ),
)
def h17(v):
    return quotes.eject_responses(v.stations())


@query(
    "h18_start_responses",
    starts_sql(
        """
        SELECT s.idempotency_key AS key, 'start' AS scope, s.quote_user AS user_id,
               '{"order_id":"' || s.order_id || '","status":"ACTIVE","powerbank_id":"' || s.ejected_id ||
               '","total_amount":0,"debt":' || CAST(CASE WHEN h.success THEN 0 ELSE s.deposit END AS VARCHAR) || '}' AS response_json,
               s.requested_at AS created_at
        FROM started s JOIN holds h ON h.request_id = s.request_id WHERE s.outcome = 'started'"""
    ),
)
def h18(v):
    return rentals.start_responses(decided(v), v.holds())


@query(
    "h18_parsed_responses",
    starts_sql(
        """
        SELECT s.idempotency_key AS key, s.order_id, 'ACTIVE' AS status, s.ejected_id AS powerbank_id, 0 AS total_amount,
               CASE WHEN h.success THEN 0 ELSE s.deposit END AS debt
        FROM started s JOIN holds h ON h.request_id = s.request_id WHERE s.outcome = 'started'"""
    ),
)
def h18_parsed(v):
    stored = rentals.start_responses(decided(v), v.holds())
    return stored.select("key", parse_start_response("response_json").alias("r")).select("key", "r.*")
