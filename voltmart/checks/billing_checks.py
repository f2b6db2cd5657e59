"""Registered queries of section G."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltmart.checks.registry import query
from voltmart.checks.sqlviews import sql
from voltmart.functions.money import BillingConfig
from voltmart.operators import billing, ledger
from voltmart.plans import billing_tick, replay
from voltmart.sources.testviews import TestViews

CFG = BillingConfig()
AS_OF = "2001-12-01 00:00:00"


def now(text: str = AS_OF):
    return F.lit(text).cast("timestamp")


def due_sql(price: str, free: str, start: str, at: str) -> str:
    billable = f"greatest(0, date_diff('second', {start}, {at}) - 60 * {free})"
    return f"CASE WHEN {start} IS NULL THEN 0 ELSE ({price} * {billable} + 3599) // 3600 END"


def backoff_sql(attempts: str) -> str:
    return f"least(60 * (1 << least({attempts}, 8)), 3600)"


@query("g1_active_rentals", sql("SELECT id FROM rentals WHERE status = 'ACTIVE'", "rentals"))
def g1(v):
    return billing.active_rentals(v.rentals()).select("id")


@query(
    "g2_amount_due",
    sql(
        f"SELECT r.id AS rental_id, {due_sql('price_per_hour', 'free_period_min', 'started_at', 'now_ts')} AS due_amount "
        "FROM rentals_base r JOIN clock c ON c.rental_id = r.id",
        "rentals_base",
        "clock",
    ),
)
def g2(v):
    timed = v.rentals_base().join(v.clock().withColumnRenamed("rental_id", "id"), "id")
    return billing.amounts_due(timed, F.col("now_ts"))


@query(
    "g3_total_paid",
    sql(
        "SELECT r.id AS rental_id, CAST(coalesce(sum(CASE WHEN p.success THEN p.amount END), 0) AS BIGINT) AS paid "
        "FROM rentals_base r LEFT JOIN payment_attempts p ON p.rental_id = r.id GROUP BY r.id",
        "rentals_base",
        "payment_attempts",
    ),
)
def g3(v):
    return billing.total_paid(v.rentals_base(), v.payment_attempts())


@query(
    "g4_payment_history",
    sql("SELECT * FROM payment_attempts ORDER BY rental_id, created_at DESC, id DESC", "payment_attempts"),
)
def g4(v):
    return billing.payment_history(v.payment_attempts())


@query(
    "g5_successful_payments",
    sql(
        "SELECT * FROM payment_attempts WHERE success ORDER BY rental_id, created_at DESC, id DESC",
        "payment_attempts",
    ),
)
def g5(v):
    return billing.successful_payments(v.payment_attempts())


@query(
    "g6_current_debt",
    sql(
        "SELECT r.id AS rental_id, coalesce(d.amount_total, 0) AS debt "
        "FROM rentals_base r LEFT JOIN debts d ON d.rental_id = r.id",
        "rentals_base",
        "debts",
    ),
)
def g6(v):
    return billing.current_debt(v.rentals_base(), v.debts())


@query("g7_total_debt", sql("SELECT CAST(coalesce(sum(amount_total), 0) AS BIGINT) AS total_debt FROM debts", "debts"))
def g7(v):
    return billing.total_debt(v.debts())


@query(
    "g8_payment_stats",
    sql(
        "SELECT rental_id, count(*) AS attempts_total, count(*) FILTER (WHERE success) AS attempts_ok, "
        "CAST(sum(CASE WHEN success THEN amount ELSE 0 END) AS BIGINT) AS amount_sum "
        "FROM payment_attempts GROUP BY rental_id",
        "payment_attempts",
    ),
)
def g8(v):
    return billing.payment_stats(v.payment_attempts())


@query(
    "g9_attempted_amounts",
    sql(
        "SELECT rental_id, CAST(sum(amount) AS BIGINT) AS attempted_amount FROM payment_attempts GROUP BY rental_id",
        "payment_attempts",
    ),
)
def g9(v):
    return billing.attempted_amounts(v.payment_attempts())


@query(
    "g10_buyout_minutes",
    sql(
        "SELECT id AS quote_id, greatest(free_period_min + CAST(trunc(7500.0::DOUBLE / greatest(price_per_hour, 1) * 60) "
        "AS BIGINT), free_period_min + 10) AS minutes_needed FROM quotes",
        "quotes",
    ),
)
def g10(v):
    return billing.buyout_minutes(v.quotes(), CFG.r_buyout)


# One billing pass in SQL: exposure, plan, decision.
_PASS = f"""
paid AS (SELECT rental_id, sum(amount) AS paid FROM payment_attempts WHERE success GROUP BY 1),
x AS (
  SELECT r.*, c.now_ts, CAST(coalesce(p.paid, 0) AS BIGINT) AS paid, coalesce(d.amount_total, 0) AS debt_amount,
         d.rental_id IS NOT NULL AS has_debt_row, coalesce(d.attempts, 0) AS debt_attempts, d.last_attempt_at,
         CAST(coalesce(p.paid, 0) AS BIGINT) + coalesce(d.amount_total, 0) AS exposure
  FROM rentals r JOIN clock c ON c.rental_id = r.id
  LEFT JOIN paid p ON p.rental_id = r.id LEFT JOIN debts d ON d.rental_id = r.id
  WHERE r.status = 'ACTIVE'
),
due AS (SELECT *, {due_sql('price_per_hour', 'free_period_min', 'started_at', 'now_ts')} AS due FROM x),
plan AS (SELECT *, least(greatest(0, due - exposure), greatest(0, 5000 - exposure)) AS to_charge FROM due),
branched AS (
  SELECT *, CASE WHEN exposure >= 5000 THEN 'buyout' WHEN to_charge > 0 THEN 'usage'
       WHEN debt_amount > 0 AND (last_attempt_at IS NULL
            OR date_diff('microsecond', last_attempt_at, now_ts) >= 1000000 * {backoff_sql('debt_attempts')})
       THEN 'debt' ELSE 'none' END AS branch
  FROM plan
),
amounts AS (
  SELECT b.*, CASE branch WHEN 'usage' THEN to_charge WHEN 'debt' THEN least(debt_amount, 100) ELSE 0 END AS attempt_amount,
         CASE WHEN branch IN ('usage', 'debt') THEN coalesce(o.success, FALSE) END AS success,
         CASE WHEN branch IN ('usage', 'debt') AND NOT coalesce(o.success, FALSE)
              THEN coalesce(o.error, 'No answer from the payment service') END AS error
  FROM branched b LEFT JOIN outcomes o ON o.rental_id = b.id
),
effects AS (
  SELECT *, CASE WHEN success THEN attempt_amount ELSE 0 END AS charged_amount,
         CASE WHEN branch = 'usage' AND NOT success THEN attempt_amount
              WHEN branch = 'debt' AND success THEN -attempt_amount ELSE 0 END AS debt_delta
  FROM amounts
),
decided AS (SELECT *, exposure + charged_amount + debt_delta >= 5000 AS bought_out FROM effects)"""
_NEEDS = ("rentals", "payment_attempts", "debts", "outcomes", "clock")


def pass_sql(body: str) -> str:
    return sql(f"WITH {_PASS.strip()}\n{body}", *_NEEDS)


def timed_rentals(v: TestViews):
    return v.rentals().join(v.clock().withColumnRenamed("rental_id", "id"), "id")


def planned(v: TestViews):
    active = billing.active_rentals(timed_rentals(v))
    exposed = billing.with_exposure(active, v.payment_attempts(), v.debts())
    return billing_tick.charge_plan(exposed, F.col("now_ts"), CFG)


def decided(v: TestViews):
    return billing_tick.decisions(
        timed_rentals(v), v.payment_attempts(), v.debts(), v.outcomes(), F.col("now_ts"), CFG
    )


@query("g11_exposure", pass_sql("SELECT id AS rental_id, paid, debt_amount, exposure, has_debt_row FROM x"))
def g11(v):
    active = billing.active_rentals(v.rentals())
    return billing.with_exposure(active, v.payment_attempts(), v.debts()).select(
        F.col("id").alias("rental_id"), "paid", "debt_amount", "exposure", "has_debt_row"
    )


@query(
    "g12_buyout_precheck",
    pass_sql("SELECT id AS rental_id, exposure, branch = 'buyout' AS buyout_reached FROM branched"),
)
def g12(v):
    return planned(v).select(
        F.col("id").alias("rental_id"), "exposure", (F.col("branch") == "buyout").alias("buyout_reached")
    )


@query("g13_charge_plan", pass_sql("SELECT id AS rental_id, due, exposure, to_charge, branch FROM branched"))
def g13(v):
    return planned(v).select(F.col("id").alias("rental_id"), "due", "exposure", "to_charge", "branch")


@query(
    "g14_charge_outcome",
    sql(
        """
        WITH req AS (SELECT order_id AS rental_id, CAST(length(order_id) * 50 - 100 AS INTEGER) AS amount FROM stop_requests)
        SELECT q.rental_id, q.amount,
               q.amount <= 0 OR (r.id IS NOT NULL AND coalesce(o.success, FALSE)) AS success,
               CASE WHEN q.amount <= 0 THEN NULL
                    WHEN r.id IS NULL THEN 'Rental ' || q.rental_id || ' not found'
                    WHEN NOT coalesce(o.success, FALSE) THEN coalesce(o.error, 'No answer from the payment service')
               END AS error,
               q.amount > 0 AND r.id IS NOT NULL AS attempt_recorded,
               CASE WHEN q.amount > 0 AND r.id IS NOT NULL AND o.success THEN q.amount ELSE 0 END AS rental_delta,
               CASE WHEN q.amount > 0 AND NOT (r.id IS NOT NULL AND coalesce(o.success, FALSE)) THEN q.amount ELSE 0 END AS debt_delta
        FROM req q LEFT JOIN rentals_base r ON r.id = q.rental_id LEFT JOIN outcomes o ON o.rental_id = q.rental_id""",
        "stop_requests",
        "rentals_base",
        "outcomes",
    ),
)
def g14(v):
    requests = v.stop_requests().select(
        F.col("order_id").alias("rental_id"), (F.length("order_id") * 50 - 100).cast("int").alias("amount")
    )
    return billing_tick.charge_requests(requests, v.rentals_base(), v.outcomes())


@query(
    "g15_backoff",
    sql(f"SELECT rental_id, attempts, {backoff_sql('attempts')} AS backoff_seconds FROM debts", "debts"),
)
def g15(v):
    return ledger.retry_states(v.debts(), now(), CFG).select("rental_id", "attempts", "backoff_seconds")


@query(
    "g16_retry_eligibility",
    sql(
        f"""
        SELECT d.rental_id, d.attempts, {backoff_sql('d.attempts')} AS backoff_seconds,
               d.amount_total > 0 AND (d.last_attempt_at IS NULL OR date_diff('microsecond', d.last_attempt_at, c.now_ts)
               >= 1000000 * {backoff_sql('d.attempts')}) AS should_retry
        FROM debts d JOIN clock c ON c.rental_id = d.rental_id""",
        "debts",
        "clock",
    ),
)
def g16(v):
    timed = v.debts().join(v.clock(), "rental_id")
    return ledger.retry_states(timed, F.col("now_ts"), CFG)


@query(
    "g17_billing_pass",
    pass_sql(
        "SELECT id AS rental_id, due, paid, debt_amount, exposure, branch, attempt_amount, success, error, "
        "charged_amount, debt_delta, bought_out FROM decided"
    ),
)
def g17(v):
    return decided(v).select(
        F.col("id").alias("rental_id"), "due", "paid", "debt_amount", "exposure", "branch", "attempt_amount",
        "success", "error", "charged_amount", "debt_delta", "bought_out",
    )


@query(
    "g17_rentals_after",
    pass_sql(
        """
        SELECT r.id, r.user_id, r.powerbank_id, r.price_per_hour, r.free_period_min, r.deposit,
               CASE WHEN d.bought_out THEN 'BUYOUT' ELSE r.status END AS status,
               CAST(r.total_amount + coalesce(d.charged_amount, 0) AS INTEGER) AS total_amount, r.started_at,
               CASE WHEN d.bought_out THEN d.now_ts ELSE r.finished_at END AS finished_at
        FROM rentals r LEFT JOIN decided d ON d.id = r.id"""
    ),
)
def g17_rentals(v):
    return billing_tick.rentals_after(v.rentals(), decided(v))


@query(
    "g17_debts_after",
    pass_sql(
        """
        , eff AS (SELECT * FROM decided WHERE branch = 'debt' OR (branch = 'usage' AND NOT success))
        SELECT coalesce(d.rental_id, e.id) AS rental_id,
               CAST(coalesce(d.amount_total, 0) + coalesce(e.debt_delta, 0) AS INTEGER) AS amount_total,
               CASE WHEN e.branch = 'usage' OR e.success THEN e.now_ts ELSE d.updated_at END AS updated_at,
               CAST(CASE WHEN e.branch = 'debt' AND e.success THEN 0 WHEN d.rental_id IS NULL THEN 0
                         WHEN e.branch = 'debt' THEN d.attempts + 1 ELSE d.attempts END AS INTEGER) AS attempts,
               CASE WHEN e.branch = 'debt' AND e.success THEN NULL
                    WHEN e.branch = 'debt' THEN e.now_ts ELSE d.last_attempt_at END AS last_attempt_at
        FROM debts d FULL JOIN eff e ON e.id = d.rental_id"""
    ),
)
def g17_debts(v):
    return billing_tick.debts_after(v.debts(), decided(v))


@query(
    "g17_attempts",
    pass_sql(
        "SELECT id AS rental_id, CAST(attempt_amount AS INTEGER) AS amount, success, error, now_ts AS created_at "
        "FROM decided WHERE branch IN ('usage', 'debt')"
    ),
)
def g17_attempts(v):
    return billing_tick.attempt_rows(decided(v))


@query(
    "g18_debt_collection",
    pass_sql(
        "SELECT id AS rental_id, debt_amount, debt_attempts, attempt_amount, success, charged_amount, debt_delta "
        "FROM decided WHERE branch = 'debt'"
    ),
)
def g18(v):
    return decided(v).filter(F.col("branch") == "debt").select(
        F.col("id").alias("rental_id"), "debt_amount", "debt_attempts", "attempt_amount", "success",
        "charged_amount", "debt_delta",
    )


# Deltas for the ledger operators: all payment lines, several per rental. Rentals that only paid
# have no debt yet.
_DELTAS = "deltas AS (SELECT rental_id, amount, created_at AS ts FROM payment_attempts)"


def _deltas(v):
    return v.payment_attempts().select("rental_id", "amount", F.col("created_at").alias("now"))


def _upsert_sql(stamp: str) -> str:
    return sql(
        f"""
        WITH {_DELTAS},
        a AS (SELECT rental_id, sum(amount) AS amount, {stamp} AS at FROM deltas GROUP BY 1)
        SELECT coalesce(o.rental_id, a.rental_id) AS rental_id,
               CAST(coalesce(o.amount_total, 0) + coalesce(a.amount, 0) AS INTEGER) AS amount_total,
               coalesce(a.at, o.updated_at) AS updated_at, CAST(coalesce(o.attempts, 0) AS INTEGER) AS attempts,
               o.last_attempt_at
        FROM debts o FULL JOIN a ON a.rental_id = o.rental_id""",
        "payment_attempts",
        "debts",
    )


@query("g19_add_debt", _upsert_sql(f"TIMESTAMP '{AS_OF}'"))
def g19(v):
    return ledger.add_debt(v.debts(), _deltas(v).drop("now"), now())


@query("g20_attach_debt", _upsert_sql("max(ts)"))
def g20(v):
    return ledger.attach_debt(v.debts(), _deltas(v))


@query(
    "g21_reduce_debt",
    sql(
        f"""
        WITH p AS (SELECT rental_id, CAST(max(amount) + CAST(rental_id AS BIGINT) % 3 - 1 AS INTEGER) AS amount
                   FROM payment_attempts WHERE NOT success GROUP BY rental_id)
        SELECT d.rental_id, CAST(CASE WHEN d.amount_total >= p.amount THEN d.amount_total - p.amount
                                 ELSE d.amount_total END AS INTEGER) AS amount_total,
               CASE WHEN d.amount_total >= p.amount THEN TIMESTAMP '{AS_OF}' ELSE d.updated_at END AS updated_at,
               CASE WHEN d.amount_total >= p.amount THEN 0 ELSE d.attempts END AS attempts,
               CASE WHEN d.amount_total >= p.amount THEN NULL ELSE d.last_attempt_at END AS last_attempt_at,
               coalesce(d.amount_total >= p.amount, FALSE) AS changed
        FROM debts d LEFT JOIN p ON p.rental_id = d.rental_id""",
        "payment_attempts",
        "debts",
    ),
)
def g21(v):
    """Payments of one below, exactly and one above the largest failed attempt."""
    shift = F.col("rental_id").cast("bigint") % 3 - 1
    pay = (
        v.payment_attempts().filter(~F.col("success")).groupBy("rental_id")
        .agg(F.max("amount").alias("m")).select("rental_id", (F.col("m") + shift).cast("int").alias("amount"), now().alias("now"))
    )
    return ledger.reduce_debt(v.debts(), pay)


@query(
    "g22_increment_attempts",
    sql(
        """
        WITH f AS (SELECT rental_id, count(*) AS n, max(created_at) AS at FROM payment_attempts GROUP BY 1)
        SELECT d.rental_id, d.amount_total, d.updated_at,
               CAST(d.attempts + coalesce(f.n, 0) AS INTEGER) AS attempts,
               coalesce(f.at, d.last_attempt_at) AS last_attempt_at, f.n IS NOT NULL AS changed
        FROM debts d LEFT JOIN f ON f.rental_id = d.rental_id""",
        "payment_attempts",
        "debts",
    ),
)
def g22(v):
    failures = v.payment_attempts().select("rental_id", F.col("created_at").alias("now"))
    return ledger.increment_attempts(v.debts(), failures)


@query(
    "g23_finish_rentals",
    sql(
        """
        WITH stops AS (SELECT order_id, min(stopped_at) AS stopped_at FROM stop_requests GROUP BY order_id)
        SELECT r.* EXCLUDE (status, finished_at),
               CASE WHEN r.status = 'ACTIVE' AND s.order_id IS NOT NULL THEN 'FINISHED' ELSE r.status END AS status,
               CASE WHEN r.status = 'ACTIVE' AND s.order_id IS NOT NULL THEN s.stopped_at ELSE r.finished_at END AS finished_at,
               r.status = 'ACTIVE' AND s.order_id IS NOT NULL AS changed
        FROM rentals r LEFT JOIN stops s ON s.order_id = r.id""",
        "rentals",
        "stop_requests",
    ),
)
def g23(v):
    requests = v.stop_requests().select(
        F.col("order_id").alias("rental_id"), F.lit("FINISHED").alias("status"), F.col("stopped_at").alias("now")
    )
    return ledger.finish_rentals(v.rentals(), requests)


@query(
    "g24_add_to_totals",
    sql(
        """
        WITH a AS (SELECT rental_id, sum(amount) AS amount FROM payment_attempts WHERE success GROUP BY 1)
        SELECT r.* EXCLUDE (total_amount), CAST(r.total_amount + coalesce(a.amount, 0) AS INTEGER) AS total_amount,
               a.rental_id IS NOT NULL AS changed
        FROM rentals r LEFT JOIN a ON a.rental_id = r.id""",
        "rentals",
        "payment_attempts",
    ),
)
def g24(v):
    deltas = v.payment_attempts().filter("success").select("rental_id", "amount")
    return ledger.add_to_totals(v.rentals(), deltas)


@query(
    "g25_tick_summary",
    pass_sql(
        "SELECT (SELECT count(*) FROM rentals WHERE status = 'ACTIVE') AS active_rentals, "
        "CAST(sum(charged_amount) AS BIGINT) AS total_charged, CAST(sum(debt_delta) AS BIGINT) AS total_debt_delta FROM decided"
    ),
)
def g25(v):
    return billing_tick.summarize(v.rentals(), decided(v))


@query(
    "g26_rejected_rentals",
    sql(
        """
        SELECT id, CASE WHEN deposit = 300 AND powerbank_id = 'pb_2' THEN 'price_per_hour is missing'
                        ELSE 'free_period_min is missing' END AS reason
        FROM rentals WHERE status = 'ACTIVE' AND ((deposit = 300 AND powerbank_id = 'pb_2') OR powerbank_id = 'pb_4')""",
        "rentals",
    ),
)
def g26(v):
    """Damaged terms: devices pb_2 and pb_4 lost a price or a free period."""
    broken = v.rentals().withColumns(
        {
            "price_per_hour": F.when((F.col("deposit") != 300) | (F.col("powerbank_id") != "pb_2"), F.col("price_per_hour")),
            "free_period_min": F.when(F.col("powerbank_id") != "pb_4", F.col("free_period_min")),
        }
    )
    tick = billing_tick.run_tick(
        broken, v.payment_attempts(), v.debts(), v.outcomes(), now(), CFG, reuse=False
    )
    return tick.rejects


_REPLAY = f"""
WITH RECURSIVE paid AS (SELECT rental_id, sum(amount) AS paid FROM payment_attempts WHERE success GROUP BY 1),
st AS (
  SELECT 0 AS tick, r.id, r.status, r.finished_at, r.price_per_hour, r.free_period_min, r.started_at,
         CAST(coalesce(p.paid, 0) AS BIGINT) AS paid, CAST(coalesce(d.amount_total, 0) AS BIGINT) AS debt,
         coalesce(d.attempts, 0) AS attempts, d.last_attempt_at, CAST(0 AS BIGINT) AS charged, CAST(0 AS BIGINT) AS n_attempts
  FROM rentals r LEFT JOIN paid p ON p.rental_id = r.id LEFT JOIN debts d ON d.rental_id = r.id
  WHERE r.status = 'ACTIVE'
  UNION ALL
  SELECT tick, id, CASE WHEN done THEN 'BUYOUT' ELSE status END, CASE WHEN done THEN now_ts ELSE finished_at END,
         price_per_hour, free_period_min, started_at, paid + pay, debt + delta,
         CASE WHEN how = 'debt' AND success THEN 0 WHEN how = 'debt' THEN attempts + 1 ELSE attempts END,
         CASE WHEN how = 'debt' AND success THEN NULL WHEN how = 'debt' THEN now_ts ELSE last_attempt_at END,
         charged + pay, n_attempts + CASE WHEN how IN ('usage', 'debt') THEN 1 ELSE 0 END
  FROM (
    SELECT *, status = 'ACTIVE' AND paid + debt + pay + delta >= 5000 AS done FROM (
      SELECT *, CASE WHEN how IN ('usage', 'debt') AND success THEN amount ELSE 0 END AS pay,
             CASE WHEN how = 'usage' AND NOT success THEN amount WHEN how = 'debt' AND success THEN -amount ELSE 0 END AS delta
      FROM (
        SELECT *, CASE how WHEN 'usage' THEN usage WHEN 'debt' THEN least(debt, 100) ELSE 0 END AS amount FROM (
          SELECT *, CASE WHEN status <> 'ACTIVE' OR paid + debt >= 5000 THEN 'none' WHEN usage > 0 THEN 'usage'
                 WHEN debt > 0 AND (last_attempt_at IS NULL OR date_diff('microsecond', last_attempt_at, now_ts)
                      >= 1000000 * {backoff_sql('attempts')}) THEN 'debt' ELSE 'none' END AS how
          FROM (
            SELECT t.tick, st.* EXCLUDE (tick), t.now_ts, t.success,
                   least(greatest(0, ({due_sql('price_per_hour', 'free_period_min', 'started_at', 't.now_ts')}) - paid - debt),
                         greatest(0, 5000 - paid - debt)) AS usage
            FROM st JOIN ticks t ON t.rental_id = st.id AND t.tick = st.tick + 1
          ))))
  )
)
SELECT id AS rental_id, status, finished_at, paid, debt, attempts, last_attempt_at, charged, n_attempts
FROM st WHERE tick = 6"""
REPLAY_SQL = sql(_REPLAY, "rentals", "payment_attempts", "debts", "ticks")


@query("g27_replay_ticks", REPLAY_SQL)
def g27(v):
    return replay.replay_ticks(v.rentals(), v.payment_attempts(), v.debts(), v.ticks(), CFG)
