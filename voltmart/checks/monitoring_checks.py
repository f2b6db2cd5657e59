"""Registered queries of sections M and R.

The events are sparse, so grids, windows and thresholds are wider than the reference's; the
rule table with the original values is ``operators.alerts.RULES``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from voltmart.checks.billing_checks import decided, pass_sql
from voltmart.checks.registry import query
from voltmart.checks.sqlviews import sql
from voltmart.functions.buckets import (
    API_DURATION_BOUNDS,
    BILLING_CYCLE_BOUNDS,
    DB_QUERY_BOUNDS,
    RENTAL_DURATION_BOUNDS,
)
from voltmart.functions.time import whole_seconds_between
from voltmart.operators import alerts, metrics, quantiles, rates
from voltmart.operators.metrics import FAIL_MAX, RESET_TIMEOUT_SEC

HOUR, DAY = 3600, 86400


def floor_sql(ts: str, step: int) -> str:
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {step * 1_000_000})"


# ----- M: counters


@query(
    "m1_rentals_by_status",
    sql(
        "SELECT 'rental-core' AS service, 'ACTIVE' AS status, count(*) AS total FROM rentals WHERE status <> 'FAILED' "
        "HAVING count(*) > 0 UNION ALL SELECT 'rental-core', status, count(*) FROM rentals "
        "WHERE status <> 'FAILED' AND finished_at IS NOT NULL GROUP BY status "
        "UNION ALL SELECT 'rental-core', 'quotes', count(*) FROM quotes",
        "rentals",
        "quotes",
    ),
)
def m1(v):
    """Starts and ends by status, and the number of quotes as one more row."""
    service = F.lit("rental-core").alias("service")
    made = metrics.rental_increments(v.rentals()).select("service", "status").unionByName(v.quotes().select(service, F.lit("quotes").alias("status")))
    return metrics.counter(made, ["service", "status"])


@query(
    "m2_payment_counters",
    pass_sql(
        """
        SELECT 'billing-worker' AS service, CASE WHEN success THEN 'success' ELSE 'failure' END AS status,
               count(*) AS total, CAST(sum(attempt_amount) AS BIGINT) AS amount_total
        FROM decided WHERE branch = 'usage' OR (branch = 'debt' AND success) GROUP BY 2"""
    ),
)
def m2(v):
    return metrics.counter(metrics.payment_metric_events(decided(v)), ["service", "status"], "amount")


@query(
    "m3_debt_operations",
    sql(
        "SELECT service, operation, count(*) AS total, CAST(sum(amount) AS BIGINT) AS amount_total "
        "FROM debt_operations GROUP BY service, operation",
        "debt_operations",
    ),
)
def m3(v):
    return metrics.counter(v.debt_operations(), ["service", "operation"], "amount")


@query(
    "m3_tick_debt_operations",
    pass_sql(
        """
        SELECT 'billing-worker' AS service, CASE WHEN branch = 'usage' THEN 'add' WHEN success THEN 'reduce' ELSE 'retry' END AS operation,
               count(*) AS total, CAST(sum(abs(debt_delta)) AS BIGINT) AS amount_total
        FROM decided WHERE branch = 'debt' OR (branch = 'usage' AND NOT success) GROUP BY 2"""
    ),
)
def m3_tick(v):
    return metrics.counter(metrics.debt_metric_events(decided(v)), ["service", "operation"], "amount")


_DEBT_GAUGE = """
SELECT service, ts, CAST(delta AS BIGINT) AS delta, CAST(sum(delta) OVER (PARTITION BY service ORDER BY ts) AS BIGINT) AS value
FROM (SELECT service, ts, sum(CASE operation WHEN 'add' THEN amount WHEN 'reduce' THEN -amount ELSE 0 END) AS delta
      FROM debt_operations GROUP BY service, ts)"""
_ACTIVE_GAUGE = """
SELECT 'rental-core' AS service, ts, CAST(delta AS BIGINT) AS delta, CAST(sum(delta) OVER (ORDER BY ts) AS BIGINT) AS value
FROM (SELECT ts, sum(c) AS delta
      FROM (SELECT started_at AS ts, 1 AS c FROM rentals_base WHERE status <> 'FAILED'
            UNION ALL SELECT finished_at, -1 FROM rentals_base WHERE status <> 'FAILED' AND finished_at IS NOT NULL)
      GROUP BY ts)"""


@query("m4_debt_gauge", sql(_DEBT_GAUGE, "debt_operations"))
def m4(v):
    return metrics.debt_gauge(v.debt_operations())


@query("m5_active_rentals_gauge", sql(_ACTIVE_GAUGE, "rentals_base"))
def m5(v):
    return metrics.active_rentals_gauge(v.rentals_base())


@query(
    "m4_debt_changes",
    sql(
        """
        SELECT service, ts, id, CAST(delta AS BIGINT) AS delta,
               CAST(sum(delta) OVER (PARTITION BY service ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
        FROM (SELECT *, CASE operation WHEN 'add' THEN amount WHEN 'reduce' THEN -amount ELSE 0 END AS delta FROM debt_operations)""",
        "debt_operations",
    ),
)
def m4_changes(v):
    """Debt after every single operation, those of one second included."""
    return metrics.debt_changes(v.debt_operations())


@query(
    "m5_active_rental_changes",
    sql(
        """
        SELECT 'rental-core' AS service, ts, id, CAST(delta AS BIGINT) AS delta,
               CAST(sum(delta) OVER (ORDER BY ts, id, delta ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
        FROM (SELECT id, started_at AS ts, 1 AS delta FROM rentals_base WHERE status <> 'FAILED'
              UNION ALL SELECT id, finished_at, -1 FROM rentals_base WHERE status <> 'FAILED' AND finished_at IS NOT NULL)""",
        "rentals_base",
    ),
)
def m5_changes(v):
    """Active rentals after every single start and end."""
    return metrics.active_rental_changes(v.rentals_base())


@query(
    "m6_last_cycle",
    sql(
        "SELECT service, arg_max(value_c, (ts, id)) AS value FROM api_events GROUP BY service",
        "api_events",
    ),
)
def m6(v):
    return metrics.last_value(v.api_events(), ["service"], "value_c", "ts", "id")


def _hist_sql(source: str, labels: list[str], value: str, bounds: list[float]) -> str:
    cols = ", ".join(labels)
    parts = [
        f"SELECT {cols}, '{b}' AS le, count(*) FILTER (WHERE {value} <= {b}::DOUBLE) AS cumulative FROM {source} GROUP BY {cols}"
        for b in bounds
    ]
    parts.append(f"SELECT {cols}, '+Inf' AS le, count({value}) AS cumulative FROM {source} GROUP BY {cols}")
    return "\nUNION ALL ".join(parts)


_DURATIONS = "dur AS (SELECT 'rental-core' AS service, date_diff('second', started_at, finished_at) AS secs FROM rentals_base WHERE finished_at IS NOT NULL)"


def rental_durations(v):
    return v.rentals_base().filter(F.col("finished_at").isNotNull()).select(
        F.lit("rental-core").alias("service"), whole_seconds_between("started_at", "finished_at").alias("secs")
    )


@query(
    "m7_rental_duration_histogram",
    sql("WITH " + _DURATIONS + "\n" + _hist_sql("dur", ["service"], "secs", RENTAL_DURATION_BOUNDS), "rentals_base"),
)
def m7_rental(v):
    wide = metrics.histogram(rental_durations(v), ["service"], "secs", RENTAL_DURATION_BOUNDS)
    return metrics.histogram_rows(wide, ["service"], RENTAL_DURATION_BOUNDS)


@query(
    "m7_duration_sum_count",
    sql(
        "WITH " + _DURATIONS + "\nSELECT service, CAST(sum(secs) AS BIGINT) AS value_sum, count(secs) AS value_count FROM dur GROUP BY service",
        "rentals_base",
    ),
)
def m7_sum(v):
    wide = metrics.histogram(rental_durations(v), ["service"], "secs", RENTAL_DURATION_BOUNDS)
    return wide.select("service", "value_sum", "value_count")


for _n, _labels, _b in [
    ("m7_api_duration_histogram", ["service", "circuit", "kind"], API_DURATION_BOUNDS),
    ("m7_db_query_histogram", ["service", "kind"], DB_QUERY_BOUNDS),
    ("m7_billing_cycle_histogram", ["service"], BILLING_CYCLE_BOUNDS),
]:
    query(_n, sql(_hist_sql("api_events", _labels, "duration_s", _b), "api_events"))(
        lambda v, ls=_labels, b=_b: metrics.histogram_rows(
            metrics.histogram(v.api_events(), ls, "duration_s", b), ls, b
        )
    )


def _count_sql(labels: list[str], where: str = "TRUE") -> str:
    cols = ", ".join(labels)
    return sql(f"SELECT {cols}, count(*) AS total FROM api_events WHERE {where} GROUP BY {cols}", "api_events")


@query("m8_external_calls", _count_sql(["service", "circuit", "kind", "status"]))
def m8(v):
    return metrics.counter(v.api_events(), ["service", "circuit", "kind", "status"])


@query("m9_errors_by_type", _count_sql(["service", "circuit"], "status = 'error'"))
def m9_errors(v):
    return metrics.counter(v.api_events().filter("status = 'error'"), ["service", "circuit"])


@query("m9_cycles", _count_sql(["service"], "kind = 'view'"))
def m9_cycles(v):
    return metrics.counter(v.api_events().filter("kind = 'view'"), ["service"])


@query(
    "m10_state_codes",
    sql(
        """
        SELECT CASE kind WHEN 'click' THEN 'closed' WHEN 'error' THEN 'open' WHEN 'view' THEN 'half_open' ELSE kind END AS state,
               CASE kind WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS code, count(*) AS samples
        FROM api_events GROUP BY 1, 2""",
        "api_events",
    ),
)
def m10(v):
    state = F.when(F.col("kind") == "click", "closed").when(F.col("kind") == "error", "open").when(
        F.col("kind") == "view", "half_open"
    ).otherwise(F.col("kind"))
    named = v.api_events().select(state.alias("state"))
    return named.groupBy("state", metrics.breaker_state_code("state").alias("code")).agg(
        F.count(F.lit(1)).alias("samples")
    )


def _case(values: dict[str, int]) -> str:
    return "CASE circuit " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in values.items()) + " END"


_RUNS = f"""
numbered AS (
  SELECT *, sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY service, circuit ORDER BY ts, id)
            - CASE WHEN status = 'success' THEN 1 ELSE 0 END AS run FROM api_events
),
placed AS (SELECT *, row_number() OVER (PARTITION BY service, circuit, run ORDER BY ts, id) AS pos FROM numbered),
runs AS (
  SELECT service, circuit, CAST(run AS BIGINT) AS run, count(*) FILTER (WHERE status = 'error') AS failures,
         min(ts) FILTER (WHERE status = 'error') AS first_failure, max(ts) FILTER (WHERE status = 'error') AS last_failure,
         min(ts) FILTER (WHERE status = 'error' AND pos = {_case(FAIL_MAX)}) AS opened_at,
         min(ts) FILTER (WHERE status = 'success') AS closed_at
  FROM placed GROUP BY service, circuit, run HAVING count(*) FILTER (WHERE status = 'error') > 0
)"""
_OUTAGES = f"""{_RUNS},
outages AS (SELECT service, circuit, run, failures, opened_at, opened_at + to_seconds({_case(RESET_TIMEOUT_SEC)}) AS half_open_at, last_failure, closed_at
            FROM runs WHERE opened_at IS NOT NULL)"""


def runs(v):
    return metrics.failure_runs(v.api_events(), F.col("status") == "error")


@query("m11_failure_runs", sql(f"WITH {_RUNS.strip()}\nSELECT * FROM runs", "api_events"))
def m11(v):
    return runs(v)


@query("m12_outages", sql(f"WITH {_OUTAGES.strip()}\nSELECT * FROM outages", "api_events"))
def m12(v):
    return metrics.outages(runs(v))


# ----- R: generic series


def slide_sql(source: str, labels: list[str], measures: dict[str, str], window: int, step: int) -> str:
    """Aggregates over [t - window, t): every event is copied to the grid times it counts for."""
    cols = "".join(f"{c}, " for c in labels)
    aggs = ", ".join(f"{e} AS {n}" for n, e in measures.items())
    return (
        f"SELECT {cols}t, {aggs} FROM (SELECT *, {floor_sql('ts', step)} + to_seconds({step} * i) AS t "
        f"FROM {source}, (SELECT unnest(range(1, {window // step + 1})) AS i)) GROUP BY {cols}t"
    )


def grid_sql(source: str, labels: list[str], step: int) -> str:
    cols = "".join(f"{c}, " for c in labels)
    sets = f"(SELECT DISTINCT {', '.join(labels)} FROM {source})" if labels else "(SELECT 1 AS one)"
    span = f"SELECT unnest(generate_series(min({floor_sql('ts', step)}), max({floor_sql('ts', step)}), to_seconds({step}))) + to_seconds({step}) AS t FROM {source}"
    return f"SELECT {cols}t FROM {sets}, ({span})"


@query(
    "r1_rate_1h",
    sql(
        f"SELECT service, status, t, increase, increase / {3 * HOUR} AS per_second, increase * 60 / {3 * HOUR} AS per_minute FROM ("
        + slide_sql("api_events", ["service", "status"], {"increase": "count(*)"}, 3 * HOUR, HOUR)
        + ")",
        "api_events",
    ),
)
def r1(v):
    return rates.rate(v.api_events(), ["service", "status"], "ts", 3 * HOUR, HOUR)


def increase_sql(source: str, labels: list[str], window: int, step: int) -> str:
    cols = "".join(f"g.{c}, " for c in labels)
    on = " AND ".join([f"s.{c} = g.{c}" for c in labels] + ["s.t = g.t"])
    return (
        f"SELECT {cols}g.t, coalesce(s.increase, 0) AS increase FROM ({grid_sql(source, labels, step)}) g LEFT JOIN "
        f"({slide_sql(source, labels, {'increase': 'count(*)'}, window, step)}) s ON {on}"
    )


@query("r2_no_activity", sql(increase_sql("api_events", ["circuit"], HOUR, HOUR // 2), "api_events"))
def r2(v):
    return rates.increase(v.api_events(), ["circuit"], "ts", HOUR, HOUR // 2)


@query(
    "r3_counter_increase",
    sql(
        """
        WITH steps AS (
          SELECT kind, ts, CASE WHEN prev IS NULL THEN 0 WHEN value_c < prev THEN value_c ELSE value_c - prev END AS step
          FROM (SELECT *, lag(value_c) OVER (PARTITION BY kind ORDER BY ts, id) AS prev FROM api_events))
        """
        + slide_sql("steps", ["kind"], {"increase": "CAST(sum(step) AS BIGINT)"}, 3 * HOUR, HOUR),
        "api_events",
    ),
)
def r3(v):
    return rates.counter_increase(v.api_events(), ["kind"], "ts", "id", "value_c", 3 * HOUR, HOUR)


def quantile_sql(source: str, labels: list[str], bounds: list[float], window: int, step: int, q: float = 0.95) -> str:
    """Bucket quantile by unpivoting the cumulative counts and taking the first that reaches the rank."""
    measures = {f"c{i}": f"count(*) FILTER (WHERE duration_s <= {b}::DOUBLE)" for i, b in enumerate(bounds)}
    measures["cn"] = "count(duration_s)"
    cols = "".join(f"{c}, " for c in labels)
    n = len(bounds)
    counts = "[" + ", ".join([*(f"c{i}" for i in range(n)), "cn"]) + "]"
    edges = "[" + ", ".join(f"{float(b)}::DOUBLE" for b in bounds) + "]"
    return f"""
SELECT {cols}t, CASE WHEN i > {n} THEN {float(bounds[-1])}::DOUBLE
       WHEN c = below THEN hi ELSE lo + (hi - lo) * (rank - below) / (c - below) END AS value
FROM (
  SELECT {cols}t, i, rank, list_extract(cs, i) AS c, CASE WHEN i > 1 THEN list_extract(cs, i - 1) ELSE 0 END AS below,
         CASE WHEN i > 1 THEN list_extract({edges}, i - 1) ELSE 0.0::DOUBLE END AS lo, list_extract({edges}, i) AS hi
  FROM (SELECT *, CAST(len(list_filter(cs, lambda x: x < rank)) + 1 AS INTEGER) AS i
        FROM (SELECT {cols}t, {counts} AS cs, {q}::DOUBLE * cn AS rank
              FROM ({slide_sql(source, labels, measures, window, step)})))
)"""


@query(
    "r4_bucket_quantile",
    sql(
        "SELECT service, circuit, t, round(value, 6) AS value FROM ("
        + quantile_sql("api_events", ["service", "circuit"], API_DURATION_BOUNDS, 6 * HOUR, HOUR)
        + ")",
        "api_events",
    ),
)
def r4(v):
    out = rates.quantile(
        v.api_events(), ["service", "circuit"], "ts", "duration_s", API_DURATION_BOUNDS, 6 * HOUR, HOUR
    )
    return out.select("service", "circuit", "t", F.round("value", 6).alias("value"))


@query(
    "r5_exact_quantile",
    sql(
        "SELECT service, circuit, count(*) AS samples, round(quantile_cont(duration_s, 0.95), 6) AS value "
        "FROM api_events GROUP BY service, circuit",
        "api_events",
    ),
)
def r5(v):
    out = quantiles.exact_quantile(v.api_events(), ["service", "circuit"], "duration_s")
    return out.withColumn("value", F.round("value", 6))


@query(
    "r5_exact_quantile_daily",
    sql(
        "SELECT service, circuit, date_trunc('day', ts) + INTERVAL 1 DAY AS t, count(*) AS samples, "
        "round(quantile_cont(duration_s, 0.95), 6) AS value FROM api_events GROUP BY ALL",
        "api_events",
    ),
)
def r5_daily(v):
    out = quantiles.exact_quantile_per_window(v.api_events(), ["service", "circuit"], "ts", "duration_s", 24 * HOUR)
    return out.withColumn("value", F.round("value", 6))


def hold_sql(points: str, step: int, hold: int) -> str:
    wait = -(-hold // step) * step
    return f"""
SELECT rule, series, pending_since, last_at, points, highest,
       CASE WHEN pending_since + to_seconds({wait}) <= last_at THEN pending_since + to_seconds({wait}) END AS firing_since
FROM (
  SELECT rule, series, min(t) AS pending_since, max(t) AS last_at, count(*) AS points, max(value) AS highest
  FROM (SELECT *, epoch_us(t) // {step * 1_000_000} - row_number() OVER (PARTITION BY rule, series ORDER BY t) AS island
        FROM ({points}))
  GROUP BY rule, series, island
)"""


def rule_sql(rule: alerts.Rule, values: str) -> str:
    """Episodes of a rule from SQL that yields its labels, t and value."""
    labels = " || '/' || ".join(rule.labels) if rule.labels else "'all'"
    op = {"==": "="}.get(rule.op, rule.op)
    points = (
        f"SELECT '{rule.name}' AS rule, {labels} AS series, t, CAST(value AS DOUBLE) AS value "
        f"FROM ({values}) WHERE value {op} {rule.threshold}"
    )
    return hold_sql(points, rule.step_s, rule.hold_s)


def tuned(name: str, **changes) -> alerts.Rule:
    return replace(alerts.RULES[name], **changes)


def rate_values(rule: alerts.Rule, source: str) -> str:
    return (
        f"SELECT *, n / {rule.window_s} AS value FROM ("
        + slide_sql(source, list(rule.labels), {"n": "count(*)"}, rule.window_s, rule.step_s)
        + ")"
    )


def ratio_values(rule: alerts.Rule, source: str) -> str:
    measures = {
        "a": f"count(*) FILTER (WHERE {rule.extra['top']})",
        "b": f"count(*) FILTER (WHERE {rule.extra['bottom']})",
    }
    return f"SELECT *, a / b AS value FROM ({slide_sql(source, list(rule.labels), measures, rule.window_s, rule.step_s)}) WHERE b > 0"


def gauge_values(rule: alerts.Rule, source: str) -> str:
    """As-of join of the dense grid with the samples before each grid time."""
    cols = "".join(f"g.{c}, " for c in rule.labels)
    on = " AND ".join([f"g.{c} = s.{c}" for c in rule.labels] + ["g.t > s.ts"])
    latest = ", ".join([*rule.labels, "ts"])
    one = f"(SELECT {latest}, arg_max(value, tie) AS value FROM {source} GROUP BY {latest})"
    return f"SELECT {cols}g.t, s.value FROM ({grid_sql(source, list(rule.labels), rule.step_s)}) g ASOF JOIN {one} s ON {on}"


ERRORS = "src AS (SELECT * FROM api_events WHERE status = 'error')"

R6_RULE = tuned("HighErrorRate", labels=("service",), threshold=0, window_s=HOUR, step_s=HOUR, hold_s=2 * HOUR)


@query(
    "r6_alert_hold",
    sql("WITH " + ERRORS + rule_sql(R6_RULE, rate_values(R6_RULE, "src")), "api_events"),
)
def r6(v):
    """Hours with any error per service, held for two hours."""
    errors = v.api_events().filter("status = 'error'")
    points = alerts.series(R6_RULE, errors).filter(alerts.breached(R6_RULE))
    return alerts.hold_stretches(points, R6_RULE.step_s, R6_RULE.hold_s)


R7 = tuned("HighErrorRate", labels=("service",), threshold=0.0006, window_s=HOUR, step_s=HOUR // 2, hold_s=HOUR)


@query("r7_high_error_rate", sql("WITH " + ERRORS + rule_sql(R7, rate_values(R7, "src")), "api_events"))
def r7(v):
    return alerts.alert(R7, v.api_events().filter("status = 'error'"))


def _quantile_rule(name: str, rule: alerts.Rule) -> None:
    values = quantile_sql("api_events", list(rule.labels), rule.extra["bounds"], rule.window_s, rule.step_s)
    query(name, sql(rule_sql(rule, values), "api_events"))(lambda v: alerts.alert(rule, v.api_events()))


_quantile_rule("r8_high_response_time", tuned("HighResponseTime", labels=("service",), window_s=HOUR, step_s=HOUR // 2, hold_s=HOUR, threshold=1))
_quantile_rule("r15_slow_queries", tuned("SlowDatabaseQueries", labels=("service",), window_s=HOUR, step_s=HOUR // 2, hold_s=HOUR, threshold=0.9))
_quantile_rule("r18_api_latency", tuned("ExternalAPIHighLatency", labels=("service", "circuit"), window_s=HOUR, step_s=HOUR // 2, hold_s=HOUR, threshold=1.5))

R9 = tuned("ServiceDown", step_s=300, hold_s=600)


@query(
    "r9_service_down",
    sql(
        rule_sql(R9, f"SELECT *, CASE WHEN increase > 0 THEN 1 ELSE 0 END AS value FROM ({increase_sql('api_events', ['service'], 300, 300)})"),
        "api_events",
    ),
)
def r9(v):
    return alerts.alert(R9, v.api_events())


R10 = tuned("HighDebtAmount", threshold=100_000, step_s=DAY, hold_s=5 * DAY)


@query(
    "r10_high_debt",
    sql(
        f"WITH src AS (SELECT service, ts, ts AS tie, value FROM ({_DEBT_GAUGE}))" + rule_sql(R10, gauge_values(R10, "src")),
        "debt_operations",
    ),
)
def r10(v):
    return alerts.alert(R10, metrics.debt_gauge(v.debt_operations()).withColumn("tie", F.col("ts")))


R11 = tuned("HighPaymentFailureRate", labels=(), window_s=2 * DAY, step_s=DAY, hold_s=3 * DAY)


@query(
    "r11_payment_failure_rate",
    sql(
        "WITH src AS (SELECT *, created_at AS ts FROM payment_attempts)" + rule_sql(R11, ratio_values(R11, "src")),
        "payment_attempts",
    ),
)
def r11(v):
    return alerts.alert(R11, v.payment_attempts().withColumn("ts", F.col("created_at")))


R12 = tuned("CircuitBreakerOpen", step_s=15, hold_s=60)


@query(
    "r12_circuit_open",
    sql(
        f"WITH {_OUTAGES.strip()},\nnewest AS (SELECT max(greatest(half_open_at, last_failure, closed_at)) AS m FROM outages),\n"
        "pts AS (SELECT service, circuit, half_open_at, unnest(generate_series("
        "make_timestamp(epoch_us(opened_at) + (15000000 - epoch_us(opened_at) % 15000000) % 15000000), "
        "coalesce(closed_at, m) - INTERVAL 1 MICROSECOND, INTERVAL 15 SECOND)) AS t FROM outages, newest)"
        + rule_sql(R12, "SELECT service, circuit, t, CASE WHEN t < half_open_at THEN 1 ELSE 2 END AS value FROM pts"),
        "api_events",
    ),
)
def r12(v):
    return alerts.alert(R12, metrics.outages(runs(v)))


R13 = tuned("BillingWorkerStuck", labels=(), window_s=HOUR, step_s=HOUR // 4, hold_s=HOUR)


@query(
    "r13_worker_stuck",
    sql(
        "WITH src AS (SELECT * FROM api_events WHERE kind = 'view')"
        + rule_sql(R13, f"SELECT *, increase AS value FROM ({increase_sql('src', [], HOUR, HOUR // 4)})"),
        "api_events",
    ),
)
def r13(v):
    """Views stand for finished billing cycles."""
    return alerts.alert(R13, v.api_events().filter("kind = 'view'"))


R14 = tuned("HighDatabaseConnections", labels=("service",), step_s=HOUR, hold_s=HOUR)


@query(
    "r14_db_connections",
    sql(
        "WITH src AS (SELECT service, ts, id AS tie, value_c / 100 AS value FROM api_events)" + rule_sql(R14, gauge_values(R14, "src")),
        "api_events",
    ),
)
def r14(v):
    samples = v.api_events().select("service", "ts", F.col("id").alias("tie"), (F.col("value_c") / 100).alias("value"))
    return alerts.alert(R14, samples)


R16 = tuned("LowRentalConversionRate", window_s=DAY, step_s=DAY, hold_s=DAY, threshold=1.2)


@query(
    "r16_low_conversion",
    sql(
        "WITH src AS (SELECT started_at AS ts, 'start' AS kind FROM rentals_base WHERE status <> 'FAILED' "
        "UNION ALL SELECT created_at, 'quote' FROM quotes)" + rule_sql(R16, ratio_values(R16, "src")),
        "rentals_base",
        "quotes",
    ),
)
def r16(v):
    """All starts per quote; the test data have more starts than quotes, hence the high threshold."""
    started = metrics.rental_increments(v.rentals_base()).filter("status = 'ACTIVE'")
    starts = started.select("ts", F.lit("start").alias("kind"))
    made = v.quotes().select(F.col("created_at").alias("ts"), F.lit("quote").alias("kind"))
    return alerts.alert(R16, starts.unionByName(made))


R17 = tuned("HighWorkerErrorRate", threshold=0.0004, window_s=HOUR, step_s=HOUR // 2, hold_s=HOUR)


@query(
    "r17_worker_errors",
    sql(
        "WITH src AS (SELECT *, circuit AS error_type FROM api_events WHERE status = 'error' AND service = 'billing-worker')"
        + rule_sql(R17, rate_values(R17, "src")),
        "api_events",
    ),
)
def r17(v):
    errors = v.api_events().filter("status = 'error' AND service = 'billing-worker'")
    return alerts.alert(R17, errors.withColumn("error_type", F.col("circuit")))


R19 = tuned("NoActiveRentals", step_s=HOUR, hold_s=2 * HOUR)


@query(
    "r19_no_active_rentals",
    sql(
        f"WITH src AS (SELECT service, ts, ts AS tie, value FROM ({_ACTIVE_GAUGE}))"
        + rule_sql(R19, gauge_values(R19, "src")),
        "rentals_base",
    ),
)
def r19(v):
    return alerts.alert(R19, metrics.active_rentals_gauge(v.rentals_base()).withColumn("tie", F.col("ts")))


@query(
    "r20_gauge_series",
    sql(
        f"SELECT service, circuit, {floor_sql('ts', HOUR)} + to_seconds({HOUR}) AS t, arg_max(value_c, (ts, id)) AS value "
        "FROM api_events GROUP BY service, circuit, 3",
        "api_events",
    ),
)
def r20(v):
    return rates.last_in_window(v.api_events(), ["service", "circuit"], "ts", "id", "value_c", HOUR)


# ----- the rules as they are written: their own labels, ranges, grid, thresholds and holds


def as_written(rule_id: str, name: str, needs: tuple[str, ...], source: str, values):
    """Register a rule unchanged; ``source`` is SQL that yields its labels, ts and what it counts."""
    rule = alerts.RULES[name]
    text = sql(f"WITH src AS ({source})" + rule_sql(rule, values(rule, "src")), *needs)
    return query(f"{rule_id}_as_written", text)


def quantile_values(rule: alerts.Rule, source: str) -> str:
    return quantile_sql(source, list(rule.labels), rule.extra["bounds"], rule.window_s, rule.step_s)


def quiet_values(rule: alerts.Rule, source: str) -> str:
    """0 at grid times whose range has no event; an ``up`` rule looks one step back."""
    window = rule.step_s if rule.kind == "up" else rule.window_s
    return f"SELECT *, increase AS value FROM ({increase_sql(source, list(rule.labels), window, rule.step_s)})"


def held_values(rule: alerts.Rule, source: str) -> str:
    """The last sample of a step shows from the step's end until the next one with samples has ended."""
    cols = "".join(f"{c}, " for c in rule.labels)
    step = f"to_seconds({rule.step_s})"
    return f"""
SELECT {cols}value, unnest(generate_series(p + {step}, coalesce(lead(p) OVER (PARTITION BY {cols[:-2]} ORDER BY p), newest + {step}), {step})) AS t
FROM (SELECT {cols}{floor_sql("ts", rule.step_s)} AS p, arg_max(value, (ts, tie)) AS value FROM {source} GROUP BY {cols}p),
     (SELECT max({floor_sql("ts", rule.step_s)}) AS newest FROM {source})"""


def held_breaches(rule: alerts.Rule, source: str) -> str:
    """Episodes from stretches, for gauges whose grid of all times would be too long for SQL."""
    cols = ", ".join(rule.labels)
    step = f"to_seconds({rule.step_s})"
    op = {"==": "="}.get(rule.op, rule.op)
    wait = -(-rule.hold_s // rule.step_s) * rule.step_s
    return f"""
SELECT '{rule.name}' AS rule, series, min(a) AS pending_since, max(b) AS last_at,
       CAST(sum(epoch_us(b - a) // {rule.step_s * 1_000_000} + 1) AS BIGINT) AS points, CAST(max(value) AS DOUBLE) AS highest,
       CASE WHEN min(a) + to_seconds({wait}) <= max(b) THEN min(a) + to_seconds({wait}) END AS firing_since
FROM (
  SELECT *, sum(CASE WHEN a - before <= {step} THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY a) AS island
  FROM (
    SELECT *, lag(b) OVER (PARTITION BY series ORDER BY a) AS before
    FROM (
      SELECT {" || '/' || ".join(rule.labels)} AS series, value, p + {step} AS a,
             coalesce(lead(p) OVER (PARTITION BY {cols} ORDER BY p), newest + {step}) AS b
      FROM (SELECT {cols}, {floor_sql("ts", rule.step_s)} AS p, arg_max(value, (ts, tie)) AS value FROM {source} GROUP BY {cols}, 2),
           (SELECT max({floor_sql("ts", rule.step_s)}) AS newest FROM {source})
    )
    WHERE value {op} {rule.threshold}
  )
)
GROUP BY series, island"""


_API = ("api_events",)


@as_written("r7", "HighErrorRate", _API, "SELECT service, circuit AS handler, ts FROM api_events WHERE status = 'error'", rate_values)
def r7_written(v):
    return alerts.alert(alerts.RULES["HighErrorRate"], v.api_events().filter("status = 'error'").withColumn("handler", F.col("circuit")))


@as_written("r8", "HighResponseTime", _API, "SELECT service, circuit AS handler, ts, duration_s FROM api_events", quantile_values)
def r8_written(v):
    return alerts.alert(alerts.RULES["HighResponseTime"], v.api_events().withColumn("handler", F.col("circuit")))


@as_written("r9", "ServiceDown", _API, "SELECT service, ts FROM api_events", quiet_values)
def r9_written(v):
    return alerts.alert(alerts.RULES["ServiceDown"], v.api_events())


_DEBT_RULE = alerts.RULES["HighDebtAmount"]
_CHANGES = """
SELECT service, ts, id AS tie, sum(delta) OVER (PARTITION BY service ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS value
FROM (SELECT *, CASE operation WHEN 'add' THEN amount WHEN 'reduce' THEN -amount ELSE 0 END AS delta FROM debt_operations)"""


@query("r10_as_written", sql(f"WITH src AS ({_CHANGES})" + held_breaches(_DEBT_RULE, "src"), "debt_operations"))
def r10_written(v):
    return alerts.alert(_DEBT_RULE, metrics.debt_changes(v.debt_operations()).withColumnRenamed("id", "tie"))


@as_written("r11", "HighPaymentFailureRate", ("payment_attempts",), "SELECT 'billing-worker' AS service, created_at AS ts, success FROM payment_attempts", ratio_values)
def r11_written(v):
    attempts = v.payment_attempts().withColumns({"ts": F.col("created_at"), "service": F.lit("billing-worker")})
    return alerts.alert(alerts.RULES["HighPaymentFailureRate"], attempts)


@as_written("r13", "BillingWorkerStuck", _API, "SELECT service, ts FROM api_events WHERE kind = 'view'", quiet_values)
def r13_written(v):
    """Views stand for finished billing cycles."""
    return alerts.alert(alerts.RULES["BillingWorkerStuck"], v.api_events().filter("kind = 'view'"))


@as_written("r14", "HighDatabaseConnections", _API, "SELECT service, circuit AS database, ts, id AS tie, value_c / 100 AS value FROM api_events", held_values)
def r14_written(v):
    samples = v.api_events().select(
        "service", F.col("circuit").alias("database"), "ts", F.col("id").alias("tie"), (F.col("value_c") / 100).alias("value")
    )
    return alerts.alert(alerts.RULES["HighDatabaseConnections"], samples)


@as_written("r15", "SlowDatabaseQueries", _API, "SELECT service, circuit AS database, kind AS operation, ts, duration_s FROM api_events", quantile_values)
def r15_written(v):
    named = v.api_events().withColumns({"database": F.col("circuit"), "operation": F.col("kind")})
    return alerts.alert(alerts.RULES["SlowDatabaseQueries"], named)


@as_written(
    "r16",
    "LowRentalConversionRate",
    ("rentals_base", "quotes"),
    "SELECT started_at AS ts, 'start' AS kind FROM rentals_base WHERE status <> 'FAILED' UNION ALL SELECT created_at, 'quote' FROM quotes",
    ratio_values,
)
def r16_written(v):
    started = metrics.rental_increments(v.rentals_base()).filter("status = 'ACTIVE'")
    starts = started.select("ts", F.lit("start").alias("kind"))
    made = v.quotes().select(F.col("created_at").alias("ts"), F.lit("quote").alias("kind"))
    return alerts.alert(alerts.RULES["LowRentalConversionRate"], starts.unionByName(made))


@as_written("r17", "HighWorkerErrorRate", _API, "SELECT service, circuit AS error_type, ts FROM api_events WHERE status = 'error'", rate_values)
def r17_written(v):
    errors = v.api_events().filter("status = 'error'").withColumn("error_type", F.col("circuit"))
    return alerts.alert(alerts.RULES["HighWorkerErrorRate"], errors)


@as_written(
    "r18", "ExternalAPIHighLatency", _API,
    "SELECT service, circuit AS api_service, kind AS endpoint, ts, duration_s FROM api_events", quantile_values,
)
def r18_written(v):
    named = v.api_events().withColumns({"api_service": F.col("circuit"), "endpoint": F.col("kind")})
    return alerts.alert(alerts.RULES["ExternalAPIHighLatency"], named)


_IDLE_RULE = alerts.RULES["NoActiveRentals"]
_ACTIVE = """
SELECT 'rental-core' AS service, ts, id AS tie, sum(delta) OVER (ORDER BY ts, id, delta ROWS UNBOUNDED PRECEDING) AS value
FROM (SELECT id, started_at AS ts, 1 AS delta FROM rentals_base WHERE status <> 'FAILED'
      UNION ALL SELECT id, finished_at, -1 FROM rentals_base WHERE status <> 'FAILED' AND finished_at IS NOT NULL)"""


@query("r19_as_written", sql(f"WITH src AS ({_ACTIVE})" + held_breaches(_IDLE_RULE, "src"), "rentals_base"))
def r19_written(v):
    return alerts.alert(_IDLE_RULE, metrics.active_rental_changes(v.rentals_base()).withColumnRenamed("id", "tie"))
