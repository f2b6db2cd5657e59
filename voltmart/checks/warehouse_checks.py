"""Registered queries of sections A, B, C, D and F."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.checks.registry import query
from voltmart.checks.sqlviews import sql
from voltmart.functions.text import csv_columns
from voltmart.operators import bi, constraints, core, mart, meta
from voltmart.plans import warehouse
from voltmart.schemas import EXTRACTS, MART_TABLES, TABLES, business_columns
from voltmart.session import scratch_path
from voltmart.sources import export, extract
from voltmart.sources.store import LayerStore
from voltmart.sources.testviews import TestViews

AS_OF = "2001-12-01 00:00:00"
FINISHED = "2001-12-01 00:12:34"
DAY = "2000-06-15"
ALL = ["quotes", "rentals", "idempotency_keys", "debts", "payment_attempts"]


def sources(v: TestViews) -> dict[str, dict[str, DataFrame]]:
    return {s: {t: getattr(v, t)() for t in tables} for s, tables in EXTRACTS.items()}


def raw(v: TestViews) -> dict[str, dict[str, DataFrame]]:
    return {
        f"raw_{s}": {t: extract.full_load(df, TABLES[t].schema, AS_OF) for t, df in tables.items()}
        for s, tables in sources(v).items()
    }


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ----- A: ingest

for _t in ALL:
    _cols = ", ".join(business_columns(TABLES[_t].schema))
    query(f"a1_full_load_{_t}", sql(f"SELECT {_cols} FROM {_t}", _t))(
        lambda v, t=_t: extract.full_load(getattr(v, t)(), TABLES[t].schema, AS_OF).drop("_ingested_at")
    )
    _layer = TABLES[_t].raw_layer
    query(
        f"b_core_{_t}",
        sql(f"SELECT {_cols}, TIMESTAMP '{AS_OF}' AS _ingested_at FROM {_t}", _t),
    )(lambda v, t=_t: core.core_table(t, raw(v)))


def _fill_sql(tables: list[str]) -> str:
    parts = []
    for t in tables:
        for i, c in enumerate(business_columns(TABLES[t].schema), start=1):
            parts.append(
                f"SELECT '{t}' AS table_name, {i} AS ordinal, '{c}' AS column_name, count({c}) AS filled_rows FROM {t}"
            )
    return sql("\nUNION ALL ".join(parts), *tables)


@query("a2_a3_column_intersection", _fill_sql(ALL))
def column_intersection(v):
    return union([extract.column_fill(getattr(v, t)(), TABLES[t].schema, t) for t in ALL])


@query(
    "a4_extract_sets",
    sql(
        "\nUNION ALL ".join(
            f"SELECT 'public.{t}' AS source, '{TABLES[t].raw_layer}.{t}' AS target, count(*) AS rows_loaded, "
            f"'{','.join(business_columns(TABLES[t].schema))}' AS columns FROM {t}"
            for t in ALL
        ),
        *ALL,
    ),
)
def extract_sets(v):
    return union(
        [
            extract.load_report(TABLES[t], extract.full_load(df, TABLES[t].schema, AS_OF))
            for tables in sources(v).values()
            for t, df in tables.items()
        ]
    )


@query(
    "a5_raw_schemas",
    sql(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS type_name, "
            f"{str(not f.nullable).upper()} AS required, count({f.name}) AS filled_rows FROM {t}"
            for t in ALL
            for f in TABLES[t].schema.fields
            if not f.name.startswith("_")
        ),
        *ALL,
    ),
)
def raw_schemas(v):
    """Declared columns and types of each raw table with the rows that fill them."""
    out = []
    for t in ALL:
        loaded = extract.full_load(getattr(v, t)(), TABLES[t].schema, AS_OF)
        fields = [f for f in TABLES[t].schema.fields if not f.name.startswith("_")]
        parts = ", ".join(
            f"'{f.name}', '{loaded.schema[f.name].dataType.simpleString()}', {str(not f.nullable).lower()}, `{f.name}`"
            for f in fields
        )
        counts = loaded.agg(*[F.count(f.name).alias(f.name) for f in fields])
        out.append(
            counts.selectExpr(f"stack({len(fields)}, {parts}) AS (column_name, type_name, required, filled_rows)")
            .select(F.lit(t).alias("table_name"), "*")
        )
    return union(out)


@query(
    "a6_sorted_write",
    sql(
        "SELECT id, rental_id, created_at FROM payment_attempts WHERE created_at >= TIMESTAMP '2000-06-15'",
        "payment_attempts",
    ),
)
def sorted_write(v):
    """Date-range read of a table written in time order: the scan prunes by row-group statistics."""
    store = LayerStore(v.spark, scratch_path(v.spark, "sorted"))
    store.bootstrap()
    loads = {t: extract.full_load(getattr(v, t)(), TABLES[t].schema, AS_OF) for t in EXTRACTS["billing"]}
    store.publish("raw_billing", "v1", loads, AS_OF, warehouse.ORDER["raw_billing"])
    back = store.read("raw_billing", "payment_attempts")
    return back.filter(F.col("created_at") >= F.lit("2000-06-15").cast("timestamp")).select(
        "id", "rental_id", "created_at"
    )


@query(
    "a7_duplicate_keys",
    sql(
        "\nUNION ALL ".join(
            [
                f"SELECT '{t}' AS table_name, CAST({TABLES[t].key} AS VARCHAR) AS key_value, count(*) AS copies "
                f"FROM {t} GROUP BY {TABLES[t].key} HAVING count(*) > 1"
                for t in ALL
            ]
            + [
                "SELECT 'raw_lines' AS table_name, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS key_value, "
                "count(*) AS copies FROM lineitem GROUP BY l_orderkey * 10 + l_linenumber HAVING count(*) > 1"
            ]
        ),
        *ALL,
    ),
)
def duplicate_keys(v):
    """Key violations of the five tables, and of the ungrouped payment lines, which have some."""
    lines = v.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return union(
        [constraints.duplicate_keys(getattr(v, t)(), TABLES[t].key, t) for t in ALL]
        + [constraints.duplicate_keys(lines, "id", "raw_lines")]
    )


def _constraint_sql() -> str:
    parts = []
    for t in ALL:
        for f in TABLES[t].schema.fields:
            if f.name.startswith("_"):
                continue
            nulls = "0 * count(*)" if f.nullable else f"count(*) - count({f.name})"
            n = TABLES[t].max_len.get(f.name)
            a = f"count(*) FILTER (WHERE length({f.name}) > {n})" if n else "0"
            b = f"max(length({f.name}))" if n else "NULL"
            parts.append(
                f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, {nulls} AS null_rows, "
                f"{a} AS over_limit_rows, {b} AS longest FROM {t}"
            )
    return sql("\nUNION ALL ".join(parts), *ALL)


@query("a8_column_constraints", _constraint_sql())
def column_constraints(v):
    return union(
        [
            constraints.column_constraints(getattr(v, t)(), TABLES[t].schema, TABLES[t].max_len, t)
            for t in ALL
        ]
    )


def _csv_ts(c: str) -> str:
    return f"regexp_replace(strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0{{1,6}}$', '') || '+00'"


_CSV_PAYMENTS = f"""
SELECT CAST(id AS VARCHAR) AS payment_attempt_id, rental_id, CAST(amount AS VARCHAR) AS amount,
       CASE WHEN success THEN 't' ELSE 'f' END AS success, error, {_csv_ts('created_at')} AS created_at
FROM payment_attempts"""
_CSV_RENTALS = f"""
SELECT id AS rental_id, user_id, powerbank_id, status, {_csv_ts('started_at')} AS started_at,
       {_csv_ts('finished_at')} AS finished_at, CAST(total_amount AS VARCHAR) AS total_amount,
       CAST(price_per_hour AS VARCHAR) AS price_per_hour, CAST(free_period_min AS VARCHAR) AS free_period_min,
       CAST(deposit AS VARCHAR) AS deposit
FROM rentals"""


@query("a9_csv_export", sql(_CSV_RENTALS, "rentals"))
def csv_export(v):
    """Export the rental fact as CSV with a header and read the files back."""
    fact = mart.fct_rentals(v.rentals())
    folder = export.export_csv(fact, f"{scratch_path(v.spark, 'export')}/{export.export_name('mart', 'fct_rentals', AS_OF)}")
    return export.read_export(v.spark, folder, fact.columns)


@query("a10_csv_text", sql(_CSV_PAYMENTS, "payment_attempts"))
def csv_text(v):
    fact = mart.fct_payments(v.payment_attempts())
    return fact.select(*csv_columns(fact))


# Each listed table with the SQL whose rows it has.
_COUNT_TABLES = [
    ("core", "debts", "debts"),
    ("core", "idempotency_keys", "idempotency_keys"),
    ("core", "payment_attempts", "payment_attempts"),
    ("core", "quotes", "quotes"),
    ("core", "rentals", "rentals"),
    ("mart", "fct_payments", "payment_attempts"),
    ("mart", "fct_rentals", "rentals"),
    ("mart", "kpi_daily", "kpi"),
    ("meta", "etl_run_audit", "(SELECT 1)"),
    ("meta", "etl_watermark", "(SELECT max(id) FROM quotes HAVING count(*) > 0 UNION ALL SELECT max(id) FROM rentals "
     "HAVING count(*) > 0 UNION ALL SELECT max(key) FROM idempotency_keys HAVING count(*) > 0 UNION ALL "
     "SELECT max(rental_id) FROM debts HAVING count(*) > 0 UNION ALL SELECT max(rental_id) FROM payment_attempts "
     "HAVING count(*) > 0)"),
    ("raw_billing", "debts", "debts"),
    ("raw_billing", "payment_attempts", "payment_attempts"),
    ("raw_rental", "idempotency_keys", "idempotency_keys"),
    ("raw_rental", "quotes", "quotes"),
    ("raw_rental", "rentals", "rentals"),
]

# ----- C: mart (SQL texts are reused by D)

# All sources as day entries, summed once per day; the calendar runs over rental starts and payments.
_KPI = """
entry AS (
  SELECT 'quote' AS kind, CAST(created_at AS DATE) AS on_day, FALSE AS paid, 0 AS amount, 0 AS seconds FROM quotes
  UNION ALL
  SELECT 'payment', CAST(created_at AS DATE), success, amount, 0 FROM payment_attempts
  UNION ALL
  SELECT 'start', CAST(started_at AS DATE), FALSE, 0, 0 FROM rentals
  UNION ALL
  SELECT 'end', CAST(finished_at AS DATE), FALSE, 0, date_diff('second', started_at, finished_at)
  FROM rentals WHERE finished_at IS NOT NULL
),
daily AS (
  SELECT on_day, count(*) FILTER (kind = 'quote') AS quoted, count(*) FILTER (kind = 'start') AS started,
         count(*) FILTER (kind = 'end') AS ended, count(*) FILTER (kind = 'payment') AS tried,
         count(*) FILTER (kind = 'payment' AND paid) AS succeeded,
         coalesce(sum(amount) FILTER (kind = 'payment' AND paid), 0) AS earned,
         (10 * sum(seconds) FILTER (kind = 'end') + 3 * count(*) FILTER (kind = 'end'))
           // nullif(6 * count(*) FILTER (kind = 'end'), 0) AS hundredths
  FROM entry GROUP BY on_day
),
span AS (SELECT min(on_day) AS first_day, max(on_day) AS last_day FROM entry WHERE kind IN ('start', 'payment')),
kpi AS (
  SELECT CAST(day AS DATE) AS day, CAST(coalesce(quoted, 0) AS INTEGER) AS quotes_cnt,
         CAST(coalesce(started, 0) AS INTEGER) AS rentals_started_cnt,
         CAST(coalesce(ended, 0) AS INTEGER) AS rentals_finished_cnt,
         CAST(coalesce(tried, 0) AS INTEGER) AS payments_attempts_cnt,
         CAST(coalesce(succeeded, 0) AS INTEGER) AS payments_success_cnt,
         CAST(coalesce(earned, 0) AS BIGINT) AS revenue_amount, CAST(hundredths AS BIGINT) AS avg_hundredths
  FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS day FROM span)
  LEFT JOIN daily ON on_day = day
)"""
_KPI_NEEDS = ("quotes", "rentals", "payment_attempts")
_MEASURES = "quotes_cnt, rentals_started_cnt, rentals_finished_cnt, payments_attempts_cnt, payments_success_cnt, revenue_amount"
KPI_ROWS = f"SELECT CAST(day AS VARCHAR) AS day, {_MEASURES}, avg_hundredths / 100 AS avg_rental_duration_min FROM kpi"


def kpi_text(rentals: str = "rentals", payments: str = "payment_attempts") -> str:
    """The KPI's clauses over other tables of rentals and payments."""
    return _KPI.strip().replace("FROM rentals", f"FROM {rentals}").replace("FROM payment_attempts", f"FROM {payments}")


def kpi_sql(body: str) -> str:
    return sql(f"WITH {_KPI.strip()}\n{body}", *_KPI_NEEDS)


_ROW_COUNT = "SELECT '{s}' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {b}"


def counts_sql(one: str, tail: str = "") -> str:
    """``one`` for each listed table, the KPI's days included."""
    parts = "\nUNION ALL ".join(one.format(s=s, t=t, b=b) for s, t, b in _COUNT_TABLES)
    return sql(f"WITH {_KPI.strip()}\n{parts}{tail}", *ALL)


def kpi(v: TestViews) -> DataFrame:
    return mart.kpi_daily(v.quotes(), v.rentals(), v.payment_attempts())


@query(
    "c1_fct_rentals",
    sql(
        "SELECT id AS rental_id, user_id, powerbank_id, status, started_at, finished_at, total_amount, "
        "price_per_hour, free_period_min, deposit FROM rentals",
        "rentals",
    ),
)
def c1(v):
    return mart.fct_rentals(v.rentals())


@query(
    "c2_fct_payments",
    sql(
        "SELECT id AS payment_attempt_id, rental_id, amount, success, error, created_at FROM payment_attempts",
        "payment_attempts",
    ),
)
def c2(v):
    return mart.fct_payments(v.payment_attempts())


@query(
    "c3_calendar_bounds",
    kpi_sql("SELECT CAST(first_day AS VARCHAR) AS min_day, CAST(last_day AS VARCHAR) AS max_day FROM span"),
)
def c3(v):
    return mart.calendar_bounds(v.rentals(), v.payment_attempts())


@query("c4_day_calendar", kpi_sql("SELECT CAST(day AS VARCHAR) AS day FROM kpi"))
def c4(v):
    return mart.day_calendar(mart.calendar_bounds(v.rentals(), v.payment_attempts()))


@query("c5_quotes_per_day", kpi_sql("SELECT CAST(on_day AS VARCHAR) AS day, quoted AS quotes_cnt FROM daily WHERE quoted > 0"))
def c5(v):
    return mart.quotes_per_day(v.quotes())


@query("c6_rentals_started_per_day", kpi_sql("SELECT CAST(on_day AS VARCHAR) AS day, started AS rentals_started_cnt FROM daily WHERE started > 0"))
def c6(v):
    return mart.rentals_started_per_day(v.rentals())


@query(
    "c7_rentals_finished_per_day",
    kpi_sql(
        "SELECT CAST(on_day AS VARCHAR) AS day, ended AS rentals_finished_cnt, "
        "CAST(hundredths AS BIGINT) / 100 AS avg_rental_duration_min FROM daily WHERE ended > 0"
    ),
)
def c7(v):
    return mart.rentals_finished_per_day(v.rentals())


@query(
    "c8_payments_per_day",
    kpi_sql(
        "SELECT CAST(on_day AS VARCHAR) AS day, tried AS payments_attempts_cnt, succeeded AS payments_success_cnt, "
        "CAST(earned AS BIGINT) AS revenue_amount FROM daily WHERE tried > 0"
    ),
)
def c8(v):
    return mart.payments_per_day(v.payment_attempts())


@query("c9_calendar_join", kpi_sql(KPI_ROWS))
def c9(v):
    rentals, payments = v.rentals(), v.payment_attempts()
    return mart.join_daily(
        mart.day_calendar(mart.calendar_bounds(rentals, payments)),
        mart.quotes_per_day(v.quotes()),
        mart.rentals_started_per_day(rentals),
        mart.rentals_finished_per_day(rentals),
        mart.payments_per_day(payments),
    )


@query("c10_kpi_in_order", kpi_sql(KPI_ROWS + " ORDER BY day"))
def c10(v):
    return mart.kpi_in_order(kpi(v))


@query("c11_kpi_daily", kpi_sql(KPI_ROWS))
def c11(v):
    return kpi(v)


@query(
    "c12_fct_rentals_with_duration",
    sql(
        """
        SELECT id AS rental_id, user_id, powerbank_id, status, started_at, finished_at, total_amount,
               price_per_hour, free_period_min, deposit,
               ((200 * date_diff('second', started_at, finished_at) + 60) // 120) / 100 AS duration_min
        FROM rentals""",
        "rentals",
    ),
)
def c12(v):
    return mart.fct_rentals_with_duration(v.rentals())


_RATE = (
    "CASE WHEN payments_attempts_cnt > 0 THEN "
    "((20000 * CAST(payments_success_cnt AS BIGINT) + payments_attempts_cnt) // (2 * payments_attempts_cnt)) / 100 END"
)


@query(
    "c13_kpi_documented",
    kpi_sql(
        f"""
        SELECT CAST(day AS VARCHAR) AS day, quotes_cnt, rentals_started_cnt,
               rentals_finished_cnt AS rentals_completed_cnt, revenue_amount AS revenue_paid_amount,
               payments_attempts_cnt AS payments_total_cnt, payments_success_cnt,
               {_RATE} AS payment_success_rate, avg_hundredths / 100 AS avg_rental_duration_min
        FROM kpi"""
    ),
)
def c13(v):
    return mart.kpi_documented(kpi(v))


# ----- D: BI

for _i, (_m, _c) in enumerate(bi.TOTALS.items(), start=1):
    query(f"d{_i}_total_{_m}", kpi_sql(f"SELECT CAST(sum({_c}) AS BIGINT) AS value FROM kpi"))(
        lambda v, m=_m: bi.total(kpi(v), m)
    )

_TENTHS = (
    "CASE WHEN sum(payments_attempts_cnt) > 0 THEN CAST((2000 * sum(payments_success_cnt) + "
    "sum(payments_attempts_cnt)) // (2 * sum(payments_attempts_cnt)) AS BIGINT) / 10 ELSE 0 END"
)
SUCCESS_RATE = (
    f"SELECT value, CASE WHEN value < 50 THEN 'red' WHEN value < 80 THEN 'yellow' ELSE 'green' END AS band "
    f"FROM (SELECT {_TENTHS} AS value FROM kpi)"
)


@query(
    "d7_success_rate",
    kpi_sql(SUCCESS_RATE),
)
def d7(v):
    return bi.success_rate(kpi(v)).withColumn("band", bi.success_band(F.col("value")))


@query(
    "d8_daily_series",
    kpi_sql(
        "SELECT CAST(day AS VARCHAR) AS time, rentals_started_cnt, rentals_finished_cnt, payments_success_cnt "
        "FROM kpi ORDER BY day"
    ),
)
def d8(v):
    return bi.daily_series(kpi(v))


KPI_DETAIL = (
    f"SELECT CAST(day AS VARCHAR) AS day, {_MEASURES}, "
    "coalesce(((2 * avg_hundredths + 10) // 20) / 10, 0) AS avg_rental_duration_min FROM kpi ORDER BY 1 DESC"
)


@query("d9_detail_table", kpi_sql(KPI_DETAIL))
def d9(v):
    return bi.detail_table(kpi(v))


for _q, _c, _s in [
    ("d10_started_on_day", "rentals_started_cnt", "rentals_started_cnt"),
    ("d11_completed_on_day", "rentals_finished_cnt", "rentals_finished_cnt"),
    ("d14_average_on_day", "avg_rental_duration_min", "avg_hundredths / 100"),
    ("d15_quotes_on_day", "quotes_cnt", "quotes_cnt"),
]:
    query(_q, kpi_sql(f"SELECT {_s} AS value FROM kpi WHERE day = DATE '{DAY}'"))(
        lambda v, c=_c: bi.on_day(kpi(v), c, DAY)
    )


@query("d12_revenue_on_day", kpi_sql(f"SELECT revenue_amount AS value FROM kpi WHERE day = DATE '{DAY}'"))
def d12(v):
    return bi.on_day(mart.kpi_documented(kpi(v)), "revenue_paid_amount", DAY)


@query(
    "d13_success_rate_on_day",
    kpi_sql(
        "SELECT CASE WHEN payments_attempts_cnt > 0 THEN CAST(payments_success_cnt AS DOUBLE) / "
        f"payments_attempts_cnt * 100 END AS value FROM kpi WHERE day = DATE '{DAY}'"
    ),
)
def d13(v):
    return bi.success_rate_on_day(kpi(v), DAY)


@query(
    "d16_rental_series",
    kpi_sql(
        "SELECT CAST(day AS TIMESTAMP) AS time, rentals_started_cnt AS rentals_started, "
        "rentals_finished_cnt AS rentals_completed FROM kpi ORDER BY 1"
    ),
)
def d16(v):
    return bi.rental_series(kpi(v))


@query(
    "d17_revenue_series",
    kpi_sql(
        f"SELECT CAST(day AS TIMESTAMP) AS time, revenue_amount AS revenue_paid_amount, "
        f"{_RATE} AS payment_success_rate FROM kpi ORDER BY 1"
    ),
)
def d17(v):
    return bi.revenue_series(mart.kpi_documented(kpi(v)))


@query(
    "d18_last_30_days",
    kpi_sql(KPI_ROWS + f" WHERE day BETWEEN DATE '{DAY}' - 30 AND DATE '{DAY}'"),
)
def d18(v):
    return bi.last_days(kpi(v), DAY, 30)


def layer_tables(v: TestViews, schemas: set[str]) -> dict[tuple[str, str], DataFrame]:
    layers = raw(v)
    core_tables = core.core_layer(layers)
    marts = {
        "fct_rentals": mart.fct_rentals(core_tables["rentals"]),
        "fct_payments": mart.fct_payments(core_tables["payment_attempts"]),
        "kpi_daily": mart.kpi_daily(core_tables["quotes"], core_tables["rentals"], core_tables["payment_attempts"]),
    }
    opening = meta.run_started(v.spark, "run-1", warehouse.RUN_NAME, AS_OF)
    every = {
        **layers,
        "core": core_tables,
        "mart": marts,
        "meta": {"etl_watermark": warehouse.bookmarks(layers, AS_OF), "etl_run_audit": opening},
    }
    return {(s, t): df for s in schemas for t, df in every[s].items()}


LAYER_NAMES = {"raw_rental", "raw_billing", "core", "mart", "meta"}


@query(
    "d19_row_count_lines",
    counts_sql("SELECT '{s}.{t}: ' || CAST(count(*) AS VARCHAR) AS line FROM {b}"),
)
def d19(v):
    return bi.row_count_lines(layer_tables(v, LAYER_NAMES))


@query(
    "d20_latest_5_days",
    kpi_sql(
        f"SELECT CAST(day AS VARCHAR) AS day, {_MEASURES}, avg_hundredths / 100 AS avg_duration_min "
        "FROM kpi ORDER BY 1 DESC LIMIT 5"
    ),
)
def d20(v):
    return bi.latest_rounded(kpi(v), 5)


@query("d21_latest_10_days", kpi_sql(KPI_ROWS + " ORDER BY 1 DESC LIMIT 10"))
def d21(v):
    return bi.latest(kpi(v), 10)


@query(
    "d22_row_counts",
    counts_sql(_ROW_COUNT, "\nORDER BY schema_name, table_name"),
)
def d22(v):
    return bi.row_counts(layer_tables(v, LAYER_NAMES))


# ----- F and the stored layers


@query(
    "f1_watermarks",
    sql(
        "\nUNION ALL ".join(
            f"SELECT '{TABLES[t].raw_layer}.{t}' AS entity, "
            f"strftime(max({TABLES[t].bookmark}), '%Y-%m-%d %H:%M:%S.%f') AS watermark_value, "
            f"TIMESTAMP '{AS_OF}' AS updated_at FROM {t}"
            for t in ALL
        ),
        *ALL,
    ),
)
def f1(v):
    """Bookmarks after a first load that stopped at mid-year and a second, full load."""
    log = []
    for t in ALL:
        df, entity = getattr(v, t)(), f"{TABLES[t].raw_layer}.{t}"
        early = df.filter(F.col(TABLES[t].bookmark) <= F.lit("2000-06-15").cast("timestamp"))
        log.append(meta.watermark_row(early, entity, TABLES[t].bookmark, "2000-06-16 00:00:00"))
        log.append(meta.watermark_row(df, entity, TABLES[t].bookmark, AS_OF))
    return meta.latest_watermarks(union(log))


@query(
    "f2_incremental_merge",
    sql(
        """
        SELECT rental_id, CAST(amount_total + CASE WHEN updated_at > TIMESTAMP '2000-06-15' THEN 7 ELSE 0 END
               AS INTEGER) AS amount_total,
               updated_at, attempts, last_attempt_at
        FROM debts""",
        "debts",
    ),
)
def f2(v):
    """Old copy of the debts, merged with a source whose newer rows have changed."""
    debts = v.debts()
    newer = F.col("updated_at") > F.lit("2000-06-15").cast("timestamp")
    now = debts.withColumn("amount_total", (F.col("amount_total") + F.when(newer, 7).otherwise(0)).cast("int"))
    changes = meta.rows_since(now, "updated_at", "2000-06-15 00:00:00")
    return meta.merge_latest(debts, changes, "rental_id", "updated_at")


def _run(v: TestViews, with_export: bool = False) -> str:
    root = scratch_path(v.spark, "run")
    warehouse.run_warehouse(
        v.spark, sources(v), root, "run-1", AS_OF, f"{root}/export" if with_export else None, finished_at=FINISHED
    )
    return root


@query(
    "f3_run_audit",
    sql(
        f"""
        SELECT 'run-1' AS run_id, 'warehouse_daily' AS dag_id, TIMESTAMP '{AS_OF}' AS started_at,
               TIMESTAMP '{FINISHED}' AS finished_at, 'SUCCESS' AS status,
               (SELECT count(*) FROM rentals) AS core_rentals,
               (SELECT count(*) FROM payment_attempts) AS core_payment_attempts""",
        "rentals",
        "payment_attempts",
    ),
)
def f3(v):
    """A whole run, then its audit row with the row counts from the details."""
    audit = warehouse.read_audit(v.spark, _run(v))
    n = "CAST(get_json_object(details, '$.core.{0}') AS BIGINT) AS core_{0}"
    return audit.selectExpr(
        "run_id", "dag_id", "started_at", "finished_at", "status", n.format("rentals"), n.format("payment_attempts")
    )


@query("f4_run_order", kpi_sql(KPI_ROWS))
def f4(v):
    """Extract, core, mart and export in order; the KPI is read back from its CSV export."""
    root = _run(v, with_export=True)
    folder = f"{root}/export/{export.export_name('mart', 'kpi_daily', AS_OF)}"
    schema = MART_TABLES["kpi_daily"]
    return export.parse_export(export.read_export(v.spark, folder, schema.names), schema)


@query(
    "b6_core_version",
    sql(
        "\nUNION ALL ".join(
            f"SELECT 'core' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL
        ),
        *ALL,
    ),
)
def b6(v):
    """Rows of the committed core version; a second version that never commits stays unseen."""
    root = _run(v)
    store = LayerStore(v.spark, root)
    rentals = store.read("core", "rentals")
    store.stage(rentals.union(rentals), "core", "run-2-unfinished", "rentals")
    return bi.row_counts({("core", t): df for t, df in store.read_layer("core").items()})


@query(
    "a11_snapshot_restore",
    counts_sql(_ROW_COUNT),
)
def a11(v):
    """Snapshot all layers, restore them into an empty store, count the rows there."""
    root = _run(v)
    LayerStore(v.spark, root).snapshot(f"{root}/snapshot")
    other = LayerStore(v.spark, f"{root}/restored")
    other.bootstrap()
    other.restore(f"{root}/snapshot", "restored-1", AS_OF, warehouse.ORDER)
    names = {(s, t) for s, t, _ in _COUNT_TABLES}
    return bi.row_counts({(s, t): other.read(s, t) for s, t in names})


@query(
    "a12_bootstrap_empty",
    sql(
        "SELECT 'raw_rental' AS schema_name, 'rentals' AS table_name, count(*) AS row_count FROM rentals\n"
        "UNION ALL SELECT 'raw_rental', 'quotes', 0 UNION ALL SELECT 'raw_rental', 'idempotency_keys', 0",
        "rentals",
    ),
)
def a12(v):
    """A layer from a source that is known to have only rentals: the other tables exist and are empty."""
    store = LayerStore(v.spark, scratch_path(v.spark, "bootstrap"))
    store.bootstrap()
    absent = ("quotes", "idempotency_keys")
    warehouse.extract_source(store, "rental", {"rentals": v.rentals()}, "v1", AS_OF, absent)
    return bi.row_counts({("raw_rental", t): df for t, df in store.read_layer("raw_rental").items()})
