"""Typed table definitions, layer map and extract configuration (A4, A5).

Every layer shares the constants below, so a core table cannot drift from its raw twin.
Serial ids are ``bigint``: at cluster scale a 32-bit sequence runs out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(spec: str) -> T.StructType:
    """Build a schema from ``name type[!]`` pairs; ``!`` marks NOT NULL."""
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "boolean": T.BooleanType(),
        "timestamp": T.TimestampType(),
        "date": T.DateType(),
        "decimal": T.DecimalType(12, 2),
    }
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


INGESTED_AT = "_ingested_at"

QUOTES = _schema(
    "id string!, user_id string!, station_id string!, price_per_hour int!, free_period_min int!,"
    "deposit int!, expires_at timestamp!, created_at timestamp!, _ingested_at timestamp!"
)
RENTALS = _schema(
    "id string!, user_id string!, powerbank_id string!, price_per_hour int!, free_period_min int!,"
    "deposit int!, status string!, total_amount int!, started_at timestamp!, finished_at timestamp,"
    "_ingested_at timestamp!"
)
IDEMPOTENCY_KEYS = _schema(
    "key string!, scope string!, user_id string!, response_json string!, created_at timestamp!,"
    "_ingested_at timestamp!"
)
DEBTS = _schema(
    "rental_id string!, amount_total int!, updated_at timestamp!, attempts int!,"
    "last_attempt_at timestamp, _ingested_at timestamp!"
)
PAYMENT_ATTEMPTS = _schema(
    "id bigint!, rental_id string!, amount int!, success boolean!, error string,"
    "created_at timestamp!, _ingested_at timestamp!"
)
FCT_RENTALS = _schema(
    "rental_id string!, user_id string!, powerbank_id string!, status string!, started_at timestamp!,"
    "finished_at timestamp, total_amount int!, price_per_hour int!, free_period_min int!, deposit int!"
)
FCT_PAYMENTS = _schema(
    "payment_attempt_id bigint!, rental_id string!, amount int!, success boolean!, error string,"
    "created_at timestamp!"
)
KPI_DAILY = _schema(
    "day date!, quotes_cnt int!, rentals_started_cnt int!, rentals_finished_cnt int!,"
    "payments_attempts_cnt int!, payments_success_cnt int!, revenue_amount bigint!,"
    "avg_rental_duration_min decimal"
)
ETL_WATERMARK = _schema("entity string!, watermark_value string!, updated_at timestamp!")
ETL_RUN_AUDIT = _schema(
    "run_id string!, dag_id string!, started_at timestamp!, finished_at timestamp, status string!,"
    "details string"
)

SLOTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("index", T.IntegerType()),
            T.StructField("empty", T.BooleanType()),
            T.StructField("charge", T.IntegerType()),
        ]
    )
)
START_RESPONSE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("powerbank_id", T.StringType()),
        T.StructField("total_amount", T.IntegerType()),
        T.StructField("debt", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """One replicated table: where it comes from, its schema and its constraints."""

    name: str
    source: str
    schema: T.StructType
    key: str
    bookmark: str
    max_len: dict[str, int]

    @property
    def raw_layer(self) -> str:
        return f"raw_{self.source}"


# Column length limits of the raw tables.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        TableSpec("quotes", "rental", QUOTES, "id", "created_at",
                  {"id": 64, "user_id": 64, "station_id": 128}),
        TableSpec("rentals", "rental", RENTALS, "id", "started_at",
                  {"id": 64, "user_id": 64, "powerbank_id": 64, "status": 16}),
        TableSpec("idempotency_keys", "rental", IDEMPOTENCY_KEYS, "key", "created_at",
                  {"key": 64, "scope": 32, "user_id": 64}),
        TableSpec("debts", "billing", DEBTS, "rental_id", "updated_at", {"rental_id": 64}),
        TableSpec("payment_attempts", "billing", PAYMENT_ATTEMPTS, "id", "created_at",
                  {"rental_id": 64}),
    ]
}

# Extract sets per source service; core reads each table from exactly this source.
EXTRACTS: dict[str, list[str]] = {
    "rental": ["quotes", "rentals", "idempotency_keys"],
    "billing": ["debts", "payment_attempts"],
}

MART_TABLES: dict[str, T.StructType] = {
    "fct_rentals": FCT_RENTALS,
    "fct_payments": FCT_PAYMENTS,
    "kpi_daily": KPI_DAILY,
}
META_TABLES: dict[str, T.StructType] = {
    "etl_watermark": ETL_WATERMARK,
    "etl_run_audit": ETL_RUN_AUDIT,
}

LAYERS: dict[str, dict[str, T.StructType]] = {
    "raw_rental": {t: TABLES[t].schema for t in EXTRACTS["rental"]},
    "raw_billing": {t: TABLES[t].schema for t in EXTRACTS["billing"]},
    "core": {t: spec.schema for t, spec in TABLES.items()},
    "mart": MART_TABLES,
    "meta": META_TABLES,
}


def business_columns(schema: T.StructType) -> list[str]:
    """Column names without technical (underscore) columns."""
    return [n for n in schema.names if not n.startswith("_")]
