"""Frames for literal cases and the comparison of two engines' rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from pathlib import Path

RENTAL_COLS = (
    "id string, user_id string, powerbank_id string, price_per_hour int, free_period_min int, deposit int,"
    "status string, total_amount int, started_at timestamp, finished_at timestamp"
)
DEBT_COLS = "rental_id string, amount_total int, updated_at timestamp, attempts int, last_attempt_at timestamp"
PAYMENT_COLS = "id bigint, rental_id string, amount int, success boolean, error string, created_at timestamp"
QUOTE_COLS = (
    "id string, user_id string, station_id string, price_per_hour int, free_period_min int, deposit int,"
    "expires_at timestamp, created_at timestamp"
)

T0 = dt.datetime(2025, 1, 1, 12, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def rental(id_="r1", price=120, free=10, deposit=500, status="ACTIVE", total=0, started=T0, finished=None):
    return (id_, "u1", "pb-1", price, free, deposit, status, total, started, finished)


def rentals(spark, *items):
    return spark.createDataFrame(list(items), RENTAL_COLS)


def debts(spark, *items):
    return spark.createDataFrame(list(items), DEBT_COLS)


def payments(spark, *items):
    """Items are (rental_id, amount, success)."""
    full = [
        (i, r, a, ok, None if ok else "Payment failed", at(i)) for i, (r, a, ok) in enumerate(items, start=1)
    ]
    return spark.createDataFrame(full, PAYMENT_COLS)


def normal(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sorted_rows(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def land(folder, *frames):
    """Write frames as files of one folder, a minute apart, so a stream takes them in order.

    The file source orders by modification time, which may have a resolution of a second.
    """
    path, seen = Path(folder.removeprefix("file:")), set()
    for minute, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(folder)
        for file in set(path.glob("*.parquet")) - seen:
            os.utime(file, (1_600_000_000 + 60 * minute,) * 2)
            seen.add(file)
