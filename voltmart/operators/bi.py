"""Dashboard and report queries on the mart.

All of them read the KPI table, one row per day, or count rows per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import round_half_away

TOTALS = {
    "quotes": "quotes_cnt",
    "rentals_started": "rentals_started_cnt",
    "rentals_finished": "rentals_finished_cnt",
    "payment_attempts": "payments_attempts_cnt",
    "payments_success": "payments_success_cnt",
    "revenue": "revenue_amount",
}


def total(kpi: DataFrame, measure: str) -> DataFrame:
    """One headline number (D1-D6); NULL on an empty table."""
    return kpi.agg(F.sum(TOTALS[measure]).alias("value"))


def success_rate(kpi: DataFrame) -> DataFrame:
    """Share of successful payments in percent, one decimal; 0 without attempts."""
    ok, n = F.col("ok").cast("decimal(20,0)"), F.col("n").cast("decimal(20,0)")
    tenths = round_half_away(ok * 1000, n).cast("decimal(20,0)") / F.lit(10).cast("decimal(2,0)")
    sums = kpi.agg(F.sum("payments_success_cnt").alias("ok"), F.sum("payments_attempts_cnt").alias("n"))
    return sums.select(
        F.when(F.col("n") > 0, tenths).otherwise(F.lit(0)).cast("decimal(5,1)").alias("value")
    )


def success_band(value: Column) -> Column:
    """Colour of the success rate. 50 and 80."""
    return F.when(value < 50, "red").when(value < 80, "yellow").otherwise("green")


def daily_series(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        F.col("day").alias("time"), "rentals_started_cnt", "rentals_finished_cnt", "payments_success_cnt"
    ).orderBy("time")


def _rounded(c: str, digits: int) -> Column:
    return F.round(F.col(c).cast("decimal(12,2)"), digits)


def detail_table(kpi: DataFrame) -> DataFrame:
    """Every day, newest first."""
    average = F.coalesce(_rounded("avg_rental_duration_min", 1), F.lit(0).cast("decimal(12,1)"))
    return kpi.select("day", *TOTALS.values(), average.alias("avg_rental_duration_min")).orderBy(F.desc("day"))


def on_day(kpi: DataFrame, column: str, as_of_day: str) -> DataFrame:
    """One measure of one day (D10-D12, D14, D15); no row when the day is absent."""
    return kpi.filter(F.col("day") == F.lit(as_of_day).cast("date")).select(F.col(column).alias("value"))


def success_rate_on_day(kpi: DataFrame, as_of_day: str) -> DataFrame:
    """Percentage as a float; NULL (not 0) without attempts."""
    n = F.col("payments_attempts_cnt")
    share = F.when(n > 0, F.col("payments_success_cnt").cast("double") / n * 100)
    return kpi.filter(F.col("day") == F.lit(as_of_day).cast("date")).select(share.alias("value"))


def rental_series(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        F.col("day").cast("timestamp").alias("time"),
        F.col("rentals_started_cnt").alias("rentals_started"),
        F.col("rentals_finished_cnt").alias("rentals_completed"),
    ).orderBy("time")


def revenue_series(documented: DataFrame) -> DataFrame:
    """Revenue and success rate per day from the documented KPI form."""
    return documented.select(
        F.col("day").cast("timestamp").alias("time"), "revenue_paid_amount", "payment_success_rate"
    ).orderBy("time")


def last_days(kpi: DataFrame, as_of_day: str, days: int) -> DataFrame:
    """Relative range: from ``days`` before ``as_of_day`` up to it."""
    end = F.lit(as_of_day).cast("date")
    return kpi.filter(F.col("day").between(F.date_sub(end, days), end))


def latest(kpi: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` days (D21); a top-k, not a full sort."""
    return kpi.orderBy(F.desc("day")).limit(n)


def latest_rounded(kpi: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` days with the average rounded to two decimals."""
    return latest(kpi, n).select(
        "day", *TOTALS.values(), _rounded("avg_rental_duration_min", 2).alias("avg_duration_min")
    )


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Exact row count per ``(schema, table)``, ordered."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "row_count"
        )
        for (schema, name), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("schema_name", "table_name")


def row_count_lines(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """The same as ``schema.table: count`` lines."""
    name = F.concat_ws(".", "schema_name", "table_name")
    return row_counts(tables).select(F.concat(name, F.lit(": "), F.col("row_count").cast("string")).alias("line"))
