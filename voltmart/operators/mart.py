"""MART layer: rental and payment facts and the dense daily KPI table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.functions.money import average_minutes, round_half_away
from voltmart.functions.time import micros_between
from voltmart.schemas import FCT_PAYMENTS, FCT_RENTALS, KPI_DAILY

KPI_COUNTS = [
    "quotes_cnt",
    "rentals_started_cnt",
    "rentals_finished_cnt",
    "payments_attempts_cnt",
    "payments_success_cnt",
    "revenue_amount",
]


def fct_rentals(rentals: DataFrame) -> DataFrame:
    return rentals.withColumnRenamed("id", "rental_id").select(*FCT_RENTALS.names)


def fct_payments(payments: DataFrame) -> DataFrame:
    return payments.withColumnRenamed("id", "payment_attempt_id").select(*FCT_PAYMENTS.names)


# ----- the calendar and its four daily aggregates, one operator each


def calendar_bounds(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """First and last day of rental starts and payments; quotes and finishes do not count.

    One min/max per table, combined as rows. Without any row both bounds are NULL.
    """

    def span(df: DataFrame, ts: str) -> DataFrame:
        return df.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi"))

    return span(rentals, "started_at").unionByName(span(payments, "created_at")).agg(
        F.min("lo").alias("min_day"), F.max("hi").alias("max_day")
    )


def day_calendar(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds; the filter comes first, reversed bounds count down."""
    days = F.sequence("min_day", "max_day", F.expr("INTERVAL 1 DAY"))
    return bounds.filter(F.col("min_day") <= F.col("max_day")).select(F.explode(days).alias("day"))


def quotes_per_day(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("quotes_cnt")
    )


def rentals_started_per_day(rentals: DataFrame) -> DataFrame:
    return rentals.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("rentals_started_cnt")
    )


def _duration_micros() -> Column:
    return micros_between("started_at", "finished_at").cast("decimal(20,0)")


def rentals_finished_per_day(rentals: DataFrame) -> DataFrame:
    daily = (
        rentals.filter(F.col("finished_at").isNotNull())
        .groupBy(F.to_date("finished_at").alias("day"))
        .agg(F.count(F.lit(1)).alias("rentals_finished_cnt"), F.sum(_duration_micros()).alias("_t"))
    )
    return daily.select(
        "day",
        "rentals_finished_cnt",
        average_minutes(F.col("_t"), F.col("rentals_finished_cnt")).alias("avg_rental_duration_min"),
    )


def payments_per_day(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("payments_attempts_cnt"),
        F.sum(F.col("success").cast("int")).alias("payments_success_cnt"),
        F.sum(F.when(F.col("success"), F.col("amount")).otherwise(0)).alias("revenue_amount"),
    )


def join_daily(
    calendar: DataFrame, quotes: DataFrame, started: DataFrame, finished: DataFrame, payments: DataFrame
) -> DataFrame:
    """Calendar with the four aggregates joined on day (C9); counts default to 0."""
    out = calendar
    for part in (quotes, started, finished, payments):
        out = out.join(part, "day", "left")
    return _typed(out)


def _typed(df: DataFrame) -> DataFrame:
    cols = []
    for f in KPI_DAILY.fields:
        c = F.col(f.name)
        if f.name in KPI_COUNTS:
            c = F.coalesce(c, F.lit(0))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


# ----- the KPI table in one pass over each source


PARTIALS = ["q", "s", "f", "t", "a", "ok", "rev"]


def _part(day: Column, **measures: Column) -> Column:
    """One ``(day, partial counts)`` entry; measures not given are 0 (no duration: NULL)."""
    zero, nil = F.lit(0).cast("bigint"), F.lit(None).cast("decimal(20,0)")
    fields = [measures.get(m, nil if m == "t" else zero).alias(m) for m in PARTIALS]
    return F.struct(F.to_date(day).alias("day"), *fields)


def quote_parts(quotes: DataFrame) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return quotes.select(F.inline(F.array(_part(F.col("created_at"), q=one))))


def rental_parts(rentals: DataFrame) -> DataFrame:
    """A start entry per rental and, if it has finished, a finish entry with its duration."""
    one = F.lit(1).cast("bigint")
    entries = F.array(
        _part(F.col("started_at"), s=one), _part(F.col("finished_at"), f=one, t=_duration_micros())
    )
    return rentals.select(F.inline(entries)).filter(F.col("day").isNotNull())


def payment_parts(payments: DataFrame) -> DataFrame:
    success = F.coalesce(F.col("success"), F.lit(False))
    entry = _part(
        F.col("created_at"),
        a=F.lit(1).cast("bigint"),
        ok=success.cast("bigint"),
        rev=F.when(success, F.col("amount")).otherwise(0).cast("bigint"),
    )
    return payments.select(F.inline(F.array(entry)))


def negated(parts: DataFrame) -> DataFrame:
    """Entries that take their share off again: of rows that were changed or deleted."""
    return parts.select("day", *[(-F.col(c)).cast(parts.schema[c].dataType).alias(c) for c in PARTIALS])


def daily_partials(parts: DataFrame) -> DataFrame:
    """Partial counts summed per day; sums of sums stay exact, so batches can be merged."""
    return parts.filter(F.col("day").isNotNull()).groupBy("day").agg(*[F.sum(c).alias(c) for c in PARTIALS])


def kpi_daily(quotes: DataFrame, rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Dense daily KPI (C11): same rows as ``join_daily``, each source read once.

    All sources become ``(day, partial counts)`` rows and meet in one aggregation by day that
    combines before its shuffle.
    """
    parts = quote_parts(quotes).unionByName(rental_parts(rentals)).unionByName(payment_parts(payments))
    return kpi_from_partials(daily_partials(parts))


def kpi_from_partials(daily: DataFrame) -> DataFrame:
    """Dense KPI from one row per day that has events.

    The window that finds the calendar bounds and the next present day orders one row per
    calendar day: a few thousand, however large the sources are.
    """
    all_days = Window.partitionBy(F.lit(1))
    counted = F.when((F.col("s") > 0) | (F.col("a") > 0), F.col("day"))
    bounded = (
        daily.withColumn("lo", F.min(counted).over(all_days))
        .withColumn("hi", F.max(counted).over(all_days))
        .filter(F.col("day").between(F.col("lo"), F.col("hi")))
        .withColumn("next", F.lead("day").over(all_days.orderBy("day")))
    )
    last = F.coalesce(F.date_sub("next", 1), F.col("day"))
    dense = bounded.withColumn("d", F.explode(F.sequence("day", last, F.expr("INTERVAL 1 DAY"))))
    here = F.col("d") == F.col("day")

    def at_day(c: Column) -> Column:
        return F.when(here, c)

    return _typed(
        dense.select(
            at_day(F.col("q")).alias("quotes_cnt"),
            at_day(F.col("s")).alias("rentals_started_cnt"),
            at_day(F.col("f")).alias("rentals_finished_cnt"),
            at_day(F.col("a")).alias("payments_attempts_cnt"),
            at_day(F.col("ok")).alias("payments_success_cnt"),
            at_day(F.col("rev")).alias("revenue_amount"),
            at_day(average_minutes(F.col("t"), F.col("f"))).alias("avg_rental_duration_min"),
            F.col("d").alias("day"),
        )
    )


def kpi_in_order(kpi: DataFrame) -> DataFrame:
    """Reading order (C10); stored files promise none."""
    return kpi.orderBy("day")


# ----- documented forms


def fct_rentals_with_duration(rentals: DataFrame) -> DataFrame:
    """Rental fact with its length in minutes, two decimals."""
    micros = micros_between("started_at", "finished_at")
    return fct_rentals(rentals).withColumn(
        "duration_min", average_minutes(micros, F.when(F.col("finished_at").isNotNull(), F.lit(1)))
    )


def kpi_documented(kpi: DataFrame) -> DataFrame:
    """KPI under its documented column names.

    ``payment_success_rate`` is a percentage with two decimals, NULL on days without attempts.
    """
    ok = F.col("payments_success_cnt").cast("bigint")
    n = F.col("payments_attempts_cnt").cast("bigint")
    rate = F.when(n > 0, round_half_away(ok * 10000, n).cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)"))
    return kpi.select(
        "day",
        "quotes_cnt",
        "rentals_started_cnt",
        F.col("rentals_finished_cnt").alias("rentals_completed_cnt"),
        F.col("revenue_amount").alias("revenue_paid_amount"),
        F.col("payments_attempts_cnt").alias("payments_total_cnt"),
        "payments_success_cnt",
        rate.cast("decimal(5,2)").alias("payment_success_rate"),
        "avg_rental_duration_min",
    )
