"""Windowed aggregates, de-duplication and joins on event-time streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.functions.time import add_seconds
from voltmart.operators.quotes import QUOTE_LIFE_SEC
from voltmart.streaming.run import FOLD_EVERY, LATENESS, BatchJob, BatchTable, drain_batches, finished


def quote_events(quotes: DataFrame) -> DataFrame:
    return quotes.select(F.col("created_at").alias("ts"), F.lit("quote").alias("kind"), F.lit(0).alias("amount"))


def rental_events(rentals: DataFrame) -> DataFrame:
    """Start and finish of each rental as two events."""
    entries = F.array(
        F.struct(F.col("started_at").alias("ts"), F.lit("start").alias("kind")),
        F.struct(F.col("finished_at").alias("ts"), F.lit("finish").alias("kind")),
    )
    return rentals.select(F.inline(entries)).filter(F.col("ts").isNotNull()).withColumn("amount", F.lit(0))


def payment_events(payments: DataFrame) -> DataFrame:
    kind = F.when(F.col("success"), "paid").otherwise("unpaid")
    return payments.select(F.col("created_at").alias("ts"), kind.alias("kind"), "amount")


def daily_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Tumbling one-day counts of ``events(ts, kind, amount)``.

    In append mode a day appears once the watermark has passed its end. Counts combine before
    the shuffle; state holds one row per open day.
    """

    def of(kind: str):
        return F.count_if(F.col("kind") == kind)

    days = events.withWatermark("ts", lateness).groupBy(F.window("ts", "1 day").alias("w"))
    return days.agg(
        of("quote").alias("quotes_cnt"),
        of("start").alias("rentals_started_cnt"),
        of("finish").alias("rentals_finished_cnt"),
        F.count_if(F.col("kind").isin("paid", "unpaid")).alias("payments_attempts_cnt"),
        of("paid").alias("payments_success_cnt"),
        F.sum(F.when(F.col("kind") == "paid", F.col("amount")).otherwise(0)).alias("revenue_amount"),
    ).select(
        F.to_date("w.start").alias("day"),
        "quotes_cnt",
        "rentals_started_cnt",
        "rentals_finished_cnt",
        "payments_attempts_cnt",
        "payments_success_cnt",
        "revenue_amount",
    )


def sliding_rate(
    events: DataFrame, labels: list[str], window_s: int, step_s: int, lateness: str = LATENESS
) -> DataFrame:
    """Events per second over sliding ranges, labelled by the range's end."""
    counted = (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", f"{window_s} seconds", f"{step_s} seconds").alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("increase"))
    )
    return counted.select(
        *labels, F.col("w.end").alias("t"), "increase", (F.col("increase") / F.lit(window_s)).alias("per_second")
    )


def with_open_windows(
    closed: DataFrame, events: DataFrame, build: Callable[[DataFrame], DataFrame], end: str, span_s: int
) -> DataFrame:
    """Windows a drained stream has emitted, and those its watermark left open.

    ``closed`` is the stream's table, ``events`` the same source read as a table, ``build`` the
    streamed expression; ``end`` orders the windows and ``span_s`` is their length. Everything up
    to the newest emitted window is closed, so only later windows are built, from the last
    ``span_s`` seconds before it on; the filter reaches the scan.
    """
    last = closed.agg(F.max(end)).first()[0]
    if last is None:
        return build(events)
    recent = events.filter(F.col("ts") >= F.lit(last).cast("timestamp") - F.expr(f"INTERVAL {span_s} SECONDS"))
    return closed.unionByName(build(recent).filter(F.col(end) > F.lit(last)))


def first_per_key(requests: DataFrame, key: str, salt_on: str, salts: int = 16, lateness: str = LATENESS) -> DataFrame:
    """One request per key within the lateness (S3).

    De-duplication has no partial step before its shuffle, so a key with very many repeats
    would go to one task. The first stage spreads each key over ``salts`` groups; the second
    sees at most that many rows per key.
    """
    salted = requests.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    once = salted.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key, "_salt"])
    return once.dropDuplicatesWithinWatermark([key]).drop("_salt")


def starts_with_quotes(
    starts: DataFrame, quotes: DataFrame, lateness: str = LATENESS, fold_every: int = FOLD_EVERY
) -> BatchJob:
    """Starts joined to their quote within its life (S4), to be drained.

    Rows that later batches may need lie in a table, not in the memory of state stores, and a micro-batch
    is joined as a table: it spills, and a quote that attracts very many starts is left to AQE's skew
    split. Rows up to the watermark (the older side's newest time, less the lateness) are dropped, and
    kept ones are no longer met, one micro-batch after it moved, as in Spark's own stream joins.
    """
    spark = starts.sparkSession
    nil = {c: F.lit(None).cast(df.schema[c].dataType).alias(c) for df, c in ((starts, "request_id"), (quotes, "price_per_hour"), (quotes, "deposit"))}
    asked = starts.select(
        F.lit(False).alias("made"), "quote_id", F.col("requested_at").alias("ts"), "request_id", nil["price_per_hour"], nil["deposit"]
    )
    made = quotes.select(
        F.lit(True).alias("made"), F.col("id").alias("quote_id"), F.col("created_at").alias("ts"), nil["request_id"], "price_per_hour", "deposit"
    )
    events = asked.unionByName(made)
    life = F.expr(f"INTERVAL {QUOTE_LIFE_SEC} SECONDS")

    def joined(rows: DataFrame) -> DataFrame:
        """Pairs with at least one row of the newest batch."""
        left = rows.filter(~F.col("made")).select("request_id", F.col("quote_id").alias("_want"), F.col("ts").alias("requested_at"), F.col("_new").alias("_asked_now"))
        right = rows.filter("made").select("quote_id", F.col("ts").alias("created_at"), "price_per_hour", "deposit", "_new")
        in_life = (F.col("requested_at") >= F.col("created_at")) & (F.col("requested_at") <= F.col("created_at") + life)
        pairs = left.join(right, (F.col("_want") == F.col("quote_id")) & in_life & (F.col("_asked_now") | F.col("_new")))
        return pairs.select(
            "request_id", "quote_id", "requested_at",
            add_seconds("created_at", QUOTE_LIFE_SEC).alias("expires_at"), "price_per_hour", "deposit",
        )

    def open_rows(rows: DataFrame, mark: dt.datetime | None) -> DataFrame:
        """Without rows that the watermark has passed; quotes stay for their life."""
        if mark is None:
            return rows
        ends = F.when(F.col("made"), F.col("ts") + life).otherwise(F.col("ts"))
        return rows.filter((F.col("ts") > F.lit(mark) - life) & (ends > F.lit(mark)))

    newest = "asked_until timestamp, made_until timestamp"

    def run(target: str) -> DataFrame:
        def table(name: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame] | None = None) -> BatchTable:
            return BatchTable(spark, f"{target}/{name}", schema, fold, fold_every)

        marks = table("marks", spark.createDataFrame([], newest).schema)
        pairs = table("pairs", joined(spark.createDataFrame([], events.schema).withColumn("_new", F.lit(True))).schema)

        def handle(batch: DataFrame, batch_id: int) -> None:
            marks.begin(batch_id)
            pairs.begin(batch_id)
            sides = [F.max("asked_until"), F.max("made_until")]
            older = F.when(sides[0].isNotNull() & sides[1].isNotNull(), F.least(*sides)) - F.expr(f"INTERVAL {lateness}")
            mark = marks.before(batch_id).filter(F.col("batch") < batch_id - 1).agg(older.alias("mark")).first()["mark"]
            kept = table("kept", events.schema, lambda rows: open_rows(rows, mark))
            kept.begin(batch_id)
            fresh = batch.filter(F.col("ts").isNotNull())
            kept.write(fresh if mark is None else fresh.filter(F.col("ts") > F.lit(mark)), batch_id)
            marks.write(
                kept.of(batch_id).agg(
                    F.max(F.when(~F.col("made"), F.col("ts"))).alias("asked_until"), F.max(F.when(F.col("made"), F.col("ts"))).alias("made_until")
                ),
                batch_id,
            )
            rows = kept.of(batch_id).withColumn("_new", F.lit(True))
            if batch_id:
                rows = rows.unionByName(open_rows(kept.before(batch_id), mark).withColumn("_new", F.lit(False)))
            pairs.write(joined(rows), batch_id)

        drain_batches(events, target, handle)
        return pairs.before(finished(spark, target)).drop("batch")

    return BatchJob(run)
