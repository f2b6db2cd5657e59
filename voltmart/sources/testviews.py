"""Rental-domain tables derived from the TPC-H-like test tables.

Every view covers its whole base table. Rows that a rule needs to be missing (profiles,
quotes, stations) are missing because of an attribute of the base row, not a row sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.functions.time import add_seconds, col, div


class TestViews:
    """Lazy domain views over one scale-factor folder."""

    __test__ = False

    # Schemas of tables seen before: a declared schema saves one footer-reading job per read.
    _schemas: dict[str, T.StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def schema_of(self, name: str) -> T.StructType:
        path = f"{self.dir}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self._schemas[path]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema_of(name)).parquet(f"{self.dir}/{name}.parquet")

    # ----- rental side

    def _orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").select(
            k.alias("k"),
            F.col("o_custkey").alias("cust"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("prio"),
            add_seconds(F.col("o_orderdate").cast("timestamp"), k * 7919 % 86400).alias("start"),
        )

    def rentals_base(self) -> DataFrame:
        k = F.col("k")
        closed = (k % 50 != 0) & F.col("st").isin("F", "P")
        return self._orders().select(
            k.cast("string").alias("id"),
            F.col("cust").cast("string").alias("user_id"),
            F.concat(F.lit("pb_"), (k % 500).cast("string")).alias("powerbank_id"),
            (F.lit(60) + 30 * (k % 4)).cast("int").alias("price_per_hour"),
            (5 * (k % 3)).cast("int").alias("free_period_min"),
            (F.lit(300) + 100 * (k % 2)).cast("int").alias("deposit"),
            F.when(k % 50 == 0, "FAILED")
            .when(F.col("st") == "F", "FINISHED")
            .when(F.col("st") == "P", "BUYOUT")
            .otherwise("ACTIVE")
            .alias("status"),
            F.col("start").alias("started_at"),
            F.when(closed, add_seconds("start", F.lit(1800) + k * 37 % 20000)).alias("finished_at"),
        )

    def payment_attempts(self) -> DataFrame:
        line = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.round(F.max("l_extendedprice") / 100).cast("int").alias("amount"),
                # The smallest flag is R only if all are; a boolean keeps the aggregation hashed.
                F.max(F.col("l_returnflag") != "R").alias("success"),
                F.min("l_shipdate").cast("timestamp").alias("created_at"),
            )
        )
        return line.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").cast("string").alias("rental_id"),
            "amount",
            "success",
            F.when(~F.col("success"), "Payment failed").alias("error"),
            "created_at",
        )

    def rentals(self) -> DataFrame:
        paid = (
            self.payment_attempts()
            .groupBy("rental_id")
            .agg(F.sum(F.when(F.col("success"), F.col("amount"))).alias("paid"))
        )
        base = self.rentals_base()
        return base.join(paid, base.id == paid.rental_id, "left").select(
            "id", "user_id", "powerbank_id", "price_per_hour", "free_period_min", "deposit", "status",
            F.coalesce(F.col("paid"), F.lit(0)).cast("int").alias("total_amount"),
            "started_at", "finished_at",
        )

    def quotes(self) -> DataFrame:
        k = F.col("k")
        made = add_seconds("start", -(k % 90))
        return (
            self._orders()
            .filter(F.col("prio") != "1-URGENT")
            .select(
                F.concat(F.lit("q"), k.cast("string")).alias("id"),
                F.col("cust").cast("string").alias("user_id"),
                station_of("cust").alias("station_id"),
                (F.lit(60) + 30 * (k % 4)).cast("int").alias("price_per_hour"),
                (5 * (k % 3)).cast("int").alias("free_period_min"),
                (F.lit(300) + 100 * (k % 2)).cast("int").alias("deposit"),
                add_seconds(made, 60).alias("expires_at"),
                made.alias("created_at"),
            )
        )

    def idempotency_keys(self) -> DataFrame:
        """Stored keys of orders that ended; their responses are plain start responses."""
        k = F.col("k").cast("string")
        body = F.concat(F.lit('{"order_id":"'), k, F.lit('","status":"ok"}'))
        return (
            self._orders()
            .filter(F.col("st") == "F")
            .select(
                F.concat(F.lit("old-"), k).alias("key"),
                F.lit("start").alias("scope"),
                F.col("cust").cast("string").alias("user_id"),
                body.alias("response_json"),
                F.col("start").alias("created_at"),
            )
        )

    def debts(self) -> DataFrame:
        failed = (
            self.payment_attempts()
            .filter(~F.col("success"))
            .groupBy("rental_id")
            .agg(
                F.sum("amount").cast("int").alias("amount_total"),
                F.max("created_at").alias("updated_at"),
                F.count(F.lit(1)).cast("int").alias("attempts"),
            )
        )
        never = F.col("rental_id").cast("bigint") % 7 == 0
        return failed.withColumn("last_attempt_at", F.when(~never, F.col("updated_at")))

    # ----- requests and responses

    def outcomes(self) -> DataFrame:
        k = F.col("k")
        ok = k % 10 != 0
        return self._orders().select(
            k.cast("string").alias("rental_id"),
            ok.alias("success"),
            F.when(~ok, "Payment failed").alias("error"),
        )

    def clock(self) -> DataFrame:
        k = F.col("k")
        return self._orders().select(
            k.cast("string").alias("rental_id"), add_seconds("start", k * 53 % 400000).alias("now_ts")
        )

    def ticks(self, n: int = 6) -> DataFrame:
        """``n`` billing ticks per rental with the answer the payment service would give."""
        k = F.col("k")
        rows = self._orders().withColumn("tick", F.explode(F.array(*[F.lit(i) for i in range(1, n + 1)])))
        ok = (k + F.col("tick")) % 4 != 0
        return rows.select(
            k.cast("string").alias("rental_id"),
            "tick",
            add_seconds("start", F.col("tick") * (k * 53 % 90000)).alias("now_ts"),
            ok.alias("success"),
            F.when(~ok, "Payment failed").alias("error"),
        )

    def stations(self) -> DataFrame:
        filled = F.struct(
            F.lit(2).alias("index"),
            F.lit(False).alias("empty"),
            (F.col("s_suppkey") * 7 % 101).cast("int").alias("charge"),
        )
        free = F.struct(F.lit(1).alias("index"), F.lit(True).alias("empty"), F.lit(0).alias("charge"))
        slots = F.array(free, filled)
        return self.table("supplier").select(
            F.concat(F.lit("st_"), F.col("s_suppkey").cast("string")).alias("id"),
            F.concat(F.lit("tariff"), F.col("s_nationkey").cast("string")).alias("tariff_id"),
            F.col("s_name").alias("location"),
            F.when(F.col("s_nationkey") == 3, F.slice(slots, 1, 0)).otherwise(slots).alias("slots"),
        )

    def tariffs(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            F.concat(F.lit("tariff"), n.cast("string")).alias("id"),
            (F.lit(60) + 10 * (n % 5)).cast("int").alias("price_per_hour"),
            (5 * F.col("n_regionkey")).cast("int").alias("free_period_min"),
            (F.lit(301) + n).cast("int").alias("default_deposit"),
        )

    def profiles(self) -> DataFrame:
        """Customers with an overdrawn account have no profile (fallback case)."""
        return (
            self.table("customer")
            .filter(F.col("c_acctbal") >= 0)
            .select(
                F.col("c_custkey").cast("string").alias("id"),
                (F.col("c_mktsegment") == "BUILDING").alias("has_subscribtion"),
                (F.col("c_acctbal") > 5000).alias("trusted"),
            )
        )

    def quote_requests(self) -> DataFrame:
        return self._orders().select(
            F.col("k").cast("string").alias("request_id"),
            F.col("cust").cast("string").alias("user_id"),
            station_of("cust").alias("station_id"),
            F.col("start").alias("requested_at"),
        )

    def start_requests(self) -> DataFrame:
        """Some requests replay a neighbour's key (9) or its quote (5), some have no key (7)."""
        k = F.col("k")
        return self._orders().select(
            k.cast("string").alias("request_id"),
            F.concat(F.lit("q"), F.when(k % 10 == 5, k - 1).otherwise(k).cast("string")).alias("quote_id"),
            F.when(
                k % 100 != 7,
                F.concat(F.lit("k"), F.when(k % 10 == 9, k - 1).otherwise(k).cast("string")),
            ).alias("idempotency_key"),
            F.col("start").alias("requested_at"),
        )

    def holds(self) -> DataFrame:
        k = F.col("k")
        return self._orders().select(k.cast("string").alias("request_id"), (k % 8 != 0).alias("success"))

    def stop_requests(self) -> DataFrame:
        """Two stops for every order: the second ten minutes later, or for even orders at the same time."""
        k = F.col("k").cast("string")
        return self._orders().withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
            F.concat_ws("-", k, "n").alias("request_id"),
            F.when(F.col("prio") == "1-URGENT", F.concat(F.lit("x"), k)).otherwise(k).alias("order_id"),
            add_seconds("start", 3600 + (F.col("n") - 1) * (F.col("k") % 2) * 600).alias("stopped_at"),
        )

    # ----- monitoring side

    def api_events(self) -> DataFrame:
        u = F.col("user_id")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.when(u % 2 == 0, "rental-core").otherwise("billing-worker").alias("service"),
            F.when(u % 3 == 0, "station").when(u % 3 == 1, "payment").otherwise("profile").alias("circuit"),
            F.col("event_type").alias("kind"),
            F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
            F.round(F.col("value") * 100).cast("bigint").alias("value_c"),
            (F.round(F.col("value") * 100).cast("bigint") / F.lit(10000)).alias("duration_s"),
        )

    def debt_operations(self) -> DataFrame:
        """One debt operation per payment line, its kind taken from the return flag."""
        line = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.round(F.max("l_extendedprice") / 100).cast("bigint").alias("amount"),
                F.max(F.col("l_returnflag") == "A").alias("any_a"),
                F.max(F.col("l_returnflag") != "R").alias("not_all_r"),
                F.min("l_shipdate").cast("timestamp").alias("day"),
            )
        )
        id_ = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return line.select(
            id_.alias("id"),
            F.lit("billing-worker").alias("service"),
            F.when(F.col("any_a"), "add").when(~F.col("not_all_r"), "reduce").otherwise("retry").alias("operation"),
            "amount",
            add_seconds("day", id_ * 613 % 86400).alias("ts"),
        )


def station_of(cust: Column | str) -> Column:
    """Station of a user; the highest numbers name stations that do not exist."""
    return F.concat(F.lit("st_"), div(col(cust), 14).cast("string"))
