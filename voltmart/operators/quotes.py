"""Pricing and upkeep of quotes as jobs over request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import quote_deposit
from voltmart.functions.text import derived_id
from voltmart.functions.time import add_seconds, as_ts

QUOTE_LIFE_SEC = 60


def with_profiles(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Requests with the user's profile (H3).

    A user without a profile counts as not trusted and without subscription, and is flagged.
    """
    known = profiles.select(
        F.col("id").alias("_u"), F.col("trusted").alias("_t"), F.col("has_subscribtion").alias("_s")
    )
    joined = requests.join(known, requests.user_id == F.col("_u"), "left")
    return joined.withColumns(
        {
            "trusted": F.coalesce("_t", F.lit(False)),
            "has_subscribtion": F.coalesce("_s", F.lit(False)),
            "from_fallback": F.col("_u").isNull(),
        }
    ).drop("_u", "_t", "_s")


def price_quotes(
    requests: DataFrame, stations: DataFrame, tariffs: DataFrame, profiles: DataFrame
) -> DataFrame:
    """New quotes (H1, H2, H4): terms come from the station's tariff.

    Stations meet their tariffs first, so requests join one terms table. No side is forced
    to broadcast; the planner and AQE decide by size, and AQE splits a station that holds
    very many requests.
    """
    terms = stations.select(F.col("id").alias("station_id"), "tariff_id").join(
        tariffs.withColumnRenamed("id", "tariff_id"), "tariff_id"
    )
    priced = with_profiles(requests, profiles).join(terms, "station_id")
    return priced.select(
        derived_id("quote", "request_id").alias("id"),
        "request_id",
        "user_id",
        "station_id",
        "price_per_hour",
        "free_period_min",
        quote_deposit("default_deposit", "trusted").alias("deposit"),
        add_seconds(F.date_trunc("second", "requested_at"), QUOTE_LIFE_SEC).alias("expires_at"),
        F.col("requested_at").alias("created_at"),
        "from_fallback",
    )


def failed_quote_requests(requests: DataFrame, stations: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Requests that cannot be priced, with the missing piece."""
    terms = stations.select(F.col("id").alias("station_id"), "tariff_id").join(
        tariffs.select(F.col("id").alias("tariff_id"), F.lit(True).alias("_has_tariff")), "tariff_id", "left"
    )
    joined = requests.join(terms, "station_id", "left")
    reason = F.when(F.col("tariff_id").isNull(), "station not found").when(
        F.col("_has_tariff").isNull(), "tariff not found"
    )
    return joined.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "request_id", "station_id", "reason"
    )


def expiry(expires_at: Column) -> Column:
    """Expiry as a timestamp; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(expires_at.cast("string"))


def quote_expired(expires_at: Column, at: Column) -> Column:
    """Past its expiry, strictly; an unknown expiry counts as valid."""
    return F.coalesce(at > expires_at, F.lit(False))


def quote_validity(requests: DataFrame, quotes: DataFrame) -> DataFrame:
    """``valid``, ``expired`` or ``not_found`` per start request (H5)."""
    known = quotes.select(F.col("id").alias("quote_id"), F.col("expires_at").alias("_e"), F.lit(True).alias("_q"))
    joined = requests.join(known, "quote_id", "left")
    state = (
        F.when(F.col("_q").isNull(), "not_found")
        .when(quote_expired(expiry(F.col("_e")), F.col("requested_at")), "expired")
        .otherwise("valid")
    )
    return joined.select("request_id", "quote_id", state.alias("validity"))


# ----- quote upkeep


def get_quotes(quotes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Quotes named in ``wanted(quote_id)``."""
    return quotes.join(wanted.select(F.col("quote_id").alias("id")), "id", "left_semi")


def create_quotes(quotes: DataFrame, new: DataFrame, now) -> DataFrame:
    """Add rows; a missing creation time becomes ``now``."""
    stamped = new.withColumn("created_at", F.coalesce("created_at", as_ts(now)))
    return quotes.unionByName(stamped.select(*quotes.columns))


def consume_quotes(quotes: DataFrame, used: DataFrame) -> DataFrame:
    """Quotes without the ones in ``used(quote_id)``; repeating it changes nothing."""
    return quotes.join(used.select(F.col("quote_id").alias("id")), "id", "left_anti")


# ----- stations


def station_slots(stations: DataFrame) -> DataFrame:
    """Free and filled slots and their charge from the nested list."""
    filled = F.filter("slots", lambda s: ~s["empty"])
    charges = F.transform(filled, lambda s: s["charge"])
    return stations.select(
        F.col("id").alias("station_id"),
        F.size("slots").alias("slots_total"),
        F.size(F.filter("slots", lambda s: s["empty"])).alias("slots_free"),
        F.size(filled).alias("slots_filled"),
        F.array_max(charges).alias("best_charge"),
    )


def slot_rows(stations: DataFrame) -> DataFrame:
    """One row per slot."""
    return stations.select(F.col("id").alias("station_id"), F.inline("slots"))


def eject_responses(stations: DataFrame) -> DataFrame:
    """What each station would answer: without slots it cannot eject."""
    ok = F.size("slots") > 0
    return stations.select(
        F.col("id").alias("station_id"),
        ok.alias("success"),
        F.when(ok, F.concat(F.lit("powerbank_"), F.regexp_extract("id", r"(\d+)$", 1))).otherwise("").alias("powerbank_id"),
    )
