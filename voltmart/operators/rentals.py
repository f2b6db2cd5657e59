"""Start, stop and status of rentals as jobs over request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.functions.money import deposit_refund
from voltmart.functions.text import derived_id, start_response_json
from voltmart.operators import ledger
from voltmart.operators.quotes import expiry, quote_expired

# Outcome names with the HTTP status the service answers.
HTTP_CODES = {
    "key_missing": 400,
    "cached": 200,
    "quote_not_found": 400,
    "quote_expired": 400,
    "eject_failed": 409,
    "started": 200,
}


def key_missing(requests: DataFrame) -> DataFrame:
    """Requests without an idempotency key (H7)."""
    return requests.filter(F.coalesce("idempotency_key", F.lit("")) == "").select("request_id")


def with_checks(requests: DataFrame, quotes: DataFrame, ejects: DataFrame) -> DataFrame:
    """Start requests with everything that depends on the request alone.

    Adds the quote's terms, whether it exists and has expired, and the station's eject
    answer; ``eligible`` requests would start if nobody came before them.
    """
    terms = quotes.select(
        F.col("id").alias("quote_id"),
        F.lit(True).alias("quote_found"),
        F.col("user_id").alias("quote_user"),
        "station_id",
        "price_per_hour",
        "free_period_min",
        "deposit",
        "expires_at",
    )
    answers = ejects.select(
        "station_id", F.col("success").alias("ejected"), F.col("powerbank_id").alias("ejected_id")
    )
    # Quotes meet their station first, so the requests take part in one join only.
    offers = terms.join(answers, "station_id", "left")
    joined = requests.join(offers, "quote_id", "left")
    has_key = F.coalesce("idempotency_key", F.lit("")) != ""
    expired = quote_expired(expiry(F.col("expires_at")), F.col("requested_at"))
    return (
        joined.withColumn("has_key", has_key)
        .withColumn("quote_found", F.coalesce("quote_found", F.lit(False)))
        .withColumn("quote_expired", F.col("quote_found") & expired)
        .withColumn("ejected", F.coalesce("ejected", F.lit(False)))
        .withColumn(
            "eligible",
            F.col("has_key") & F.col("quote_found") & ~F.col("quote_expired") & F.col("ejected"),
        )
        .withColumn("turn", F.struct("requested_at", "request_id"))
        .withColumn("order_id", derived_id("rental", "request_id"))
    )


def outcomes(checked: DataFrame, winners: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Outcome and HTTP code of every request, in the service's order of checks (H6, H8).

    ``winners(key, quote_id, turn, order_id)`` are the successful starts. A request whose key
    was claimed earlier, or is in ``stored(key, response_json)``, gets that response whatever
    it asks for; one whose quote was used earlier does not find it.
    """
    by_key = winners.select(
        F.col("key").alias("idempotency_key"),
        F.col("turn").alias("key_turn"),
        F.col("order_id").alias("cached_order"),
    )
    by_quote = winners.select("quote_id", F.col("turn").alias("quote_turn"))
    # Requests without a key are settled; in a join on it they would all meet in one task.
    keyless = checked.filter(~F.col("has_key")).withColumns(
        {
            "key_turn": F.lit(None).cast(by_key.schema["key_turn"].dataType),
            "quote_turn": F.lit(None).cast(by_quote.schema["quote_turn"].dataType),
            "cached_order": F.lit(None).cast("string"),
            "stored_order": F.lit(None).cast("string"),
        }
    )
    out = checked.filter("has_key").join(by_key, "idempotency_key", "left").join(by_quote, "quote_id", "left")
    if stored is None:
        out = out.withColumn("stored_order", F.lit(None).cast("string"))
    else:
        old = stored.select(
            F.col("key").alias("idempotency_key"),
            F.get_json_object("response_json", "$.order_id").alias("stored_order"),
        )
        out = out.join(old, "idempotency_key", "left")
    out = out.unionByName(keyless)
    replay = F.col("stored_order").isNotNull() | (F.col("key_turn") < F.col("turn"))
    used = F.col("quote_turn") < F.col("turn")
    outcome = (
        F.when(~F.col("has_key"), "key_missing")
        .when(replay, "cached")
        .when(~F.col("quote_found") | used, "quote_not_found")
        .when(F.col("quote_expired"), "quote_expired")
        .when(~F.col("ejected"), "eject_failed")
        .otherwise("started")
    )
    code = F.lit(None).cast("int")
    for name, value in HTTP_CODES.items():
        code = F.when(F.col("outcome") == name, value).otherwise(code)
    order = F.when(F.col("outcome") == "started", F.col("order_id")).when(
        F.col("outcome") == "cached", F.coalesce("stored_order", "cached_order")
    )
    return (
        out.withColumn("outcome", outcome)
        .withColumn("http_code", code)
        .withColumn("response_order_id", order)
        .drop("key_turn", "quote_turn", "cached_order", "stored_order")
    )


def new_rentals(decided: DataFrame) -> DataFrame:
    """Rental rows of started and of eject-failed requests (H9).

    Terms come from the quote. A failed eject leaves a FAILED row whose device is PENDING.
    """
    made = decided.filter(F.col("outcome").isin("started", "eject_failed"))
    started = F.col("outcome") == "started"
    return made.select(
        F.col("order_id").alias("id"),
        F.col("quote_user").alias("user_id"),
        F.when(started, F.col("ejected_id")).otherwise("PENDING").alias("powerbank_id"),
        "price_per_hour",
        "free_period_min",
        "deposit",
        F.when(started, "ACTIVE").otherwise("FAILED").alias("status"),
        F.lit(0).alias("total_amount"),
        F.col("requested_at").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
    )


def hold_failures(decided: DataFrame, holds: DataFrame) -> DataFrame:
    """Deposits of started rentals whose hold failed, as debt deltas."""
    failed = holds.filter(~F.coalesce(F.col("success"), F.lit(False))).select("request_id")
    return (
        decided.filter(F.col("outcome") == "started")
        .join(failed, "request_id", "left_semi")
        .select(
            F.col("order_id").alias("rental_id"), F.col("deposit").alias("amount"), F.col("requested_at").alias("now")
        )
    )


def attach_hold_debts(debts: DataFrame, decided: DataFrame, holds: DataFrame) -> DataFrame:
    return ledger.attach_debt(debts, hold_failures(decided, holds))


def start_responses(decided: DataFrame, holds: DataFrame) -> DataFrame:
    """Stored response of every successful start, as the JSON of H18."""
    owed = hold_failures(decided, holds).select(
        F.col("rental_id").alias("order_id"), F.col("amount").alias("_debt")
    )
    started = decided.filter(F.col("outcome") == "started").join(owed, "order_id", "left")
    body = start_response_json(
        order_id=F.col("order_id"),
        status=F.lit("ACTIVE"),
        powerbank_id=F.col("ejected_id"),
        total_amount=F.lit(0),
        debt=F.coalesce("_debt", F.lit(0)),
    )
    return started.select(
        F.col("idempotency_key").alias("key"),
        F.lit("start").alias("scope"),
        F.col("quote_user").alias("user_id"),
        body.alias("response_json"),
        F.col("requested_at").alias("created_at"),
    )


# ----- stop and status


def _with_debt(rentals: DataFrame, debts: DataFrame) -> DataFrame:
    owed = debts.select(F.col("rental_id").alias("id"), F.col("amount_total").alias("_debt"))
    return rentals.join(owed, "id", "left").withColumn("debt", F.coalesce("_debt", F.lit(0))).drop("_debt")


def stop_rentals(rentals: DataFrame, debts: DataFrame, requests: DataFrame) -> DataFrame:
    """Answer to ``requests(request_id, order_id, stopped_at)``.

    Any status but FINISHED becomes FINISHED, also BUYOUT; an unknown rental is not found. Of
    several stops of one rental the first by time and id ends it; the others find it finished
    with the end that the first one set.
    """
    known = _with_debt(rentals, debts).select(
        F.col("id").alias("order_id"), "status", "powerbank_id", "total_amount", "debt", "deposit", "finished_at"
    )
    turn = F.struct("stopped_at", "request_id")
    first = requests.groupBy("order_id").agg(F.min(turn).alias("_first"))
    joined = requests.join(first, "order_id", "left").join(known, "order_id", "left")
    found = F.col("status").isNotNull()
    before = F.col("status") == "FINISHED"
    already = before | (F.col("request_id") != F.col("_first.request_id"))
    return joined.select(
        "order_id",
        F.when(~found, "not_found").when(already, "already_finished").otherwise("finished").alias("outcome"),
        F.when(found, 200).otherwise(404).alias("http_code"),
        F.when(found, "FINISHED").alias("status"),
        "powerbank_id",
        "total_amount",
        "debt",
        F.when(found, deposit_refund("deposit", "total_amount", "debt")).alias("deposit_refund"),
        F.when(before, F.col("finished_at")).when(found, F.col("_first.stopped_at")).alias("finished_at"),
    )


def rentals_after_stop(rentals: DataFrame, requests: DataFrame) -> DataFrame:
    """Next version of the rentals; the first stop of a rental sets its end."""
    first = requests.groupBy(F.col("order_id").alias("_k")).agg(F.min("stopped_at").alias("_at"))
    joined = rentals.join(first, rentals.id == F.col("_k"), "left")
    hit = F.col("_k").isNotNull() & (F.col("status") != "FINISHED")
    return joined.withColumns(
        {
            "finished_at": F.when(hit, F.col("_at")).otherwise(F.col("finished_at")),
            "status": F.when(hit, "FINISHED").otherwise(F.col("status")),
        }
    ).select(*rentals.columns)


def status_view(rentals: DataFrame, debts: DataFrame) -> DataFrame:
    """Status of every rental with its debt."""
    return _with_debt(rentals, debts).select(
        F.col("id").alias("order_id"), "status", "powerbank_id", "total_amount", "debt"
    )
