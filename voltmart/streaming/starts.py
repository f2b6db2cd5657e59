"""Start requests on a stream: the first success of a key answers all that follow (S3, H6, H8).

Keys that have started and quotes they have used are kept for good, with the response. A failed start
leaves its key free. Both tables are stored by hash bucket, and a micro-batch reads the buckets its own
requests fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.operators import rentals
from voltmart.plans import claims
from voltmart.session import cut_lineage
from voltmart.streaming.run import BatchTable, drain_batches, finished

BUCKETS = 1024
ANSWERS = "request_id string, idempotency_key string, outcome string, http_code int, response_order_id string, response_json string"


def bucket_of(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int").alias("bucket")


def touched(kept: BatchTable, batch_id: int, values: DataFrame) -> DataFrame:
    """Kept rows in the buckets of the given values; at most BUCKETS numbers reach the driver."""
    numbers = [r["bucket"] for r in values.select(bucket_of(values.columns[0])).distinct().collect()]
    return kept.before(batch_id).filter(F.col("bucket").isin(numbers)).drop("bucket", "batch")


def _by_bucket(df: DataFrame) -> DataFrame:
    # Sorted by bucket, so that a filter on buckets skips row groups.
    return df.repartitionByRange("bucket").sortWithinPartitions("bucket")


def answer_starts(
    requests: DataFrame, quotes: DataFrame, ejects: DataFrame, holds: DataFrame, target: str, fold_every: int = 50
) -> DataFrame:
    """Outcome and response of every request of the stream; ``quotes``, ``ejects`` and ``holds`` are tables.

    Inside a batch requests go in the order of their time, batches in the order they come: a request
    that comes late finds what an earlier batch has started, however long ago, and gets its response.
    """
    spark = requests.sparkSession

    def table(name: str, columns: str) -> BatchTable:
        return BatchTable(spark, f"{target}/{name}", spark.createDataFrame([], columns).schema, every=fold_every)

    keys = table("keys", "key string, response_json string, bucket int")
    used = table("used_quotes", "quote_id string, bucket int")
    answers = table("answers", ANSWERS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        for kept in (keys, used, answers):
            kept.begin(batch_id)
        stored, open_quotes = None, quotes
        if batch_id:
            stored = touched(keys, batch_id, batch.select("idempotency_key"))
            gone = touched(used, batch_id, batch.select("quote_id")).select(F.col("quote_id").alias("id"))
            open_quotes = quotes.join(gone, "id", "left_anti")
        decided = cut_lineage(claims.decide_starts(batch, open_quotes, ejects, stored))
        fresh = rentals.start_responses(decided, holds).select("key", "response_json", bucket_of("key"))
        keys.write(_by_bucket(fresh), batch_id)
        taken = decided.filter("outcome = 'started'").select("quote_id", bucket_of("quote_id"))
        used.write(_by_bucket(taken), batch_id)
        known = keys.of(batch_id).select(F.col("key").alias("idempotency_key"), "response_json")
        if stored is not None:
            known = known.unionByName(stored.select(F.col("key").alias("idempotency_key"), "response_json"))
        # Only these have a response; the others have no key or none that started.
        told = F.col("outcome").isin("started", "cached")
        columns = ["request_id", "idempotency_key", "outcome", "http_code", "response_order_id"]
        with_body = decided.filter(told).select(*columns).join(known, "idempotency_key", "left")
        without = decided.filter(~told).select(*columns).withColumn("response_json", F.lit(None).cast("string"))
        answers.write(with_body.unionByName(without), batch_id)

    drain_batches(requests, target, handle)
    return answers.before(finished(spark, target)).drop("batch")
