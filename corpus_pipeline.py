"""A corpus pipeline: toxicity, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.llm.jaccard_join import drop_near_copies
from voltmart.llm.packing import pack
from voltmart.llm.site_quality import keep_good
from voltmart.llm.substring_dedup import substring_dedup
from voltmart.llm.text import prepare, table
from voltmart.llm.toxicity import keep_clean
from voltmart.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return keep_clean(docs, table(prepare(spark), sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(prepare(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return drop_near_copies(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; the character count follows the text."""
    prepare(spark)
    # The other columns go along as one struct, so none can clash with what the operator adds.
    named = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c not in ("doc_id", "text")}
    rest = F.struct(F.lit(True).alias("carried"), *[col.alias(f"c{i}") for i, col in enumerate(named.values())])
    cut = substring_dedup(docs.select("doc_id", "text", rest.alias("rest")), carry=["rest"], with_text=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    columns |= {c: F.col(f"rest.c{i}") for i, c in enumerate(named)}
    columns |= {"n_chars": F.length("kept_text").cast("long")} if "n_chars" in named else {}
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of what is left."""
    prepare(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packing),
]

# Learned models and similarity joins have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
