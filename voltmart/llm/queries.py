"""Registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from voltmart.llm import merkle
from voltmart.llm.best_fit import pack_documents
from voltmart.llm.byte_bpe import token_digests
from voltmart.llm.jaccard_join import jaccard_join
from voltmart.llm.ngram_lm import language_model
from voltmart.llm.packing import pack
from voltmart.llm.quality_rules import quality_rules
from voltmart.llm.site_quality import site_quality
from voltmart.llm.substring_dedup import substring_dedup
from voltmart.llm.text import prepare, table
from voltmart.llm.token_counts import token_counts
from voltmart.llm.toxicity import toxicity
from voltmart.llm.vector_join import near_vectors
from voltmart.llm.whitening import whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PACKED_FILE = "byte_bpe_50k.json"
END_OF_DOCUMENT = 50_256  # the first id the vocabulary leaves free


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op5_quality_rules")
def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_byte_bpe")
def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path(BPE_FILE))
    return token_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op7_near_vectors")
def _near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_token_counts")
def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path(BPE_FILE))
    return token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, END_OF_DOCUMENT)


@query("op8_substring_dedup")
def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


@query("op9_jaccard_join")
def _jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


@query("op2_language_model")
def _language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(table(spark, sf_dir, "documents"))


@query("op3_site_quality")
def _site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_merkle_manifest", merkle.SQL)
def _merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"))


@query("op12_best_fit")
def _best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path(PACKED_FILE))
    return pack_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op13_whitening")
def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
