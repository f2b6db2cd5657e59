from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm import brute
from tests.llm.test_joins import expected_cut

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_a_missing_package_of_the_operators_costs_only_them(tmp_path):
    """Without the tokenizer files the other queries are still there."""
    code = (
        "import sys\nsys.modules['public_tokenizers'] = None\nimport __spark_entry__ as e\n"
        "assert len(e.queries()) == len(e.oracle_sql()) > 150 and not any(n.startswith('op') for n in e.queries())"
    )
    root = str(Path(contract.__file__).parent)
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "left out" in done.stderr


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"file://{tmp_path}/{name}")
        out = spark.read.parquet(f"file://{tmp_path}/{name}")
        after = {r.doc_id: r for r in out.collect()}
        assert len(after) == out.count() and after.keys() <= before.keys()
        if name != "packing":
            assert out.columns == docs.columns
        if name in ("toxicity", "quality", "near_duplicates"):
            assert all(after[i] == before[i] for i in after)
        if name == "quality":
            good = labels.where("quality = 1").select("doc_id").collect()
            kept = [r.doc_id in after for r in good if r.doc_id in before]
            assert sum(kept) >= 0.95 * len(kept)
        if name == "near_duplicates":
            sets = {i: brute.shingles(r.text) for i, r in before.items()}
            ids = sorted(sets)
            links = [
                (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
                if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
            ]
            root = brute.roots(ids, links)
            assert after.keys() == {i for i in ids if root[i] == i}
        if name == "passages":
            want = {w[0]: w[1] - w[2] for w in expected_cut([(i, r.text) for i, r in before.items()], 50)}
            assert {i: len(brute.words(r.text)) for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
        if name == "packing":
            assert after.keys() == before.keys()
        docs, before = out, after


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_rows_with_nulls(spark, name):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "plain words of a text", None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.columns == docs.columns
    assert out.count() <= 3 and (name == "quality" or out.count() == 3)
    assert out.select(F.max("doc_id")).count() == 1


CLASHING = ["n_words", "n_removed", "kept_sha256", "kept_text", "rest", "c0", "p", "th", "a.b", "t`k", "score", "predicted", "row", "kept"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_clashing_columns(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    more = docs.select("*", *[F.col("doc_id").cast("string").alias(c) for c in CLASHING])
    out = dict(corpus_pipeline.STAGES)[name](spark, more, SF)
    if name == "packing":
        assert out.columns == plain.columns and out.count() == plain.count()
        return
    assert out.columns == more.columns
    got = out.collect()
    assert all(str(r["doc_id"]) == r[c] for r in got for c in CLASHING)
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r["doc_id"], r["text"]) for r in plain.collect())
