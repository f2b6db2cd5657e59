from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from voltmart.llm import jaccard_join as jj
from voltmart.llm import substring_dedup as sd
from voltmart.llm import vector_join as vj
from voltmart.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def copies(seed=1, groups=12, size=9):
    """Texts with near copies, exact copies, shared passages, and short, empty and null ones."""
    r = random.Random(seed)
    vocabulary = [f"w{k}é" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(70)]
    rows = []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([6, 60, 130]))]
        for _ in range(r.randint(1, size)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w[at:at] = passage
            rows.append(r.choice([" ", "\n", " \t"]).join(w))
    rows += ["", None, " \n", "a", "a", "a b c d", "a b c d e", "x " * 300, "x " * 300, "x " * 120]
    r.shuffle(rows)
    return list(enumerate(rows))


def check_join(df, rows):
    sets = {i: brute.shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    ]
    root = brute.roots(ids, links)
    got = {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}
    want = {i: (root[i], sum(i in x for x in links)) for i in ids}
    assert got == want


def test_jaccard_join_on_copies(spark):
    rows = copies()
    check_join(jj.jaccard_join(make(spark, rows)), rows)


def test_jaccard_join_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jj, "CHUNK", 4)
    rows = copies(seed=5, groups=6, size=25)
    check_join(jj.jaccard_join(make(spark, rows)), rows)


def test_jaccard_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_join(jj.jaccard_join(docs), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_jaccard_edges(spark):
    docs = make(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)])
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in jj.jaccard_join(docs).collect())
    assert got == [(0, 0, 0), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]
    assert jj.jaccard_join(docs.limit(0)).count() == 0
    kept = jj.drop_near_copies(docs.withColumn("first", F.lit(1)).withColumn("_gone", F.lit(2)))
    assert kept.columns == [*docs.columns, "first", "_gone"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


def test_bayesian_pruning_keeps_what_can_reach_the_threshold():
    need = jj.least_matches(0.8)
    # A pair at the threshold agrees in 0.8 n values; losing it must be very unlikely.
    from math import comb

    for n, m in need.items():
        below = sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m))
        assert below < 1e-6
        assert m > 0


def expected_cut(rows, target):
    first = {}
    for i, t in rows:
        w = brute.words(t)
        if i is None:
            continue
        for k in range(len(w) - target + 1):
            key = tuple(w[k : k + target])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = brute.words(t)
        gone = [False] * len(w)
        for k in range(len(w) - target + 1):
            if i is not None and first[tuple(w[k : k + target])] < i:
                gone[k : k + target] = [True] * target
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i if i is not None else -1, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("base", [None, 12, 6])
def test_substring_dedup_on_copies(spark, base):
    rows = copies(seed=3) + [(None, "q " * 60), (None, "q " * 60), (7, "q " * 55), (7, "r " * 55), (9, "r " * 70)]
    got = sd.substring_dedup(make(spark, rows), base=base, group_bytes=2000)
    assert sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in got.collect()) == expected_cut(rows, 50)


def test_substring_dedup_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sd.substring_dedup(docs)
    assert sorted(tuple(r) for r in got.collect()) == expected_cut(rows, 50)


def test_substring_dedup_hands_columns_through(spark):
    docs = make(spark, [(1, "a " * 60), (2, "b " + "a " * 60), (3, None)]).withColumn("p", F.lit("x"))
    got = {r.doc_id: r for r in sd.substring_dedup(docs, carry=["lang", "p"], with_text=True).collect()}
    assert got[1].kept_text == "a " * 60 and got[2].kept_text == "b" and got[3].kept_text == ""
    assert got[1].lang == "en" and got[3].p == "x"
    assert sd.substring_dedup(docs.limit(0)).count() == 0


def check_vectors(df, rows, threshold=0.95):
    unit = {}
    for i, v in rows:
        x = np.array([np.nan if c is None else c for c in v or []], float)
        if len(x) and np.isfinite(x).all() and (x != 0).any():
            x = x / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    ids = sorted(unit)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
    ]
    root = brute.roots([i for i, _ in rows], links)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}
    assert got == {i: (sum(i in x for x in links), root[i], root[i] == i) for i, _ in rows}


@pytest.mark.parametrize("block, cell", [(4096, 4096), (16, 4096), (4096, 16), (24, 32)])
def test_vectors(spark, block, cell):
    r = np.random.RandomState(2)
    centres = r.normal(size=(20, 8))
    rows = []
    for k in range(220):
        c = centres[k % 20 if k < 150 else 0]
        rows.append((k, [float(x) for x in (c + r.normal(size=8) * r.choice([0.0, 0.1, 0.3])) * r.choice([1.0, 3.0])]))
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] * 8)]
    rows += [(905, [float("inf")] * 8), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    check_vectors(vj.near_vectors(df, block=block, cell=cell), rows)


def test_vector_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vj.near_vectors(df).collect())
    assert got == [(0, 0, None, True), (1, 0, 1, True)]
    assert vj.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_magnitude(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e-200, 0.0]), (3, [3.0, 1e-3]), (4, [0.0, 5e-324]), (5, [1e-310, 1e308]), (6, [-1e200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_vectors(vj.near_vectors(df), rows)
    narrow = [(1, [1e-40, 0.0]), (2, [2.0, 0.0]), (3, [3e38, 3e38])]
    check_vectors(vj.near_vectors(spark.createDataFrame(narrow, "vec_id long, embedding array<float>")), narrow)


@pytest.mark.parametrize("threshold, cell", [(-0.2, 16), (0.3, 16), (0.999, 8)])
def test_vectors_at_other_thresholds(spark, threshold, cell):
    """Bounds by angle hold for wide and narrow ones; a third of all vectors is one tight group."""
    r = np.random.RandomState(5)
    rows = [(k, [float(x) for x in (r.normal(size=6) if k % 3 else 1 + 0.01 * r.normal(size=6))]) for k in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_vectors(vj.near_vectors(df, threshold, block=32, cell=cell), rows, threshold)


def test_vectors_hold_few_links_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(vj, "HELD", 50)
    monkeypatch.setattr(vj, "PRODUCTS", 400)
    r = np.random.RandomState(6)
    base = r.normal(size=(3, 5))
    x = [base[k % 3] + 0.02 * r.normal(size=5) for k in range(90)]
    part = np.where(np.arange(90) < 60, vj.HOME | vj.OTHER, vj.VISITOR)
    table = pa.table({"vec_id": np.arange(90), "times": np.ones(90, np.int64), "part": part, "v": [v.tobytes() for v in x]})
    out = vj._compare(0.95, "<f8")(table).to_pylist()
    unit = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    near[60:, 60:] = False  # visitors are not compared with each other
    np.fill_diagonal(near, False)
    assert {o["vec_id"]: o["links"] for o in out if o["root"] is None} == dict(enumerate(near.sum(1)))
    assert {o["vec_id"]: o["root"] for o in out if o["root"] is not None} == {k: k % 3 for k in range(3, 90)}


def test_different_vectors_under_one_id(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vj.near_vectors(df).collect())
    assert got == [(1, 0, 1, True), (1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components_of_chains_and_stars(spark, one_task):
    links = [(k, k + 1) for k in range(1, 120)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (3, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b", one_task).collect()}
    assert got == {**{k: 1 for k in range(1, 121)}, **{k: 500 for k in range(500, 560)}}
