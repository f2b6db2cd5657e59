"""Merkle manifest against a plain tree built in Python, and against its SQL."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.helpers import sorted_rows
from voltmart.llm import merkle
from voltmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("g", "w", "slot", "leaf", "path", "total", "digest", "number", "at")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def climb(nodes):
    """All levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def way(levels, at):
    """(left, right) of every level up to the last node."""
    out = []
    for nodes in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return out


def plain_manifest(rows):
    groups = {}
    for r in rows:
        text = r["text"]
        bent = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        leaf = plain_leaf(r, text)
        order = (r["doc_id"] is not None, r["doc_id"] or 0, leaf)
        groups.setdefault(r["source"], []).append((order, r["doc_id"], leaf, plain_leaf(r, bent) if hit else leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf for _, _, leaf, _ in sorted(groups[s])]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for g, s in enumerate(names):
        for k, (_, doc_id, leaf, shown) in enumerate(sorted(groups[s])):
            path = way(trees[s], k) + way(top, g)
            node = shown
            for left, right in path:
                node = h(left + node + right)
            out.append((doc_id, leaf, trees[s][-1][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return out


def same(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("?"))
    got = [tuple(r) for r in merkle.merkle_manifest(docs).collect()]
    wanted = plain_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert sorted_rows(got) == sorted_rows(wanted)
    return got


def test_odd_rows(spark):
    rows = [(i * 37 % 4001 - 2000, f"Text {i} É", "en", "hot", i) for i in range(700)]  # negative ids, several levels
    rows += [(2**62 + i, "A", None, "far", None) for i in (0, 1, 64, 70_000, 5_000_000, 2**40)] + [(-(2**63), "LOW", "x", "far", 1), (2**63 - 1, "z", "x", "far", 1)]
    rows += [(5, "Same", "en", "again", 4)] * 20 + [(5, f"other {i}", "en", "again", 4) for i in range(20)]
    rows += [(None, f"n {i % 3}", None, None, None) for i in range(19)] + [(None, None, None, "hot", None)]
    rows += [(1, "", "", "", 0), (1, None, "de", "lone", 0), (3, "Ünïcode ß İ", "de", "zz", 1), (3, "x" * 200_000, "de", "zé", 1)]
    rows += [(i, "Word", "en", f"s{i}", 4) for i in range(40)]  # more than 16 groups
    got = same(spark, rows)
    assert len(got) == len(rows) and any(not r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_one_group(spark, n):
    same(spark, [(i, f"T{i}", "en", "only", 1) for i in range(n)])


def test_single_rows_and_empty(spark):
    same(spark, [(None, None, None, None, None)])
    same(spark, [(i, "a", "en", f"s{i}", 1) for i in range(3)])
    empty = merkle.merkle_manifest(spark.createDataFrame([], DOCS))
    assert empty.columns == merkle.merkle_manifest(spark.createDataFrame([(1, "a", "b", "c", 1)], DOCS)).columns
    assert empty.count() == 0


def test_directory_counts_over_all_levels(spark):
    ids = [-(2**63), -(2**40), -1, 0, 63, 64, 2**22, 2**22 + 1, 2**38, 2**54, 2**62]
    rows = spark.createDataFrame([(i, "g", "l") for i in ids], "doc_id long, g string, leaf string").withColumn("at", F.lit(0))
    got = {r.doc_id: r.slot for r in merkle.coordinates(rows).collect()}
    assert got == {v: k for k, v in enumerate(ids)}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES["op11_merkle_manifest"](spark, SF)
    result = con.execute(ORACLES["op11_merkle_manifest"])
    assert [d[0] for d in result.description] == df.columns
    assert sorted(tuple(r) for r in df.collect()) == sorted(result.fetchall())
