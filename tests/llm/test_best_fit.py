"""Best-fit packing against item-by-item best fit and the tokenizer's own library."""

from __future__ import annotations

import bisect
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from voltmart.llm import best_fit  # noqa: E402
from voltmart.llm.queries import PACKED_FILE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
PATH, PATTERN = str(public_tokenizers.path(PACKED_FILE)), public_tokenizers.PATTERN
ODD = ["", None, " ", "a", "x" * 30_000, "1 000  2\t\t3", "<|endoftext|> 'S's<|endoftext|>", "ſ K\x1c İ 汉字 🎈", "the " * 1022, "the " * 1023, "the " * 1024, "the " * 5000]


def plain_best_fit(lengths, capacity):
    """Sequences that best fit with falling lengths opens, item by item."""
    gaps = []
    opened = 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        opened += k == len(gaps) and gap == capacity
        bisect.insort(gaps, gap - n)
    return opened


def valid(places, capacity):
    """(sequence, offset, length) places leave no gap and no overlap; number of sequences."""
    by_sequence = {}
    for sequence, offset, length in places:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 60), st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=20))
def test_plan_is_best_fit(capacity, histogram):
    histogram = {n: c for n, c in histogram.items() if n <= capacity}
    runs = best_fit.plan_sequences(histogram, capacity)
    places, ranks = [], {}
    for r in runs:
        assert r.first == ranks.get(r.length, 0)
        ranks[r.length] = r.first + r.count
        places += [(r.sequence + k // r.per, r.offset + k % r.per * r.length, r.length) for k in range(r.count)]
    assert ranks == {n: c for n, c in histogram.items() if c}
    lengths = [n for n, c in histogram.items() for _ in range(c)]
    assert valid(places, capacity) == plain_best_fit(lengths, capacity)


def test_plan_size_depends_on_the_capacity():
    small = best_fit.plan_sequences({n: 1 + n * 7919 % 50 for n in range(1, 1025)})
    large = best_fit.plan_sequences({n: 10**9 * (1 + n * 7919 % 50) for n in range(1, 1025)})
    assert len(large) < 5000 and len(small) < 5000
    with pytest.raises(ValueError):
        best_fit.plan_sequences({1025: 1})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(spark, library, docs):
    """All pieces of (doc_id, text) rows; returns the result's rows."""
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("length", "item", "task", "nth", "rank", "ids", "piece"):
        frame = frame.withColumn(name, F.lit("?"))
    got = best_fit.pack_documents(frame, PATH, PATTERN).collect()
    wanted = []
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        at = [0, *range(first, len(ids) + 1, 1024)]
        wanted += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, at[1:]))]
    order = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(wanted, key=order)
    used = valid([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert used == plain_best_fit([r.length for r in got], 1024)
    return got


def test_pieces_and_places(spark, library):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("text").collect()]
    check(spark, library, list(enumerate(ODD + texts)) + [(None, "a b"), (3, "a"), (3, "a")])


def test_one_length_with_all_rows(spark, library):
    got = check(spark, library, [(i, "the cat sat") for i in range(3000)])
    assert len({r.sequence_id for r in got}) == -(-3000 // (1024 // got[0].length))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = best_fit.pack_documents(docs, PATH, PATTERN)
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert best_fit.sequences(docs, PATH, PATTERN).count() == 0


def test_sequences_hold_the_documents(spark, library):
    docs = list(enumerate(ODD))
    rows = best_fit.sequences(spark.createDataFrame(docs, "doc_id long, text string"), PATH, PATTERN).collect()
    pieces = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.n_tokens <= 1024
        for s in r.spans:
            pieces[s.doc_id, s.start] = ids[s.offset : s.offset + s.length].tolist()
    for doc_id, text in docs:
        parts = [ids for (d, _), ids in sorted(pieces.items()) if d == doc_id]
        assert sum(parts, []) == [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_general_items(spark):
    items = spark.createDataFrame([(f"k{i}", 1 + i % 10, None) for i in range(500)], "name string, size int, extra string")
    got = best_fit.best_fit(items, 10, "size")
    assert got.columns == ["name", "size", "extra", "sequence_id", "offset"]
    assert valid([(r.sequence_id, r.offset, r["size"]) for r in got.collect()], 10) == 275


def test_query(spark):
    got = QUERIES["op12_best_fit"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.select("doc_id").distinct().count() == docs.count()
