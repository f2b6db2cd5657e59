from __future__ import annotations

import base64
import hashlib
import math
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from voltmart.llm import packing, quality_rules, token_counts
from voltmart.llm.byte_bpe import ByteBpe, coder, encode_documents, token_digests
from voltmart.llm.queries import BPE_FILE, END_OF_DOCUMENT

SF = "/root/testdata/sf0.001"
PATH, PATTERN = str(public_tokenizers.path(BPE_FILE)), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, n_words string, row_id string, bucket string"
ODD = ["", None, " ", "\n\n", "a", "a b c d e " * 30, "ſ K\x1c İ", "x" * 3000, "1 000  2\t\t3", "<|endoftext|> 'S's", "the " * 9]


def make(spark, texts, first=0):
    return spark.createDataFrame([(i, t, "?", "?", "?") for i, t in enumerate(texts, first)], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("text").collect()
    return ODD + [r.text for r in rows]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests_match_the_library(spark, texts, reference):
    got = {r.doc_id: r for r in token_digests(make(spark, texts), PATH, PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode_ordinary(text or "")
        want = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), want)
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_ids_and_round_trip(spark):
    rows = encode_documents(make(spark, ODD).union(make(spark, ["a"])), PATH, PATTERN).collect()
    assert len(rows) == len(ODD) + 1
    assert all(bytes(r.decoded).decode() == (ODD[r.doc_id] or "") for r in rows if r.doc_id)
    assert token_digests(make(spark, ODD).limit(0), PATH, PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_matches_the_library(text):
    bpe = coder(PATH, PATTERN)
    with_merges = [i for p in bpe.split(text) for i in ([bpe.ranks[p.encode()]] if p.encode() in bpe.ranks else bpe.merge(p.encode()))]
    ids = bpe.encode(text)
    assert list(np.frombuffer(ids, "<u4")) == with_merges
    assert bpe.decode(ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40), st.text("abc", min_size=1, max_size=40))
def test_any_vocabulary_encodes_as_merges_do(merges, text):
    """Random merge tables, where backtracking has to work."""
    ranks = {bytes([c]): k for k, c in enumerate(b"abc")}
    for a, b in merges:
        known = list(ranks)
        joined = known[a % len(known)] + known[b % len(known)]
        if len(joined) < 12:
            ranks.setdefault(joined, len(ranks))
    bpe = ByteBpe(ranks, r"\w+")
    piece = text.encode()
    want = [ranks[piece]] if piece in ranks else bpe.merge(piece)
    assert bpe.encode_piece(piece) == want


def test_token_counts_over_blocks(spark, texts, reference, tmp_path):
    docs = make(spark, texts).repartition(3)
    folder = f"file://{tmp_path}/shards"
    blocks = token_counts.write_token_shards(docs, folder, PATH, PATTERN, END_OF_DOCUMENT, block=97)
    got = token_counts.scan_token_blocks(blocks, END_OF_DOCUMENT)
    counts = {r.doc_id: r.n_tokens for r in got.collect()}
    assert counts == {i: len(reference.encode_ordinary(t or "")) for i, t in enumerate(texts)}


def test_token_counts_runs_and_open_end(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 3)
    r = random.Random(4)
    rows, want = [], []
    for shard in range(3):
        ids = [r.choice([9, 9, 1, 2, 3] if shard else [1, 2]) for _ in range(400)]
        for k in range(0, 400, 7):
            rows.append((shard, k // 7, np.array(ids[k : k + 7], "<u2").tobytes(), None))
        lengths, n = [], 0
        for i in ids:
            if i == 9:
                lengths.append((n, True))
                n = 0
            else:
                n += 1
        if n:
            lengths.append((n, False))
        want += [(shard, k, n, c) for k, (n, c) in enumerate(lengths)]
    rows.append((0, 60, None, None))
    df = spark.createDataFrame(rows, token_counts.BLOCKS)
    got = token_counts.scan_token_blocks(df, 9).select("shard", "ordinal", "n_tokens", "closed").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_counts.scan_token_blocks(df.limit(0), 9).count() == 0


def test_flat_files(spark, tmp_path):
    np.array([1, 2, 9, 9, 3], "<u2").tofile(tmp_path / "a.bin")
    np.array([4, 9], "<u2").tofile(tmp_path / "b.bin")
    blocks = token_counts.read_token_files(spark, f"file://{tmp_path}", block=2)
    got = token_counts.scan_token_blocks(blocks, 9).collect()
    assert sorted((r.ordinal, r.n_tokens, r.closed) for r in got) == [(0, 1, True), (0, 2, True), (1, 0, True), (2, 1, False)]


def base(text):
    w = brute.words(text)
    t = text or ""
    lines = [x for x in t.split("\n") if brute.words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    twice = {x for x in windows if counts[x] > 1}
    covered = {i + k for i, x in enumerate(windows) if x in twice for k in range(5)}
    n = len(w)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def grams(text):
    h = lambda x, seed=42: xxhash.xxh64_intdigest(x.encode(), seed)
    w = brute.words(text)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return [signed(v) % quality_rules.BUCKETS for k, x in enumerate(w) for v in (h(x), h(x, h(w[k - 1] if k else " ")))]


def test_quality_rules_match_brute_force(spark, texts):
    r = random.Random(8)
    texts = [*texts, " ".join(f"w{r.randrange(40)} w{k}" if k % 9 else "one two three four five six" for k in range(4000))]
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(0, len(texts), 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(make(spark, texts), labels).collect()}
    raw, target = {}, {}
    for i, t in enumerate(texts):
        for g in grams(t):
            raw[g] = raw.get(g, 0) + 1
            if i % 2 == 0 and i % 3:
                target[g] = target.get(g, 0) + 1
    assert max(len(brute.words(t)) for t in texts) > 3000
    all_raw, all_target, m = sum(raw.values()), sum(target.values()), quality_rules.BUCKETS
    for i, t in enumerate(texts):
        r, g = got[i], grams(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        score = sum(math.log((target.get(x, 0) + 1) / (all_target + m)) - math.log((raw[x] + 1) / (all_raw + m)) for x in g)
        assert r.score == pytest.approx(score / len(g) if g else 0.0, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


def test_quality_rules_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make(spark, ["a b c d e f g h i j k l", None]).union(make(spark, [None]))
    assert sorted(r.kept for r in quality_rules.quality_rules(docs, labels).collect()) == [False, False, True]
    assert quality_rules.quality_rules(docs.limit(0), labels).count() == 0


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=40), st.integers(1, 5))
def test_best_bounds_are_optimal(lengths, buckets):
    from itertools import combinations

    bins = [(b, lengths.count(b), b * lengths.count(b)) for b in sorted(set(lengths))]
    got = packing.best_bounds(bins, buckets)
    assert len(got) <= buckets and got[-1] == max(lengths)
    kinds = sorted(set(lengths))
    best = min(
        padding(lengths, [*some, kinds[-1]]) for k in range(min(buckets, len(kinds))) for some in combinations(kinds[:-1], k)
    )
    assert padding(lengths, got) == best


def test_packing(spark, texts, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 5)
    docs = make(spark, texts + ["same length"] * 300)
    rows = packing.pack(docs, buckets=4, budget=400).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts) + 300))
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(brute.words(t)) + 1 for i, t in enumerate(texts + ["same length"] * 300)}
    batches = {}
    for r in rows:
        assert r.padding == r.bucket_len - r.n_tokens >= 0
        batches.setdefault((r.bucket_len, r.batch), []).append(r.position)
    for bucket in {b for b, _ in batches}:
        per = max(1, 400 // bucket)
        sizes = [len(batches[bucket, k]) for k in range(len([1 for b, _ in batches if b == bucket]))]
        assert all(s == per for s in sizes[:-1]) and 1 <= sizes[-1] <= per
        assert all(sorted(p) == list(range(len(p))) for (b, _), p in batches.items() if b == bucket)
    lengths = [r.n_tokens for r in rows]
    bins = [(b, lengths.count(b), b * lengths.count(b)) for b in set(lengths)]
    assert {r.bucket_len for r in rows} == set(packing.best_bounds(bins, 4))
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_grid_is_fine(spark):
    n = [1, 8192, 8193, 8194, 100_000, 2**40 + 1]
    df = spark.createDataFrame([(x,) for x in n], "n long").select("n", packing._grid(F.col("n")).alias("g")).collect()
    assert all(r.n <= r.g <= r.n * 1.0003 for r in df)
    assert [r.g for r in df][:2] == [1, 8192]
