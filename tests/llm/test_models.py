from __future__ import annotations

import math
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from voltmart.llm import ngram_lm, quality_rules, site_quality, toxicity
from voltmart.llm.elias_fano import EliasFano

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=200), st.lists(st.integers(0, 2**40), max_size=30))
def test_elias_fano(values, others):
    values = sorted(values)
    e = EliasFano.load(*EliasFano.build(np.array(values, np.uint64)))
    assert e.get(np.arange(len(values))).tolist() == values
    asked = values + others
    want = [values.index(x) if x in values else -1 for x in asked]
    assert e.find(np.array(asked, np.uint64)).tolist() == want
    if values:
        lo = np.full(len(asked), len(values) // 2)
        inside = values[len(values) // 2 :]
        want = [inside.index(x) + len(values) // 2 if x in inside else -1 for x in asked]
        assert e.find(np.array(asked, np.uint64), lo, np.full(len(asked), len(values))).tolist() == want
        here, after = e.spans(np.arange(len(values) - 1))
        assert (here.tolist(), after.tolist()) == (values[:-1], values[1:])


def lower(text):
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in brute.words(text)] + [""]


def plain_model(rows, order, head_min, keep):
    """The smoothed model without trie or quantisation."""
    training = [lower(t) for i, t in rows if brute.fold(i, 7) != 2]
    c = Counter(w for x in training for w in x)
    n, v = sum(c.values()), len(c)
    head = {w for w in c if c[w] >= head_min or w == ""}
    other = sum(c[w] for w in c if w not in head) + sum(w not in head for w in c) + 1
    name = lambda w: w if w in head else None
    seqs = [["<s>", *map(name, x)] for x in training]
    c1 = Counter(w for s in seqs for w in s)
    c2 = Counter(p for s in seqs for p in zip(s, s[1:]))
    k2 = {p: k for p, k in c2.items() if k >= keep}
    c3 = Counter(p for s in seqs for p in zip(s, s[1:], s[2:]) if p[:2] in k2)
    k3 = {p: k for p, k in c3.items() if k >= keep}
    left2, left3 = Counter(), Counter()
    for p, k in k2.items():
        left2[p[0]] += (k - 0.75) / c1[p[0]]
    for p, k in k3.items():
        left3[p[:2]] += (k - 0.75) / k2[p[:2]]

    def p1(w):
        return (c[w] + 1 if w is not None else other) / (n + v + 1)

    def p2(a, w):
        if not c1[a]:
            return p1(w)
        return max(k2.get((a, w), 0) - 0.75, 0) / c1[a] + max(1 - left2[a], 1e-12) * p1(w)

    def p3(a, b, w):
        if order < 3 or (a, b) not in k2:
            return p2(b, w)
        return max(k3.get((a, b, w), 0) - 0.75, 0) / k2[a, b] + max(1 - left3[a, b], 1e-12) * p2(b, w)

    out = {}
    for i, t in rows:
        x = lower(t)
        s = ["<s>", *map(name, x)]
        score = 0.0
        for k, w in enumerate(x, 1):
            p = p3(s[k - 2], s[k - 1], s[k]) if k > 1 else p2(s[0], s[1])
            score += math.log10(p * ((c[w] + 1) / other if s[k] is None else 1))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)
        out.setdefault(i, []).append((len(x), sum(c[w] > 0 for w in x), n, base, score))
    return out


def odd_rows():
    texts = ["the cat sat on the mat", "The CAT sat on a mat", "É the\tcat", None, "", "the cat sat on the mat again and again", "x y z x y z x y"]
    rows = [(i, texts[i % len(texts)]) for i in range(60)]
    return rows + [(3, "the cat sat on the mat"), (None, "the cat"), (1000, "unseen words only")]


@pytest.mark.parametrize("order,ask", [(3, 10**6), (2, 10**6), (3, 20), (3, 1)])
def test_language_model(spark, monkeypatch, order, ask):
    """``ask``: texts whose tokens are looked up together, all of a task or a few."""
    monkeypatch.setattr(ngram_lm, "ASK", ask)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("w", F.lit(1))
    want = plain_model(rows, order, 1, 1)
    got = {}
    for r in ngram_lm.language_model(docs, order=order).collect():
        assert r.held_out == (brute.fold(r.doc_id, 7) == 2)
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert got.keys() == want.keys()
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i])):
            assert a[:3] == b[:3]
            assert a[3] == pytest.approx(b[3], abs=1e-9)
            # Quantised downwards, by little on few different values.
            assert b[4] - 0.02 * a[0] - 1e-6 <= a[4] <= b[4] + 1e-6
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("order,shard_words", [(3, 3), (2, 10**6)])
def test_language_model_keeps_everything_in_shards(spark, monkeypatch, order, shard_words):
    monkeypatch.setattr(ngram_lm, "SHARD_WORDS", shard_words)
    built = []
    build = ngram_lm.build
    monkeypatch.setattr(ngram_lm, "build", lambda *a: built.append(build(*a)) or built[-1])
    rows = odd_rows() + [(2000 + i, f"the cat once saw thing{i} near place{i % 7}") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    want = plain_model(rows, order, 1, 1)
    got = {}
    for r in ngram_lm.language_model(docs, order=order).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert got.keys() == want.keys()
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i])):
            assert a[:3] == b[:3]
            assert a[3] == pytest.approx(b[3], abs=1e-9)
            assert b[4] - 0.02 * a[0] - 1e-6 <= a[4] <= b[4] + 1e-6
    # All n-grams of the training text, in several shards.
    training = [["<s>", *lower(t)] for i, t in rows if brute.fold(i, 7) != 2]
    for k, level in enumerate(built[0]["levels"], 2):
        assert sum(level["sizes"]) == len({g for x in training for g in zip(*(x[j:] for j in range(k)))}) and len(level["sizes"]) > 3
    assert (len(built[0]["word_sizes"]) > 3) == (shard_words == 3)


def test_language_model_reads_texts_four_times(spark):
    """Words, bounds (a sample, here all), one count for both levels, scores."""
    met = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).mapInArrow(run, DOCS)
    assert len(ngram_lm.language_model(docs).collect()) == len(rows)
    assert met.value == 4 * len(rows)


@pytest.mark.parametrize("flush", [1, 10**6])
def test_language_model_pairs_over_several_shards(spark, monkeypatch, flush):
    """A pair with more continuations than a shard has triples, and one that only ends texts."""
    monkeypatch.setattr(ngram_lm, "FLUSH", flush)
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 20)
    merged = []
    merge = ngram_lm._merged
    monkeypatch.setattr(ngram_lm, "_merged", lambda *a: merged.append(merge(*a)) or merged[-1])
    rows = odd_rows() + [(2000 + i, f"of the thing{i} of the thing{i // 2} of the") for i in range(150)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    want = {(i, t): x for i, group in plain_model(rows, 3, 1, 1).items() for t, x in zip([t for j, t in rows if j == i], group)}
    got = {}
    for r in ngram_lm.language_model(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.train_tokens, r.score))
    assert sum(r["shared"] for r in merged[0]) > 3
    for i in {i for i, _ in want}:
        exact = sorted((*x[:3], x[4]) for (j, _), x in want.items() if j == i)
        for a, b in zip(sorted(got[i]), exact, strict=True):
            assert a[:3] == b[:3]
            assert b[3] - 0.02 * a[0] - 1e-6 <= a[3] <= b[3] + 1e-6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aBZ \t\n\x0b\x0c\r\x1c\x85\xa0éİ", max_size=12) | st.none(), max_size=8))
def test_language_model_words(texts):
    words, sizes = ngram_lm._words_of(pa.array(texts, pa.string()))
    want = [lower(t)[:-1] for t in texts]
    assert words.to_pylist() == [w for x in want for w in x]
    assert sizes.tolist() == [len(x) for x in want]


@pytest.mark.parametrize("vocabulary", [4, 3_000_000])
def test_language_model_triples(vocabulary):
    """Also where three words of one count have more bits than a number."""
    rng = np.random.default_rng(5)
    trie = SimpleNamespace(begin=2 * vocabulary + 1, width=2 * vocabulary + 2)
    alphabet = np.arange(vocabulary) * 2
    local = rng.choice(np.array([0, 1, vocabulary - 2, vocabulary - 1]), 500)
    first = rng.random(500) < 0.2
    first[0] = True
    pair, third, counts = ngram_lm._triples(trie, alphabet, local, first, 3)
    want = Counter()
    for k, x in enumerate(local.tolist()):
        before = trie.begin if first[k] else 2 * int(local[k - 1])
        want[before * trie.width + 2 * x, 0 if k == 499 or first[k + 1] else 2 * int(local[k + 1]) + 1] += 1
    assert list(zip(pair.tolist(), third.tolist(), counts.tolist())) == [(*k, want[k]) for k in sorted(want)]
    order, new = ngram_lm._in_order(np.array([5, 2**61, 5, 5]), np.array([9, 7, 8, 9]))
    assert order.tolist() == [2, 0, 3, 1] and new.tolist() == [0, 1, 3]
    values = rng.integers(0, 2**62, 50)
    assert ngram_lm._numbers(ngram_lm._planes(values), 50).tolist() == values.tolist()


def test_language_model_beats_unigrams(spark):
    got = ngram_lm.language_model(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out")
    base, score = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.97 * base


def test_language_model_edges(spark):
    docs = spark.createDataFrame([(None, None, "", "", 0)], DOCS)
    only_held = spark.createDataFrame([(i, "a b", "", "", 0) for i in range(200) if brute.fold(i, 7) == 2], DOCS)
    for r in ngram_lm.language_model(only_held).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    assert ngram_lm.language_model(docs).count() == 1
    assert ngram_lm.language_model(docs.limit(0)).count() == 0


def distance(a, b):
    """Edits with swaps of neighbours."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=10), min_size=1, max_size=8, unique=True), st.text("abc", min_size=3, max_size=11))
def test_automaton_finds_all_near_terms(terms, word):
    found = toxicity.Lexicon([(t, False) for t in terms]).find(word)
    near = [(distance(t, word), k) for k, t in enumerate(terms) if distance(t, word) <= toxicity.allowed(t)]
    assert found == ((min(near)[1], min(near)[0]) if near else None)


@pytest.mark.parametrize(
    "text, inside",
    [
        ('he said "a b c" d', ["a b c"]),
        ("she said 'don't be it' ok", ["don't be it"]),
        ("it's the dogs' bone, isn't it", []),
        ('an "open mark\nand "one line" more', ["one line"]),
        ("„wort hier“ und «mot ici» et »so« “en” “a ‘b’ c”", ["wort hier", "mot ici", "so", "en", "a ‘b’ c"]),
        ('""', [""]),
        ('5" and 6" wide', []),
        ("", []),
    ],
)
def test_quotations(text, inside):
    assert [text[a + 1 : b] for a, b in toxicity.quotations(text)] == inside


@pytest.mark.parametrize("n", range(1, 13))
def test_quoted_sentences_of_any_length(n):
    lexicon = toxicity.Lexicon([("idiot", False)])
    for k in range(n):
        told = " ".join(["idiot" if i == k else "filler" for i in range(n)])
        for text in (f'he said "{told}" to them', f'"{told}" he wrote', f"she called him '{told}' once"):
            direct, _, quoted, kinds, _ = toxicity.features(text, lexicon, {})[0]
            assert direct == 0 and quoted > 0 and kinds == 0
        for text in (told, f'"{told}" to them', f'he said "{told}'):
            x = toxicity.features(text, lexicon, {})[0]
            assert x[0] > 0 and x[2] == 0


def test_lexicon_stems_and_quotes():
    lexicon = toxicity.Lexicon([("idiot", False), ("vequ", True)])
    assert lexicon.find("vequtant") == (1, 0) and lexicon.find("idoit") == (0, 1) and lexicon.find("idea") is None
    direct, _ = toxicity.features("you idiot go", lexicon, {})
    quoted, _ = toxicity.features('he said "idiot" to them', lexicon, {})
    assert direct[0] > 0 and quoted[0] == 0 and quoted[2] > 0
    assert not toxicity.features("", lexicon, {})[0].any()
    shouted, odd = toxicity.features("IDIOT!! *idiot* id!ot", lexicon, {})
    assert shouted[0] == pytest.approx(np.log1p(2)) and odd == {"id!ot"}


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.union(docs.where("doc_id = 1")).union(spark.createDataFrame([(None, None, "", "", 0), (5000, "", "", "", 0)], DOCS))
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (2, 1, None)], LABELS))
    got = toxicity.toxicity(docs.withColumn("score", F.lit("x")).withColumn("term", F.lit("x")), labels)
    assert got.count() == docs.count()
    assert got.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> (CASE WHEN score >= 0.5 THEN 1 ELSE 0 END)").count() == 0
    rated = got.where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.avg("toxic")
    ).first()
    assert rated[0] > 0.9 and rated[0] > 1 - rated[1]
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 0").count()


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "", "", 0)], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert [(r.score, r.predicted) for r in toxicity.toxicity(docs, labels).collect()] == [(0.0, 0)]
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.keep_clean(docs, labels).count() == 1


def test_site_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.union(spark.createDataFrame([(None, None, None, None, None), (0, "", None, "", 0), (1, "a b", "en", None, 3)], DOCS))
    got = site_quality.site_quality(docs.withColumn("host", F.lit(1)).withColumn("p", F.lit(1)), labels)
    assert got.count() == docs.count() and got.where("score IS NULL OR kept IS NULL").count() == 0
    rated = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert rated > 0.93
    kept = site_quality.keep_good(docs.withColumn("host", F.lit(1)).withColumn("p", F.lit(1)), labels)
    assert kept.columns == [*docs.columns, "host", "p"] and kept.count() == got.where("kept").count()


def test_site_posteriors_match_the_formula(spark):
    rows = [("a", "x", 0.9), ("a", "x", 0.8), ("a", "y", 0.2), ("b", "x", 0.5)] + [("c", "z", 0.99)] * 50
    sites = site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    table = {(r.host, r.path): r for r in sites.table.collect()}
    rate = sum(p for _, _, p in rows) / len(rows)
    assert sites.rate == pytest.approx(rate)
    a = table["a", "x"]
    assert min(1.9 / 3, rate) < a.host_rate < max(1.9 / 3, rate)
    want = (1.7 + sites.path_strength * a.host_rate) / (2 + sites.path_strength)
    assert a.path_rate == pytest.approx(want)
    # Few documents stay near the prior, many leave it.
    assert abs(table["c", "z"].host_rate - 0.99) < abs(table["b", "x"].host_rate - 0.5)


def test_site_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert [(r.evidence, r.kept) for r in site_quality.site_quality(docs, labels).collect()] == [(0.5, True)]
    assert site_quality.site_quality(docs.limit(0), labels).count() == 0


def test_quality_target_counts_every_trusted_text(spark):
    docs = spark.range(21_000).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    labels = spark.range(21_000).selectExpr("id AS doc_id", "1 AS quality")
    # Target and raw counts are the same if no trusted text is left out.
    assert {r.ratio for r in quality_rules.ratio_model(docs, labels).collect()} == {0.0}


def letters(k):
    return "".join("abcdefghij"[int(c)] for c in f"{k:05d}")


def test_toxic_terms_beside_a_copied_text(spark):
    copied = " ".join(f"rare{letters(k)}" for k in range(5000))
    texts = [(copied, 1)] * 40 + [(f"you vilest {letters(k)}", 1) for k in range(12)] + [(f"fine day {letters(k)}", 0) for k in range(40)]
    ids = [i for i in range(1000) if brute.fold(i, 5) != 0]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, texts)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.Lexicon(model.terms).find("vilest")
    assert found and found[1] == 0
    assert not any(t.startswith("rare") for t, _ in model.terms)


def test_all_toxic_terms_enter_the_lexicon():
    rows = [(letters(k), False, 3, 0) for k in range(260)]
    holders = {letters(k): {3 * k, 3 * k + 1, 3 * k + 2} for k in range(260)}
    assert sorted(toxicity.choose_terms(rows, holders, 780)) == [(letters(k), False) for k in range(260)]


def test_misspellings_of_words_that_a_stem_covers(spark):
    forms = ["idiot", "idiot", "idiot", "idiotic", "idiotic", "idiotic", "idiots", "idiots", "idiots"]
    texts = [(f"you {w} {letters(k)}", 1) for k, w in enumerate(forms)] + [(f"you fine {letters(k)}", 0) for k in range(40)]
    ids = [i for i in range(1000) if brute.fold(i, 5) != 0]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, texts)], "doc_id long, toxic int")
    terms = toxicity.fit(docs, labels).terms
    lexicon = toxicity.Lexicon(terms)
    assert any(stem for _, stem in terms)
    for word, near in (("idiot", "idoit"), ("idiotic", "idoitic")):
        found = lexicon.find(near)
        assert found and found[1] == 1 and terms[found[0]][0].startswith("idiot")
        # Beside its stem, a whole word is no kind of its own.
        assert lexicon.kinds[lexicon.find(word)[0]] == lexicon.kinds[found[0]]
