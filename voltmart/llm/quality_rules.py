"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio. DataFrame functions only.

Every word gives two n-grams, itself and the pair with the word before it. They are hashed into a
fixed number of buckets, and two multinomials are counted over the buckets: one of trusted target
texts, one of the whole raw corpus. A text's score is the mean log ratio of the two over its
n-grams; the verdict compares it with a fixed threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmart.llm.text import whole, words
from voltmart.session import cut_lineage

BUCKETS = 1 << 16  # rows of the model and length of its array (half a megabyte)
# Bits of the filter that keeps texts without a trusted id from being exchanged (2 MB).
FILTER_BITS = 1 << 24
SMOOTHING = 1.0
THRESHOLD = -0.2  # nats per n-gram
WINDOW = 5


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hashes(w: Column) -> Column:
    """One hash for every window of words, of the hashes of its words."""

    def of(h: Column) -> Column:
        last = F.size(h) - WINDOW
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), of)


def _covered(hashes: Column) -> Column:
    """Words under a window whose hash is found twice or more."""

    def count(ordered: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(ordered) - 1)

        def start(k: Column) -> Column:
            own = F.get(ordered, k)["h"]
            twin = (F.get(ordered, k - 1)["h"] == own) | (F.get(ordered, k + 1)["h"] == own)
            return F.when(twin, F.get(ordered, k)["i"])

        starts = F.array_sort(F.filter(F.transform(at, start), lambda x: x.isNotNull()))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            starts,
            zero,
            lambda acc, x: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"), x.alias("last")
            ),
            lambda acc: acc["n"],
        )

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        _let(F.array_sort(pairs), count)
    )


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed, and the word array."""
    df = docs.select(
        F.col(id_col).alias("doc_id"),
        whole(F.col(text_col)).alias("text"),
    ).select("*", words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(F.col("words"), lambda w: _let(_window_hashes(w), _covered)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _bucket(*words_: Column) -> Column:
    """Bucket of a word, or of a word and the one before it."""
    return F.pmod(F.xxhash64(*words_), F.lit(BUCKETS)).cast("int")


def _in_order(parts: DataFrame, place: str, value: str, size: int, nothing) -> Column:
    """The values of (place, value) rows as one array of ``size`` entries, a scalar subquery.

    At most ``size`` rows meet in one task, whatever the input holds.
    """
    here = parts.select(F.col(place).cast("int").alias(place), value)
    empty = F.lit(nothing).cast(here.schema[value].dataType)
    every = parts.sparkSession.range(size).select(F.col("id").cast("int").alias(place))
    dense = every.join(here, place, "left").select(place, F.coalesce(value, empty).alias(value))
    ordered = F.array_sort(F.collect_list(F.struct(place, value)))
    return dense.agg(F.transform(ordered, lambda p: p[value]).alias("values")).scalar()


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): n-grams of all rows of ``words`` by bucket, combined in the task that reads them."""
    before = F.concat(F.array(F.lit(" ")), F.col("words"))
    # Words beside those before them; the longer array's last entry has no word.
    pairs = texts.select(F.inline(F.arrays_zip(F.col("words").alias("x"), before.alias("y")))).toDF("x", "y").where("x IS NOT NULL")
    grams = pairs.select(_bucket(F.col("x")).alias("a"), _bucket(F.col("y"), F.col("x")).alias("b"))
    return grams.select(F.explode(F.array("a", "b")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``words`` of all texts of an id labelled quality 1.

    A filter of FILTER_BITS hashed bits drops nearly all other texts where they are read; it lets some
    pass when there are millions of trusted ids, never drops one, and the join by id decides. The join
    exchanges what has passed at every size, so the plan does not depend on the number of ids.
    """
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    trusted = cut_lineage(trusted)

    def at(id_: Column) -> tuple[Column, Column]:
        bit = F.pmod(F.xxhash64(id_), F.lit(FILTER_BITS))
        return F.shiftright(bit, 6).cast("int"), F.pmod(bit, F.lit(64)).cast("int")

    word, bit = at(F.col("trusted_id"))
    words_set = trusted.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("one"))
    words_set = words_set.groupBy("word").agg(F.bit_or("one").alias("bits"))
    filled = _in_order(words_set, "word", "bits", FILTER_BITS // 64, 0)
    word, bit = at(F.col("doc_id"))
    held = F.get(F.col("filter"), word)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    may = texts.withColumn("filter", filled).where(F.call_function("shiftright", held, bit).bitwiseAND(F.lit(1).cast("long")) == 1).drop("filter")
    known = may.join(trusted.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    return known.select(words(F.col("text")).alias("words"))


def ratio_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(bucket, ratio): log of target probability over raw probability, one row per bucket seen.

    The raw counts cover every text, the target every text of an id labelled quality 1; without
    any, all ratios are 0. Raw texts are counted where they are read, without a join.
    """
    raw = bucket_counts(docs.select(words(F.col(text_col)).alias("words"))).select("bucket", F.col("n").alias("raw"), F.lit(0).cast("long").alias("target"))
    target = bucket_counts(trusted_texts(docs, labels, id_col, text_col)).select("bucket", F.lit(0).cast("long").alias("raw"), F.col("n").alias("target"))
    counts = cut_lineage(raw.unionByName(target).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    all_raw, all_target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not all_target:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    spread = smoothing * BUCKETS
    ratio = F.log((F.col("target") + smoothing) / (all_target + spread)) - F.log(
        (F.col("raw") + smoothing) / (all_raw + spread)
    )
    return counts.select("bucket", ratio.alias("ratio"))


def mean_ratio(ratios: Column, w: Column) -> Column:
    """Mean of the ratios of a text's n-grams; 0 without words."""

    def both(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(w, i - 1), F.lit(" "))
        return F.get(ratios, _bucket(x)) + F.get(ratios, _bucket(before, x))

    total = F.aggregate(F.transform(w, both), F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(w) > 0, total / (2 * F.size(w))).otherwise(F.lit(0.0))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, base counts, base_failed, score, kept; one row per input row.

    A null or blank text has no words, fails the base rules and has score 0. Rows with null or
    repeated ids are judged one by one. Other columns of the input, whatever their names, are not
    read. An empty table gives an empty result. Ties with the threshold are kept.

    The model is one array of BUCKETS ratios, and a row's words are looked up in it inside the
    row: scoring exchanges nothing.
    """
    model = ratio_model(docs, labels, id_col, text_col)
    base = base_counts(docs, id_col, text_col).withColumn("ratios", _in_order(model, "bucket", "ratio", BUCKETS, None))
    scored = base.withColumn("score", mean_ratio(F.col("ratios"), F.col("words")))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "score", kept.alias("kept"),
    )
