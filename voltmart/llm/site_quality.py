"""Quality classifier with site priors: hierarchical empirical Bayes.

A logistic classifier on surface features gives each document a probability of good quality. The
probabilities of all documents are summed per path and per host. Host rates are shrunk towards the
global rate, path rates towards their host's, with strengths estimated from the spread of the
rates; sparse sites therefore stay near the prior above them. The score adds the classifier's
log odds and what the site says beyond the global rate, the document itself left out.

Documents carry no address: by default the source stands for the host and the language for the
path below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.llm.text import fold, labelled_sample
from voltmart.llm.toxicity import logistic
from voltmart.session import cut_lineage

SAMPLE = 20_000  # labelled rows the classifier is fitted on, at most
FEW_SITES = 100_000  # sites that are broadcast: some 10 MB of names and numbers
SYMBOLS = b"#*$%&|<>"
FEATURES = 10


def features(text: str | None) -> list[float]:
    """Surface features of a whole text; all defined for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))

    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / size

    lines = [x for x in raw.split(b"\n") if x.strip()]
    twins = sum(a == b for a, b in zip(words, words[1:]))
    return [
        np.log1p(len(words)),
        min(len(raw) / n, 50.0),
        share(SYMBOLS),
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        share(b"0123456789"),
        share(b"!?"),
        len(set(words)) / n,
        twins / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(not words),
    ]


@dataclass
class Classifier:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.spread
        z = np.clip(np.hstack([z, z * z]), -10, 10)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -12, 12)))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", folds: int = 5, held: int = 0) -> Classifier | None:
    """Fit on at most SAMPLE labelled rows outside the held-out fold; None without both classes.

    FEATURES numbers per sampled row reach the driver.
    """
    ids = labelled_sample(labels.where(fold(F.col(id_col), folds) != held), "quality", SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(ids), "doc_id").select("label", "text").mapInArrow(run, "label int, x array<double>").collect()
    )
    y = np.array([r["label"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in rows])
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / spread
    return Classifier(mean, spread, logistic(np.clip(np.hstack([z, z * z]), -10, 10), y))


def with_evidence(docs: DataFrame, model: Classifier | None, text_col: str, name: str) -> DataFrame:
    """The input with one more column, the classifier's probability (0.5 without a model)."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(at)]).reshape(-1, FEATURES)
            p = model.probability(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _key(c: Column) -> Column:
    """Group key; null and empty are one group."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _strength(mean: float, spread: float) -> float:
    """Prior weight in documents for which rates around ``mean`` spread this much."""
    return float(np.clip(mean * (1 - mean) / max(spread, 1e-9) - 1, 1.0, 1e4))


@dataclass
class Sites:
    """Sums per (host, path) with their priors; strengths and the global rate are numbers."""

    table: DataFrame
    rate: float
    path_strength: float

    def score(self, p: Column) -> Column:
        """Log odds of the classifier, plus those of the site without the document, less the global ones."""
        rest = (F.col("path_sum") - p + self.path_strength * F.col("host_rate")) / (F.col("path_n") - 1 + self.path_strength)
        rest = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rest))
        odds = F.log(p / (1 - p)) + F.log(rest / (1 - rest)) - float(np.log(self.rate / (1 - self.rate)))
        return 1 / (1 + F.exp(-odds))


def site_posteriors(evidence: DataFrame) -> Sites:
    """Posteriors from (host, path, p) rows: sums combine before the shuffle, so a host may hold most rows."""
    paths = cut_lineage(
        evidence.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum("p").alias("path_sum"))
    )
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_sum")).first()
    n = total[0] or 0
    rate = float(np.clip((total[1] or 0) / n if n else 0.5, 1e-3, 1 - 1e-3))

    def spread(table: DataFrame, count: str, mean: Column, rate_: Column) -> float:
        """Variance of the rates beyond what their sizes explain."""
        row = table.agg(
            F.sum(F.col(count) * (mean - rate_) ** 2), F.sum(count), F.count("*"), F.sum(F.col(count) ** 2)
        ).first()
        if not row[1] or row[2] < 2:
            return 0.0
        scale = row[1] - row[3] / row[1]
        return max(0.0, (row[0] - (row[2] - 1) * rate * (1 - rate)) / scale) if scale > 0 else 0.0

    host_mean = F.col("host_sum") / F.col("host_n")
    host_strength = _strength(rate, spread(hosts, "host_n", host_mean, F.lit(rate)))
    hosts = hosts.withColumn(
        "host_rate", (F.col("host_sum") + host_strength * rate) / (F.col("host_n") + host_strength)
    )
    paths = paths.join(hosts, "host")
    path_strength = _strength(rate, spread(paths, "path_n", F.col("path_sum") / F.col("path_n"), F.col("host_rate")))
    paths = paths.withColumn(
        "path_rate",
        (F.col("path_sum") + path_strength * F.col("host_rate")) / (F.col("path_n") + path_strength),
    )
    return Sites(cut_lineage(paths.select("host", "path", "path_n", "path_sum", "host_rate", "path_rate")), rate, path_strength)


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    folds: int = 5,
    held: int = 0,
) -> DataFrame:
    """doc_id, held_out, evidence, host_rate, path_rate, score, kept (score >= 0.5); one row per input row.

    Null hosts or paths form a group of their own with empty ones. Null and empty texts have the
    features of no words. Null and repeated ids are scored row by row. Without labels of both
    classes the evidence is 0.5 and everything is kept. An empty table gives an empty result;
    other columns are not read.

    Texts are not shuffled. Evidence meets its site by a join that the planner broadcasts while
    the sites are few, and splits on a hot site otherwise.
    """
    model = fit(docs, labels, id_col, text_col, folds, held)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _key(F.col(host_col)).alias("host"), _key(F.col(path_col)).alias("path"),
        F.col(text_col).cast("string").alias("text"),
    )
    evidence = cut_lineage(with_evidence(narrow, model, "text", "p").drop("text"))
    sites = site_posteriors(evidence)
    score = sites.score(F.col("p"))
    return (
        evidence.join(sites.table, ["host", "path"])
        .withColumn("score", score)
        .select(
            "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), F.col("p").alias("evidence"), "host_rate",
            "path_rate", "score", (F.round("score", 12) >= 0.5).alias("kept"),
        )
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", host_col="source", path_col="lang") -> DataFrame:
    """The rows of ``docs`` that site_quality keeps, all columns as they were.

    Rows are not exchanged while at most FEW_SITES sites have to meet them; more are joined as the
    planner sees fit.
    """
    model = fit(docs, labels, id_col, text_col)
    # The row travels as one struct, so no column of it can clash with the sites'.
    packed = docs.select(
        F.struct("*").alias("row"), _key(F.col(host_col)).alias("host"), _key(F.col(path_col)).alias("path"),
        F.col(text_col).cast("string").alias("text"),
    )
    sites = site_posteriors(cut_lineage(with_evidence(packed.drop("row"), model, "text", "p").drop("text")))
    # The checkpoint hides from the planner how small the table is.
    table = F.broadcast(sites.table) if sites.table.count() <= FEW_SITES else sites.table
    scored = with_evidence(packed, model, "text", "p").drop("text").join(table, ["host", "path"])
    return scored.where(F.round(sites.score(F.col("p")), 12) >= 0.5).select("row.*")
