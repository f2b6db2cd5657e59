"""Substring de-duplication by level-wise doubling.

A word goes if a window of ``target`` words over it also starts in a document with a smaller id.
Windows are tested at lengths that double up to the target: only where every shorter window inside
is found in several documents is the longer one tested. At the first length not all windows are
tested but one anchor in each target window, the one of least hash. Equal target windows have
equal anchors, so nothing is missed, and few windows are sent.

Documents are dealt into groups of bounded size by a hash. A group tests its windows by requests:
hashes sorted by shard, each hash once per group with the smallest and largest document that has
it. A shard answers the groups for which a hash counts as repeated. A passage that most documents
share therefore reaches a shard at most once per group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.llm.hashing import WordHashes, window_hashes
from voltmart.llm.text import whole

TARGET = 50
GROUP_BYTES = 8 << 20  # text of a group

_WORDS = WordHashes()
REQUESTS = "shard int, p int, kind int, a binary, b binary, low binary, high binary, at binary"
ANSWERS = "p int, kind int, a binary, at binary"


class Group:
    """The words of a group's documents in one array, in the order of (doc_id, text hash)."""

    def __init__(self, table: pa.Table):
        order = table.select(["doc_id", "th"]).to_pandas().sort_values(["doc_id", "th"], kind="stable").index
        self.table = table.take(pa.array(order.to_numpy()))
        self.texts = self.table["text"]
        ids = self.table["doc_id"]
        known = ids.is_valid().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        hashes, sizes = [], []
        for text in self.texts:
            w = text.as_py().encode().split()
            hashes.append(_WORDS.of(w))
            sizes.append(len(w))
        self.sizes = np.array(sizes, np.int64)
        self.h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        # Words from here to the end of the document; rows without an id take no part.
        self.left = np.where(known[self.doc], self.ends[self.doc] - np.arange(len(self.h)), 0) if len(self.h) else np.zeros(0, np.int64)

    def starts(self, length: int) -> np.ndarray:
        return np.flatnonzero(self.left[: max(0, len(self.h) - length + 1)] >= length)

    def anchors(self, target: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all target windows, and in each the base window of least hash, the first of equals."""
        starts = self.starts(target)
        if not len(starts):
            return starts, starts
        views = np.lib.stride_tricks.sliding_window_view(window_hashes(self.h, base), target - base + 1)
        out = [s + views[s].argmin(1) for s in np.array_split(starts, max(1, len(starts) // 100_000))]
        return starts, np.concatenate(out)

    def candidates(self, target: int, lengths: list[int], answers: dict[int, np.ndarray]) -> np.ndarray:
        """Starts of target windows all of whose tested shorter windows are repeated."""
        starts = self.starts(target)
        for k, length in enumerate(lengths):
            if not len(starts):
                break
            h = window_hashes(self.h, length)
            found = answers.get(k, np.zeros(0, np.uint64))
            if k == 0:
                starts, anchor = self.anchors(target, length)
                starts = starts[np.isin(h[anchor], found)]
            else:
                for m in range(target // length):
                    starts = starts[np.isin(h[starts + m * length], found)]
        return starts


def _levels(target: int, base: int) -> list[int]:
    """Lengths before the target: halves of halves down to ``base``."""
    out = []
    length = target // 2
    while length >= max(1, base):
        out.append(length)
        length //= 2
    return out[::-1] or [max(1, target // 2)]


def _requests(p: int, shards: int, kind: int, a, b, low, high, at) -> list[dict]:
    shard = (a % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for s in range(shards):
        k = order[bounds[s] : bounds[s + 1]]
        if len(k):
            rows.append(
                {"shard": s, "p": p, "kind": kind, "a": a[k].tobytes(), "b": b[k].tobytes(), "low": low[k].tobytes(),
                 "high": high[k].tobytes(), "at": at[k].tobytes()}
            )
    return rows


_REQUEST_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("p", pa.int32()), ("kind", pa.int32())] + [(n, pa.binary()) for n in ("a", "b", "low", "high", "at")]
)
_ANSWER_SCHEMA = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("at", pa.binary())])
_B = "<u4"  # 32 more bits beside the 64 of ``a``


def _once(a, b, doc):
    """Positions of one entry for each (a, b): the entry of smallest document; also its group."""
    order = np.lexsort((doc, b, a))
    sa, sb = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    return order, new


def _ask(target: int, lengths: list[int], level: int, shards: int):
    """Requests of one level: anchors, tested parts of candidates, or candidates themselves."""

    def requests(table: pa.Table, answers: pa.Table | None) -> pa.Table:
        if not table.num_rows:
            return _REQUEST_SCHEMA.empty_table()
        p, g = table["p"][0].as_py(), Group(table.drop_columns(["p"]))
        last = level == len(lengths)
        length = target if last else lengths[level]
        if level == 0:
            at = np.unique(g.anchors(target, length)[1])
        else:
            at = g.candidates(target, lengths[:level], _found(answers))
            if not last:
                at = np.unique((at[:, None] + np.arange(target // length) * length).ravel())
        if not len(at):
            return _REQUEST_SCHEMA.empty_table()
        a = window_hashes(g.h, length)[at]
        b = window_hashes(g.h, length, 1)[at].astype(_B) if last else np.zeros(len(at), _B)
        doc = g.ids[g.doc[at]]
        order, new = _once(a, b, doc)
        first = np.flatnonzero(new)
        group_end = np.append(first[1:], len(order)) - 1
        low, high = doc[order[first]], doc[order[group_end]]
        sent = order[first]
        rows = _requests(p, shards, level, a[sent], b[sent], low, high, at[sent].astype("<u4"))
        if last:
            # Later documents of the group are covered by its first; nobody needs to be asked.
            later = doc[order] > low[np.cumsum(new) - 1]
            sure = np.sort(at[order[later]]).astype("<u4")
            # Further places in the first document itself wait for the same verdict.
            twin = np.flatnonzero(~new & ~later)
            if len(sure):
                rows.append({"shard": p % shards, "p": p, "kind": -1, "a": b"", "b": b"", "low": b"", "high": b"", "at": sure.tobytes()})
            if len(twin):
                k, t = np.searchsorted(first, twin, side="right") - 1, order[twin]
                rows += _requests(p, shards, level, a[t], b[t], low[k], high[k], at[t].astype("<u4"))
        return pa.Table.from_pylist(rows, schema=_REQUEST_SCHEMA)

    if level == 0:
        def alone(table: pa.Table) -> pa.Table:
            return requests(table, None)

        return alone

    def both(table: pa.Table, answers: pa.Table) -> pa.Table:
        return requests(table, answers)

    return both


def _found(answers: pa.Table) -> dict[int, np.ndarray]:
    out: dict[int, list[np.ndarray]] = {}
    for kind, a in zip(answers["kind"].to_pylist(), answers["a"]):
        out.setdefault(kind, []).append(np.frombuffer(a.as_py(), np.uint64))
    return {k: np.concatenate(v) for k, v in out.items()}


def _answer(last: int):
    """A shard's verdicts: repeated hashes by value, covered target windows by position."""

    def run(table: pa.Table) -> pa.Table:
        rows, asked = [], []
        for p, kind, a, b, low, high, at in zip(*[table[n] for n in ("p", "kind", "a", "b", "low", "high", "at")]):
            if kind.as_py() < 0:
                rows.append({"p": p.as_py(), "kind": last, "a": b"", "at": at.as_py()})
                continue
            n = len(a.as_py()) // 8
            asked.append(
                (np.full(n, p.as_py()), np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), _B),
                 np.frombuffer(low.as_py(), np.int64), np.frombuffer(high.as_py(), np.int64), np.frombuffer(at.as_py(), "<u4"))
            )
            level = kind.as_py()
        if asked:
            p, a, b, low, high, at = (np.concatenate(x) for x in zip(*asked))
            order, new = _once(a, b, low)
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            least = low[order[first]][group]
            if level == last:
                yes = order[low[order] > least]
            else:
                most = np.maximum.reduceat(high[order], first)[group]
                yes = order[most > least]
            yes = yes[np.argsort(p[yes], kind="stable")]
            groups, begin = np.unique(p[yes], return_index=True)
            for k, (q, i) in enumerate(zip(groups, begin)):
                mine = yes[i : begin[k + 1] if k + 1 < len(begin) else len(yes)]
                if level == last:
                    rows.append({"p": int(q), "kind": last, "a": b"", "at": np.sort(at[mine]).tobytes()})
                else:
                    rows.append({"p": int(q), "kind": level, "a": a[mine].tobytes(), "at": b""})
        return pa.Table.from_pylist(rows, schema=_ANSWER_SCHEMA)

    return run


def _cut(target: int, last: int, names: list[str], with_text: bool):
    """Results of a group's documents from the covered windows."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        g = Group(table.drop_columns(["p"]))
        covered = np.zeros(len(g.h) + target + 1, np.int32)
        for kind, at in zip(answers["kind"].to_pylist(), answers["at"]):
            if kind == last:
                k = np.frombuffer(at.as_py(), "<u4").astype(np.int64)
                np.add.at(covered, k, 1)
                np.add.at(covered, k + target, -1)
        gone = np.cumsum(covered)[: len(g.h)] > 0
        removed, digests, kept_texts = [], [], []
        for text, size, end in zip(g.texts, g.sizes, g.ends):
            out = gone[end - size : end]
            w = text.as_py().encode().split()
            n = int(out.sum())
            if n:
                w = [x for x, drop in zip(w, out) if not drop]
            kept = b" ".join(w)
            removed.append(n)
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept.decode() if n else text.as_py())
        columns = {
            "doc_id": g.table["doc_id"], "n_words": pa.array(g.sizes), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if with_text:
            columns["kept_text"] = pa.array(kept_texts, pa.string())
        return pa.table({n: columns[n] if n in columns else g.table[n] for n in names})

    return run


def substring_dedup(
    docs: DataFrame,
    target: int = TARGET,
    base: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    with_text: bool = False,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; one row per input row.

    ``with_text`` adds kept_text: the kept words joined by one blank where words were removed, else
    the text as it was (null: empty). ``carry`` names input columns to hand through; they must not
    be called like a result column. ``base`` is the shortest length tested (default: half the
    target).

    A null text has no words. Rows with a null id neither lose words nor make others lose any. Rows
    repeated under one id do not remove each other's words. Texts shorter than the target stay
    whole. An empty table gives an empty result. Equal windows are told by 96 bits of hash.

    The texts are dealt out once, by one exchange that every level reads again. Executors that are
    lost cost the tasks they held.
    """
    carry = carry or []
    size = docs.agg(F.count("*"), F.sum(F.octet_length(whole(F.col(text_col))))).first()
    groups = max(12, -(-(size[1] or 0) // group_bytes))
    lengths = _levels(target, base if base is not None else target // 2)
    last = len(lengths)
    # Prefixed, so that no input column clashes with the operator's own.
    dealt = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        whole(F.col(text_col)).alias("text"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    ).withColumn("th", F.xxhash64("text"))
    dealt = dealt.withColumn("p", F.pmod(F.xxhash64("doc_id", "th"), F.lit(groups)).cast("int"))
    columns = ["p", "doc_id", "th", "text", *[f"_c{i}" for i in range(len(carry))]]
    dealt = dealt.select(*columns).repartition(groups, "p")
    answers = None
    for level in range(last + 1):
        ask = _ask(target, lengths, level, groups)
        if answers is None:
            asked = dealt.groupBy("p").applyInArrow(ask, REQUESTS)
        else:
            asked = dealt.groupBy("p").cogroup(answers.groupBy("p")).applyInArrow(ask, REQUESTS)
        got = asked.groupBy("shard").applyInArrow(_answer(last), ANSWERS)
        if level == last:
            answers = got
        else:
            answers = got if answers is None else answers.union(got)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    types = {"doc_id": T.LongType(), "n_words": T.LongType(), "n_removed": T.LongType()}
    shape = T.StructType(
        [T.StructField(n, types.get(n, T.StringType())) for n in names] + [dealt.schema[f"_c{i}"] for i in range(len(carry))]
    )
    out = dealt.groupBy("p").cogroup(answers.groupBy("p")).applyInArrow(_cut(target, last, shape.names, with_text), shape)
    return out.select(*names, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])
