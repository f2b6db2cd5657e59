"""N-gram language model in an Elias-Fano trie, and scores of whole texts by it.

Every word and every n-gram of the training text is kept, whatever its count and whatever the size
of the corpus. Probabilities are interpolated with absolute discounts, down to add-one unigrams:

    P(w | c) = max(count(c w) - D, 0) / count(c) + weight(c) * P(w | shorter c)

where weight(c) is the mass that the continuations leave. The trie keeps the first term and the
weight, both quantised downwards to 256 levels, so the mass of a context never exceeds one.

A level of the trie has, for each context of the level above, a range of continuations. Ranges
begin at monotone pointers; continuations are made monotone over the whole level by adding the
context's number times the vocabulary's size. Both are Elias-Fano sequences, and a continuation is
found by successor search inside its context's range.

All levels are counted in one pass: every token but an end is followed by one token, so the counts
of the pairs are sums over the triples. Levels are cut into range shards of triples, words into
shards by hash. The task that merges a shard's counts writes its sequences to the shared folder, and
all workers map them from there. An index of the trie is the place in the shard plus the sizes of
the shards before. The driver sees sizes, the sums of contexts that may lie in several shards, and
one histogram. The folder must be one that executors can map (a mounted path), and is left there
like other scratch folders. Words are told apart by 64 bits of hash.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import repeat
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.elias_fano import EliasFano
from voltmart.llm.text import fold, whole
from voltmart.session import cut_lineage, scratch_path

ORDER = 3
ASK = 1_000_000  # tokens looked up together: every lookup visits each shard it has a key of
DISCOUNT = 0.75
FLUSH = 1_000_000  # tokens counted together in a task
MOST_BYTES = 1 << 28  # of words that are gathered, which may be long
SHARD_TOKENS = 2_000_000
SHARD_WORDS = 1_000_000
BOUND_TOKENS = 2_000  # sampled per shard to place the bounds, which only balance the shards
MOST_BOUND_TOKENS = 2_000_000
END = b""  # the end of a text; no word is empty


def _words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in a row, with A-Z in lower case; their number per text)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    some = pc.binary_length(words).to_numpy() > 0  # blanks at the ends of a text leave empty words
    if not some.all():
        upto = np.append(0, np.cumsum(some))[np.append(0, np.cumsum(sizes))]
        words, sizes = words.filter(pa.array(some)), np.diff(upto)
    return words, sizes


def _gathered(batches: Iterator[pa.RecordBatch], column: int, ask: int):
    """(rows without their texts, words in a row, words per text) of about ``ask`` tokens at a time."""
    rows: list[pa.RecordBatch] = []
    held: list[tuple[pa.Array, np.ndarray]] = []
    n = size = 0

    def out():
        return pa.Table.from_batches(rows), pa.chunked_array([w for w, _ in held]), np.concatenate([k for _, k in held])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_words_of(batch.column(column)))
        rows.append(batch.drop_columns([batch.schema.names[column]]))
        n += sum(map(len, held[-1]))
        size += held[-1][0].nbytes
        if n >= ask or size >= MOST_BYTES:
            yield out()
            rows, held, n, size = [], [], 0, 0
    if n:
        yield out()


def _word_counts(training: DataFrame) -> DataFrame:
    """(w, c): counts of all tokens; words are combined in the task before they are sent."""

    ask = 2 * FLUSH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, sizes in _gathered(batches, 0, ask):
            found = held.value_counts()
            words = pa.concat_arrays([found.field(0).cast(pa.binary()), pa.array([END], pa.binary())])
            yield pa.RecordBatch.from_arrays([words, pa.array(np.append(found.field(1).to_numpy(), len(sizes)))], names=["w", "c"])

    return training.select("text").mapInArrow(run, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _load(path: str) -> np.ndarray:
    return np.asarray(np.load(path, mmap_mode="r"))


def _save(path: str, values: np.ndarray) -> None:
    """Whole files only, also where a task runs twice."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, path)


class _Parts:
    """Arrays of the shards, mapped when they are asked for, as one long array."""

    def __init__(self, begin: np.ndarray, load):
        self.begin, self.load = begin, load
        self.held: dict = {}

    def __getitem__(self, s: int):
        if s not in self.held:
            self.held[s] = self.load(s)
        return self.held[s]

    def split(self, index: np.ndarray):
        """(shard, which queries, places in the shard) of positions in the long array."""
        shard = np.searchsorted(self.begin, index, side="right") - 1
        order = np.argsort(shard.astype(np.uint16) if len(self.begin) < 1 << 16 else shard, kind="stable")
        some, first = np.unique(shard[order], return_index=True)
        for s, own in zip(some.tolist(), np.split(order, first[1:])):
            yield s, own, index[own] - self.begin[s]

    def take(self, index: np.ndarray, dtype) -> np.ndarray:
        out = np.empty(len(index), dtype)
        for s, own, place in self.split(index):
            out[own] = self[s][place]
        return out


class Words:
    """Hashes of the words in order, cut by their first bits; a word's id is its place."""

    def __init__(self, head: dict):
        self.bits, sizes = head["word_bits"], head["word_sizes"]
        self.begin = np.cumsum([0, *sizes])
        self.bounds = np.array([s << (64 - self.bits) for s in range(1, len(sizes))], np.uint64)
        self.hashes = _Parts(self.begin[:-1], lambda s: EliasFano.mapped(_load(f"{head['root']}/words-{s}.npy")))
        none = np.zeros(1, np.int64)  # of a word not met
        self.counts = _Parts(self.begin, lambda s: none if s == len(sizes) else _load(f"{head['root']}/word-counts-{s}.npy"))
        self.sizes = sizes

    def ids(self, words: pa.Array) -> np.ndarray:
        """Id of each word; all words that training has not share one."""
        values = words.cast(pa.binary()).to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, values, repeat(42)), np.uint64, len(words))
        found = self.find(hashes)
        return np.where(found >= 0, found, self.begin[-1])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        order = np.argsort(hashes)
        asked = hashes[order]
        edges = [0, *np.searchsorted(asked, self.bounds), len(asked)]
        out = np.full(len(hashes), -1, np.int64)
        for s, (lo, hi) in enumerate(zip(edges, edges[1:])):
            if lo < hi and self.sizes[s]:
                base = self.bounds[s - 1] if s else np.uint64(0)
                found = self.hashes[s].find(asked[lo:hi] - base)
                out[order[lo:hi]] = np.where(found >= 0, found + self.begin[s], -1)
        return out


class Level:
    """A level's range shards. Keys are context * width + word; shard s has keys from its bound on.

    A context whose continuations lie in several shards has a range in each of them.
    """

    def __init__(self, root: str, number: int, info: dict, width: int):
        self.width = width
        self.bounds = np.array(info["bounds"], np.int64)  # first keys of all shards but the first
        self.low = np.array(info["low"], np.int64)  # first contexts of all shards
        self.begin = np.cumsum([0, *info["sizes"]])
        name = f"{root}/level{number}-"
        self.pointers = _Parts(self.low, lambda s: EliasFano.mapped(_load(f"{name}{s}.pointers.npy")))
        self.follow = _Parts(self.begin[:-1], lambda s: EliasFano.mapped(_load(f"{name}{s}.follow.npy")))
        self.p = _Parts(self.begin[:-1], lambda s: _load(f"{name}{s}.p.npy"))
        self.rest = _Parts(self.low, lambda s: _load(f"{name}{s}.rest.npy"))
        self.p_book, self.rest_book = (np.array(info[k]) for k in ("p_book", "rest_book"))

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index or -1, first term, weight) of n-grams, which are different and in order.

        The pointers give the context's range, and the search stays inside it.
        """
        index, p, rest = np.full(len(word), -1, np.int64), np.zeros(len(word)), np.ones(len(word))
        edges = np.concatenate([[0], np.searchsorted(context * self.width + word, self.bounds), [len(word)]])
        for s in np.flatnonzero(np.diff(edges)).tolist():
            at = slice(edges[s], edges[s + 1])
            owner = context[at] - self.low[s]
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(first, len(owner)))
            begin, end = self.pointers[s].spans(owner[first])
            rest[at] = np.repeat(self.rest_book[self.rest[s][owner[first]]], size)
            begin, end = np.repeat(begin, size), np.repeat(end, size)
            found = self.follow[s].find(owner * self.width + word[at], begin, end)
            ok = np.flatnonzero(found >= 0)
            index[edges[s] + ok] = found[ok] + self.begin[s]
            p[edges[s] + ok] = self.p_book[self.p[s][found[ok]]]
        return index, p, rest


def _distinct(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(different high * width + low in order, place of each pair among them)."""
    key = high * width + low
    bits = len(key).bit_length()
    if len(key) and int(key.max()) < 1 << (63 - bits):
        # Sorting numbers with their places in the low bits is cheaper than sorting places.
        key = np.sort(key << bits | np.arange(len(key)))
        order, key = key & ((1 << bits) - 1), key >> bits
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    back = np.empty(len(key), np.int64)
    back[order] = np.cumsum(new) - 1
    return key[new], back


class Trie:
    """The words and the levels, as maps of the shared folder's files."""

    def __init__(self, head: dict):
        self.head = head
        self.words = Words(head)
        self.other = int(self.words.begin[-1])  # id of all words that training has not
        self.begin = self.other + 1  # id of the beginning of a text, only a context
        self.width = self.other + 2
        self.end = int(self.words.ids(pa.array([END], pa.binary()))[0])
        self.levels = [Level(head["root"], k, info, self.width) for k, info in enumerate(head["levels"])]

    def unigrams(self, ids: np.ndarray) -> np.ndarray:
        """The base's probabilities; a word that training has not counts as met 0 times."""
        return (self.words.counts.take(ids, np.int64) + 1) * self.head["unit"]

    def log10(self, first: np.ndarray, alphabet: np.ndarray, local: np.ndarray) -> np.ndarray:
        """log10 of each token's probability. Tokens are places in ``alphabet``; ``first``: they begin a text.

        Each different pair and triple is looked up once, in order.
        """
        p = self.unigrams(alphabet)
        if not self.levels:
            return np.log10(p)[local]
        words, width = np.append(alphabet, self.begin), len(alphabet) + 1
        before = np.append(0, local[:-1])
        before[first] = len(alphabet)
        pairs, pair = _distinct(before, local, width)
        context, word = np.divmod(pairs, width)
        gram, term, rest = self.levels[0].find(words[context], words[word])
        p = term + rest * p[word]
        out = np.log10(p)[pair]
        if len(self.levels) > 1:
            later = np.flatnonzero(~first)
            triples, triple = _distinct(pair[later - 1], local[later], width)
            context, word = np.divmod(triples, width)
            shorter = np.empty(len(triples), np.int64)
            shorter[triple] = pair[later]
            p = p[shorter]
            known = np.flatnonzero(gram[context] >= 0)
            _, term, rest = self.levels[1].find(gram[context[known]], words[word[known]])
            p[known] = term + rest * p[known]
            out[later] = np.log10(p)[triple]
        return out


def _flat(batches: Iterator[pa.RecordBatch], trie: Trie, column: int, ask: int):
    """(rows without their texts, tokens per text, ids that occur, tokens as places among these, which begin a text).

    About ``ask`` tokens at a time.
    """
    for rows, held, sizes in _gathered(batches, column, ask):
        # Chunks share one dictionary; without words there is none.
        coded = held.dictionary_encode().chunks or [pa.array([], held.type).dictionary_encode()]
        ids = trie.words.ids(coded[-1].dictionary)
        alphabet = np.unique(np.append(ids, trie.end))
        places = np.searchsorted(alphabet, ids)[np.concatenate([x.indices.to_numpy() for x in coded])]
        local = np.full(len(places) + len(sizes), np.searchsorted(alphabet, trie.end))
        local[np.arange(len(places)) + np.repeat(np.arange(len(sizes)), sizes)] = places
        sizes = sizes + 1
        first = np.zeros(len(local), bool)
        first[np.append(0, np.cumsum(sizes)[:-1])] = True
        yield rows, sizes, alphabet, local, first


_MAPPED: dict[tuple, Trie] = {}


def _open(head: dict) -> Trie:
    """The trie of a head, opened once per worker."""
    name = head["root"], len(head["levels"]), [sorted(x) for x in head["levels"]].__repr__()
    if name not in _MAPPED:
        _MAPPED.clear()
        _MAPPED[name] = Trie(head)
    return _MAPPED[name]


def _folder(spark) -> str:
    """A fresh folder that the driver and all executors see as a path."""
    url = urlparse(scratch_path(spark, "lm"))
    if url.scheme not in ("", "file"):
        raise RuntimeError("spark.checkpoint.dir must be a mounted folder: the model is mapped from it")
    os.makedirs(url.path)
    return url.path


def _grid(values: np.ndarray) -> np.ndarray:
    """Cells of positive numbers, a thousandth wide; monotone."""
    return (np.ascontiguousarray(values, np.float64).view(np.int64) >> 42).astype(np.int32)


def _book(histogram: dict[int, int]) -> tuple[np.ndarray, list[float]]:
    """Quantiles of a histogram, as cells and as the cells' lower ends; at most 256."""
    if not histogram:
        return np.array([1023 << 10]), [1.0]
    cells = np.array(sorted(histogram))
    upto = np.cumsum([histogram[c] for c in cells.tolist()])
    book = np.unique(cells[np.searchsorted(upto, (np.linspace(0, 1, 256) * (upto[-1] - 1)).astype(np.int64), side="right")])
    return book, (book.astype(np.int64) << 42).view(np.float64).tolist()


def _codes(cells: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (np.searchsorted(book, cells, side="right") - 1).astype(np.uint8)


def _planes(values: np.ndarray) -> bytes:
    """Numbers from 0 on as their lowest bytes, then the next, compressed: planes of few different bytes cost little."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _numbers(planes: bytes, n: int) -> np.ndarray:
    out, width = np.zeros((n, 8), np.uint8), planes[0]
    out[:, :width] = np.frombuffer(pa.decompress(planes[1:], n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def _in_order(pair: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by pair and third word, places in it where a new triple begins)."""
    span = int(third.max(initial=0)) + 1
    if (int(pair.max(initial=0)) + 1) * span < 1 << 63:
        order = np.argsort(pair * span + third, kind="stable")
    else:
        order = np.lexsort((third, pair))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(pair[order]) != 0) | (np.diff(third[order]) != 0)
    return order, np.flatnonzero(new)


def _triples(trie: Trie, alphabet: np.ndarray, local: np.ndarray, first: np.ndarray, order: int) -> tuple:
    """(pairs, third words plus 1, counts) of the different triples in order; a pair is word * width + word.

    The third word is 0 after the end of a text, and everywhere if pairs are all that is wanted.
    """
    words, width = np.append(alphabet, trie.begin), len(alphabet) + 1
    before = np.append(0, local[:-1])
    before[first] = len(alphabet)
    pair, third = before * width + local, np.zeros(len(local), np.int64)
    if order > 2:
        third[:-1] = np.where(first[1:], 0, local[1:] + 1)
    if width**3 < 1 << 63:
        key = np.sort(pair * width + third)
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.diff(np.append(new, len(key)))
        pair, third = np.divmod(key[new], width)
    else:
        by, new = _in_order(pair, third)
        counts = np.diff(np.append(new, len(by)))
        pair, third = pair[by[new]], third[by[new]]
    left, right = np.divmod(pair, width)
    return words[left] * trie.width + words[right], np.append(0, alphabet + 1)[third], counts


def _bounds(training: DataFrame, shared, shards: int, n: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """First (pairs, third words plus 1) of all shards but the first, from a sample of the texts."""
    ask = ASK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _open(shared.value)
        for _, _, alphabet, local, first in _flat(batches, trie, 0, ask):
            found = _triples(trie, alphabet, local, first, order)[:2]
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in found], names=["pairs", "thirds"])

    part = min(1.0, min(BOUND_TOKENS * shards, MOST_BOUND_TOKENS) / max(n, 1))
    rows = training.select("text").sample(part, 7).mapInArrow(run, "pairs binary, thirds binary").collect()
    pair, third = (np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r[k], np.int64) for r in rows]]) for k in ("pairs", "thirds"))
    by, new = _in_order(pair, third)
    # Different triples at even distances.
    by = by[new][np.unique(np.arange(1, shards) * len(new) // shards)] if len(new) else by
    return pair[by], third[by]


def _merged(training: DataFrame, shared, bounds: tuple[np.ndarray, np.ndarray], order: int) -> list:
    """Count the triples and write each shard's sequences and counts.

    A pair belongs to the shard where its triples would begin. Returns per shard whether its first
    pair belongs to an earlier one, and per level the number of contexts and of n-grams, and count
    and number of the continuations of the first and the last context.
    """
    spark = training.sparkSession
    shards, ask = len(bounds[0]) + 1, FLUSH
    start = np.append(0, bounds[0])  # the first pair met in a shard
    own = np.append(0, bounds[0] + (bounds[1] > 0))  # the first pair that is a shard's own

    columns, kinds = ["shard", "n", "pairs", "thirds", "counts"], [pa.int32(), pa.int32(), *[pa.binary()] * 3]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _open(shared.value)
        for _, _, alphabet, local, first in _flat(batches, trie, 0, ask):
            pair, third, counts = _triples(trie, alphabet, local, first, order)
            lo, hi = (np.searchsorted(pair, bounds[0], side=side).tolist() for side in ("left", "right"))
            edges = [0, *(i + int(np.searchsorted(third[i:j], t)) for i, j, t in zip(lo, hi, bounds[1].tolist())), len(pair)]
            parts = []
            for s, (i, j) in enumerate(zip(edges, edges[1:])):
                if i == j:
                    continue
                parts.append((s, pair[i:j] - start[s], third[i:j], counts[i:j]))
                if pair[i] < own[s]:
                    # The shard that the pair belongs to is told of the triples that lie here.
                    owner = int(np.searchsorted(own, pair[i], side="right")) - 1
                    here = counts[i : i + int(np.searchsorted(pair[i:j], pair[i], side="right"))].sum()
                    parts.append((owner, pair[i : i + 1] - start[owner], np.zeros(1, np.int64), np.array([here])))
            # Differences of sorted pairs are small.
            sent = [(s, len(p), _planes(np.diff(p, prepend=0)), _planes(t), _planes(c)) for s, p, t, c in parts]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*sent), kinds)], names=columns)

    names = ["shard", "shared", *(f"{k}{level}" for level in range(order - 1) for k in ("contexts", "size", "c_low", "n_low", "c_high", "n_high"))]
    fields = pa.schema([(k, pa.int64()) for k in names])

    def merge(table: pa.Table) -> pa.Table:
        s = table["shard"][0].as_py()
        head = shared.value
        width = sum(head["word_sizes"]) + 2
        sent = [r for r in zip(*(table[k].to_pylist() for k in ("n", "pairs", "thirds", "counts"))) if r[0]]
        none = np.zeros(0, np.int64)
        pair = np.concatenate([none, *[np.cumsum(_numbers(p, n)) for n, p, _, _ in sent]])
        third = np.concatenate([none, *[_numbers(t, n) for n, _, t, _ in sent]])
        counts = np.concatenate([none, *[_numbers(c, n) for n, _, _, c in sent]])
        by, new = _in_order(pair, third)
        counts = np.add.reduceat(counts[by], new) if len(new) else counts
        pair, third = pair[by[new]] + start[s], third[by[new]]
        del sent, by
        first = np.ones(len(pair), bool)
        first[1:] = pair[1:] != pair[:-1]
        begins = np.flatnonzero(first)
        pairs = pair[begins]
        values = [s, int(len(pairs) > 0 and pairs[0] < own[s])]

        def write(level: int, pointers: np.ndarray, follow: np.ndarray, counts: np.ndarray) -> None:
            name = f"{head['root']}/level{level}-{s}"
            _save(f"{name}.pointers.npy", EliasFano.flat(pointers))
            _save(f"{name}.follow.npy", EliasFano.flat(follow))
            _save(f"{name}.counts.npy", np.frombuffer(_planes(counts), np.uint8))
            ends = [counts[p:q] for p, q in (pointers[:2], pointers[-2:])] if len(pointers) > 1 else [counts, counts]
            values.extend([len(pointers) - 1, len(follow), *(int(x) for e in ends for x in (e.sum(), len(e)))])

        low, high = own[s] // width, own[s + 1] // width if s + 1 < shards else width - 1
        mine = slice(values[1], None)
        # Contexts without continuations have empty ranges.
        pointers = np.searchsorted(pairs[mine], np.arange(low, high + 2) * width)
        total = np.add.reduceat(counts, begins) if len(begins) else counts
        write(0, pointers, pairs[mine] - low * width, total[mine])
        if order > 2:
            some = third > 0
            context = np.cumsum(first) - 1
            pointers = np.append(0, np.cumsum(some))[np.append(begins, len(pair))]
            write(1, pointers, context[some] * width + third[some] - 1, counts[some])
        return pa.Table.from_arrays([pa.array([v]) for v in values], schema=fields)

    empty = [F.lit(b"").alias(k) for k in ("pairs", "thirds", "counts")]
    none = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(0).alias("n"), *empty)
    counted = training.select("text").mapInArrow(count, "shard int, n int, pairs binary, thirds binary, counts binary")
    return counted.union(none).groupBy("shard").applyInArrow(merge, ", ".join(f"{k} long" for k in fields.names)).collect()


def _write_words(words: DataFrame, root: str, v: int) -> dict:
    """Write the shards of the words; returns what the driver knows of them."""
    bits = max(0, -(-v // SHARD_WORDS) - 1).bit_length()
    shard = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")

    def write(table: pa.Table) -> pa.Table:
        s = table["s"][0].as_py()
        h, c = table["h"].to_numpy().view(np.uint64), table["c"].to_numpy()
        order = np.argsort(h)
        base = np.uint64(s << (64 - bits)) if s else np.uint64(0)
        _save(f"{root}/words-{s}.npy", EliasFano.flat(h[order] - base))
        _save(f"{root}/word-counts-{s}.npy", c[order].astype(np.int64))
        return pa.table({"s": [s], "n": [len(h)]})

    rows = words.select(shard.alias("s"), "h", "c").groupBy("s").applyInArrow(write, "s long, n long").collect()
    sizes = [0] * (1 << bits)
    for r in rows:
        sizes[r["s"]] = r["n"]
    for s in (s for s, size in enumerate(sizes) if not size):
        _save(f"{root}/word-counts-{s}.npy", np.zeros(0, np.int64))
    return {"word_bits": bits, "word_sizes": sizes}


def build(training: DataFrame, words: DataFrame, n: int, v: int, order: int = ORDER) -> dict:
    """Head of the trie, whose shards lie in the shared folder; the driver holds a few numbers per shard."""
    spark = training.sparkSession
    root = _folder(spark)
    head = {"root": root, "levels": [], "unit": 1 / (n + v + 1), **_write_words(words, root, v)}
    if not n:
        return head
    width = sum(head["word_sizes"]) + 2
    shared = spark.sparkContext.broadcast(head)
    pair, third = _bounds(training, shared, max(12, -(-n // SHARD_TOKENS)), n, order)
    done = sorted(_merged(training, shared, (pair, third), order), key=lambda r: r["shard"])
    shared.unpersist()
    own = pair + (third > 0)
    levels = [{"bounds": own.tolist(), "low": [0, *(own // width).tolist()], "sizes": [r["size0"] for r in done]}]
    if order > 2:
        low = [int(b) - r["shared"] for b, r in zip(np.cumsum([0, *levels[0]["sizes"]]), done)]
        bounds = [c * width + (t - 1 if r["shared"] else 0) for c, t, r in zip(low[1:], third.tolist(), done[1:])]
        levels.append({"bounds": bounds, "low": low, "sizes": [r["size1"] for r in done]})
    for level, info in enumerate(levels):
        info["ends"] = _ends(level, info, done)
    _quantise(spark, root, levels, len(done))
    return {**head, "levels": [{k: x for k, x in info.items() if k != "ends"} for info in levels]}


def _ends(level: int, info: dict, done: list) -> list[tuple]:
    """Per shard count and number of all continuations of its first and its last context, which others may share."""
    totals: dict[int, list[int]] = {}
    ends = []
    for low, r in zip(info["low"], done):
        high = low + r[f"contexts{level}"] - 1
        for c, end in [(low, "low")] * (high >= low) + [(high, "high")] * (high > low):
            total = totals.setdefault(c, [0, 0])
            total[0] += r[f"c_{end}{level}"]
            total[1] += r[f"n_{end}{level}"]
        ends.append((low, high))
    return [tuple(totals.get(c, [0, 0]) for c in x) for x in ends]


def _quantise(spark, root: str, levels: list[dict], shards: int) -> None:
    """Write the first terms and weights of levels whose counts are written; adds the books to ``levels``."""

    def each(work, schema: str) -> DataFrame:
        """Rows of ``work(level, shard, ends)``, one task for each shard of each level."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    level, s = divmod(i, shards)
                    yield work(level, s, plan.value[level]["ends"][s])

        return spark.range(0, shards * len(levels), 1, shards * len(levels)).mapInArrow(run, schema)

    def cells(level: int, s: int, ends: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the first terms and of the weights."""
        name = f"{root}/level{level}-{s}"
        e = EliasFano.mapped(_load(f"{name}.pointers.npy"))
        pointers = e.get(np.arange(e.n)).astype(np.int64)
        counts = _numbers(_load(f"{name}.counts.npy").tobytes(), int(pointers[-1]) if e.n else 0)
        total, size = np.diff(np.append(0, np.cumsum(counts))[pointers]), np.diff(pointers)
        own = size.copy()
        if len(size):
            for at, end in zip((0, -1), ends):
                total[at], size[at] = end
        # A context's count is that of its continuations; a context without any leaves all to the shorter one.
        rest = np.where(size > 0, DISCOUNT * size / np.maximum(total, 1), 1.0)
        return _grid((counts - DISCOUNT) / np.repeat(total, own)), _grid(rest)

    def weigh(level: int, s: int, ends: tuple) -> pa.RecordBatch:
        found = [(2 * level + k, np.unique(x, return_counts=True)) for k, x in enumerate(cells(level, s, ends))]
        columns = [np.concatenate([np.full(len(x), k) for k, (x, _) in found])]
        columns += [np.concatenate([x[i] for _, x in found]).astype(np.int64) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["kind", "cell", "count"])

    plan = spark.sparkContext.broadcast(levels)
    histograms: list[dict] = [{} for _ in range(2 * len(levels))]
    for r in each(weigh, "kind long, cell long, count long").groupBy("kind", "cell").agg(F.sum("count").alias("count")).collect():
        histograms[r["kind"]][r["cell"]] = r["count"]
    books = []
    for k, histogram in enumerate(histograms):
        book, levels[k // 2][("p_book", "rest_book")[k % 2]] = _book(histogram)
        books.append(book)

    def encode(level: int, s: int, ends: tuple) -> pa.RecordBatch:
        name = f"{root}/level{level}-{s}"
        for k, (kind, found) in enumerate(zip(("p", "rest"), cells(level, s, ends))):
            _save(f"{name}.{kind}.npy", _codes(found, books[2 * level + k]))
        return pa.RecordBatch.from_arrays([pa.array([s])], names=["s"])

    each(encode, "s long").collect()
    plan.unpersist()
    for level in range(len(levels)):
        for s in range(shards):
            os.remove(f"{root}/level{level}-{s}.counts.npy")


def language_model(
    docs: DataFrame, folds: int = 7, held: int = 2, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per input row.

    A null or empty text is one end. Rows with a null id fall into the fold of the empty text;
    repeated rows are counted and scored one by one. Without training rows nothing is known, and
    base_score is 0. An empty table gives an empty result; other columns are not read. Orders of 2
    and 3 are supported.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    training = rows.where(fold(F.col("doc_id"), folds) != held)
    words = cut_lineage(_word_counts(training).select(F.xxhash64("w").alias("h"), "c"))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    built = build(training, words, n, v, order)
    shared = spark.sparkContext.broadcast(built)
    ask = ASK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _open(shared.value)
        for table, sizes, alphabet, local, first in _flat(batches, trie, 1, ask):
            begin = np.flatnonzero(first)
            columns = [
                table["doc_id"].combine_chunks(),
                pa.array(sizes),
                pa.array(np.add.reduceat((alphabet < trie.other)[local], begin, dtype=np.int64)),
                pa.array(np.add.reduceat(np.log10(trie.unigrams(alphabet))[local], begin)),
                pa.array(np.add.reduceat(trie.log10(first, alphabet, local), begin)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    scored = rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
