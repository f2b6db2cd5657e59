"""Byte-level BPE: exact merges in linear time, by longest matches and backtracking.

The vocabulary becomes an Aho-Corasick automaton over bytes written as Latin-1 characters. A piece
of text is covered from the left by longest matches. A token may follow another only if the two
are compatible, that is if merging their joined bytes by rank gives the same two tokens; a
sequence of pairwise compatible tokens is the BPE encoding. Where no token fits, the last one is
taken back and replaced by its longest shorter prefix; positions that led nowhere are marked, so
each is tried once.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 300_000
CACHED_PAIRS = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Pieces(dict):
    """Little-endian ids by piece; forgets everything when it is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = self[piece] = array("I", self.encode(piece.encode())).tobytes()
        return ids


class ByteBpe:
    """Encoder and decoder for one vocabulary of ranks and one pattern of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = Pieces(self.encode_piece)
        self.automaton = ahocorasick.Automaton()
        # A token that merges cannot produce occurs only as a piece of its own.
        self.made = {b for b in ranks if len(b) == 1 or self.merge(b) == [ranks[b]]}
        for b in self.made:
            self.automaton.add_word(b.decode("latin-1"), (len(b), ranks[b]))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The definition: join the neighbours of lowest rank until none can be joined."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(
                ((self.ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.ranks),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def prefix(self, token: int) -> int | None:
        """The longest token that is a true prefix of this one."""
        if token not in self.shorter:
            b = self.bytes_of[token]
            self.shorter[token] = next(
                (self.ranks[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.made), None
            )
        return self.shorter[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        longest: list[int | None] = [None] * (n + 1)
        for end, (size, token) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size + 1] = token  # matches come by their end, so the longest stays
        open_at, out, at = bytearray(b"\1") * (n + 1), [], 0
        token = longest[0]
        while at < n:
            end = at + len(self.bytes_of[token])
            if open_at[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at, token = end, longest[end]
            elif (less := self.prefix(token)) is not None:
                token = less
            else:
                open_at[at] = 0
                token = out.pop()
                at -= len(self.bytes_of[token])
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, numbers))


_CODERS: dict[tuple[str, str], ByteBpe] = {}


def coder(path: str, pattern: str) -> ByteBpe:
    """One coder per Python worker and vocabulary."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = ByteBpe(load_ranks(path), pattern)
    return _CODERS[path, pattern]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (binary, little-endian 32 bit), decoded (binary); one row per input row.

    A null or empty text has no ids. Null and repeated doc_ids stay as they are; other columns are
    not read; an empty table gives an empty result. No exchange: each row is encoded where it is
    read, and a task holds one batch of rows. ``path`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                ids = bpe.encode(text.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([ids], pa.binary()), pa.array([bpe.decode(ids)], pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def token_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; cases as in encode_documents.

    The digests are taken inside the encoding task, so neither ids nor bytes leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
