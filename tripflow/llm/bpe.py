"""Byte-level BPE by longest matches and backtracking.

Method. The bytes of a piece are read as Latin-1 letters by an Aho-Corasick automaton of all
tokens, which gives the longest token from each position on in one pass. The encoder takes longest
matches from left to right. A token may follow another only if merging would really leave the two
side by side; that is decided by undoing their merges down the seam, and remembered per pair. Where
a token does not fit, its next shorter prefix token is tried, and where none fits the token before
it is taken back; a position that was given up is never tried again, so the work stays linear. The
result is the one sequence whose neighbours all fit, which is what the merges produce.

Text is cut into pieces by a pattern first. A piece that is itself a token is that token, as in the
reference library, even where merges would not reach it. Pieces repeat, so a task remembers the ids
of the pieces it has met, as bytes, up to a bound; pieces that are met again stay longest.

Null and empty texts have no ids and decode to no bytes. Rows without a doc_id and repeated rows
are encoded like any other. No rows in, no rows out.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import ready

#: Pieces a task remembers in each of two generations, the longest of them, and remembered pairs.
_PIECES, _LONGEST, _PAIRS = 300_000, 64, 300_000
_FREE = 1 << 62


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class _Pieces(dict):
    """Piece → its ids as bytes. A full generation becomes the old one, from which pieces that are
    met again come back; the rest of it is forgotten with the next change."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            numbers = self.encode(piece.encode("utf-8", "surrogatepass"))
            ids = b"".join([n.to_bytes(4, "little") for n in numbers])
        if len(piece) <= _LONGEST:
            if len(self) >= _PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Bpe:
    def __init__(self, tokens: list[bytes], pattern: str):
        import ahocorasick
        import regex

        self.tokens = tokens
        self.rank = {token: number for number, token in enumerate(tokens)}
        self.cut = regex.compile(pattern).findall
        self.pieces = _Pieces(self.encode_piece)
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter = self._shorter_prefixes()
        self.halves: list[tuple[int, int] | None] = [None] * len(tokens)
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        #: tokens that merges reach; the others stand for whole pieces only
        self.made = bytearray(len(tokens))
        for number, token in enumerate(tokens):
            if len(token) == 1 or self._find_halves(number):
                self.made[number] = 1
                self.automaton.add_word(token.decode("latin-1"), (number, len(token)))
        self.automaton.make_automaton()
        for number, prefix in enumerate(self.shorter):
            while prefix >= 0 and not self.made[prefix]:
                prefix = self.shorter[prefix]
            self.shorter[number] = prefix

    def _shorter_prefixes(self) -> list[int]:
        """For each token the longest other token that it starts with, or -1."""
        out = []
        for token in self.tokens:
            stop = len(token) - 1
            while stop and token[:stop] not in self.rank:
                stop -= 1
            out.append(self.rank[token[:stop]] if stop else -1)
        return out

    def _find_halves(self, number: int) -> bool:
        """The two tokens whose merge makes this one; False if no merge does."""
        token, left = self.tokens[number], self.shorter[number]
        while left >= 0:
            right = self.rank.get(token[len(self.tokens[left]):], _FREE)
            if (left < number and right < number and self.made[left] and self.made[right]
                    and self._side_by_side(left, right)):
                self.halves[number] = (left, right)
                self.joined[left, right] = number
                return True
            left = self.shorter[left]
        return False

    def _side_by_side(self, left: int, right: int) -> bool:
        """Would merging leave the two tokens next to each other?

        Both are taken apart, the later merge first. If at any stage the tokens on the two sides of
        the seam make a token of lower rank than the merges already undone, the seam would have been
        closed before those merges took place.
        """
        limit = _FREE
        while True:
            if self.joined.get((left, right), _FREE) < limit:
                return False
            first, second = self.halves[left], self.halves[right]
            # a merge of the right side that ties in rank comes after one of the left side
            if first is not None and (second is None or left > right):
                limit, left = left, first[1]
            elif second is not None:
                limit, right = right + 1, second[0]
            else:
                return True

    def _fit(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= _PAIRS:
                self.fits.clear()
            known = self.fits[pair] = self._side_by_side(left, right)
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        longest = [0] * len(data)
        for end, (number, size) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = number  # ends come in order, so the last one is the longest
        tokens, shorter, size = self.tokens, self.shorter, len(data)
        dead = bytearray(size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(tokens[token])
            if not dead[end] and (not out or self._fit(out[-1], token)):
                out.append(token)
                at = end
                if at == size:
                    return out
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<i4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str) -> Bpe:
    return Bpe(read_ranks(path), pattern)


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for batch in batches:
            packed = [bpe.encode_packed(text or "") for text in batch["text"].to_pylist()]
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.ListArray.from_arrays(pa.array(offsets), ids)], ["doc_id", "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for batch in batches:
            ids, ends = batch["ids"].flatten().to_numpy(), np.cumsum(batch["ids"].value_lengths().to_numpy())
            data = [bpe.decode(part.tolist()) for part in np.split(ids, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())],
                                             [*batch.schema.names, "decoded"])
    return run


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """docs(doc_id, text) → (doc_id, ids)."""
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_encode(ranks, pattern), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) → (doc_id, ids, decoded): the bytes the ids stand for."""
    return (encoded.select("doc_id", "ids")
            .mapInArrow(_decode(ranks, pattern), "doc_id long, ids array<int>, decoded binary"))
