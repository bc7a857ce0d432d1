"""Documents packed into sequences by minimum bin slack.

Method. Per bin: the longest piece that is left goes in, and a bitset subset-sum over the lengths
that are left finds the fullest combination for the rest of the bin; the combination is removed and
the next bin begins. Only lengths matter for that, and there are at most `capacity` of them, so the
search runs on the histogram of lengths, whose size does not depend on the number of documents. A
combination is used as often as its lengths allow before the next search, which is what repeating
the search would choose. The plan says, per length, which ranks go to which sequences; pieces get
their ranks from counts per length and salt, so a length that very many pieces share is spread over
many tasks.

A document is its token ids and one end id. Only documents longer than `capacity` are cut: pieces
of `capacity` tokens, the first piece holding the remainder.

Null and empty texts are the end id alone. Rows without a doc_id and repeated rows are documents of
their own. Other columns are not read. No rows in, no rows out. Strings that name added tokens are
ordinary text, unless `added_tokens` gives them the ids that `tokenizers` gives by default.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import ready, stored

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SALTS = 1024


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 letters stand for themselves, the other bytes for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level vocabulary file of `tokenizers`.

    The merges run in tiktoken on the same vocabulary, which gives the same ids several times
    faster; a text its pattern engine gives up on goes to `tokenizers` itself. With `added_tokens`,
    so does a text that holds the content of an added token.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): number
                 for token, number in model["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not added_tokens
        self.added = sorted(special) if added_tokens else []

    def ids(self, text: str) -> list[int]:
        if any(content in text for content in self.added):
            return self.slow.encode(text, add_special_tokens=False).ids
        try:
            return self.fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the engine's panic is no Exception
            return self.slow.encode(text, add_special_tokens=False).ids


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool, added_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, added_tokens)
        for batch in batches:
            names, piece, start, length, sums, tokens = [], [], [], [], [], []
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids), capacity), len(ids)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    names.append(name)
                    piece.append(number)
                    start.append(a)
                    length.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        tokens.append(ids[a:b].astype(np.int32))
            columns = [pa.array(names, pa.int64()), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(sums, pa.int64())]
            labels = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
                labels.append("ids")
            yield pa.RecordBatch.from_arrays(columns, labels)
    return run


def fullest(left: dict[int, int], space: int) -> dict[int, int]:
    """The combination of lengths (each at most left[length] times) with the largest sum within
    `space`, long pieces first. Bit s of `reach` says that the sum s is possible."""
    mask = (1 << (space + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in left if x <= space), reverse=True):
        copies, step = min(left[length], space // length), 1
        while copies:
            step = min(step, copies)
            steps.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            copies, step = copies - step, 2 * step
        if reach >> space:
            break
    total, used = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + step
            total -= length * step
    return used


def plan_bins(lengths: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, copies per length) patterns that hold every length as often as given."""
    left, patterns = {x: n for x, n in lengths.items() if n > 0}, []
    while left:
        longest = max(left)
        if longest > capacity:
            raise ValueError("a piece is longer than a sequence")
        left[longest] -= 1
        used = fullest({x: n for x, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        patterns.append((times, used))
    return patterns


class _Places:
    """Rank within a length → sequence and offset, from the plan."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]]):
        rows, taken, sequence = [], {}, 0
        for times, used in patterns:
            offset = 0
            for length in sorted(used, reverse=True):
                copies = used[length]
                rows.append((length, taken.get(length, 0), copies, sequence, offset))
                taken[length] = taken.get(length, 0) + times * copies
                offset += length * copies
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.copies, self.sequence, self.offset = table.T
        self.heads = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.empty(len(length), np.int64)
        for x in np.unique(length):
            own = length == x
            a, b = self.heads[x], self.heads[x + 1]
            row[own] = a + np.searchsorted(self.rank[a:b], rank[own], side="right") - 1
        within = rank - self.rank[row]
        return (self.sequence[row] + within // self.copies[row],
                self.offset[row] + within % self.copies[row] * length)


def _place(places: _Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch["length"].to_numpy(), batch["rank"].to_numpy())
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """docs(doc_id, text) → a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset; and the token ids themselves `with_ids`. `added_tokens` are read as `tokenizers` does by
    default, otherwise as text."""
    ready(docs.sparkSession)
    schema = _PIECE + (", ids array<int>" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    pieces = texts.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids, added_tokens), schema)
    # salted by place, so that equal pieces and rows without a doc_id spread like any others
    salted = stored(pieces.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int")), "pieces")
    counts = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    heads = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("own", F.row_number().over(own)).join(heads, ["length", "salt"])
              .withColumn("rank", F.col("head") + F.col("own") - 1)
              .select(*pieces.columns, "rank"))
    return ranked.mapInArrow(_place(_Places(plan_bins(lengths, capacity))),
                             schema + ", sequence_id long, offset long")
