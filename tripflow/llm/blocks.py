"""Documents as blocks of numbered words, and the exchange of keys between blocks.

A block holds a bounded amount of text: for each document its word numbers, and the block's own
list of words. Blocks are rows of a stored table, so later steps read numbers instead of cutting
the text again. A block can also hold what the words leave out: the white space between them, where it
is not one space, and the documents' other columns; it then is the documents themselves.

Questions such as "how often does this n-gram occur anywhere?" go through one exchange. A block
sends each distinct key once, packed by key range into messages; one task per range answers every
message with one value per key, in the order it was asked. A key that every document holds is
asked once per block, so no range grows with the most frequent key, and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64, encode, hash_words, number_words, starts_of
from .work import stored

SCHEMA = "block_id long, doc_ids array<long>, sizes binary, ids binary, words binary, n_words long, gaps binary, rest binary"
MESSAGE = "range int, block_id long, payload binary"

#: Text bytes and documents that close a block; the last document is never cut.
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 20_000
#: Keys that one task answers at a time, and the fewest ranges.
RANGE_KEYS, LEAST_RANGES = 1 << 20, 64

_NOWHERE = np.iinfo(np.int64).max


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; the byte planes of each are kept apart, which packs better."""
    parts = []
    for array in arrays:
        data = np.ascontiguousarray(array)
        planes = data.view(np.uint8).reshape(len(data), data.itemsize).T
        parts.append(np.array([len(data)], np.int64).tobytes() + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(payload), 0, []
    for kind in kinds:
        n, width = int(np.frombuffer(data, np.int64, 1, at)[0]), np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at + 8).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += 8 + n * width
    return out


class Block:
    """One row of the block table, unpacked."""

    def __init__(self, row: dict):
        self.block_id = row["block_id"]
        #: as given, null where a row had no id
        self.doc_ids = row["doc_ids"]
        self.gaps, self.rest = row.get("gaps"), row.get("rest")
        #: for comparisons; rows without an id come last
        self.order = np.array([_NOWHERE if d is None else d for d in self.doc_ids], np.int64)
        (self.sizes,) = unpack(row["sizes"], np.int32)
        (self.ids,) = unpack(row["ids"], np.int32)
        self.starts = starts_of(self.sizes)
        data = zstandard.ZstdDecompressor().decompress(row["words"])
        self.words = data.split(b" ") if data else []
        self.word_hashes = hash_words(self.words)
        self.hashes = self.word_hashes[self.ids]


def odd_gaps(texts: list[bytes], sizes: np.ndarray) -> bytes:
    """The white space of texts where it is not what a join by one space would put there.

    A text of n words has gaps 0 to n; they are numbered through, text by text.
    """
    places, found, first = [], [], 0
    for text, n in zip(texts, sizes.tolist()):
        points = np.frombuffer(text, np.uint8)
        space = np.zeros(len(points) + 2, np.int8)
        space[1:-1] = (points == 32) | ((points >= 9) & (points <= 13))
        edges = np.flatnonzero(np.diff(space))
        starts, stops = edges[::2], edges[1::2]  # runs of white space
        leads = len(starts) > 0 and starts[0] == 0
        # runs between words follow each other; only a run at the start is gap 0
        number = np.arange(len(starts)) + (0 if leads else 1)
        plain = (stops - starts == 1) & (number > 0) & (number < n)
        plain[plain] = points[starts[plain]] == 32
        for at, start, stop in zip(number[~plain].tolist(), starts[~plain].tolist(), stops[~plain].tolist()):
            places.append(first + at)
            found.append(text[start:stop])
        first += n + 1
    lengths = np.fromiter(map(len, found), np.int32, len(found))
    return pack(np.array(places, np.int64), lengths, np.frombuffer(b"".join(found), np.uint8))


class Texts:
    """The texts of a block that holds its gaps, whole or without some of their words."""

    def __init__(self, block: Block):
        self.block = block
        self.places, lengths, points = unpack(block.gaps, np.int64, np.int32, np.uint8)
        spaces, ends = points.tobytes(), starts_of(lengths).tolist()
        self.found = [spaces[a:b] for a, b in zip(ends, ends[1:])]

    def text(self, at: int, gone: np.ndarray) -> bytes:
        """One text without the words marked as gone and the white space after each of them."""
        block = self.block
        own = slice(int(block.starts[at]), int(block.starts[at + 1]))
        n, first = own.stop - own.start, own.start + at
        low, high = np.searchsorted(self.places, [first, first + n + 1]).tolist()
        gaps = dict(zip((self.places[low:high] - first).tolist(), self.found[low:high]))
        kept = np.flatnonzero(~gone[own])
        words = list(map(block.words.__getitem__, block.ids[own][kept].tolist()))
        # words followed by something else than one space close a piece
        odd = np.flatnonzero(np.isin(kept + 1, [*gaps, n]))
        out, start = [gaps.get(0, b"")], 0
        for k in odd.tolist():
            out += [b" ".join(words[start:k + 1]), gaps.get(int(kept[k]) + 1, b"")]
            start = k + 1
        if start < len(words):
            out += [b" ".join(words[start:]), b" "]
        return b"".join(out)

    def rows(self) -> pa.RecordBatch:
        """The other columns, as the struct `rest`, and whether the text was null, as `absent`."""
        return pa.ipc.open_stream(self.block.rest).read_next_batch()


def _cut(lower: bool, carry: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block_id = TaskContext.get().partitionId() << 32
        held: list[bytes] = []
        names: list[int | None] = []
        rest: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            ids, sizes, words = number_words(held, lower)
            carried = None
            if carry:
                carried = pa.BufferOutputStream()
                whole = pa.Table.from_batches(rest).combine_chunks().to_batches(max_chunksize=None)[0]
                with pa.ipc.new_stream(carried, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(whole)
                carried = carried.getvalue().to_pybytes()
            return pa.RecordBatch.from_pydict({
                "block_id": [block_id], "doc_ids": [list(names)],
                "sizes": [pack(sizes.astype(np.int32))], "ids": [pack(ids)],
                "words": [zstandard.ZstdCompressor(level=1).compress(b" ".join(words))],
                "n_words": [len(ids)],
                "gaps": [odd_gaps(held, sizes) if carry else None], "rest": [carried]}, schema=pa.schema({
                    "block_id": pa.int64(), "doc_ids": pa.list_(pa.int64()), "sizes": pa.binary(),
                    "ids": pa.binary(), "words": pa.binary(), "n_words": pa.int64(),
                    "gaps": pa.binary(), "rest": pa.binary()}))

        total = 0
        for batch in batches:
            first = 0
            for at, (name, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())):
                names.append(name)
                held.append(encode(text))
                total += len(held[-1])
                if total >= BLOCK_BYTES or len(held) >= BLOCK_DOCS:
                    if carry:
                        rest.append(batch.slice(first, at + 1 - first).select(["rest", "absent"]))
                    yield block()
                    block_id, total, first = block_id + 1, 0, at + 1
                    names.clear()
                    held.clear()
                    rest.clear()
            if carry and first < batch.num_rows:
                rest.append(batch.slice(first).select(["rest", "absent"]))
        if held:
            yield block()
    return run


def cut_blocks(docs: DataFrame, lower: bool, label: str, carry: bool = False) -> DataFrame:
    """The stored block table of docs(doc_id, text); with all that `Texts` needs, if asked for."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"),
                        *([F.struct(*rest).alias("rest"), F.col("text").isNull().alias("absent")] if carry else []))
    return stored(texts.mapInArrow(_cut(lower, carry), SCHEMA), label)


def each_block(work: Callable[[Block], Iterator[pa.RecordBatch]]):
    """For mapInArrow over the block table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from work(Block(batch.slice(at, 1).to_pylist()[0]))
    return run


def range_count(keys: int) -> int:
    return max(LEAST_RANGES, -(-keys // RANGE_KEYS))


def messages(block_id: int, ranges: int, keys: np.ndarray, *values: np.ndarray,
             first: int = 0) -> pa.RecordBatch:
    """Cut sorted distinct keys, and a value array or more beside them, into a message per range."""
    step = -(-(1 << 64) // ranges)
    bounds = np.searchsorted(keys, np.array([step * r for r in range(1, ranges)], U64))
    bounds = [0, *bounds.tolist(), len(keys)]
    full = [r for r in range(ranges) if bounds[r] < bounds[r + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array([first + r for r in full], pa.int32()), pa.array([block_id] * len(full), pa.int64()),
         pa.array([pack(*(a[bounds[r]:bounds[r + 1]] for a in (keys, *values))) for r in full],
                  pa.binary())], ["range", "block_id", "payload"])


def replies(asked: pa.Table, answers: list[bytes]) -> pa.Table:
    return pa.table({"range": asked["range"], "block_id": asked["block_id"],
                     "payload": pa.array(answers, pa.binary())})


def received(table: pa.Table, kind: type, first: int = 0, last: int | None = None) -> np.ndarray:
    """One value per key a block asked for, from its replies in ranges first to last."""
    found = sorted((r, p) for r, p in zip(table["range"].to_pylist(), table["payload"].to_pylist())
                   if r >= first and (last is None or r < last))
    return np.concatenate([unpack(p, kind)[0] for _, p in found]) if found else np.empty(0, kind)
