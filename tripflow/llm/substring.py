"""Repeated passages: winnowed anchors as seeds, extended to maximal repeats.

Method. In each document every run of `length` words is represented by one anchor: the smallest
hash among its `seed`-word windows (winnowing). Equal runs have equal anchors, and neighbouring
runs mostly share theirs, so one position in about seven is an anchor. Documents meet on anchor
values; an anchor that occurs only once in the corpus cannot lie in a repeat, and its surroundings
are left alone. A seed that does occur again is extended both ways by comparing all runs around it
with the earliest place that holds the same run; neighbouring runs with neighbouring sources are
one maximal repeat, whose length is `length` or more.

A passage that thousands of documents share costs one message per block of documents, not a pair
per two documents: each copy is compared with the earliest place only, which is all that decides
what goes. Runs are judged on the input, not on what is left.

Runs are told apart by two independent hashes, 128 bits together. Anchors have 64 bits: two that
share one by chance cost a look at the runs around them and change nothing.

Null, empty and wordless texts have no words. Rows without a doc_id come after all named ones in
the order of places. Rows that repeat a doc_id are one document: equal places do not remove each
other. Other columns are not read. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import (MESSAGE, Block, Texts, cut_blocks, each_block, messages, pack, range_count, received,
                     replies, unpack)
from .words import U64, Prefix, mix, whole_windows, window_hashes
from .work import ready, stored

_SPAN = "struct<start: int, stop: int, source_doc: bigint, source_start: int>"
_RESULT = f"doc_id long, n_words long, n_removed long, kept_text string, spans array<{_SPAN}>"


def _slide(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Smallest or largest of the `size` values from each position on, by doubling."""
    pick = np.minimum if least else np.maximum
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        out = pick(out[:-step], out[step:])
        width += step
    return out


class _Anchors:
    """The runs of a block, their anchors, and the distinct anchor values."""

    def __init__(self, block: Block, seed: int, length: int):
        n, span = len(block.ids), length - seed + 1
        self.runs = np.flatnonzero(whole_windows(block.sizes, length))
        if not len(self.runs):
            self.keys, self.counts = np.empty(0, U64), np.empty(0, np.int64)
            return
        grams = window_hashes(block.hashes, seed)
        least = _slide(grams, span, True)
        self.least = least[self.runs]
        # a position is an anchor where some whole run around it has its hash as the smallest
        top = np.zeros(n + span, U64)
        top[self.runs + span - 1] = self.least
        places = np.flatnonzero((_slide(top, span, False)[:len(grams)] == grams) & (grams > 0))
        self.keys, self.counts = np.unique(grams[places], return_counts=True)

    def on(self, shared: np.ndarray) -> np.ndarray:
        """The runs whose anchor is shared."""
        if not len(self.runs):
            return self.runs
        change = np.flatnonzero(np.append(True, self.least[1:] != self.least[:-1]))
        hit = shared[np.minimum(np.searchsorted(self.keys, self.least[change]), len(shared) - 1)]
        return self.runs[np.repeat(hit, np.diff(np.append(change, len(self.least))))]


def _ask_anchors(seed: int, length: int, ranges: int):
    def work(block: Block) -> Iterator[pa.RecordBatch]:
        found = _Anchors(block, seed, length)
        yield messages(block.block_id, ranges, found.keys, (found.counts > 1).astype(np.uint8))
    return each_block(work)


def _answer_anchors(asked: pa.Table) -> pa.Table:
    """Is the anchor anywhere else? One byte per key."""
    held = [unpack(p, U64, np.uint8) for p in asked["payload"].to_pylist()]
    keys, place, counts = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True,
                                    return_counts=True)
    again = counts > 1
    again[place[np.concatenate([m for _, m in held]) > 0]] = True
    told, at, answers = again[place].astype(np.uint8), 0, []
    for k, _ in held:
        answers.append(pack(told[at:at + len(k)]))
        at += len(k)
    return replies(asked, answers)


def _changes(keys: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Where, in sorted order, a new pair of hashes begins."""
    return np.append(True, (keys[1:] != keys[:-1]) | (others[1:] != others[:-1]))[:len(keys)]


class _Runs:
    """The runs of a block around shared seeds, and the first place of each distinct one."""

    def __init__(self, block: Block, found: _Anchors, shared: np.ndarray, length: int):
        self.runs = found.on(shared.astype(bool))
        hashes = Prefix(block.hashes).ranges(self.runs, length)
        # a second hash, of other word hashes
        others = Prefix(mix(block.word_hashes ^ _OTHER)[block.ids]).ranges(self.runs, length)
        doc = np.searchsorted(block.starts, self.runs, side="right") - 1
        self.doc, self.start = block.order[doc], (self.runs - block.starts[doc]).astype(np.int32)
        by = np.lexsort((self.start, self.doc, others, hashes))
        first = np.flatnonzero(_changes(hashes[by], others[by]))
        self.keys, self.others = hashes[by][first], others[by][first]
        self.first = by[first]
        self.key_of = np.empty(len(by), np.int64)
        self.key_of[by] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(by))))


def _ask_runs(seed: int, length: int, ranges: int):
    def work(_, blocks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = Block(row)
            found = _Anchors(block, seed, length)
            runs = _Runs(block, found, received(told, np.uint8), length)
            out.append(messages(block.block_id, ranges, runs.keys, runs.others, runs.doc[runs.first],
                                runs.start[runs.first]))
        schema = pa.schema({"range": pa.int32(), "block_id": pa.int64(), "payload": pa.binary()})
        return pa.Table.from_batches(out, schema)
    return work


def _answer_runs(asked: pa.Table) -> pa.Table:
    """The earliest place of each run, told only where the block's own is later."""
    held = [unpack(p, U64, U64, np.int64, np.int32) for p in asked["payload"].to_pylist()]
    keys, others, docs, starts = (np.concatenate([h[i] for h in held]) for i in range(4))
    by = np.lexsort((starts, docs, others, keys))
    first = np.flatnonzero(_changes(keys[by], others[by]))
    source = np.empty(len(by), np.int64)
    source[by] = np.repeat(by[first], np.diff(np.append(first, len(by))))
    doc, start = docs[source], starts[source]
    later = (doc < docs) | ((doc == docs) & (start < starts))
    answers, at = [], 0
    for h in held:
        own = slice(at, at + len(h[0]))
        is_later = later[own]
        answers.append(pack(is_later.astype(np.uint8), doc[own][is_later], start[own][is_later]))
        at += len(h[0])
    return replies(asked, answers)


def _sources(told: pa.Table) -> list[np.ndarray]:
    found = sorted(zip(told["range"].to_pylist(), told["payload"].to_pylist()))
    parts = [unpack(p, np.uint8, np.int64, np.int32) for _, p in found]
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kind)
            for i, kind in enumerate((np.uint8, np.int64, np.int32))]


_OTHER = U64(0xA0761D6478BD642F)

#: What becomes of a block and its repeated runs: their first words, and the sources of each.
_Finish = Callable[[Block, np.ndarray, np.ndarray, np.ndarray, int], Iterator[pa.RecordBatch]]


def _remove(seed: int, length: int, finish: _Finish):
    def work(_, blocks: pa.Table, told: pa.Table, sources: pa.Table) -> Iterator[pa.RecordBatch]:
        for row in blocks.to_pylist():
            block = Block(row)
            found = _Anchors(block, seed, length)
            runs = _Runs(block, found, received(told, np.uint8), length)
            later, docs, starts = _sources(sources)
            place = np.cumsum(later) - 1
            # the earliest place of each run's key: another block's, or this block's first
            own = runs.first
            key_doc, key_start = runs.doc[own].copy(), runs.start[own].copy()
            key_doc[later > 0], key_start[later > 0] = docs[place[later > 0]], starts[place[later > 0]]
            doc, start = key_doc[runs.key_of], key_start[runs.key_of]
            gone = (doc < runs.doc) | ((doc == runs.doc) & (start < runs.start))
            yield from finish(block, runs.runs[gone], doc[gone], start[gone], length)

    def run(key, blocks: pa.Table, told: pa.Table) -> pa.Table:
        first = told.filter(pa.array([k == 0 for k in told["kind"].to_pylist()], pa.bool_()))
        second = told.filter(pa.array([k == 1 for k in told["kind"].to_pylist()], pa.bool_()))
        return pa.Table.from_batches(list(work(key, blocks, first, second)))
    return run


def _covered(n: int, at: np.ndarray, length: int) -> np.ndarray:
    """Which of n words lie in a run that starts at one of the places."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return np.cumsum(edges)[:n] > 0


def _cut_out(block: Block, at: np.ndarray, doc: np.ndarray, start: np.ndarray,
             length: int) -> Iterator[pa.RecordBatch]:
    """A row per document: what is left of it, and its maximal repeats."""
    gone = _covered(len(block.ids), at, length)
    owner = np.searchsorted(block.starts, at, side="right") - 1
    fresh = np.append(True, (np.diff(at) != 1) | (np.diff(doc) != 0) | (np.diff(start) != 1)
                      | (np.diff(owner) != 0))[:len(at)]
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(at)) - 1
    spans: dict[int, list[dict]] = {}
    unnamed = np.iinfo(np.int64).max
    for h, t in zip(head.tolist(), tail.tolist()):
        base = int(block.starts[owner[h]])
        spans.setdefault(int(owner[h]), []).append(
            {"start": int(at[h]) - base, "stop": int(at[t]) - base + length,
             "source_doc": None if doc[h] == unnamed else int(doc[h]), "source_start": int(start[h])})
    words = block.words
    names, sizes, removed, texts, found = [], [], [], [], []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.struct(
                 {"start": pa.int32(), "stop": pa.int32(), "source_doc": pa.int64(),
                  "source_start": pa.int32()})))],
            ["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    for i, name in enumerate(block.doc_ids):
        own = slice(block.starts[i], block.starts[i + 1])
        left = block.ids[own][~gone[own]]
        names.append(name)
        sizes.append(int(block.sizes[i]))
        removed.append(int(block.sizes[i]) - len(left))
        texts.append(b" ".join(map(words.__getitem__, left.tolist())).decode("utf-8", "replace"))
        found.append(spans.get(i, []))
    yield rows()


def repeated_passages(docs: DataFrame, length: int = 20, seed: int = 8) -> DataFrame:
    """docs(doc_id, text) → (doc_id, n_words, n_removed, kept_text, spans), one row per input row.

    A word goes if it lies in a run of `length` words that also starts earlier: in a smaller
    doc_id, or further ahead in the same document. `kept_text` joins the other words by one space;
    `spans` are the removed repeats as word ranges, each with its earliest source.
    """
    return _passages(docs, length, seed, False, _cut_out, _RESULT)


def _passages(docs: DataFrame, length: int, seed: int, carry: bool, finish: _Finish,
              schema: str | StructType) -> DataFrame:
    if not 1 <= seed <= length:
        raise ValueError("a seed has 1 to `length` words")
    ready(docs.sparkSession)
    blocks = cut_blocks(docs, False, "passage-blocks", carry)
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    ranges = range_count(words * 2 // (length - seed + 2))
    shared = stored(blocks.drop("gaps", "rest").mapInArrow(_ask_anchors(seed, length, ranges), MESSAGE)
                    .groupBy("range").applyInArrow(_answer_anchors, MESSAGE), "anchors")
    asked = (blocks.drop("gaps", "rest").groupBy("block_id").cogroup(shared.groupBy("block_id"))
             .applyInArrow(_ask_runs(seed, length, ranges), MESSAGE))
    sources = stored(asked.groupBy("range").applyInArrow(_answer_runs, MESSAGE), "sources")
    told = (shared.withColumn("kind", F.lit(0))
            .unionByName(sources.withColumn("kind", F.lit(1))))
    return (blocks.groupBy("block_id").cogroup(told.groupBy("block_id"))
            .applyInArrow(_remove(seed, length, finish), schema))


def _rewrite(columns: list[str]) -> _Finish:
    """A row per document as it was, its text without the repeated words."""
    def finish(block: Block, at: np.ndarray, doc: np.ndarray, start: np.ndarray,
               length: int) -> Iterator[pa.RecordBatch]:
        gone, held = _covered(len(block.ids), at, length), Texts(block)
        rows = held.rows()
        absent = rows["absent"].to_pylist()
        texts = [None if absent[i] else held.text(i, gone).decode("utf-8", "surrogatepass")
                 for i in range(len(block.doc_ids))]
        rest = dict(zip((f.name for f in rows["rest"].type), rows["rest"].flatten()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if c == "text" else rest[c] for c in columns], columns)
    return finish


def without_passages(docs: DataFrame, length: int = 20, seed: int = 8) -> DataFrame:
    """docs with repeated passages taken out of `text`, with the white space after them; the rest of
    each text and all other columns stay. Blocks carry the rows themselves, so no text is looked up
    again: rows that share a doc_id or have none are cut each by its own repeats."""
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    return _passages(docs, length, seed, True, _rewrite(docs.columns), schema)
