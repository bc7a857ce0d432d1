"""Language-model scores from a weighted backoff automaton.

Model. States are the word sequences of up to `order` - 1 words that occur in training texts as a
context, the empty one being the root. A state h has an arc for each word w that follows it, with
weight log10 of (c(hw) + m * p(w | h')) / (c(h) + m), h' being h without its first word, and one
failure arc to h' with weight log10 of m / (c(h) + m), taken for every other word. m is the
`strength` of the order (Dirichlet smoothing, so that the arcs and the failure arc of a state share
one unit of probability). The root's arc for w weighs log10 of (c(w) + a) / (N + a * (V + 1)), a
word never seen counting as c = 0.

Scoring. Each block of documents builds the part of the automaton that its own n-grams touch, as sorted
arcs and failure arcs (`automaton`), and walks its texts once from left to right, side by side: the
state is carried from word to word, a word without an arc takes failure arcs down to a state that
has one, and the weights on the way are added up.

Scale. Counts of all n-grams are exact and cover all training texts; no table of them is broadcast
or brought to one place. Each block of documents sends its distinct n-grams with its own counts
into the exchange of `blocks` and gets the corpus counts back, which is the part of the automaton
the block needs. Words and pairs go first. Of the longer ones only those go whose beginning and end, one
word shorter, both occur in other blocks as well; the counts of all others are the block's own.

Words are as in `words`, A-Z lower-cased; every text ends with one end token. Null and wordless
texts are the end token alone. Rows without a doc_id count as the empty id for the choice of
training rows. Repeated rows are texts of their own. Without training texts every probability of
the root is 1. Other columns are not read. No rows in, no rows out. Keys have 64 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton
from .blocks import (MESSAGE, Block, cut_blocks, each_block, messages, pack, range_count, received,
                     unpack)
from .words import U64, starts_of, whole_windows, window_hashes
from .work import ready, stored

_RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")
#: Columns of blocks and answers that are sent.
_LEAN, _ANSWER = ("block_id", "doc_ids", "sizes", "ids", "words"), ("range", "block_id", "payload")
_COUNTED = MESSAGE + ", known long, total long"
_BEGIN, _END = U64(0x1B873593CC9E2D51), U64(0x2545F4914F6CDD1D)


def is_held_out(doc_id: int | None, folds: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


class _Grams:
    """The texts of a block as begin, words, end; and the distinct n-grams of each order."""

    def __init__(self, block: Block, folds: int, order: int):
        sizes = block.sizes.astype(np.int64) + 2
        self.starts = starts_of(sizes)
        symbols = np.empty(int(self.starts[-1]), U64)
        inner = np.ones(len(symbols), bool)
        inner[self.starts[:-1]] = inner[self.starts[1:] - 1] = False
        symbols[inner] = block.hashes
        symbols[self.starts[:-1]], symbols[self.starts[1:] - 1] = _BEGIN, _END
        self.held = np.array([is_held_out(d, folds) for d in block.doc_ids], bool)
        training = ~np.repeat(self.held, sizes)
        self.orders, self.first = [], []
        for n in range(1, order + 1):
            whole = whole_windows(sizes, n)
            if n == 1:
                whole[self.starts[:-1]] = False  # the begin is a context, never a word
            at = np.flatnonzero(whole)
            found = symbols[at] if n == 1 else window_hashes(symbols, n)[at]
            keys, first, place = np.unique(found, return_index=True, return_inverse=True)
            counts = np.bincount(place[training[at]], minlength=len(keys))
            # the n-gram belongs to the position of its last word
            self.orders.append((at + n - 1, keys, place, counts))
            self.first.append(at[first] + n - 1)
        self.n = len(symbols)

        #: numbers of the n-grams that end at each position; the begin mark is the last single word
        self.numbers = np.full((order, self.n), -1, np.int64)
        for n, (at, _, place, _) in enumerate(self.orders):
            self.numbers[n, at] = place
        self.numbers[0, self.starts[:-1]] = len(self.orders[0][1])

    def links(self, n: int) -> dict[str, np.ndarray]:
        """For each distinct n-gram, n of two or more: its first and last n - 1 words, and its last word."""
        at = self.first[n - 1]
        return {"prefix": self.numbers[n - 2, at - 1], "suffix": self.numbers[n - 2, at], "word": self.numbers[0, at]}

    def open(self, n: int, below: np.ndarray) -> np.ndarray:
        """Which n-grams, n of three or more, may occur elsewhere, given the corpus counts of the shorter ones.
        Where all training texts with its first or its last words are in this block, so is the n-gram."""
        elsewhere, links = below > self.orders[n - 2][3], self.links(n)
        return elsewhere[links["prefix"]] & elsewhere[links["suffix"]]

    def counts(self, told: pa.Table, ranges: int, upto: int) -> list[np.ndarray]:
        """Corpus counts of the n-grams up to an order, from the replies and the block's own counts."""
        out = []
        for n in range(1, upto + 1):
            answers = received(told, np.int64, (n - 1) * ranges, n * ranges)
            if n > 2:
                asked, answered = self.open(n, out[-1]), answers
                answers = self.orders[n - 1][3].astype(np.int64)
                answers[asked] = answered
            out.append(answers)
        return out

    def automaton(self, counts: list[np.ndarray], add: float, strengths: Sequence[float], known: int,
                  total: int) -> tuple[Automaton, np.ndarray]:
        """The automaton over these n-grams, given their corpus counts, and the word numbers by position."""
        # every training text has one begin, as it has one end
        end = counts[0][self.numbers[0, self.starts[1] - 1]] if len(self.starts) > 1 else 0
        grams = [{"counts": np.append(counts[0], end)}]
        grams += [{"counts": counts[n - 1], **self.links(n)} for n in range(2, len(counts) + 1)]
        return Automaton(grams, add, strengths, known, total), self.numbers[0]


def _ask(folds: int, order: int, ranges: int):
    """The block's single words and pairs."""
    def work(block: Block) -> Iterator[pa.RecordBatch]:
        for n, (_, keys, _, counts) in enumerate(_Grams(block, folds, min(order, 2)).orders):
            yield messages(block.block_id, ranges, keys, counts.astype(np.int64), first=n * ranges)
    return each_block(work)


def _ask_longer(folds: int, n: int, ranges: int):
    """The block's n-grams that may occur elsewhere."""
    def run(_, blocks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = Block(row)
            grams = _Grams(block, folds, n)
            asked = grams.open(n, grams.counts(told, ranges, n - 1)[-1])
            _, keys, _, counts = grams.orders[n - 1]
            out.append(messages(block.block_id, ranges, keys[asked], counts[asked].astype(np.int64),
                                first=(n - 1) * ranges))
        return pa.Table.from_batches(out, pa.schema({"range": pa.int32(), "block_id": pa.int64(), "payload": pa.binary()}))
    return run


def _count(ranges: int):
    """Corpus counts of one key range; the first row also has the words and tokens in it."""
    def run(asked: pa.Table) -> pa.Table:
        held = [unpack(p, U64, np.int64) for p in asked["payload"].to_pylist()]
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate([c for _, c in held]))
        answers, at, told = [], 0, counts[place]
        for k, _ in held:
            answers.append(pack(told[at:at + len(k)]))
            at += len(k)
        single = asked["range"][0].as_py() < ranges
        known, total = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
        known[0], total[0] = (int((counts > 0).sum()), int(counts.sum())) if single else (0, 0)
        return pa.table({"range": asked["range"], "block_id": asked["block_id"],
                         "payload": pa.array(answers, pa.binary()), "known": known, "total": total})
    return run


def _score(folds: int, order: int, ranges: int, add: float, strengths: Sequence[float], known: int,
           total: int):
    schema = pa.schema({"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(),
                        "n_known": pa.int64(), "train_tokens": pa.int64(),
                        "base_score": pa.float64(), "score": pa.float64()})

    def run(_, blocks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = Block(row)
            grams = _Grams(block, folds, order)
            counts = grams.counts(told, ranges, order)
            automaton, words = grams.automaton(counts, add, strengths, known, total)
            first = grams.starts[:-1]
            seen = (np.append(counts[0], 0) > 0)[words]
            base = automaton.root_weight[words]
            seen[first], base[first] = False, 0
            score = automaton.walk(words, grams.starts)
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(block.doc_ids, pa.int64()), pa.array(grams.held),
                 pa.array(block.sizes.astype(np.int64) + 1),
                 pa.array(np.add.reduceat(seen.astype(np.int64), first)),
                 pa.array(np.full(len(first), total, np.int64)),
                 pa.array(np.add.reduceat(base, first)), pa.array(score)],
                schema=schema))
        return pa.Table.from_batches(out, schema)
    return run


def automaton_scores(docs: DataFrame, order: int = 3, folds: int = 10, add: float = 0.1,
                     strengths: Sequence[float] = (100.0, 10.0, 10.0, 10.0)) -> DataFrame:
    """docs(doc_id, text) → (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Texts whose crc32 of the doc_id is divisible by `folds` are held out of training. `base_score`
    is the log10 probability of the text by the root alone, `score` by the automaton.
    """
    ready(docs.sparkSession)
    if not 1 <= order <= len(strengths) + 1:
        raise ValueError("a strength is needed for each order above 1")
    blocks = cut_blocks(docs, True, "lm-blocks")
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    ranges = range_count(words)
    answered = lambda asked: stored(asked.groupBy("range").applyInArrow(_count(ranges), _COUNTED), "lm-counts")
    told = answered(blocks.mapInArrow(_ask(folds, order, ranges), MESSAGE))
    for n in range(3, order + 1):
        told = told.unionByName(answered(
            blocks.select(*_LEAN).groupBy("block_id").cogroup(told.select(*_ANSWER).groupBy("block_id"))
            .applyInArrow(_ask_longer(folds, n, ranges), MESSAGE)))
    known, total = told.agg(F.coalesce(F.sum("known"), F.lit(0)),
                            F.coalesce(F.sum("total"), F.lit(0))).first()
    return (blocks.select(*_LEAN).groupBy("block_id").cogroup(told.select(*_ANSWER).groupBy("block_id"))
            .applyInArrow(_score(folds, order, ranges, add, strengths, known, total), _RESULT))
