"""Blocks that carry whole documents give them back byte for byte."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tripflow.llm.blocks import Block, Texts, cut_blocks, odd_gaps
from tripflow.llm.substring import without_passages
from tripflow.llm.words import number_words

SPACES = [" ", " ", " ", " ", "\n", "  ", "\t\r\n", "\x0b\x0c"]


def messy(rnd, n):
    """Words and white space in turn, either of them first and last."""
    parts = [rnd.choice(SPACES)] if rnd.random() < 0.3 else []
    for _ in range(n):
        parts += ["".join(rnd.choice("abé\x1c😀") for _ in range(rnd.randint(1, 4))), rnd.choice(SPACES)]
    return "".join(parts[:-1] if rnd.random() < 0.5 else parts)


def cut_by_hand(text, gone):
    """The text without the words at these places and the white space after them."""
    pieces = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
    lead = re.match(r"[\x20\x09-\x0D]*", text).group()
    return lead + "".join(p for i, p in enumerate(pieces) if i not in gone)


@pytest.mark.parametrize("seed", range(5))
def test_texts_come_back(seed):
    rnd = random.Random(seed)
    texts = [messy(rnd, rnd.randint(0, 30)) for _ in range(40)] + ["", " ", "\n\n", "a", " a", "a ", "x" * 3000]
    data = [t.encode() for t in texts]
    ids, sizes, words = number_words(data, False)
    block = Block.__new__(Block)
    block.ids, block.sizes, block.words = ids, sizes, words
    block.starts, block.gaps, block.rest = np.concatenate([[0], np.cumsum(sizes)]), odd_gaps(data, sizes), None
    held = Texts(block)
    gone = np.array([rnd.random() < 0.3 for _ in range(len(ids))], bool)
    for i, text in enumerate(texts):
        assert held.text(i, np.zeros(len(ids), bool)).decode() == text
        own = gone[block.starts[i]:block.starts[i + 1]]
        assert held.text(i, gone).decode() == cut_by_hand(text, set(np.flatnonzero(own).tolist()))


def test_rows_come_back_whole(spark, frame):
    rnd = random.Random(9)
    passage = " \n".join(f"p{i}" for i in range(40))
    rows = [(i, messy(rnd, 50), {"k": i}, [i, None], None if i % 3 else "x", 1.5) for i in range(200)]
    rows += [(500, f"a\n\n{passage}", {}, [], "y", None), (501, f"\tb {passage}  c\n", None, None, None, None),
             (502, None, None, None, None, None), (None, "", None, None, None, None)]
    schema = "doc_id long, text string, m map<string,int>, a array<int>, `odd name.x` string, rest double"
    docs = frame(schema, rows).repartition(3)
    cut = without_passages(docs)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    found = {r[0]: tuple(r) for r in cut.collect()}
    assert len(found) == len(rows)
    for row in rows:
        wanted = row if row[0] != 501 else (501, "\tb c\n", *row[2:])
        assert found[row[0]] == wanted


def test_one_block_of_many_and_none(spark, frame, monkeypatch):
    docs = frame("doc_id long, text string, x int", [(i, f"t{i} \n u", i) for i in range(50)]).coalesce(1)
    blocks = cut_blocks(docs, False, "test-blocks", carry=True).collect()
    assert len(blocks) == 1 and Texts(Block(blocks[0].asDict())).rows().num_rows == 50
    assert cut_blocks(docs.limit(0), False, "test-blocks", carry=True).count() == 0
    assert without_passages(docs.limit(0)).collect() == []


def test_runs_that_share_one_hash_are_told_apart(frame, monkeypatch):
    """With a first hash that is the same for all runs, the second one alone decides."""
    from tripflow.llm import substring, words

    class Blunt(words.Prefix):
        made = 0

        def ranges(self, starts, size):
            Blunt.made += 1
            found = super().ranges(starts, size)
            return found if Blunt.made % 2 == 0 else np.zeros_like(found)

    monkeypatch.setattr(substring, "Prefix", Blunt)
    text = lambda name: " ".join(f"{name}{i}" for i in range(30))
    block = Block.__new__(Block)
    ids, sizes, known = number_words([f"{text('a')} {text('b')}".encode(), text("a").encode()], False)
    block.ids, block.sizes, block.words, block.block_id = ids, sizes, known, 0
    block.starts, block.order = np.concatenate([[0], np.cumsum(sizes)]), np.array([1, 2])
    block.word_hashes = words.hash_words(known)
    block.hashes = block.word_hashes[ids]
    found = substring._Anchors(block, 8, 20)
    runs = substring._Runs(block, found, np.ones(len(found.keys), bool), 20)
    assert len(set(runs.keys.tolist())) == 1 and len(runs.keys) == 41  # runs of the first text
    again = runs.first[runs.key_of[runs.doc == 2]]
    assert (runs.doc[again] == 1).all() and (runs.start[again] == np.arange(11)).all()
