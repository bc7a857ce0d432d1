"""The automaton of arrays next to one of dictionaries, arc by arc."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
import zstandard

from tripflow.llm import lm
from tripflow.llm.blocks import Block, pack
from tripflow.llm.words import number_words

ADD, STRENGTHS = 0.1, (3.0, 0.7)


def dictionaries(texts, order, known, total):
    """States as word tuples; arcs (state, word) -> (weight, state); failure arcs state -> (weight, state)."""
    counts = Counter(("<s>",) for _ in texts)
    for words in texts:
        row = ["<s>", *words, "</s>"]
        for n in range(1, order + 1):
            counts.update(tuple(row[i:i + n]) for i in range(n == 1, len(row) - n + 1))

    def chance(gram):
        if len(gram) == 1:
            return (counts[gram] + ADD) / (total + ADD * (known + 1))
        lower, m = chance(gram[1:]), STRENGTHS[len(gram) - 2]
        return (counts[gram] + m * lower) / (counts[gram[:-1]] + m) if counts[gram[:-1]] else lower

    states = {()} | {g for g in counts if len(g) < order}
    longest = lambda g: next(g[i:] for i in range(len(g) + 1) if g[i:] in states)
    arcs = {(g[:-1], g[-1]): (math.log10(chance(g)), longest(g[-(order - 1):] if order > 1 else ()))
            for g in counts if g != ("<s>",)}
    fails = {s: (math.log10(STRENGTHS[len(s) - 1] / (counts[s] + STRENGTHS[len(s) - 1])), s[1:]) for s in states if s}
    return states, arcs, fails, chance


def walk(words, order, states, arcs, fails, chance):
    state, total = ("<s>",) if ("<s>",) in states else (), 0.0
    for word in [*words, "</s>"]:
        while (state, word) not in arcs and state:
            weight, state = fails[state]
            total += weight
        weight, state = arcs.get((state, word), (math.log10(chance((word,))), ()))
        total += weight
    return total


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("segment", [1, 2, 5, 256])
def test_walks_are_those_of_dictionaries(order, segment):
    rnd = random.Random(order)
    texts = [[rnd.choice("abcde") for _ in range(rnd.choice([0, 1, 2, 30]))] for _ in range(40)]
    unseen = [[rnd.choice("abxyz") for _ in range(25)] for _ in range(10)]
    ids, sizes, words = number_words([" ".join(t).encode() for t in texts + unseen], True)
    block = Block({"block_id": 0, "doc_ids": list(range(50)), "sizes": pack(sizes.astype(np.int32)), "ids": pack(ids),
                   "words": zstandard.ZstdCompressor().compress(b" ".join(words))})
    grams = lm._Grams(block, 10, order)
    # counts of the first forty texts alone
    training = np.repeat(np.arange(50) < 40, sizes + 2)
    counts = [np.bincount(place[training[at]], minlength=len(keys)) for at, keys, place, _ in grams.orders]
    total, known = sum(map(len, texts)) + 40, int((counts[0] > 0).sum())
    automaton, numbers = grams.automaton(counts, ADD, STRENGTHS, known, total)
    found = automaton.walk(numbers, grams.starts, segment)
    states, arcs, fails, chance = dictionaries(texts, order, known, total)
    wanted = [walk(t, order, states, arcs, fails, chance) for t in texts + unseen]
    assert found == pytest.approx(wanted, rel=1e-9)
    assert len(automaton.fail) == len(states)
    assert len(automaton.keys) == sum(1 for (s, _) in arcs if s)


def test_higher_order_tells_held_out_texts_better(frame):
    """Texts of a second-order source: each word follows from the two before it."""
    rnd = random.Random(5)
    rule = {(a, b): rnd.choice("abcdefgh") for a in "abcdefgh" for b in "abcdefgh"}

    def text():
        row = [rnd.choice("abcdefgh"), rnd.choice("abcdefgh")]
        while len(row) < 60:
            row.append(rule[row[-2], row[-1]] if rnd.random() < 0.8 else rnd.choice("abcdefgh"))
        return " ".join(row)

    docs = frame("doc_id long, text string", [(i, text()) for i in range(200)])
    held = [lm.automaton_scores(docs, order).where("held_out").groupBy().sum("score").head()[0] for order in (1, 2, 3)]
    assert held[0] < held[1] < held[2]


def test_only_grams_that_may_occur_elsewhere_are_asked(frame, monkeypatch):
    """Blocks of one text each: the counts are those of the corpus, though few triples are sent."""
    from tripflow.llm import blocks
    monkeypatch.setattr(blocks, "BLOCK_DOCS", 1)
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcdefghij") + str(rnd.choice(["", i])) for _ in range(40)) for i in range(30)]
    rows = [*enumerate(texts), (100, texts[3]), (101, texts[4] + " end"), (102, None)]
    docs = frame("doc_id long, text string", rows).repartition(4)
    sent = []
    real = lm._ask_longer
    monkeypatch.setattr(lm, "_ask_longer", lambda *a: sent.append(a[1]) or real(*a))
    found = {r.doc_id: r.score for r in lm.automaton_scores(docs, 4, strengths=(3.0, 0.7, 0.5)).collect()}
    assert sent == [3, 4]
    monkeypatch.undo()
    whole = {r.doc_id: r.score for r in lm.automaton_scores(docs.coalesce(1), 4, strengths=(3.0, 0.7, 0.5)).collect()}
    from tests.llm.test_text_operators import model_scores
    wanted = {r[0]: r[6] for r in model_scores(rows, 4, (3.0, 0.7, 0.5))}
    assert found == pytest.approx(wanted, rel=1e-9) and whole == pytest.approx(wanted, rel=1e-9)
