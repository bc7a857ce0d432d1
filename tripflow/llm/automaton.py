"""A weighted backoff automaton as arrays, and its walk over many texts side by side.

States are numbers, 0 the root. An arc is found by (state, word) in a sorted list and has a weight and a next
state; the root has an arc for every word. A state without an arc for a word takes its failure arc,
which has a weight and leads to the state of the context without its first word, and tries again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Words that a text is walked in one go; a longer one is cut into segments that are walked side by
#: side, each starting in the state that the words before it lead to.
SEGMENT = 256


class Automaton:
    """Built from the n-grams of a piece of text and their counts in the corpus.

    grams[n - 1] describes the distinct n-grams: `counts`, `prefix` and `suffix` (numbers of the (n - 1)-grams
    without the last and the first word) and `word` (number of the last word). Single words come
    first; the last one of them is the begin mark, which no arc carries.
    """

    def __init__(self, grams: Sequence[dict[str, np.ndarray]], add: float, strengths: Sequence[float], known: int,
                 total: int):
        self.order, self.n_words = len(grams), len(grams[0]["counts"])
        chance = (grams[0]["counts"] + add) / (total + add * (known + 1))
        # a context that training texts have is a state; those of full length have no longer history
        states, first = [np.zeros(1, np.int64)], 1
        for n in range(1, self.order):
            there = grams[n - 1]["counts"] > 0
            numbers = np.zeros(len(there), np.int64)
            numbers[there] = first + np.arange(np.count_nonzero(there))
            first += np.count_nonzero(there)
            states.append(numbers)
        self.fail = np.zeros(first, np.int64)
        self.fail_weight = np.zeros(first)
        self.root_weight = np.log10(chance)
        self.root_next = states[1] if self.order > 1 else np.zeros(self.n_words, np.int64)
        keys, weights, nexts = [], [], []
        for n in range(2, self.order + 1):
            gram, before = grams[n - 1], grams[n - 2]
            m, context = strengths[n - 2], before["counts"]
            source = states[n - 1]
            there = source > 0
            self.fail_weight[source[there]] = np.log10(m / (context[there] + m))
            if n > 2:
                self.fail[source[there]] = states[n - 2][before["suffix"][there]]
            below = chance[gram["suffix"]]
            of = context[gram["prefix"]]
            chance = np.where(of > 0, (gram["counts"] + m * below) / (of + m), below)
            seen = gram["counts"] > 0
            keys.append(source[gram["prefix"][seen]] * self.n_words + gram["word"][seen])
            weights.append(np.log10(chance[seen]))
            # the longest end of the context and the word that is a state
            nexts.append((states[n] if n < self.order else source[gram["suffix"]])[seen])
        by = np.argsort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        self.keys, self.weights, self.nexts = (np.concatenate(a)[by] if keys else np.empty(0, kind)
                                               for a, kind in ((keys, np.int64), (weights, np.float64), (nexts, np.int64)))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of one word read from each state, and the states it leads to."""
        weight = np.zeros(len(state))
        new, open_ = state.copy(), np.arange(len(state))
        while len(open_):
            at_root = new[open_] == 0
            done = open_[at_root]
            weight[done] += self.root_weight[word[done]]
            new[done] = self.root_next[word[done]]
            open_ = open_[~at_root]
            key = new[open_] * self.n_words + word[open_]
            place = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            hit = self.keys[place] == key if len(self.keys) else np.zeros(len(open_), bool)
            found = open_[hit]
            weight[found] += self.weights[place[hit]]
            new[found] = self.nexts[place[hit]]
            open_ = open_[~hit]
            weight[open_] += self.fail_weight[new[open_]]
            new[open_] = self.fail[new[open_]]
        return weight, new

    def walk(self, words: np.ndarray, starts: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """The weight of each text, read from left to right. words[starts[i]] is the begin mark of text i,
        the words after it are read; starts has the end of the last text too."""
        begin = self.root_next[words[starts[:-1]]] if len(starts) > 1 else np.empty(0, np.int64)
        lengths = starts[1:] - starts[:-1] - 1
        pieces = -(-lengths // segment)
        text = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = starts[text] + 1 + nth * segment
        size = np.minimum(lengths[text] - nth * segment, segment)
        by = np.argsort(-size, kind="stable")  # those still being read come first
        text, nth, at, size = text[by], nth[by], at[by], size[by]
        state = np.where(nth == 0, begin[text], 0)
        # the last order - 1 words before a later segment lead from the root to its state
        later = np.flatnonzero(nth > 0)
        for back in range(self.order - 1, 0, -1):
            _, state[later] = self.step(state[later], words[at[later] - back])
        total = np.zeros(len(text))
        for step in range(int(size[0]) if len(size) else 0):
            alive = int(np.searchsorted(-size, -step, side="left"))
            weight, state[:alive] = self.step(state[:alive], words[at[:alive] + step])
            total[:alive] += weight
        return np.bincount(text, total, minlength=len(lengths))
