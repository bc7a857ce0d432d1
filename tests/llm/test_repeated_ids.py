"""Passages cut out of rows that share a doc_id or have none."""

from __future__ import annotations

from collections import Counter

from tripflow.llm.substring import without_passages


def test_rows_of_one_id_are_cut_each_by_its_own(docs):
    passage, other = (" ".join(f"{w}{i}" for i in range(25)) for w in ("p", "q"))
    fill = lambda name: " ".join(f"{name}{i}" for i in range(30))
    rows = [(1, passage), (1, other), (5, f"{fill('a')} {passage}"), (5, f"{other} {fill('b')}"), (5, fill("c")),
            (None, f"x {passage} y"), (None, f"{fill('d')} {other}"), (None, f"{fill('d')} {other}"), (None, None)]
    cut = without_passages(docs(rows))
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == Counter(
        [rows[0], rows[1], (5, f"{fill('a')} "), (5, fill("b")), (5, fill("c")), (None, "x y"),
         *[(None, f"{fill('d')} ")] * 2, (None, None)])
