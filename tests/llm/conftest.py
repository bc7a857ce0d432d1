from __future__ import annotations

import os

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# workers of the test session find the package where it lies
os.environ["PYTHONPATH"] = os.pathsep.join([REPO, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture
def docs(frame):
    """docs([(doc_id, text), ..]) with extra columns whose names the operators use themselves."""
    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, score double, kept string, words string"
        return frame(schema, [(d, t, extra.get("lang", "en"), 0.5, "x", "y") for d, t in rows])
    return make


#: One of each odd case: null, empty, white space, no id, a very long text, repeated rows.
ODD = [(1, None), (2, ""), (3, " \n\t\x0b "), (None, "a b c d e f"), (None, "a b c d e f"), (4, "x" * 200_000),
       (5, "word " * 30_000), (6, "one two three"), (6, "one two three"), (7, "\x1c\x85  é퟿ 😀")]
