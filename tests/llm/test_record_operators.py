"""Archives, vectors, tool calls and the classifier next to brute force."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set
from tests.llm.conftest import ODD
from tripflow.llm import vectors, warc
from tripflow.llm.classifier import (Model, held_out, quality_scores, score_documents, text_features,
                                     train)
from tripflow.llm.components import components
from tripflow.llm.queries import TOOLS, tool_messages
from tripflow.llm.toolcalls import canonical, link_tool_calls, violations
from tripflow.llm.vectors import near_vectors
from tripflow.llm.warc import cuts, read_archives, read_records, write_archives

MARK = "\r\n\r\nWARC/1.1\r\n"


# --- archives ---

def test_cuts_stay_inside_characters_and_separators():
    payload = ("é" * 10 + MARK + "x" * 7 + MARK * 2).encode()
    stops = cuts(payload, 6)
    assert stops[-1] == len(payload) and stops == sorted(set(stops))
    parts = [payload[a:b] for a, b in zip([0, *stops], stops)]
    assert max(map(len, parts)) <= 6 and not any(b"WARC/1.1" in p for p in parts)
    assert all(p.decode() for p in parts)
    assert cuts(b"", 6) == [0] and len(cuts(b"\x80" * 1000, 100)) == 11


@pytest.fixture
def pages(frame):
    return lambda rows: frame("page_id long, url string, html string, digest string, refers_to string",
                              [(*r, "x", "y") for r in rows])


def test_archives_round_trip(spark, pages, tmp_path):
    long, other = "long page ü " * 300, "q" * 5000
    rows = [(1, "http://a\r\nb", None), (2, None, ""), (3, "u", long), (4, "u", long), (5, "u", long),
            (6, "u", "short"), (7, "u", "short"), (8, "u", f"a{MARK}b{MARK}"), (9, "u", MARK * 200),
            (10, "u", other), (-11, "u", "ends with breaks\r\n\r\n"), (12, "u", "\r\n" * 400 + "x" * 300),
            (13, "u", "😀" * 3000), (14, "u", "Content-Length: 5\r\n\r\nWARC/1.1"), (15, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
            (16, "u", "z" * 1024 + "WARC/1.1\r\n" * 3)]
    path = str(tmp_path / "archives")
    write_archives(pages(rows), path, chunk_bytes=1024, records_per_file=5, compression="none")
    packed = str(tmp_path / "packed")
    write_archives(pages(rows), packed, chunk_bytes=1024, records_per_file=5)
    assert row_set(read_archives(spark, packed)) == row_set(read_archives(spark, path))
    found = {r.page_id: r for r in read_archives(spark, path).collect()}
    payloads = {d: (h or "").encode() for d, _, h in rows}
    assert set(found) == set(payloads)
    for d, payload in payloads.items():
        r, winner = found[d], 5 if d in (3, 4) else d
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if winner == d else ("revisit", 5))
    chunks = read_records(spark, path).groupBy("page_id").agg(F.count("*").alias("n"), F.max(
        F.octet_length("payload")).alias("top")).collect()
    assert max(r.top for r in chunks) <= 1024 and {r.page_id: r.n for r in chunks}[13] == 12
    texts = "".join(f.read_bytes().decode() for f in sorted((tmp_path / "archives").glob("part-*")))
    assert texts.startswith("WARC/1.1\r\n") and texts.endswith("\r\n\r\n")
    assert "WARC-Segment-Origin-ID: <urn:page:13:" in texts


def test_damaged_archives_are_noticed(spark, pages, tmp_path):
    path = tmp_path / "archives"
    write_archives(pages([(1, "u", "one"), (2, "u", "y" * 3000)]), str(path), chunk_bytes=1000, compression="none")
    files = [f for f in path.glob("part-*") if f.stat().st_size]
    whole = {f: f.read_bytes() for f in files}

    def damaged(change):
        for f, data in whole.items():
            f.write_bytes(change(data))
            crc = f.with_name(f".{f.name}.crc")
            if crc.exists():
                crc.write_bytes(b"")
                crc.unlink()
        with pytest.raises(Exception, match="damaged|broken|missing"):
            read_archives(spark, str(path)).collect()

    damaged(lambda d: d.replace(b"one", b"two"))
    damaged(lambda d: d.replace(b"yyy\r\n\r\n", b"yyz\r\n\r\n", 1))
    damaged(lambda d: d.replace(b"one", b"only some more"))


def test_archives_of_nothing(spark, pages, tmp_path):
    write_archives(pages([]), str(tmp_path / "none"))
    assert read_archives(spark, str(tmp_path / "none")).count() == 0


def test_archives_of_repeated_and_unnamed_pages(spark, pages, tmp_path):
    one, two = "a" * 3000, "b" * 3000
    rows = [(1, "u", one), (1, "u", one), (1, "u", two), (2, "u", two), (None, "u", one), (None, None, one),
            (None, "u", "x"), (0, "u", one)]
    write_archives(pages(rows), str(tmp_path / "odd"), chunk_bytes=1000)
    found = [tuple(r) for r in read_archives(spark, str(tmp_path / "odd")).collect()]
    digest = {t: hashlib.sha1(t.encode()).hexdigest() for t in (one, two, "x")}
    kept = lambda d, t: (d, len(t), digest[t], "response", None)
    assert Counter(found) == Counter([
        kept(1, one), kept(1, one), (1, 3000, digest[two], "revisit", 2), kept(2, two), kept(None, one),
        kept(None, one), kept(None, "x"), (0, 3000, digest[one], "revisit", 1)])


# --- components ---

def test_components(frame):
    rnd = random.Random(1)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)]
    links += [(3, 3), (300, 300), (None, 4), (5, None)] + [(400, 401 + i) for i in range(50)] * 2
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = components(frame("a long, b long", links)).collect()
    assert {(r.id, r.component) for r in found} == {(x, find(x)) for x in list(root)}
    assert len(found) == len(root)
    assert components(frame("a long, b long", [])).count() == 0


# --- vectors ---

def by_force(rows, cosine, width):
    units = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.zeros(width)
            x[:len(v)] = v
            units.setdefault(i, []).append(x / np.sqrt(x @ x))
    ids = sorted(i for i, _ in rows)
    counts, root = dict.fromkeys(ids, 0), {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and a in units and b in units and units[a][0] @ units[b][0] >= cosine:
                counts[a] += 1
                counts[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (counts[i], find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("block,inner", [(2048, 256), (8, 3)])
def test_near_vectors(frame, block, inner, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "INNER_ROWS", inner)
    monkeypatch.setattr(vectors, "FAN_BITS", 2)
    rnd = np.random.default_rng(block)
    centres = rnd.normal(size=(12, 6))
    rows = [(i, [float(x) for x in np.float32(centres[i % 12] * rnd.uniform(0.5, 2) + rnd.normal(size=6) * 0.25)])
            for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(20)]
    rows += [(300, None), (301, []), (302, [0.0, -0.0]), (303, [1.0, None]), (304, [float("nan"), 1.0]),
             (305, [float("inf")]), (306, [1e30, 1e30]), (307, [2.0, 2.0, 0.0]), (308, [1e-30])]
    df = frame("vec_id long, embedding array<float>, label int, n_links int", [(*r, 1, 2) for r in rows])
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, count=4).collect()}
    assert found == by_force(rows, 0.95, 6)


def test_near_vectors_of_odd_tables(frame):
    schema = "vec_id long, embedding array<double>"
    assert near_vectors(frame(schema, [])).count() == 0
    lonely = near_vectors(frame(schema, [(1, None), (2, [0.0])])).collect()
    assert {tuple(r) for r in lonely} == {(1, 0, 1, True), (2, 0, 2, True)}
    odd = near_vectors(frame(schema, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert sorted(tuple(r) for r in odd if r.vec_id) == [(1, 1, 1, True)] * 2
    assert [tuple(r) for r in odd if r.vec_id is None] == [(None, 0, None, True)]


# --- tool calls ---

SCHEMA = {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
    "q": {"type": "string", "minLength": 2}, "n": {"type": ["integer", "null"], "minimum": 1, "maximum": 9},
    "kind": {"enum": ["a", "b"]}, "tags": {"type": "array", "items": {"type": "string"}},
    "in": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number"}}}}}


@pytest.mark.parametrize("value,wrong", [
    ({"q": "ok"}, []), ({"q": "x"}, ["q: too short"]), ({}, ["q: missing"]), ([], ["arguments: not object"]),
    ({"q": "ok", "z": 1}, ["z: not allowed"]), ({"q": "ok", "n": 2.0}, []), ({"q": "ok", "n": None}, []),
    ({"q": "ok", "n": 0}, ["n: too small"]), ({"q": "ok", "n": 10}, ["n: too large"]),
    ({"q": "ok", "n": True}, ["n: not integer or null"]), ({"q": "ok", "n": 1.5}, ["n: not integer or null"]),
    ({"q": "ok", "kind": "c"}, ["kind: not one of the values"]),
    ({"q": "ok", "tags": ["a", 1]}, ["tags[1]: not string"]), ({"q": "ok", "in": {"x": "1"}}, ["in.x: not number"]),
    ({"q": "ok", "in": {}}, ["in.x: missing"])])
def test_violations(value, wrong):
    assert violations(value, SCHEMA) == wrong


MESSAGES = ("conv_id long, turn long, kind string, call_id string, name string, arguments string, "
            "depends_on array<string>, content string, step int, status string")


def test_linked_calls(frame):
    good = '{"q": "über", "n": 1}'
    rows = [
        (1, 5, "call", "c", "find", '{ "n":1, "q":"über" }', ["b", "a", "b", None], None),
        (1, 3, "call", "b", "find", good, ["a"], None), (1, 1, "call", "a", "find", good, None, None),
        (1, 2, "result", "a", None, None, None, "first"), (1, 4, "result", "a", None, None, None, "second"),
        (1, 9, "result", "zz", None, None, None, "lost"), (1, 0, "text", "a", None, None, None, "hello"),
        (1, 8, "call", "a", "find", good, None, None), (2, 1, "result", "b", None, None, None, "other talk"),
        (2, 2, "call", "x", "find", good, ["y"], None), (2, 3, "call", "y", "find", good, ["x"], None),
        (2, 4, "call", "w", "find", good, ["y"], None), (2, 5, "call", "s", "find", good, ["s"], None),
        (3, 1, "call", "u", "nope", good, None, None), (3, 2, "call", "m", "find", "{", None, None),
        (3, 3, "call", "l", "find", "[1]", None, None), (3, 4, "call", "n", "find", None, None, None),
        (3, 5, "call", "i", "find", '{"q": 1}', None, None), (3, 6, "call", "d", "find", good, ["gone"], None),
        (3, None, "call", "o", "find", good, None, None), (3, None, "result", "o", None, None, None, None),
        (None, 1, "call", "a", "find", good, None, None), (3, 7, "call", None, "find", good, None, None),
        (3, 8, "call", "inf", "find", '{"q": Infinity}', None, None),
        (3, 9, "call", "half", "find", '{"q": "\\ud800"}', None, None)]
    found = link_tool_calls(frame(MESSAGES, [(*r, 7, "x") for r in rows]), {"find": SCHEMA}).collect()
    assert len(found) == len(rows) - 2  # two results are part of their calls
    state = {(r.conv_id, r.turn, r.call_id): (r.step, r.status) for r in found if r.turn is not None}
    assert state == {
        (1, 0, "a"): (None, "message"), (1, 1, "a"): (0, "ok"), (1, 3, "b"): (1, "unanswered"), (1, 5, "c"): (2, "unanswered"),
        (1, 4, "a"): (None, "extra_result"), (1, 9, "zz"): (None, "orphan"), (1, 8, "a"): (None, "duplicate"),
        (2, 1, "b"): (None, "orphan"), (2, 2, "x"): (None, "cycle"), (2, 3, "y"): (None, "cycle"),
        (2, 4, "w"): (None, "cycle"), (2, 5, "s"): (None, "cycle"), (3, 1, "u"): (0, "unknown_tool"),
        (3, 2, "m"): (0, "malformed"), (3, 3, "l"): (0, "malformed"), (3, 4, "n"): (0, "malformed"),
        (3, 5, "i"): (0, "invalid"), (3, 6, "d"): (0, "dangling"), (None, 1, "a"): (None, "unidentified"),
        (3, 7, None): (None, "unidentified"), (3, 8, "inf"): (0, "malformed"), (3, 9, "half"): (0, "malformed")}
    rest = {r.call_id: r for r in found}
    assert rest["o"].status == "ok" and rest["i"].errors == ["q: not string"]
    texts = {(r.conv_id, r.call_id): r.json for r in found if r.status in ("ok", "unanswered")}
    assert texts[1, "c"] == ('{"arguments":{"n":1,"q":"über"},"conversation":1,"depends_on":["a","b"],"id":"c",'
                             '"name":"find","result":null,"step":2}')
    assert json.loads(texts[1, "a"])["result"] == "first"
    # equal calls are equal texts
    assert canonical(json.loads(texts[1, "a"])) == texts[1, "a"]
    assert link_tool_calls(frame(MESSAGES, []), {}).count() == 0


def steps_by_hand(calls):
    """Step of each call; None where a cycle holds it back."""
    steps, moved = {}, True
    while moved:
        moved = False
        for name, needs in calls.items():
            needs = {n for n in needs if n in calls}
            if name not in steps and needs <= steps.keys():
                steps[name], moved = max((steps[n] + 1 for n in needs), default=0), True
    return {name: steps.get(name) for name in calls}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_steps_of_random_graphs(frame, seed):
    """Chains, trees, ladders and cycles in several conversations, next to settling by hand."""
    rnd = random.Random(seed)
    graphs, rows = {}, []
    for conv in range(8):
        n = rnd.choice([1, 5, 30, 60])
        shape = rnd.choice(["chain", "tree", "ladder", "any", "cycles"])
        calls = {}
        for i in range(n):
            earlier = {"chain": [i - 1], "tree": [(i - 1) // 2], "ladder": [i - 1, i - 2],
                       "any": rnd.sample(range(max(i, 1)), rnd.randint(0, min(i, 3))) + [i - 1] * (rnd.random() < 0.5),
                       "cycles": [rnd.randrange(n) for _ in range(rnd.choice([0, 1, 1, 1, 2]))]}[shape]
            calls[f"c{i}"] = {f"c{j}" for j in earlier if j >= 0} | ({"gone"} if rnd.random() < 0.1 else set())
        graphs[conv] = steps_by_hand(calls)
        rows += [(conv, i, "call", name, "find", '{"q": "x"}', sorted(needs) or None, None, 1, "x")
                 for i, (name, needs) in enumerate(calls.items())]
    rnd.shuffle(rows)
    found = link_tool_calls(frame(MESSAGES, rows), {"find": SCHEMA}).collect()
    assert len(found) == len(rows)
    assert {(r.conv_id, r.call_id): r.step for r in found} == {
        (conv, name): step for conv, steps in graphs.items() for name, step in steps.items()}
    assert {r.status == "cycle" for r in found if r.step is None} <= {True}


def test_a_long_chain_takes_few_rounds(frame, monkeypatch):
    from tripflow.llm import toolcalls
    stores = []
    real = toolcalls.stored
    monkeypatch.setattr(toolcalls, "stored", lambda df, label: stores.append(label) or real(df, label))
    rows = [(1, i, "call", f"c{i}", "find", '{"q": "x"}', [f"c{i - 1}"] if i else None, None, 1, "x") for i in range(300)]
    found = link_tool_calls(frame(MESSAGES, rows), {"find": SCHEMA}).collect()
    assert {(r.call_id, r.step) for r in found} == {(f"c{i}", i) for i in range(300)}
    assert stores.count("chain-moved") <= 10 and stores.count("heard") <= 2


def test_every_turn_is_a_row_or_a_result(frame):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "question " * 9), (1, 2, "tool", "answer"), (1, 3, None, "?"),
            (2, 0, "user", "question " * 9), (2, 1, "assistant", "a"), (2, 2, "user", "more " * 9), (2, 3, "judge", "b"),
            (3, 0, "user", "q " * 30), (3, 1, "assistant", "a"), (3, 2, "user", "r " * 30), (3, 3, "assistant", "a"),
            (3, 4, "user", "s " * 30), (None, 5, "user", "x")]
    messages = tool_messages(frame("conv_id long, turn long, role string, text string", rows))
    found = {(r.conv_id, r.turn): r for r in link_tool_calls(messages, TOOLS).collect()}
    assert {k: r.status for k, r in found.items()} == {
        (1, 0): "message", (1, 1): "ok", (1, 3): "message", (2, 0): "ok", (2, 2): "unanswered", (2, 3): "message",
        (3, 0): "ok", (3, 2): "ok", (3, 4): "unanswered", (None, 5): "unidentified"}
    assert [found[3, t].step for t in (0, 2, 4)] == [0, 1, 2]
    assert json.loads(found[1, 0].json)["result"] == "s" and json.loads(found[1, 1].json)["result"] == "answer"


def test_turns_as_calls(frame):
    rows = [(4, i, "user" if i % 2 == 0 else "assistant", f"text number {i} " * 4) for i in range(16)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "short"), (2, 2, "assistant", None), (2, 3, "user", None)]
    messages = tool_messages(frame("conv_id long, turn long, role string, text string", rows))
    found = {(r.conv_id, r.turn): r for r in link_tool_calls(messages, TOOLS).collect()}
    steps = {t // 2: r.step for (c, t), r in found.items() if c == 4}
    assert steps == {0: 0, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 2, 7: 3}
    assert {r.status for (c, _), r in found.items() if c == 4} == {"ok"}
    assert found[2, 1].status == "invalid" and found[2, 3].status == "invalid"


# --- classifier ---

def junk_and_prose(n: int, seed: int):
    rnd = random.Random(seed)
    syllables = ["the", "an", "er", "on", "re", "he", "in", "ed", "nd", "ha"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3)))
    rows = []
    for i in range(n):
        bad = rnd.random() < 0.3
        tokens = [word() for _ in range(rnd.randint(5, 60))]
        if bad:
            tokens = [[t.upper() + "!!" for t in tokens], [rnd.choice(tokens)] * len(tokens),
                      [x for t in tokens for x in (t, "|")]][i % 3]
        rows.append((i, " ".join(tokens), int(not bad)))
    return rows


def test_features_are_those_of_the_words():
    """Words, neighbouring words and n-grams with the words' borders, each once per occurrence."""
    def count(text):
        return len(np.concatenate(list(text_features(text, (3, 4), 20))))
    # word + n-grams of " abc "
    assert count("abc") == 1 + 3 + 2 and count("") == 0 and count(" \n ") == 0
    assert count("abc\tabc") == 2 * 6 + 1
    a, b = (set(np.concatenate(list(text_features(t, (3, 4), 30))).tolist()) for t in ("xx yy", "yy  xx"))
    assert len(a - b) == len(b - a) == 1  # only the pair differs
    same = [set(np.concatenate(list(text_features(f"{w} {w}", (3,), 30))).tolist()) for w in ("ab", "cd")]
    assert len(same[0] & same[1]) == 1  # a repeat is one sign


def test_long_texts_go_in_slices(monkeypatch):
    import tripflow.llm.classifier as c
    texts = ["some words here " * 50, "x" * 999 + " yy " + "z" * 205, " \n a\tb" * 40, "", "ab " * 67, " " * 300, "é" * 100]
    whole = [sorted(np.concatenate(list(text_features(t, (1, 3, 4), 16))).tolist()) for t in texts]
    for size in (1, 2, 3, 7, 100):
        monkeypatch.setattr(c, "_SLICE", size)
        for text, wanted in zip(texts, whole):
            parts = list(text_features(text, (1, 3, 4), 16))
            assert len(parts) == max(1, -(-len(text) // size))
            assert sorted(np.concatenate(parts).tolist()) == wanted


def test_classifier_on_held_out_rows(frame):
    rows = junk_and_prose(900, 1)
    df = frame("doc_id long, text string, held_out int, predicted int, quality int", [(d, t, 1, 2, 1 - q) for d, t, q in rows])
    labels = frame("doc_id long, quality int, text string", [(d, q, "z") for d, _, q in rows]
                   + [(rows[0][0], rows[0][2], "z"), (5000, 1, "z"), (None, 1, "z"), (7, None, "z")])
    found = {r.doc_id: r for r in quality_scores(df, labels).collect()}
    held = [(found[d], q) for d, _, q in rows if found[d].held_out]
    assert 120 < len(held) < 240 and all(0 <= r.score <= 1 for r, _ in held)
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    assert {d for d, r in found.items() if r.held_out} == {
        r.doc_id for r in df.where(held_out(F.col("doc_id"), 5)).collect()}


def test_the_sample_is_bounded(frame):
    rows = junk_and_prose(200, 2)
    df, labels = frame("doc_id long, text string", [r[:2] for r in rows]), frame(
        "doc_id long, quality int", [(d, q) for d, _, q in rows])
    seen = []

    class Spy(Model):
        def fit(self, texts, *args):
            seen.append(texts)
    import tripflow.llm.classifier as c
    original, c.Model = c.Model, Spy
    try:
        train(df, labels, sample_rows=40)
        train(df, labels, sample_chars=2000)
    finally:
        c.Model = original
    assert len(seen[0]) == 40 and sum(map(len, seen[1])) <= 2000 and len(seen[1]) > 1


def test_what_does_not_fit_the_sample_is_left_out(frame, monkeypatch):
    import tripflow.llm.classifier as c
    rows = junk_and_prose(200, 3)
    free = [r[0] for r in frame("doc_id long", [(d,) for d, _, _ in rows]).where(~held_out(F.col("doc_id"), 5)).collect()]
    texts = {d: t for d, t, _ in rows}
    seen = []

    class Spy(Model):
        def fit(self, texts, *args):
            seen.append(texts)
    monkeypatch.setattr(c, "Model", Spy)
    df = lambda t: frame("doc_id long, text string", [*t])
    labels = frame("doc_id long, quality int", [(d, q) for d, _, q in rows] + [(d, 1) for d in range(1000, 4000)])
    total = sum(len(texts[d]) for d in free)
    # wherever a text beyond the limit stands in the sample, the others are taken
    for long in free[:3]:
        train(df((texts | {long: "x" * (total + 1)}).items()), labels, sample_chars=total)
        assert sorted(seen[-1]) == sorted(texts[d] for d in free if d != long)
    # labels of documents that are not there use up nothing
    train(df(texts.items()), labels, sample_rows=len(free))
    assert len(seen[-1]) == len(free)
    # rows of one doc_id stay within the limits
    train(df([*texts.items(), *[(free[0], "again")] * 500]), labels, sample_rows=300)
    assert len(seen[-1]) == len(free) - 1


def test_training_starts_no_python_workers(frame, monkeypatch):
    from pyspark import SparkContext
    rows = junk_and_prose(200, 4)
    df, labels = frame("doc_id long, text string", [r[:2] for r in rows]), frame(
        "doc_id long, quality int", [(d, q) for d, _, q in rows])
    called = []
    original = SparkContext.parallelize
    # rows dealt out from a list pass through workers on the executors, beside those of the operators
    monkeypatch.setattr(SparkContext, "parallelize", lambda *a, **b: called.append(a) or original(*a, **b))
    model = train(df, labels)
    assert not called
    scores = {r.doc_id: r.score for r in score_documents(df, model).collect()}
    assert np.mean([(scores[d] >= 0.5) == q for d, _, q in rows]) > 0.95


def test_scores_of_odd_rows(docs, frame):
    none = frame("doc_id long, quality int", [])
    found = quality_scores(docs(ODD), none).collect()
    assert len(found) == len(ODD) and {(r.score, r.predicted) for r in found} == {(0.5, 1)}
    assert [r.held_out for r in found if r.doc_id is None] == [True, True]
    one_class = quality_scores(docs([(1, "a"), (2, "b"), (3, None)]), frame(
        "doc_id long, quality int", [(1, 1), (2, 1), (3, 1)])).collect()
    assert all(r.score > 0.9 for r in one_class)
    assert quality_scores(docs([]), none).count() == 0
    with pytest.raises(ValueError):
        score_documents(docs([]), Model(4, (3,), 2, 1))
