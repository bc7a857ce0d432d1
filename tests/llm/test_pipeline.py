"""The corpus pipeline on small tables."""

from __future__ import annotations

import random
import tempfile

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.conftest import ODD
from tripflow.llm.quality import COMMON_WORDS
from tripflow.llm.work import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string"


def corpus():
    """Clean prose, junk that each of the first stages knows, copies, near copies, a shared passage."""
    rnd = random.Random(8)
    common = COMMON_WORDS["en"].split()
    word = lambda: rnd.choice(common) if rnd.random() < 0.4 else "".join(
        rnd.choice(["an", "er", "on", "th", "in", "re"]) for _ in range(rnd.randint(2, 4)))
    prose = lambda n: [word() for _ in range(n)]
    clean = {i: prose(rnd.randint(120, 260)) for i in range(80)}
    passage = prose(60)
    clean[70][50:50], clean[71][20:20] = passage, passage
    texts = {i: " ".join(w) for i, w in clean.items()}
    texts[100] = texts[3]
    near = list(clean[4])
    near[10] = "changed"
    texts[101] = " ".join(near)
    junk = {i: " ".join(f"{w.upper()}!!" for w in prose(150)) for i in range(200, 240)}
    repeats = {240 + i: f"{word()} " * 200 for i in range(10)}
    rows = [(d, t, "en", "src", len(t), "r", "k") for d, t in {**texts, **junk, **repeats}.items()]
    labels = [(d, int(d < 200), 0) for d in (*texts, *junk, *repeats)]
    return rows, labels, passage


def run_stages(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], folder), f"test-{name}"))
    return out


@pytest.fixture
def tables(frame, tmp_path):
    def make(rows, labels):
        folder = str(tmp_path / "tables")
        frame(SCHEMA, rows).write.parquet(f"{folder}/documents.parquet")
        frame("doc_id long, quality int, toxic int", labels).write.parquet(f"{folder}/labels.parquet")
        return folder
    return make


def test_stages(spark, tables):
    rows, labels, passage = corpus()
    folder = tables(rows, labels)
    docs, ruled, scored, unique, cut, packed = run_stages(
        spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    for stage in (ruled, scored, unique, cut):
        assert stage.columns == docs.columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in (ruled, scored, unique, cut, packed)]
    clean = {*range(80), 100, 101}
    assert clean <= ids[0] and not any(d >= 240 for d in ids[0])
    assert ids[1] == clean
    assert ids[2] == ids[3] == ids[4] == set(range(80))
    texts = {r.doc_id: r for r in cut.collect()}
    given = {r[0]: r[1] for r in rows}
    assert " ".join(passage) in texts[70].text and " ".join(passage) not in texts[71].text
    assert texts[71].text.split() == given[71].split()[:20] + given[71].split()[80:]
    assert all(r.n_chars == len(r.text) for r in texts.values()) and texts[5].text == given[5]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    whole = driver.queries()["pipeline"](spark, folder)
    assert whole.columns == packed.columns and whole.count() == packed.count()


def test_rules_reject_separators_between_words(spark, frame):
    rnd = random.Random(9)
    common = COMMON_WORDS["en"].split()
    clean = lambda n: [rnd.choice(common) if rnd.random() < 0.4 else
                       "".join(rnd.choice("abcdefghi") for _ in range(13)) for _ in range(n)]
    digits = lambda n: ["".join(rnd.choice("0123456789") for _ in range(6)) for _ in range(n)]
    rows = [(i, " ".join(clean(250))) for i in range(30)] + [(30 + i, " ".join(clean(60 + 10 * i))) for i in range(10)]
    odd = [(100 + n, " | ".join(clean(n))) for n in (60, 90, 110, 150, 250)] + [(400, " ".join(digits(150)))]
    docs = frame("doc_id long, text string, lang string", [(d, t, "en") for d, t in [*rows, *odd]])
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()} == {d for d, _ in rows}


def test_stages_of_odd_rows(spark, tables):
    long = "word other third " * 200
    rows = [(d, t, None, None, None, None, None) for d, t in ODD]
    rows += [(None, " ".join(f"w{i}" for i in range(60)), "en", "s", 1, "r", "k")] * 2 + [(9, long, "zz", "s", 1, "r", "k")]
    out = run_stages(spark, spark.read.parquet(f"{(folder := tables(rows, []))}/documents.parquet"), folder)
    assert [r.doc_id for r in out[-1].collect()] == [None, None]


def test_one_row_of_each_group_of_texts_stays(spark, frame):
    """Rows that share a doc_id are judged by their own texts; equal rows are copies."""
    rnd = random.Random(3)
    x, u, z, v = (" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(60)) for _ in range(4))
    near = x.replace(x.split()[30], "other")
    schema = "doc_id long, text string, row_key string, Digest string, row_name int, n int"
    table = lambda rows: frame(schema, [(*r, "k", "d", 1, 2) for r in rows])
    stage = lambda rows: sorted((tuple(r)[:2] for r in corpus_pipeline.minhash_near_dedup(
        spark, table(rows), "").collect()), key=str)
    assert stage([(3, x), (7, u), (7, x)]) == [(3, x), (7, u)]
    assert stage([(9, z), (9, z)]) == [(9, z)]
    assert stage([(9, z), (9, z), (9, None), (9, "")]) == sorted([(9, z), (9, None), (9, "")], key=str)
    assert stage([(1, x), (2, near), (4, u), (None, x), (None, x), (5, None)]) == [
        (1, x), (4, u), (5, None), *[(None, x)] * 2]
    assert stage([(2, x), (2, near), (2, u), (1, v), (6, v), (6, x)]) in (
        sorted([(a, b) for a, b in r], key=str) for r in (
            [(2, x), (2, u), (1, v)], [(2, near), (2, u), (1, v)], [(6, x), (2, u), (1, v)]))
    assert stage([((1 << 63) - 1, x), ((1 << 63) - 1, u), (0, x)]) in (
        [(0, x), ((1 << 63) - 1, u)], [((1 << 63) - 1, x), ((1 << 63) - 1, u)])
    assert stage([]) == []


def test_private_tables_go(spark, tables, tmp_path):
    import os
    from tripflow.session import work_root
    rows, labels, _ = corpus()
    docs = spark.read.parquet(f"{tables(rows, labels)}/documents.parquet")
    before = set(os.listdir(work_root(spark)))
    corpus_pipeline.minhash_near_dedup(spark, docs, "").collect()
    new = {n.rsplit("-", 1)[0] for n in set(os.listdir(work_root(spark))) - before}
    assert new == {"near-duplicates"}


def test_names_of_extra_columns_do_not_clash(spark, frame):
    rows, labels, _ = corpus()
    extra = ["quality_score", "rest", "absent", "block_id", "row", "kept", "row_key", "spans", "gaps", "Doc", "chars"]
    schema = SCHEMA.replace(", row string, kept string", "") + "".join(f", {c} string" for c in extra)
    docs = frame(schema, [(*r[:5], *extra) for r in rows])
    model = frame("doc_id long, quality int, toxic int", labels)
    folder = f"{tempfile.mkdtemp()}"
    model.write.parquet(f"{folder}/labels.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, out, folder), f"test-{name}")
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.select(*extra).distinct().collect()] == [tuple(extra)]
    assert corpus_pipeline.STAGES[-1][1](spark, out, folder).count() > 0


def test_stages_of_nothing(spark, tables):
    folder = tables([], [])
    out = run_stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert [s.count() for s in out] == [0] * 6


def test_the_guard_is_the_drivers():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in driver.queries() if k.startswith("op")}
    assert set(driver.oracle_sql()) <= set(driver.queries())
