"""Clustering, whitening and the URL filter next to brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tripflow.llm.centroids import cluster_vectors, pack, unpack
from tripflow.llm.eigen import counts_below, leading_eigenpairs, tridiagonal
from tripflow.llm.queries import URL_RULES
from tripflow.llm.url_labels import labelled_rows, labelled_urls
from tripflow.llm.urls import UrlModel, judge_urls, train
from tripflow.llm.whitening import deviations, whiten

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, n string, data string, names string"


@pytest.fixture
def vectors(frame):
    return lambda rows: frame(VECTORS, [(i, v, 1, "c", "n", "d", "m") for i, v in rows])


def some(count, width, seed, groups=5):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.4, (groups, width))
    rows = centres[rnd.integers(0, groups, count)] + rnd.normal(0, 0.1, (count, width))
    return rows.astype(np.float32).tolist()


ODD_VECTORS = [(None, None), (900, None), (901, []), (902, [0.5] * 3), (903, [float("nan")] + [0.0] * 7),
               (904, [float("inf")] + [0.0] * 7), (905, [float("-inf")] + [0.0] * 7), (906, [None] + [0.0] * 7),
               (907, [0.5] * 9)]


def lloyd(rows, clusters, rounds, scale=64):
    """The rounds with Python's own numbers; rows of usable vectors only."""
    points = [[math.floor(scale * x) for x in v] for _, v in rows]
    place = lambda i: ((1, "") if rows[i][0] is None else
                       (0, hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest()))
    first = sorted(range(len(rows)), key=lambda i: (place(i), points[i]))[:clusters]
    centroids = [points[i] for i in first]
    for turn in range(rounds + 1):
        best = []
        for p in points:
            best.append(min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(centroids)))
        if turn < rounds:
            for k in range(len(centroids)):
                own = [p for p, (_, b) in zip(points, best) if b == k]
                if own:
                    centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    total = sum(d for d, _ in best)
    out = []
    for (name, _), (d, k) in zip(rows, best):
        digest = hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
        out.append((name, k, d, sum(x for x, b in best if b == k), total, digest))
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("shard_columns", [1, 3, 8, 100])
def test_clusters_are_lloyds(vectors, shard_columns):
    rows = list(enumerate(some(300, 8, 1)))
    found = cluster_vectors(vectors(rows + ODD_VECTORS), 6, 3, 8, 64, shard_columns)
    assert found.columns == COLUMNS
    assert as_rows(found) == sorted(lloyd(rows, 6, 3), key=str)


def test_clusters_with_ties_copies_and_names(vectors):
    """Equal distances go to the smaller number; repeated ids, missing ids and copies are rows."""
    grid = [[float(x), float(y)] for x in (-1, 0, 1) for y in (-1, 0, 1)]
    rows = [(i, v) for i, v in enumerate(grid * 3)] + [(3, grid[0]), (3, grid[5]), (None, grid[1]), (None, grid[7])]
    random.Random(1).shuffle(rows)
    assert as_rows(cluster_vectors(vectors(rows), 7, 2, 2)) == sorted(lloyd(rows, 7, 2), key=str)


def test_clusters_of_few_or_no_vectors(vectors):
    rows = [(i, v) for i, v in enumerate(some(3, 8, 2))]
    assert as_rows(cluster_vectors(vectors(rows), 16, 3, 8)) == sorted(lloyd(rows, 16, 3), key=str)
    assert cluster_vectors(vectors([]), 16, 3, 8).collect() == []
    assert cluster_vectors(vectors(ODD_VECTORS), 16, 3, 8).collect() == []
    same = [(i, [0.25] * 8) for i in range(40)]  # all centroids but the first are empty and stay
    assert as_rows(cluster_vectors(vectors(same), 4, 3, 8)) == sorted(lloyd(same, 4, 3), key=str)


def test_clusters_in_many_blocks(spark, vectors):
    rows = list(enumerate(some(5000, 8, 3)))
    assert as_rows(cluster_vectors(vectors(rows).repartition(11), 5, 2, 8)) == sorted(lloyd(rows, 5, 2), key=str)


def test_cluster_limits(vectors):
    with pytest.raises(ValueError):
        cluster_vectors(vectors([]), 0)
    with pytest.raises(ValueError):
        cluster_vectors(vectors([]), 4, scale=3)
    with pytest.raises(Exception, match="2\\^26"):
        cluster_vectors(vectors([(1, [1e9] * 8)]), 2, 1, 8).collect()


def test_matrices_are_packed_whole():
    for top in (1, 127, 128, 40_000, 1 << 40):
        numbers = np.array([[top, -top], [0, 5]])
        assert (unpack(pack(numbers), 2) == numbers).all()
    assert unpack(pack(np.empty((0, 3), np.int64)), 3).shape == (0, 3)


@pytest.mark.parametrize("n, kind", [(n, k) for n in (1, 2, 3, 30) for k in ("random", "equal", "pairs", "rank")])
def test_eigenpairs(n, kind):
    rnd = np.random.default_rng(n)
    turned = np.linalg.qr(rnd.normal(size=(n, n)))[0]
    values = {"random": rnd.uniform(0, 5, n), "equal": np.full(n, 3.0), "pairs": np.arange(n) // 2 + 1.0,
              "rank": np.where(np.arange(n) < 2, 7.0, 0)}[kind]
    matrix = (turned * values) @ turned.T
    matrix = (matrix + matrix.T) / 2
    found, axes = leading_eigenpairs(matrix, 20)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:20]
    assert np.abs(found - wanted).max() < 1e-13 * 10
    assert np.abs(matrix @ axes - axes * found).max() < 1e-13 * 10
    assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-12
    diagonal, off, _ = tridiagonal(matrix)
    assert counts_below(diagonal, off, np.array([-1.0, 100.0])).tolist() == [0, n]


def whitened_by_hand(rows, width, count, scale=64):
    x = np.array([[math.floor(scale * c) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return deviation, values[order], centred @ axes[:, order] / np.sqrt(values[order]), values.sum()


def check_whitening(df, rows, width, count):
    deviation, values, wanted, trace = whitened_by_hand(rows, width, count)
    got = df.collect()
    assert len(got) == len(rows) * len(values) and {r.n for r in got} == {len(rows)}
    assert all(r.identity_error < 1e-9 for r in got)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-9)
    signs = {}
    for (name, _), d, row in zip(rows, deviation, wanted):
        for component, w in enumerate(row, 1):
            found = by_row[name, d][component]
            sign = signs.setdefault(component, 1 if any(math.isclose(f, w, abs_tol=1e-8) for f in found) else -1)
            assert any(math.isclose(sign * f, w, abs_tol=1e-8) for f in found)


def test_whitening_is_that_of_the_covariance(vectors):
    rows = [(i, v) for i, v in enumerate(some(400, 12, 5, groups=9))]
    df = whiten(vectors(rows + [(None, None), (900, None), (903, [float("nan")] * 12), (906, [None] * 12)]).repartition(5), 7)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(df, rows, 12, 7)
    assert {r.component for r in whiten(vectors(rows), 32).select("component").distinct().collect()} == set(range(1, 13))


def test_whitening_pads_short_vectors_and_keeps_rows(vectors):
    rows = [(i, v) for i, v in enumerate(some(60, 4, 6, groups=20))] + [(7, [0.5]), (7, []), (None, [0.25, -3.0])]
    check_whitening(whiten(vectors(rows), 4), rows, 4, 4)


def test_whitening_without_variance(vectors):
    schema = whiten(vectors([(1, [0.1, 0.2]), (2, [0.9, 0.8])])).schema
    for rows in ([], [(1, [0.5, 0.5])], [(i, [0.5, 0.25]) for i in range(9)], [(1, []), (2, [])], [(1, None)]):
        empty = whiten(vectors(rows))
        assert empty.collect() == [] and [f.dataType for f in empty.schema] == [f.dataType for f in schema]
    line = [(i, [i / 8, i / 4, 0.5]) for i in range(20)]  # rank one: one component
    assert {r.component for r in whiten(vectors(line)).collect()} == {1}


def test_deviations_are_exact():
    assert deviations(np.array([[3, -2]]), [5, -7], 10) == [(30 - 5) ** 2 + (-20 + 7) ** 2]
    large = np.array([[1 << 27, -(1 << 26)]])
    assert deviations(large, [1 << 20, 3], 4) == [(4 * (1 << 27) - (1 << 20)) ** 2 + (4 * -(1 << 26) - 3) ** 2]
    assert deviations(large, [0, 0], 1 << 40) == [None]
    with_gap = [(1, 2.0**30)]
    assert with_gap[0][1] * 64 < 1 << 40


PAGES = "page_id long, url string, html string, score double, host string, rule string"


@pytest.fixture
def pages(frame):
    return lambda rows: frame(PAGES, [(i, u, "h", 0.5, "x", "y") for i, u in rows])


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def judged_by_hand(url, rules, model, threshold):
    host, path = cut(url)
    fits = []
    for text, says in rules:
        name, _, start = text.partition("/")
        start = "/" + start if "/" in text else ""
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            fits.append((len(text), len(name), says == "block", text, says))
    own = "block" if model.score(host, path) >= threshold else "allow"
    return (host, path, fits and max(fits)[3] or None, max(fits)[4] if fits else own)


URLS = [None, "", "no scheme", "http://", "://", "http://org/", "http://ORG", "https://a.org/x?y=/z#/w", "ftp://xorg/",
        "http://example.org/es/1", "http://www.Example.ORG/es", "http://example.org/en/12", "http://example.org/en/2",
        "http://example.org/en/1?x", "http://a.com/fr/1", "http://a.com/de/1", "http://com/de/", "http://a.com/en/1",
        "https://a.com#/de/", "https://a.com?/de/", "http://user:pw@a.com:80/de/x", "http://a.com/de", "x://y://org/",
        "http://exämple.ÄRG/Straße/ß", "http://a.net/\n/b\nc", "http://casino-bets.net/1", "http://garden.net/1",
        "http://a.com//fr/", "HTTP://CHEAP-PILLS.NET/", "http://" + "a" * 100_000 + ".org/" + "b" * 100_000]


def test_urls_are_judged_by_rules_then_model(pages, model):
    rows = [*enumerate(URLS), (None, URLS[7]), (3, URLS[9]), (3, URLS[9])]
    df = judge_urls(pages(rows), URL_RULES, model)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)
    assert got == sorted(((i, *judged_by_hand(u, URL_RULES, model, 0.3)) for i, u in rows), key=str)
    assert judge_urls(pages([]), URL_RULES, model).collect() == []


def test_longest_rule_wins_then_longer_host_then_block(pages, model):
    rules = [("a.b/c", "allow"), ("b/cde", "block"), ("b", "block"), ("x/y", "allow"), ("x/y", "block"), ("B.c/", "block")]
    rows = [(1, "h://a.b/cde"), (2, "h://z.b/q"), (3, "h://x/y"), (4, "h://b.c/")]
    found = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages(rows), rules, model).collect()}
    assert found == {1: ("a.b/c", "allow"), 2: ("b", "block"), 3: ("x/y", "block"), 4: ("B.c/", "block")}
    with pytest.raises(ValueError):
        judge_urls(pages([]), [("a", "maybe")], model)
    with pytest.raises(ValueError):
        judge_urls(pages([]), [("a", "allow")] * 1001, model)


def test_many_rules_are_one_expression(pages, model):
    rules = [(f"h{i}.net/p{i}", "block" if i % 2 else "allow") for i in range(1000)]
    rows = [(i, f"http://h{i}.net/p{i}/q") for i in (0, 1, 500, 999)]
    found = {r.page_id: r.verdict for r in judge_urls(pages(rows), rules, model).collect()}
    assert found == {0: "allow", 1: "block", 500: "allow", 999: "block"}


def test_model_tells_unseen_hosts(spark, frame):
    rows = labelled_rows()
    random.Random(3).shuffle(rows)
    fourth = len(rows) // 4
    model = train(frame("url string, label int, host string", [(*r, "x") for r in rows[fourth:]]))
    right = [(model.score(*cut(u)) >= 0.3) == bool(label) for u, label in rows[:fourth]]
    assert sum(right) / len(right) >= 0.97
    # hosts of made-up syllables carry none of the words
    rnd = random.Random(4)
    clean = ["".join(rnd.choice(["th", "er", "on", "an", "re", "ti", "ble"]) for _ in range(3)) for _ in range(200)]
    assert sum(model.score(f"www.{h}.example.com", "/en/77") >= 0.3 for h in clean) <= 4


def test_labels_of_odd_kinds(frame):
    schema = "url string, label int"
    assert train(frame(schema, [])).score("a.com", "/") < 1e-5
    assert train(frame(schema, [("http://a.com/", 1), (None, 0), ("http://b.com/", None)])).score("b", "") > 0.99
    twice = [("http://bet.com/", 1)] * 2 + [("http://bet.com/", 0), ("http://book.com/", 0)]
    model = train(frame(schema, twice))
    assert model.score("bet.com", "/") > 0.5 > model.score("book.com", "/")


def test_features_do_not_count_numbers_or_mix_kinds():
    model = UrlModel((3,), 16)
    one, two = (model.score(h, p) for h, p in (("", ""), ("abc", "")))
    assert one == two == 0.5
    from tripflow.llm.urls import url_features
    assert url_features("a1.b", "/7/8", (3,), 16).tolist() == url_features("a2.b", "/0/1", (3,), 16).tolist()
    assert set(url_features("abc", "", (3,), 16)).isdisjoint(url_features("", "abc", (3,), 16))
