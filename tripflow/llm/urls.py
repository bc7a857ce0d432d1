"""URL filter: written rules first, logistic regression on hashed character n-grams for the rest.

Method. A URL's host and path are cut out by DataFrame functions. Rules name a host, which includes
its subdomains, and the start of a path; the longest rule that fits decides. Where none fits, a
logistic regression does: the character n-grams of the host's labels and of the path's words, each
kind hashed into buckets of its own, weighted by 1 / sqrt(features). It is trained by gradient
steps in numpy on a small labelled table of URLs. Digits count as one character, since numbers in
addresses are mostly counters.

Training reads at most `sample_rows` labelled URLs, in the order of a hash; rules are a list in code
of at most MOST_RULES. Both bounds do not depend on the corpus. Scoring is a map over the rows and
reads the two columns it needs.

Null URLs and those without `://` have an empty host and path: no rule fits, and the score is what
the bias says. Repeated rows and rows without a page_id are judged like any other. Ports and user
names are part of the host as they stand. Among the rules that fit, the one with the longest text wins, then the one
with the longer host; of rules with one text, block wins. Labels that are null, and URLs that are null, are no labels; a URL labelled
several times has the rounded mean. Without labels of both classes every score is the share of
label 1, or 0 without any. Other columns are not read. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import ready

MOST_RULES = 1000
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL; both empty without `://`."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _LOWER.upper(), _LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the deciding rule among (text, verdict) pairs, null where none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules, not {len(rules)}")
    found = verdict = F.when(F.lit(False), F.lit(None).cast("string"))
    strongest = lambda r: (-len(r[0]), -len(r[0].partition("/")[0]), r[0], r[1] != "block")
    for text, says in sorted(rules, key=strongest):
        if says not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {says}")
        name, slash, start = text.partition("/")
        name = name.lower()
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found, verdict = found.when(fits, F.lit(text)), verdict.when(fits, F.lit(says))
    return found, verdict


def url_features(host: str, path: str, grams: Sequence[int], bits: int) -> np.ndarray:
    """Distinct bucket numbers of a URL: n-grams of the host and, hashed apart, of the path."""
    out = set()
    for kind, text in (("h", f".{host}."), ("p", f"{path}$")):
        if len(text) <= 2 - (kind == "p"):
            continue
        text = "".join("0" if c.isdigit() else c for c in text)
        for size in grams:
            out.update(kind + text[i:i + size] for i in range(len(text) - size + 1))
    shift = 64 - bits
    return np.fromiter((xxhash.xxh3_64_intdigest(g.encode("utf-8", "surrogatepass")) >> shift for g in sorted(out)),
                       np.int64, len(out))


class UrlModel:
    """Weights per bucket and a bias."""

    def __init__(self, grams: Sequence[int], bits: int):
        self.grams, self.bits = tuple(grams), bits
        self.weights, self.bias = np.zeros(1 << bits), 0.0

    def fit(self, urls: Sequence[tuple[str, str]], labels: np.ndarray, epochs: int, rate: float,
            decay: float, seed: int) -> None:
        share = labels.mean() if len(labels) else 0.0
        self.bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        if share in (0.0, 1.0):
            return
        found = [url_features(h, p, self.grams, self.bits) for h, p in urls]
        random, steps, done = np.random.default_rng(seed), epochs * len(urls), 0
        for _ in range(epochs):
            for i in random.permutation(len(urls)):
                step = rate * (1 - done / steps)
                done += 1
                buckets = found[i]
                size = 1 / np.sqrt(max(len(buckets), 1))
                error = 1 / (1 + np.exp(-(self.weights[buckets].sum() * size + self.bias))) - labels[i]
                self.weights[buckets] -= step * (error * size + decay * self.weights[buckets])
                self.bias -= 0.1 * step * error

    def score(self, host: str, path: str) -> float:
        buckets = url_features(host, path, self.grams, self.bits)
        total = float(self.weights[buckets].sum()) / np.sqrt(max(len(buckets), 1)) + self.bias
        return float(1 / (1 + np.exp(-total)))


def train(labelled: DataFrame, sample_rows: int = 20_000, grams: Sequence[int] = (3, 4, 5), bits: int = 16,
          epochs: int = 60, rate: float = 0.5, decay: float = 1e-4, seed: int = 11) -> UrlModel:
    """Fit a model to labelled(url, label), label 1 meaning block."""
    host, path = host_and_path(F.col("url"))
    rows = (labelled.where("url is not null and label is not null")
            .groupBy(F.col("url").cast("string").alias("url")).agg(F.round(F.avg("label")).alias("label"))
            .orderBy(F.xxhash64("url"), "url").limit(sample_rows)
            .select("url", host.alias("host"), path.alias("path"), "label").collect())  # at most sample_rows
    model = UrlModel(grams, bits)
    model.fit([(r["host"], r["path"]) for r in rows], np.array([float(r["label"] > 0) for r in rows]),
              epochs, rate, decay, seed)
    return model


def _scores(model: UrlModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            values = []
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist()):
                # numbers do not count, so most paths of a site look alike
                key = "".join("0" if c.isdigit() else c for c in f"{host}\n{path}")
                if key not in known:
                    if len(known) >= 1 << 16:
                        known.clear()
                    known[key] = model.score(host, path)
                values.append(known[key])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())],
                                             [*batch.schema.names, "score"])
    return run


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], model: UrlModel,
               threshold: float = 0.3) -> DataFrame:
    """pages(page_id, url) → (page_id, host, path, rule, verdict, score), one row per input row.

    `verdict` is the deciding rule's, else block from a score of `threshold` on, else allow.
    """
    ready(pages.sparkSession)
    host, path = host_and_path(F.col("url").cast("string"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = cut.mapInArrow(_scores(model), "page_id long, host string, path string, score double")
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(says, own).alias("verdict"), "score")
