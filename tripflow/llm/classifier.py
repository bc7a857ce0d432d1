"""Text quality from supervised subword embeddings.

Method. The features of a text are its words, its pairs of neighbouring words (a word that repeats
the one before it is one sign) and the character n-grams inside its words (a word's borders count as
a space), hashed into buckets. Each bucket has a learned vector; a text is the
mean of its features' vectors, and a linear layer with softmax gives the class probabilities. Both
are trained by stochastic gradient descent in numpy, text by text, over a bounded sample.

Training takes labelled documents whose doc_id is not held out, at most `sample_rows` of them in the
order of a hash of the doc_id, and at most `sample_chars` characters, which bounds the driver's
work whatever the size of the corpus. Rows of a doc_id go together, and one that does not fit is left out. Scoring reads every whole text. Since the layer is linear,
a bucket's vector acts on the score as one number, so scoring looks up one number per feature.

The text is the only input of a score. Null, empty and wordless texts have no features; their score
is what the bias says. Rows without a doc_id are scored and count as held out. Repeated rows are
scored alike. Labels of rows that have several are averaged and rounded up; null labels are no
labels. Without labels of both classes every score is the share of class 1, or 0.5 without any. Other columns
are not read. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .words import U64
from .work import ready

_FACTOR = U64(0x9E3779B97F4A7C15)
_STEP = 0xD1342543DE82EF95
_INVERSE = pow(_STEP, -1, 1 << 64)
#: Characters worked on at a time; longer texts go through in slices, with the same features.
_SLICE = 1 << 20


def held_out(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text is divisible by `folds`; true without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _letters(text: str) -> np.ndarray:
    """Code points, every white-space character as a space."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((points >= 9) & (points <= 13), 32, points).astype(U64)


def text_features(text: str, grams: Sequence[int], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all features of a text, slice by slice.

    What a slice leaves open goes on in the next one: the last characters, which begin n-grams, the
    hash so far of a word that is cut, and the word before it. So the features do not depend on where slices end.
    """
    shift, space = U64(64 - bits), np.array([32], U64)
    tail = np.empty(0, U64)  # the characters before this slice that its n-grams can start at
    word, length, before = 0, 0, None  # an unfinished word, and the last finished one
    for at in range(0, max(len(text), 1), _SLICE):
        points = _letters(text[at:at + _SLICE])
        points = np.concatenate([*([] if at else [space]), points, *([space] if at + _SLICE >= len(text) else [])])
        out = list(_grams(tail, points, grams))
        tail = np.concatenate([tail, points])[-max(max(grams, default=1) - 1, 1):]
        words, word, length = _words(points, word, length)
        words ^= words >> U64(32)
        # a word that repeats the one before it makes the same pair whatever it is
        row = words if before is None else np.concatenate([before, words])
        pairs = row[:-1] * U64(_STEP) + row[1:] + U64(2)
        pairs[row[1:] == row[:-1]] = 1
        pairs ^= pairs >> U64(32)
        before = row[-1:] if len(row) else before
        yield np.concatenate([(values * _FACTOR) >> shift for values in (words, pairs, *out)]).astype(np.int64)


def _words(points: np.ndarray, word: int, length: int) -> tuple[np.ndarray, int, int]:
    """Hashes of the words that end here, and the hash and length of one that goes on; a first word
    may have begun before. Differences of prefix sums, moved to a common power."""
    inside = np.concatenate([[False], points != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    n = len(points)
    powers = np.full(n, _STEP, U64)
    powers[0] = 1
    sums = np.zeros(n + 1, U64)
    np.cumsum(points * np.cumprod(powers), out=sums[1:])
    inverse = np.full(n, _INVERSE, U64)
    inverse[0] = 1
    words = (sums[stops] - sums[starts]) * np.cumprod(inverse)[starts]
    if length and len(starts) and starts[0] == 0:
        words[0] = U64((word + int(words[0]) * pow(_STEP, length, 1 << 64)) % (1 << 64))
        length += int(stops[0])
    elif length:  # it ended with the slice before
        words, length = np.concatenate([np.array([word], U64), words]), 0
        starts, stops = np.append(-1, starts), np.append(0, stops)
    if len(stops) and stops[-1] == n:
        return words[:-1], int(words[-1]), length if starts[-1] == 0 and length else int(stops[-1] - starts[-1])
    return words, 0, 0


def _grams(tail: np.ndarray, points: np.ndarray, grams: Sequence[int]) -> Iterator[np.ndarray]:
    """Hashes of the n-grams that end in these points and have no space but at their ends."""
    for size in grams:
        row = np.concatenate([tail[len(tail) - min(size - 1, len(tail)):], points])
        if len(row) < size:
            continue
        marks = np.cumsum(row == 32, dtype=np.int32)
        value = row[:len(row) - size + 1].copy()
        for step in range(1, size):
            value *= U64(_STEP)
            value += row[step:step + len(value)]
        inner = marks[max(size - 2, 0):max(size - 2, 0) + len(value)] == marks[:len(value)]
        value = value[inner]
        value += U64(size)
        value ^= value >> U64(32)
        yield value


class Model:
    """Embeddings, output layer and bias of the two classes."""

    def __init__(self, bits: int, grams: Sequence[int], size: int, seed: int):
        self.bits, self.grams = bits, tuple(grams)
        random = np.random.default_rng(seed)
        self.vectors = random.uniform(-1 / size, 1 / size, (1 << bits, size))
        self.layer = np.zeros((2, size))
        self.bias = np.zeros(2)

    def fit(self, texts: Sequence[str], labels: np.ndarray, epochs: int, rate: float, seed: int) -> None:
        shares = np.bincount(labels, minlength=2) / max(len(labels), 1)
        if not shares.all():
            share = np.clip(shares[1] if len(labels) else 0.5, 1e-6, 1 - 1e-6)
            self.bias[:] = 0, np.log(share / (1 - share))
            return
        self.bias[:] = np.log(shares)
        found = []
        for text in texts:
            features = np.concatenate(list(text_features(text, self.grams, self.bits)))
            buckets, counts = np.unique(features, return_counts=True)
            found.append((buckets.astype(np.int32), (counts / max(len(features), 1)).astype(np.float32)))
        random, done, steps = np.random.default_rng(seed), 0, epochs * len(texts)
        for _ in range(epochs):
            for i in random.permutation(len(texts)):
                step = rate * (1 - done / steps)
                done += 1
                buckets, weights = found[i]
                if not len(buckets):
                    continue
                mean = weights @ self.vectors[buckets]
                scores = self.layer @ mean + self.bias
                error = np.exp(scores - scores.max())
                error /= error.sum()
                error[labels[i]] -= 1
                back = error @ self.layer
                self.layer -= step * np.outer(error, mean)
                self.bias -= 0.1 * step * error
                # a mean's gradient is thin where a text has many features: weigh by share of the largest
                self.vectors[buckets] -= step * np.outer(weights / weights.max(), back)

    def folded(self) -> tuple[np.ndarray, float]:
        """Per bucket, what one feature adds to the difference of the classes; and the bias."""
        return self.vectors @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


def _scores(weights: np.ndarray, bias: float, grams: Sequence[int], bits: int, keep_text: bool, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for text in batch["text"].to_pylist():
                total, count = 0.0, 0
                for features in text_features(text or "", grams, bits):
                    total += float(weights[features].sum())
                    count += len(features)
                values.append(total / max(count, 1) + bias)
            score = 1 / (1 + np.exp(-np.array(values, np.float64)))
            kept = [c for c in batch.schema.names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(score)], [*kept, name])
    return run


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_rows: int = 5000,
          sample_chars: int = 25_000_000, grams: Sequence[int] = (3, 4), bits: int = 16,
          size: int = 8, epochs: int = 5, rate: float = 0.5, seed: int = 7) -> Model:
    """Fit a model to docs(doc_id, text) and labels(doc_id, quality) on a bounded sample."""
    model = Model(bits, grams, size, seed)
    marked = (labels.where("quality is not null and doc_id is not null")
              .where(~held_out(F.col("doc_id"), folds))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.round(F.avg("quality")).cast("int").alias("quality")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    # only ids and lengths of labelled documents are shuffled
    sized = (texts.select("doc_id", F.length("text").alias("length")).join(marked, "doc_id")
             .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.count("*").alias("n"),
                                    F.sum("length").alias("chars")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    names = sized.select("doc_id", "quality", "n", "chars").collect()  # at most sample_rows
    names.sort(key=lambda r: r["doc_id"])
    names = [names[i] for i in np.random.default_rng(seed).permutation(len(names))]
    chosen, taken, chars = {}, 0, 0
    for row in names:
        if taken + row["n"] > sample_rows or chars + (row["chars"] or 0) > sample_chars:
            continue
        taken, chars = taken + row["n"], chars + (row["chars"] or 0)
        chosen[row["doc_id"]] = row["quality"]
    if not chosen:
        model.fit([], np.empty(0, np.int64), epochs, rate, seed)
        return model
    # an Arrow table becomes rows in the JVM; a list would start Python workers of its own on executors
    ids = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(list(chosen), pa.int64())}))
    rows = texts.join(F.broadcast(ids), "doc_id").collect()  # at most sample_chars
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    model.fit([r["text"] or "" for r in rows],
              np.array([1 if chosen[r["doc_id"]] > 0 else 0 for r in rows], np.int64), epochs, rate, seed)
    return model


def score_documents(docs: DataFrame, model: Model, name: str = "score",
                    keep_text: bool = False) -> DataFrame:
    """docs with a new column, the probability of class 1; `text` goes unless `keep_text`."""
    ready(docs.sparkSession)
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    weights, bias = model.folded()
    schema = StructType([f for f in docs.schema.fields if keep_text or f.name != "text"]
                        + [StructField(name, DoubleType())])
    return docs.mapInArrow(_scores(weights, bias, model.grams, model.bits, keep_text, name), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                   folds: int = 5) -> DataFrame:
    """docs(doc_id, text) and labels(doc_id, quality) → (doc_id, held_out, score, predicted)."""
    model = train(docs, labels, folds)
    return (score_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                         F.col("text").cast("string").alias("text")), model)
            .select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
