"""Near-equal vectors by an epsilon grid order join.

Method. On unit vectors a cosine of at least c is a distance of at most eps = sqrt(2 - 2c), and no
projection makes a distance longer. Vectors are projected on their leading principal directions and
sorted by grid cells of width eps on these, first direction first (epsilon grid order). The sequence
is cut into blocks with bounding boxes; intervals of blocks are joined recursively from the whole
sequence down, and a pair of intervals whose boxes are more than eps apart is skipped with all that
lies in it. The length of what lies outside the directions is one more coordinate: the distance of two vectors
is no less than that of their coordinates and these lengths.

Pairs of blocks that are left are first held against each other by these few numbers, in single
precision with a margin; only the vectors that come within eps of one in the other block so are sent
whole and joined, again interval by interval, by their cosines in double precision. The directions are
fitted on a bounded sample; they decide how much is skipped, never what is found.

Equal vectors are one vector with a number of copies, so copies cost nothing. A task returns the
number of links per vector and its links' components as stars, never the pairs themselves, so a
large group of near-equal vectors costs time but no rows.

Vectors that are null, empty, zero, or that hold null or non-finite components link with nothing.
Shorter vectors count as padded with zeros. Rows that repeat a vec_id are one vector with several
places: it has the links of each, and each row comes back. Rows without a vec_id come back without links and component, and
nothing links to them. Other columns are not read. No rows in, no rows out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .work import ready, stored

#: Rows of a block, rows of an interval inside a task, intervals that make the next larger one (as
#: a power of two), and vectors the directions are fitted on.
BLOCK_ROWS, INNER_ROWS, FAN_BITS, SAMPLE = 2048, 256, 7, 8192
_SLACK = 1e-9
#: Single precision moves a squared distance of unit vectors by less than this.
_MARGIN = 1e-5


def _clean(width: int):
    """Vectors as bytes of doubles, null where they link with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data: list[bytes | None] = []
            keys: list[bytes | None] = []
            given = batch["embedding"]
            flat = given.flatten()
            whole = flat.is_valid().to_numpy(zero_copy_only=False)
            numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            at = 0
            for size in given.value_lengths().fill_null(0).to_pylist():
                vector = np.zeros(width)
                vector[:size] = numbers[at:at + size]
                vector += 0.0  # no negative zeros
                good = whole[at:at + size].all() and vector.any() and np.isfinite(vector).all()
                data.append(vector.tobytes() if good else None)
                keys.append(hashlib.blake2b(data[-1], digest_size=16).digest() if good else None)
                at += size
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
                ["vec_id", "key", "data"])
    return run


def _units(data: list[bytes], width: int) -> np.ndarray:
    vectors = np.frombuffer(b"".join(data), np.float64).reshape(len(data), width)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def directions(sample: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal directions."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return mean, np.ascontiguousarray(vectors[:, ::-1][:, :count])


def _coordinates(units: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Projections on the directions, and the length of the rest."""
    centred = units - mean
    seen = centred @ axes
    rest = centred - seen @ axes.T
    return np.column_stack([seen, np.sqrt((rest * rest).sum(axis=1))])


def _project(width: int, mean: np.ndarray, axes: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch["data"].to_pylist(), width)
            cells = np.floor((units - mean) @ axes / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c) for c in np.ascontiguousarray(cells.T))],
                [*batch.schema.names, *(f"c{i}" for i in range(cells.shape[1]))])
    return run


def _block(width: int, mean: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        place = TaskContext.get().partitionId() << 24
        names: list[int] = []
        copies: list[int] = []
        data: list[bytes] = []

        def block() -> pa.RecordBatch:
            units = _units(data, width)
            seen = _coordinates(units, mean, axes)
            return pa.RecordBatch.from_arrays(
                [pa.array([place]), pa.array([seen.min(axis=0).tolist()]),
                 pa.array([seen.max(axis=0).tolist()]), pa.array([np.array(names, np.int64).tobytes()]),
                 pa.array([np.array(copies, np.int64).tobytes()]), pa.array([units.tobytes()]),
                 pa.array([seen.astype(np.float32).tobytes()])],
                ["place", "low", "high", "names", "copies", "units", "seen"])

        for batch in batches:
            for name, copy, vector in zip(*(batch[c].to_pylist() for c in ("head", "copies", "data"))):
                names.append(name)
                copies.append(copy)
                data.append(vector)
                if len(names) == BLOCK_ROWS:
                    yield block()
                    place += 1
                    names.clear(), copies.clear(), data.clear()
        if names:
            yield block()
    return run


def _close(count: int, eps: float) -> Column:
    """Are the boxes (low, high) and (low2, high2) within eps of each other?"""
    gaps = [F.greatest(F.col("low")[i] - F.col("high2")[i], F.col("low2")[i] - F.col("high")[i], F.lit(0.0))
            for i in range(count)]
    return reduce(lambda a, b: a + b, [g * g for g in gaps]) <= (eps + _SLACK) ** 2


def interval_pairs(blocks: DataFrame, count: int, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of block places whose boxes are within eps, from the top down."""
    levels = [blocks.select("place", "low", "high")]
    top = blocks.agg(F.max("place")).first()[0]
    while top > 0:
        top >>= FAN_BITS
        box = [F.array(*[f(F.col(c)[i]) for i in range(count)]).alias(c)
               for c, f in (("low", F.min), ("high", F.max))]
        levels.append(stored(levels[-1].groupBy(F.shiftright("place", FAN_BITS).alias("place")).agg(*box),
                             "intervals"))
    pairs = levels[-1].select(F.col("place").alias("a"), F.col("place").alias("b"))
    for level in levels[-2::-1]:
        left = level.select(F.shiftright("place", FAN_BITS).alias("a"), F.col("place").alias("x"),
                            "low", "high")
        right = level.select(F.shiftright("place", FAN_BITS).alias("b"), F.col("place").alias("y"),
                             F.col("low").alias("low2"), F.col("high").alias("high2"))
        pairs = stored(pairs.join(left, "a").join(right, "b").where("x <= y").where(_close(count, eps))
                       .select(F.col("x").alias("a"), F.col("y").alias("b")), "interval-pairs")
    return pairs


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes reaches by the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _near(count: int, eps: float):
    """Of pairs of blocks, the rows on each side that some row on the other may be near to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, seen, other in zip(*(batch[c].to_pylist() for c in ("a", "b", "seen", "seen2"))):
                one, two = (np.frombuffer(x, np.float32).reshape(-1, count).astype(np.float64) for x in (seen, other))
                apart = one @ two.T
                apart *= -2
                apart += (one * one).sum(axis=1)[:, None]
                apart += (two * two).sum(axis=1)
                near = apart <= (eps + _SLACK) ** 2 + _MARGIN
                if a == b:
                    near = np.triu(near, 1)
                left, right = near.any(axis=1), near.any(axis=0)
                if a == b:
                    left = right = left | right
                if left.any():
                    rows = [np.flatnonzero(x).astype(np.int32).tobytes() for x in (left, right)]
                    out += [(a, a, b, 0, rows[0])] + ([(b, a, b, 1, rows[1])] if a != b else [])
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["place", "a", "b", "side", "rows"])
    return run


def _send(width: int):
    """The wanted rows of a block, one pair of blocks after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                wanted = batch.slice(at, 1)
                rows = np.frombuffer(wanted["rows"][0].as_py(), np.int32)
                parts = [np.frombuffer(wanted[c][0].as_py(), np.int64)[rows] for c in ("names", "copies")]
                units = np.frombuffer(wanted["units"][0].as_py(), np.float64).reshape(-1, width)[rows]
                yield pa.RecordBatch.from_arrays(
                    [wanted["a"], wanted["b"], wanted["side"], *(pa.array([p.tobytes()]) for p in (*parts, units))],
                    ["a", "b", "side", "names", "copies", "units"])
    return run


def _join(width: int, mean: np.ndarray, axes: np.ndarray, eps: float, least: float):
    def parts(units: np.ndarray) -> list[tuple[slice, np.ndarray, np.ndarray]]:
        seen = _coordinates(units, mean, axes)
        out = []
        for at in range(0, len(units), INNER_ROWS):
            rows = slice(at, min(at + INNER_ROWS, len(units)))
            out.append((rows, seen[rows].min(axis=0), seen[rows].max(axis=0)))
        return out

    def links(one: np.ndarray, two: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for rows, low, high in parts(one):
            for columns, low2, high2 in parts(two):
                if same and columns.start < rows.start:
                    continue
                gap = np.maximum(np.maximum(low - high2, low2 - high), 0)
                if gap @ gap > (eps + _SLACK) ** 2:
                    continue
                i, j = np.nonzero(one[rows] @ two[columns].T >= least)
                i, j = i + rows.start, j + columns.start
                if same:
                    i, j = i[i < j], j[i < j]
                found.append((i, j))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def run(sent: pa.Table) -> pa.Table:
        sides = sorted(sent.to_pylist(), key=lambda r: r["side"])
        units = [np.frombuffer(r["units"], np.float64).reshape(-1, width) for r in sides]
        names, copies = (np.concatenate([np.frombuffer(r[c], np.int64) for r in sides]) for c in ("names", "copies"))
        if len(sides) == 1:
            i, j = links(units[0], units[0], True)
        else:
            i, j = links(units[0], units[1], False)
            j = j + len(units[0])
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, i, copies[j])
        np.add.at(counts, j, copies[i])
        hit = np.flatnonzero(counts)
        root = _roots(i, j, len(names)) if len(i) else np.empty(0, np.int64)
        return pa.table({"a": names[hit], "b": names[root[hit]] if len(hit) else names[:0], "links": counts[hit]})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, count: int = 16) -> DataFrame:
    """vectors(vec_id, embedding) → (vec_id, n_links, component_id, kept), one row per input row.

    Vectors link where their cosine is at least `cosine`; `count` principal directions order them.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    ready(vectors.sparkSession)
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
    width = given.agg(F.max(F.size("embedding"))).first()[0] or 0
    named = stored(given.mapInArrow(_clean(max(width, 1)), "vec_id long, key binary, data binary"), "vectors")
    heads = stored(named.where("key is not null and vec_id is not null").groupBy("key")
                   .agg(F.min("vec_id").alias("head"), F.count("*").alias("copies"),
                        F.first("data").alias("data")), "distinct")
    sample = heads.orderBy(F.xxhash64("key")).limit(SAMPLE).select("data").collect()
    spent = F.lit(None).cast("long")
    if sample:
        eps = float(np.sqrt(2 - 2 * cosine))
        count = min(count, width)
        mean, axes = directions(_units([r["data"] for r in sample], width), count)
        cells = [f"c{i}" for i in range(count)]
        ordered = heads.select("head", "copies", "data").mapInArrow(
            _project(width, mean, axes, eps), "head long, copies long, data binary, "
            + ", ".join(f"{c} int" for c in cells))
        # the id splits a cell that very many vectors share
        blocks = stored(ordered.repartitionByRange(*cells, "head").sortWithinPartitions(*cells, "head")
                        .mapInArrow(_block(width, mean, axes), "place long, low array<double>, "
                                    "high array<double>, names binary, copies binary, units binary, seen binary"),
                        "vector-blocks")
        pairs = interval_pairs(blocks, count + 1, eps)
        left = blocks.select(F.col("place").alias("a"), "seen")
        right = left.toDF("b", "seen2")
        wanted = stored(pairs.join(left, "a").join(right, "b").mapInArrow(
            _near(count + 1, eps), "place long, a long, b long, side int, rows binary"), "vector-rows")
        sent = wanted.join(blocks.select("place", "names", "copies", "units"), "place").mapInArrow(
            _send(width), "a long, b long, side int, names binary, copies binary, units binary")
        found = stored(sent.groupBy("a", "b").applyInArrow(
            _join(width, mean, axes, eps, cosine), "a long, b long, links long"), "vector-links")
        counts = found.groupBy(F.col("a").alias("head")).agg(F.sum("links").alias("links"))
        groups = components(found.select("a", "b")).withColumnRenamed("id", "head")
        placed = (heads.select("key", "head", "copies").join(counts, "head", "left")
                  .join(groups, "head", "left").select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "head").alias("component")))
    else:
        placed = heads.select("key", spent.alias("n_links"), spent.alias("component"))
    known = F.col("vec_id").isNotNull()
    return (named.select("vec_id", "key").join(placed, "key", "left").select(
        "vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(known, F.coalesce("component", "vec_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
