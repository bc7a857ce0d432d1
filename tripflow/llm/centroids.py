"""Centroid clustering: Lloyd's rounds over column blocks.

Method. Vectors become whole numbers and are cut both ways: into blocks of rows, and each block into
shards of `shard_columns` dimensions. A task holds one shard of one block and the slices of the
centroids that lie in that shard's dimensions, never a whole vector. In a round each such task
computes exact partial squared distances; the partials of a block are added up by key, and the
smallest sum names each row's centroid. The assignments go back to the shards, each of which adds up
its own columns per centroid and sets its own slices to the floor of the means. All is whole-number
arithmetic, so the result does not depend on the order of rows, tasks or shards.

A round sends one partial matrix per shard and block, in the narrowest whole-number type that holds
it, and one byte or two per vector back. No row is heavier than a block, and the number of centroids
bounds what a sum is keyed by, so hot clusters cost no more than others. Slices are broadcast; they
hold `clusters` * `width` numbers, at most MOST_NUMBERS.

Rows whose vector is null, has another length than `width`, or holds null, NaN or infinite
components are left out, and so is every row if none is left. Rows that repeat a vec_id are vectors
of their own. Rows without a vec_id are clustered too; they come last when first centroids are
chosen, and rows that share a vec_id there are ordered by their numbers. With fewer vectors than
`clusters` there are as many centroids as vectors. Components whose whole number reaches 2^26 are an
error, since squared distances would not fit. Other columns are not read. No rows in, no rows out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import ready, stored

#: Rows of a block times centroids, rows of a block, and numbers of all centroids together.
BLOCK_CELLS, BLOCK_ROWS, MOST_NUMBERS = 1 << 19, 8192, 1 << 22
_LARGEST = 1 << 26


def whole_numbers(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, exactly: the scale is a power of two."""
    numbers = np.floor(flat * float(scale))
    if len(numbers) and np.abs(numbers).max() >= _LARGEST:
        raise ValueError(f"a component times {scale} reaches 2^26")
    return numbers.astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    """A matrix of whole numbers in the narrowest type that holds it, compressed."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    kind = next(k for k in "bhiq" if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind.encode() + zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(numbers.astype(kind)).tobytes())


def unpack(payload: bytes, columns: int) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(payload[1:])
    return np.frombuffer(data, payload[:1].decode()).astype(np.int64).reshape(-1, columns)


def usable(vector: str, width: int | None = None) -> Column:
    """The vector is there, has the length, and all its components are numbers."""
    good = F.forall(vector, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    there = F.col(vector).isNotNull() & good
    return there if width is None else there & (F.size(vector) == width)


def _cut(width: int, step: int, scale: int, rows: int):
    """Blocks of rows as one row per shard; the first shard's row holds the names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False)
            numbers = whole_numbers(flat, scale).reshape(-1, width)
            names = batch["vec_id"].to_pylist()
            for at in range(0, len(numbers), rows):
                part = numbers[at:at + rows]
                shards = range(0, width, step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(shards), pa.int64()),
                     pa.array([s // step for s in shards], pa.int32()),
                     pa.array([pack(part[:, s:s + step]) for s in shards], pa.binary()),
                     pa.array([names[at:at + rows] if s == 0 else None for s in shards], pa.list_(pa.int64()))],
                    ["block", "shard", "data", "names"])
                block += 1
    return run


def _partial_distances(width: int, step: int):
    """Squared distances of a block's rows to all centroids, over one shard's columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for shard, data, slices in zip(*(batch[c].to_pylist() for c in ("shard", "data", "slices"))):
                numbers = unpack(data, min(step, width - shard * step))
                centroids = np.array([s["slice"] for s in slices], np.int64)
                found = numbers @ centroids.T
                found *= -2
                found += (numbers * numbers).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)
                payloads.append(pack(found))
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(payloads, pa.binary())],
                                             ["block", "partial"])
    return run


def _nearest(clusters: int):
    """The sum of a block's partial distances, and the smallest of each row."""
    def run(partials: pa.Table) -> pa.Table:
        total = sum(unpack(p, clusters) for p in partials["partial"].to_pylist())
        best = total.argmin(axis=1)  # the first of equal ones
        least = total[np.arange(len(total)), best]
        return pa.table({"block": partials["block"][:1], "clusters": pa.array([pack(best)], pa.binary()),
                         "distances": pa.array([pack(least)], pa.binary())})
    return run


def _shard_sums(width: int, step: int, clusters: int):
    """Rows and column sums per shard and centroid, over all blocks of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, data, best in zip(*(batch[c].to_pylist() for c in ("shard", "data", "clusters"))):
                columns = min(step, width - shard * step)
                numbers, best = unpack(data, columns), unpack(best, 1)[:, 0]
                if shard not in sums:
                    sums[shard], counts[shard] = np.zeros((clusters, columns), np.int64), np.zeros(clusters, np.int64)
                by = np.argsort(best, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(best[by]) != 0))
                sums[shard][best[by][first]] += np.add.reduceat(numbers[by], first, axis=0)
                counts[shard] += np.bincount(best, minlength=clusters)
        rows = [(s, c) for s in sums for c in np.flatnonzero(counts[s]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.int32()),
             pa.array([int(counts[s][c]) for s, c in rows], pa.int64()),
             pa.array([sums[s][c].tolist() for s, c in rows], pa.list_(pa.int64()))],
            ["shard", "cluster", "n", "sums"])
    return run


def _start(kept: DataFrame, clusters: int, width: int, step: int, scale: int) -> DataFrame:
    """Slices (shard, cluster, slice) of the first centroids: the vectors whose hashed ids are smallest."""
    numbers = F.transform("embedding", lambda x: F.floor(x * float(scale)))
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = (kept.select(name.alias("place"), numbers.alias("numbers"))
              .orderBy(F.asc_nulls_last("place"), "numbers").limit(clusters).collect())
    rows = [(at // step, cluster, r["numbers"][at:at + step])
            for cluster, r in enumerate(chosen) for at in range(0, width, step)]
    return kept.sparkSession.createDataFrame(rows, "shard int, cluster int, slice array<long>")


def _moved(slices: DataFrame, sums: DataFrame, step: int) -> DataFrame:
    """Each shard's slices at the floored means; a centroid without vectors stays."""
    totals = sums.groupBy("shard", "cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(step)]).alias("sums"))
    mean = F.transform(F.filter("sums", lambda s: s.isNotNull()),
                       lambda s: F.call_function("div", s - F.pmod(s, F.col("n")), F.col("n")))
    return (slices.join(totals, ["shard", "cluster"], "left")
            .select("shard", "cluster", F.coalesce(mean, "slice").alias("slice")))


def _assigned(shards: DataFrame, slices: DataFrame, clusters: int, width: int, step: int) -> DataFrame:
    held = slices.groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("cluster", "slice"))).alias("slices"))  # at most MOST_NUMBERS
    partial = (shards.select("block", "shard", "data").join(F.broadcast(held), "shard")
               .select("block", "shard", "data", "slices")
               .mapInArrow(_partial_distances(width, step), "block long, partial binary"))
    return stored(partial.groupBy("block").applyInArrow(
        _nearest(clusters), "block long, clusters binary, distances binary"), "assigned")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to a row per vector."""
    for batch in batches:
        for names, best, least in zip(*(batch[c].to_pylist() for c in ("names", "clusters", "distances"))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(unpack(best, 1)[:, 0], pa.int32()),
                 pa.array(unpack(least, 1)[:, 0], pa.int64())], ["vec_id", "cluster", "distance"])


def cluster_vectors(vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64,
                    scale: int = 64, shard_columns: int = 32) -> DataFrame:
    """vectors(vec_id, embedding) → (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256), one row per usable vector.

    Each of `rounds` rounds assigns every vector to its nearest centroid, ties to the smaller number,
    and moves the centroids; then vectors are assigned once more. `distance` is squared, the
    inertias are its sums over the cluster and over all, the digest is of the centroid's numbers.
    """
    if min(clusters, width, shard_columns) < 1 or rounds < 0 or clusters * width > MOST_NUMBERS:
        raise ValueError(f"clusters * width must be 1 to {MOST_NUMBERS}")
    if scale < 1 or scale & (scale - 1):
        raise ValueError("the scale must be a power of two")
    spark = ready(vectors.sparkSession)
    step = min(shard_columns, width)
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .where(usable("embedding", width)))
    slices = _start(kept, clusters, width, step, scale)
    clusters = slices.where("shard = 0").count()
    rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(clusters, 1)))
    shards = stored(kept.mapInArrow(_cut(width, step, scale, rows),
                                    "block long, shard int, data binary, names array<long>"), "column-blocks")
    assigned = _assigned(shards, slices, clusters, width, step)
    for _ in range(rounds):
        sums = (shards.select("block", "shard", "data").join(assigned.select("block", "clusters"), "block")
                .mapInArrow(_shard_sums(width, step, clusters),
                            "shard int, cluster int, n long, sums array<long>"))
        slices = stored(_moved(slices, sums, step), "slices")
        assigned = _assigned(shards, slices, clusters, width, step)

    members = (shards.where("names is not null").select("block", "names").join(assigned, "block")
               .mapInArrow(_members, "vec_id long, cluster int, distance long"))
    inertia = {r["cluster"]: r["n"] for r in members.groupBy("cluster")
               .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}  # a row per cluster
    centroids: dict[int, list[int]] = {}
    for r in sorted(slices.collect(), key=lambda r: (r["cluster"], r["shard"])):  # at most MOST_NUMBERS
        centroids.setdefault(r["cluster"], []).extend(r["slice"])
    told = [(c, int(inertia.get(c, 0)), int(sum(inertia.values())),
             hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest())
            for c, numbers in centroids.items()]
    facts = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return members.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
