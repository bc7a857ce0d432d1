"""Near-duplicate documents by one-permutation hashing with optimal densification.

Method. Every distinct shingle of a document is hashed once; the hash's leading bits choose one of
`bins` bins, and each bin keeps its smallest hash. An empty bin borrows from the first full bin of
a fixed random order that belongs to the bin alone (optimal densification). `rows` bins make a
band; documents that agree on a band share a bucket. A bucket of n documents gives n - 1 edges, a
star around its smallest document, not n * n / 2 pairs. Edges are confirmed on the full shingle
sets, and confirmed links make components.

A star can miss a link between two of its leaves. Buckets whose documents are still in different
components after the stars are therefore compared in chunks, inside tasks. Signatures go first: they
name the documents of a bucket that have a likely partner in another component, and only the sets of
those are sent, in chunks of bounded size, tried in full, and give the links that join components.
Equal shingle sets are one document for all of this, so copies cost nothing after the first shuffle.

With 25 bands of 5 bins a pair at similarity 0.85 fails to meet with probability 4e-7, one at 0.8
with 5e-5.

Nulls, empty texts and texts without a word have an empty set and link with nothing. A text with
fewer words than a shingle has one shingle, the whole sequence. Rows that repeat a doc_id are one
document with several texts: it has the links of each, and each row comes back. Rows without a
doc_id come back as they are, linked with nothing, their component null. Other columns are not read.
No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .words import U64, encode, hash_words, mix, number_words, starts_of, window_hashes
from .work import kept_beyond, private_tables, ready, stored, unused

_ATTEMPTS = 4096
#: Documents of a bucket whose signatures meet in one task.
_CHUNK = 1024
#: Documents, and shingles of them all, whose sets do.
_SET_CHUNK, _SET_SHINGLES = 512, 1 << 20


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z are lower-cased."""
    ids, sizes, words = number_words(texts, lower=True)
    hashes = hash_words(words)[ids]
    windows, starts = window_hashes(hashes, size), starts_of(sizes)
    for at, n in enumerate(sizes):
        if n >= size:
            yield np.unique(windows[starts[at]:starts[at] + n - size + 1])
        elif n:
            whole = window_hashes(hashes[starts[at]:starts[at + 1]], int(n))
            yield mix(whole + U64(n))
        else:
            yield np.empty(0, U64)


def _donors(bins: int) -> np.ndarray:
    """The order in which each bin asks the others for a value."""
    return np.random.default_rng(20).integers(0, bins, (_ATTEMPTS, bins))


def densify(values: np.ndarray, donors: np.ndarray) -> None:
    """Fill the empty bins (the largest value) of signatures that have a full one."""
    empty = np.iinfo(np.uint64).max
    full = values != empty
    rows, bins = np.nonzero(~full & full.any(axis=1)[:, None])
    for attempt in donors:
        if not len(rows):
            return
        found = full[rows, attempt[bins]]
        values[rows[found], bins[found]] = values[rows[found], attempt[bins[found]]]
        rows, bins = rows[~found], bins[~found]
    if len(rows):  # never asked a full bin: the first full one
        values[rows, bins] = values[rows, full[rows].argmax(axis=1)]


def _sketch(size: int, bands: int, rows: int):
    bins = 1 << (bands * rows - 1).bit_length()
    shift = U64(64 - bins.bit_length() + 1)
    edges = np.arange(bins, dtype=U64) << shift
    places = np.arange(bands, dtype=U64) * U64(0x632BE59BD9B4E019)
    empty = U64(np.iinfo(np.uint64).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        donors = _donors(bins)
        for batch in batches:
            texts = [encode(t) for t in batch["text"].to_pylist()]
            n = len(texts)
            counts, keys = np.zeros(n, np.int64), []
            values = np.full((n, bins), empty, U64)
            for at, found in enumerate(shingle_sets(texts, size)):
                counts[at] = len(found)
                # sorted, so the first hash of a bin is its smallest
                first = np.searchsorted(found, edges)
                last = np.append(first[1:], len(found))
                has = first < last
                values[at, has] = found[first[has]]
                other = mix(found * U64(0xD6E8FEB86659FD93) + U64(1))
                keys.append((np.add.reduce(found).tobytes()
                             + np.bitwise_xor.reduce(other).tobytes()) if len(found) else None)
            densify(values, donors)
            grouped = values[:, :bands * rows].reshape(n, bands, rows)
            buckets = np.zeros((n, bands), U64)
            for step in range(rows):
                buckets = buckets * U64(0x9E3779B97F4A7C15) + grouped[:, :, step]
            buckets = mix(buckets + places).view(np.int64)
            signature = (mix(values.copy()) & U64(255)).astype(np.uint8)
            offsets = np.arange(n + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(buckets.ravel())),
                 pa.array([r.tobytes() for r in signature], pa.binary())],
                ["doc_id", "n_shingles", "set_key", "buckets", "signature"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.view(np.int64) for s in
                     shingle_sets([encode(t) for t in batch["text"].to_pylist()], size)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["doc_id", "shingles"])
    return run


class _Chunks:
    """One chunk of a bucket, or two to be held against each other."""

    def __init__(self, table: pa.Table, sizes: np.ndarray, percent: int):
        self.ids = table["doc_id"].to_numpy()
        self.label = np.unique(table["component"].to_numpy(), return_inverse=True)[1]
        self.side, band = table["side"].to_numpy(), table["band"][0].as_py()
        signs = b"".join(table["signature"].to_pylist())
        self.signs = np.frombuffer(signs, np.uint8).reshape(len(self.ids), -1)
        places = np.array(table["buckets"].to_pylist(), np.int64).reshape(len(self.ids), -1)
        self.earlier, self.sizes, self.least = places[:, :band], sizes.astype(np.float64), percent / 100
        # side 0 is to be held against side 1, side 2 against itself
        self.left, self.right = np.flatnonzero(self.side != 1), np.flatnonzero(self.side != 0)

    def likely(self, a: int) -> np.ndarray:
        """Partners of a in other components that set sizes and signatures (five deviations of the
        estimate) do not rule out, the likeliest first. A pair that meets in several bands is left to the
        first of them."""
        b, least = self.right, self.least
        b = b[(self.label[b] != self.label[a]) & ((self.side[a] != 2) | (self.ids[b] > self.ids[a]))]
        small, large = np.minimum(self.sizes[b], self.sizes[a]), np.maximum(self.sizes[b], self.sizes[a])
        b, small = b[small >= least * large], small[small >= least * large]
        agree = (self.signs[b] == self.signs[a]).mean(axis=1)
        margin = 5 * np.sqrt(least * (1 - least) / np.clip(small, 1, self.signs.shape[1]))
        near = (agree >= least - margin) & ~(self.earlier[b] == self.earlier[a]).any(axis=1)
        return b[near][np.argsort(-agree[near], kind="stable")]


def _with_partners(percent: int):
    """The documents of one chunk pair that have a likely partner in another component."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        held = _Chunks(table, table["n_shingles"].to_numpy(), percent)
        found = np.zeros(len(held.ids), bool)
        for a in held.left:
            partners = held.likely(a)
            found[partners] = True
            found[a] |= len(partners) > 0
        return table.filter(pa.array(found)).select(["band", "bucket", "doc_id", "n_shingles", "component"])
    return run


def _missing_links(percent: int):
    """Links between the components of one chunk pair, as few as join them: likely pairs are tried on
    their full sets until the two are in one component."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = [v.to_numpy().view(U64) for v in (s.values for s in table["shingles"])]
        held = _Chunks(table, np.array([len(s) for s in sets]), percent)
        ids, label = held.ids, held.label

        def linked(a: int, b: int) -> bool:
            one, two = sets[a], sets[b]
            common = np.count_nonzero(two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one)
            return 100 * common >= percent * (len(one) + len(two) - common)

        links = []
        for a in held.left:
            b = held.likely(a)
            while len(b):
                if linked(a, b[0]):
                    links.append((int(ids[a]), int(ids[b[0]])))
                    label[label == label[b[0]]] = label[a]
                    b = b[label[b] != label[a]]
                else:
                    b = b[1:]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([x for _, x in links], pa.int64())})
    return run


def _against_each_other(rows: DataFrame, chunks: Column) -> DataFrame:
    """Each document once per chunk of its bucket; rows of one (band, bucket, c0, c1) meet."""
    return (rows.withColumn("chunks", chunks.cast("int"))
            .withColumn("chunk", F.pmod(F.xxhash64("doc_id"), "chunks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumn("c0", F.least("chunk", "other")).withColumn("c1", F.greatest("chunk", "other"))
            .withColumn("side", F.when(F.col("chunk") == F.col("other"), 2)
                        .when(F.col("chunk") < F.col("other"), 0).otherwise(1))
            .drop("n", "chunks", "chunk", "other"))


def _links_between(stars: DataFrame, full: DataFrame, sets: DataFrame, parts: DataFrame,
                   percent: int) -> DataFrame:
    """Links (a, b) that join components within buckets. A bucket is compared in chunks of a bounded
    size, each pair of chunks in a task of its own: by signatures first, by sets what they leave."""
    placed = stored(stars.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")), "placed")
    mixed = (placed.groupBy("band", "bucket")
             .agg(F.min("component").alias("c0"), F.max("component").alias("c1"),
                  F.count("*").alias("n")).where("c0 <> c1 and n > 2").drop("c0", "c1"))
    signs = full.select("doc_id", "n_shingles", "signature", "buckets")
    met = (_against_each_other(placed.drop("a").join(mixed, ["band", "bucket"]).join(signs, "doc_id"),
                               F.ceil(F.col("n") / _CHUNK))
           .groupBy("band", "bucket", "c0", "c1"))
    near = stored(met.applyInArrow(_with_partners(percent), "band int, bucket long, doc_id long, "
                                   "n_shingles long, component long").distinct(), "with-partners")
    if near.isEmpty():
        return near.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    load = near.groupBy("band", "bucket").agg(F.greatest(
        F.count("*") / _SET_CHUNK, F.sum("n_shingles") / _SET_SHINGLES).alias("n"))
    tried = (_against_each_other(near.select("band", "bucket", "doc_id", "component").distinct()
                                 .join(load, ["band", "bucket"]).join(signs.drop("n_shingles"), "doc_id")
                                 .join(sets, "doc_id"), F.ceil("n"))
             .groupBy("band", "bucket", "c0", "c1"))
    return tried.applyInArrow(_missing_links(percent), "a long, b long").distinct()


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose full sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (edges.join(two, "b").join(one, "a").withColumn("common", common)
            .where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 25,
                    rows: int = 5) -> DataFrame:
    """docs(doc_id, text) → (doc_id, n_shingles, component_id, kept), one row per input row.

    Documents link where the Jaccard similarity of their sets of `size`-word shingles is at least
    `percent` / 100; `component_id` is the smallest doc_id reachable by links.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    sketches = stored(texts.mapInArrow(
        _sketch(size, bands, rows), "doc_id long, n_shingles long, set_key binary, "
        "buckets array<long>, signature binary"), "sketches")

    # equal sets: one representative each
    named = sketches.where("set_key is not null and doc_id is not null")
    heads = stored(named.groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("head")), "heads")
    # a doc_id on several rows may name several texts, so a head is known by its name and its set
    full = (named.join(heads.withColumnRenamed("head", "doc_id"),
                       ["doc_id", "set_key", "n_shingles"], "left_semi")
            .dropDuplicates(["doc_id", "set_key"]))
    entries = stored(full.select("doc_id", F.posexplode("buckets").alias("band", "bucket")), "entries")
    shared = (entries.groupBy("band", "bucket")
              .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a <> z"))
    stars = stored(entries.join(shared.drop("z"), ["band", "bucket"]), "stars")
    edges = stored(stars.where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct(), "edges")
    wanted = edges.select(F.col("a").alias("doc_id")).union(edges.select("b")).distinct()
    # a merge join at every size: the share of documents that have partners follows the corpus
    sets = stored(texts.join(wanted.hint("merge"), "doc_id", "left_semi")
                  .mapInArrow(_sets(size), "doc_id long, shingles array<long>"), "sets")
    links = stored(_confirmed(edges, sets, percent), "links")
    parts = stored(components(links), "parts")
    more = stored(_links_between(stars, full, sets, parts, percent), "more-links")
    if not more.isEmpty():
        known = parts.select(F.col("id").alias("a"), F.col("component").alias("b"))
        parts = stored(components(known.unionByName(more)), "parts")

    groups = (heads.join(parts.withColumnRenamed("id", "head"), "head", "left")
              .select("set_key", "n_shingles", F.coalesce("component", "head").alias("component")))
    return (sketches.select("doc_id", "n_shingles", "set_key")
            .join(groups, ["set_key", "n_shingles"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _row_names(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc_id, digest, row_name) of the distinct texts under repeated doc_ids: new names beyond all
    doc_ids, so that each text is a document of its own."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    first = high + 1 if high < 1 << 62 else low - (1 << 61)
    texts = (docs.join(repeated.select("doc_id"), "doc_id", "left_semi")
             .select("doc_id", _digest().alias("digest")).distinct())
    return texts.withColumn("row_name", F.lit(first) + F.monotonically_increasing_id())


def _digest() -> Column:
    return F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit(b""))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs less near duplicates: of each group of linked texts one row stays.

    Groups are of texts. Rows that share a doc_id are documents of their own where their texts differ and
    copies where they are equal; rows without a doc_id all stay. Which doc_ids repeat is known from
    the ids alone; where none does, rows go by doc_id.
    """
    spark = ready(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = given.where("doc_id is not null")
    key, digest, name = (unused(docs, c) for c in ("row_key", "row_digest", "row_name"))
    with private_tables(spark):
        repeated = stored(named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"), "repeated-ids")
        if repeated.isEmpty():
            gone = kept_beyond(near_duplicates(given, size, percent).where("not kept").select("doc_id"), "near-duplicates")
            names = None
        else:
            names = kept_beyond(_row_names(named, repeated), "row-names")
            own = given.withColumn("digest", _digest()).join(names, ["doc_id", "digest"], "left")
            judged = near_duplicates(own.select(F.coalesce("row_name", "doc_id").alias("doc_id"), "text"), size, percent)
            gone = kept_beyond(judged.where("not kept").select("doc_id").distinct(), "near-duplicates")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if names is None:
        left = docs.withColumn(key, F.col("doc_id").cast("long"))
        return left.join(gone.withColumnRenamed("doc_id", key), key, "left_anti").select(*columns)
    names = names.toDF(key, digest, name)
    rows = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(digest, _digest())
    rows = rows.join(names, [key, digest], "left").withColumn(key, F.coalesce(name, key))
    rows = rows.join(gone.withColumnRenamed("doc_id", key), key, "left_anti")
    # equal texts of one doc_id are one document on several rows
    return (rows.where(F.col(name).isNull()).select(*columns)
            .unionAll(rows.where(F.col(name).isNotNull()).dropDuplicates([name]).select(*columns)))
