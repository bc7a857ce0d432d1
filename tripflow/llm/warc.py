"""Web archives as chunked record tables.

Method. A payload is turned into rows of record identifier and chunk number, each row one WARC
record of bounded size: the first is a `response` (or a `revisit` without a payload), the others are
`continuation` records. A digest is carried along while the chunks are cut, and every row states
the digest of the payload so far; the last one's is the payload's own. Reading back works on the
same rows: records of one chunk are checked and hashed where they are read; only the chunks of
longer records are shuffled, sorted by number and fed one after the other to a running digest, which
must agree with the stated one after every chunk. No step holds a whole payload of an archive.

Archives are plain WARC/1.1 files written and read by Spark's text source, in the folder a caller
names, which may be in any store that Spark reaches. The end of a record with the next one's first line is
the line separator when reading; the writer cuts a payload inside every `WARC/1.1` that it holds, so
that neither a chunk nor its borders can be taken for one. Block lengths are checked against
Content-Length.

Among pages with equal payloads of at least `least_bytes` the one with the largest page_id is
stored, the others refer to it.

Null html is the empty payload. Every row is a record of its own, with an identifier that holds its
page_id and its place in the run, so rows that repeat a page_id, or have none, come back one by one.
Rows without a page_id are always stored, and nothing refers to them. Other columns are not read. No
rows in, no records out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import encode
from .work import ready

_VERSION = "WARC/1.1\r\n"
_SEPARATOR = "\r\n\r\n" + _VERSION
_MARK = b"WARC/1.1"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"
_BATCH_BYTES = 8 << 20


def cuts(payload: bytes, chunk_bytes: int) -> list[int]:
    """Where a payload is cut: after every `chunk_bytes`, never inside a character, and inside
    every version line."""
    marks, at = [], payload.find(_MARK)
    while at >= 0:
        marks.append(at + 2)
        at = payload.find(_MARK, at + 2)
    marks.append(len(payload))
    out, start = [], 0
    for mark in marks:
        while mark - start > chunk_bytes:
            stop = start + chunk_bytes
            while stop > max(start + 1, start + chunk_bytes - 3) and payload[stop] & 0xC0 == 0x80:
                stop -= 1
            out.append(stop)
            start = stop
        out.append(mark)
        start = mark
    return out


def _header(fields: list[tuple[str, object]]) -> bytes:
    return (_VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _records(chunk_bytes: int):
    def rows(name: str, url: str | None, html: str | None, refers_to: int | None,
             digest: str | None) -> Iterator[bytes]:
        uri = " ".join((url or "").split())
        common = [("WARC-Date", _DATE), ("WARC-Target-URI", uri)]
        if refers_to is not None:
            yield _header([
                ("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common,
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Payload-Digest", f"sha1:{digest}"),
                ("Content-Length", 0)]) + b"\r\n"
            return
        payload = encode(html)
        stops, running, start = cuts(payload, chunk_bytes), hashlib.sha1(), 0
        for number, stop in enumerate(stops, 1):
            chunk = payload[start:stop]
            running.update(chunk)
            block = (_HTTP.encode() if number == 1 else b"") + chunk
            fields = [("WARC-Type", "response" if number == 1 else "continuation"),
                      ("WARC-Record-ID", f"<{name}>" if number == 1 else f"<{name}:{number}>"),
                      *common]
            if number == 1:
                fields.append(("Content-Type", "application/http; msgtype=response"))
            else:
                fields.append(("WARC-Segment-Origin-ID", f"<{name}>"))
            if len(stops) > 1:
                fields.append(("WARC-Segment-Number", number))
                if number == len(stops):
                    fields.append(("WARC-Segment-Total-Length", len(payload) + len(_HTTP)))
            fields += [("X-Digest-So-Far", f"sha1:{running.hexdigest()}"), ("Content-Length", len(block))]
            yield _header(fields) + block + b"\r\n"
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to", "digest")]
            for page_id, *record in zip(*columns):
                count += 1
                for row in rows(f"urn:page:{'' if page_id is None else page_id}:{part}.{count}", *record):
                    held.append(row)
                    size += len(row)
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
    return run


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = 1 << 18,
                   least_bytes: int = 1000, records_per_file: int = 5_000,
                   compression: str = "gzip") -> None:
    """Write pages(page_id, url, html) as WARC files below `path`, compressed as a whole file each
    or plain (`none`). A compressed file is read by one task, so files have a bounded number of
    records."""
    ready(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    marked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).alias("bytes"))
    long = marked.where(F.col("bytes") >= least_bytes).select("page_id", "digest", "bytes")
    copied = (long.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"),
                                                  F.min("page_id").alias("other"))
              .where("refers_to <> other").drop("other"))
    revisits = (long.join(copied, ["digest", "bytes"]).where("page_id <> refers_to")
                .select("page_id", "digest", "refers_to").distinct())
    (marked.join(revisits, ["page_id", "digest"], "left")
     .mapInArrow(_records(chunk_bytes), "value binary")
     # the bytes as they are: the text source writes them unchanged
     .select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The chunk rows of archives: record, page_id, chunk, type, refers_to, so_far, last, payload."""
    lines = spark.read.option("lineSep", _SEPARATOR).text(path).where(F.length("value") > 0)
    data = F.col("value").cast("binary")
    head = F.substring_index("value", "\r\n\r\n", 1)
    field = lambda name: F.regexp_extract(F.concat(F.lit("\r\n"), "head"), rf"\r\n{name}: ([^\r]*)", 1)
    page = lambda text: F.regexp_extract(text, r"^<urn:page:(-?\d+)", 1)
    split = lines.select(data.alias("data"), head.alias("head")).withColumn(
        "head_bytes", F.octet_length("head") + 4)
    named = split.select(
        F.when(field("WARC-Type") == "continuation", field("WARC-Segment-Origin-ID"))
        .otherwise(field("WARC-Record-ID")).alias("record"),
        F.nullif(page(field("WARC-Record-ID")), F.lit("")).cast("long").alias("page_id"),
        F.coalesce(F.nullif(field("WARC-Segment-Number"), F.lit("")).cast("int"), F.lit(1)).alias("chunk"),
        field("WARC-Type").alias("type"),
        F.nullif(page(field("WARC-Refers-To")), F.lit("")).cast("long").alias("refers_to"),
        F.regexp_replace(F.when(field("WARC-Type") == "revisit", field("WARC-Payload-Digest"))
                         .otherwise(field("X-Digest-So-Far")), "^sha1:", "").alias("so_far"),
        ((field("WARC-Segment-Number") == "") | (field("WARC-Segment-Total-Length") != "")).alias("last"),
        field("Content-Length").cast("int").alias("length"), "head_bytes", "data")
    # what follows the block is the end of the record: nothing, or the separator at a file's end
    rest = F.octet_length("data") - F.col("head_bytes") - F.col("length")
    checked = named.withColumn("length", F.when((rest >= 0) & (rest <= 4), F.col("length")).otherwise(
        F.raise_error(F.concat(F.lit("broken record "), F.col("record"))).cast("int")))
    skip = F.when(F.col("type") == "response", F.lit(len(_HTTP))).otherwise(0)
    return checked.select("record", "page_id", "chunk", "type", "refers_to", "so_far", "last",
                          F.substring("data", F.col("head_bytes") + skip + 1, F.col("length") - skip)
                          .alias("payload"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record, from chunk rows in order; only the running digest is kept."""
    name, size, running, expected, so_far = None, 0, None, 0, None
    for batch in batches:
        names, sizes, digests = [], [], []
        for number, stated, last, this, page, payload in zip(*(batch[c].to_pylist() for c in (
                "chunk", "so_far", "last", "record", "page_id", "payload"))):
            if number == 1:
                name, size, running, expected = this, 0, hashlib.sha1(), 1
            if this != name or number != expected:
                raise ValueError(f"chunk {expected} of {name} is missing")
            running.update(payload)
            size, expected, so_far = size + len(payload), expected + 1, running.hexdigest()
            if so_far != stated:
                raise ValueError(f"chunk {number} of {name} is damaged")
            if last:
                names.append(page)
                sizes.append(size)
                digests.append(so_far)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
            ["page_id", "payload_bytes", "payload_digest"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to. Damage is an error."""
    ready(spark)
    rows = read_records(spark, path)
    single = rows.where("type = 'response' and last")
    digest = F.sha1("payload")
    plain = single.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == F.col("so_far"), digest).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload of "), F.col("record"))))
        .alias("payload_digest"))
    chunked = (rows.where("type = 'continuation' or (type = 'response' and not last)")
               .repartition("record").sortWithinPartitions("record", "chunk")
               .mapInArrow(_digests, "page_id long, payload_bytes long, payload_digest string"))
    stored = plain.unionByName(chunked)
    revisits = rows.where("type = 'revisit'").select("record", "page_id", "refers_to", "so_far")
    referred = stored.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("so_far"),
                             "payload_bytes", "payload_digest").distinct()
    checked = revisits.join(referred, ["refers_to", "so_far"], "left").select(
        "page_id", "payload_bytes",
        F.when(F.col("payload_digest") == F.col("so_far"), F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("broken reference of "), F.col("record"))))
        .alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    return stored.select("page_id", "payload_bytes", "payload_digest",
                         F.lit("response").alias("record_type"),
                         F.lit(None).cast("long").alias("refers_to")).unionByName(checked)
