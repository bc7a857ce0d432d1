"""Records of large JSON arrays, in bounded memory and by all tasks at once.

A file that is one array, or one object that holds the array under a key, has no line to split at. It is cut at
every closing brace instead, which text readers can do anywhere in a file, so a file is as many
splits as its size asks for and no task holds more than a record and a batch of pieces.

Whether a brace is part of a string, and how deep it lies, depends on all that comes before. Two
passes find out. The first sums up each split for both cases, starting inside a string or outside:
how the depth changes, how low it gets, and where the wanted key opens a list. The sums of a file's
splits, a small row per split, are put together in order on the driver, which gives every split the
state it starts in; their number is the input's size over that of a split. The second pass walks each split from that
state and cuts out the records. One that begins in a split and ends in another comes out in parts,
which are joined by the split it began in.

Elements that are not objects are left out. A file that ends inside a value is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a string, closed or not, or a bracket
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|[{}\[\]]', re.DOTALL)
_CLOSE = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
Key = tuple[str, int]


@dataclass
class Sums:
    """What a split does to the state it starts in, for one of the two cases."""

    in_string: bool
    depth: int = 0
    #: The lowest depth, seen from the start.
    lowest: int = 0
    #: Depths at which the key opened a list, and the lowest depth since the last time.
    lists: dict[int, int] = field(default_factory=dict)
    #: The bracket that was opened last at each depth.
    brackets: dict[int, str] = field(default_factory=dict)
    last_string: str = ""

    def take(self, text: str, key: str | None) -> None:
        """Go on over a piece."""
        at = 0
        if self.in_string:
            end = _CLOSE.match(text)
            if end is None:
                return
            at, self.in_string = end.end(), False
        for token in _TOKEN.finditer(text, at):
            first = token.group()[0]
            if first == '"':
                self.in_string = not token.group(1)
                self.last_string = token.group()
            elif first in "{[":
                if first == "[" and key is not None and _names(self.last_string, key):
                    self.lists[self.depth] = self.depth + 1
                self.brackets[self.depth] = first
                self.depth += 1
            else:
                self.depth -= 1
                self.lowest = min(self.lowest, self.depth)
                for depth, least in self.lists.items():
                    self.lists[depth] = min(least, self.depth)

    def told(self) -> list:
        return [self.in_string, self.depth, self.lowest, sorted(self.lists.items()), sorted(self.brackets.items())]


def _names(token: str, key: str) -> bool:
    try:
        return json.loads(token, strict=False) == key
    except ValueError:
        return False


@dataclass(frozen=True)
class Start:
    """The state in which a split starts."""

    in_string: bool = False
    depth: int = 0
    #: Is the split inside the wanted list (or a top-level array)?
    inside: bool = False
    #: The split in which the record that is open here began.
    opened: int | None = None


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Key, str]]:
    """Each split's pieces in order, the closing brace put back."""
    for batch in batches:
        for file, start, text in zip(*(batch[c].to_pylist() for c in ("file", "start", "value"))):
            yield (file, start), text + "}"


def _sum_up(key: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cases, head = None, [], ""
        told: list[tuple[Key, str]] = []
        for split, text in _pieces(batches):
            if split != now:
                if now is not None:
                    told.append((now, json.dumps([head, *[c.told() for c in cases]])))
                now, cases, head = split, [Sums(False), Sums(True)], ""
            head = head or text.lstrip("\ufeff \t\r\n")[:1]
            for case in cases[:1] if split[1] == 0 else cases:
                case.take(text, key)
        if now is not None:
            told.append((now, json.dumps([head, *[c.told() for c in cases]])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in told], pa.string()), pa.array([k[1] for k, _ in told], pa.int64()),
             pa.array([t for _, t in told], pa.string())], ["file", "start", "sums"])
    return run


def _starts(sums: list, key: str | None) -> dict[Key, Start]:
    """Put the splits of each file together in their order."""
    states: dict[Key, Start] = {}
    files: dict[str, list] = {}
    for row in sums:
        files.setdefault(row["file"], []).append((row["start"], json.loads(row["sums"])))
    for file, splits in files.items():
        state, base = Start(), 0
        for place, (start, (head, *cases)) in enumerate(sorted(splits)):
            if place == 0:
                # the depth outside records: 0 for objects in a row, 1 in an array, 2 in a list of an object
                base = 2 if key is not None else int(head == "[")
                state = Start(inside=key is None)
            states[file, start] = state
            in_string, change, lowest, lists, brackets = cases[state.in_string]
            inside = state.inside
            if key is not None:
                inside = inside and state.depth + lowest >= 2
                for depth, least in lists:
                    inside = inside or (state.depth + depth == 1 and state.depth + least >= 2)
            depth, opened = state.depth + change, None
            if inside and depth > base:
                if state.depth + lowest > base:  # in one value from end to end
                    opened = state.opened
                elif dict(brackets)[base - state.depth] == "{":
                    opened = start
            state = Start(in_string, depth, inside, opened)
        if state.in_string or state.depth > 0:
            raise ValueError(f"{file} ends inside a value")
    return states


class _Walk:
    """Cuts the records out of one split."""

    def __init__(self, state: Start, start: int, key: str | None, array: bool):
        self.in_string, self.depth, self.inside, self.opened = state.in_string, state.depth, state.inside, state.opened
        self.start, self.key, self.base = start, key, 2 if key is not None else int(array)
        self.parts: list[str] = []
        self.last_string = ""

    def take(self, text: str) -> Iterator[tuple[int, str]]:
        """Records that end in this piece, each with the split it began in."""
        at, begin = 0, 0 if self.opened is not None else None
        if self.in_string:
            end = _CLOSE.match(text)
            if end is not None:
                at, self.in_string = end.end(), False
            else:
                at = len(text)
        for token in _TOKEN.finditer(text, at):
            first = token.group()[0]
            if first == '"':
                self.in_string = not token.group(1)
                if self.opened is None:
                    self.last_string = token.group()
            elif first in "{[":
                if self.opened is None:
                    if self.inside and self.depth == self.base and first == "{":
                        self.opened, begin = self.start, token.start()
                    elif self.key is not None and first == "[" and self.depth == 1 and _names(self.last_string, self.key):
                        self.inside = True
                self.depth += 1
            else:
                self.depth -= 1
                if self.opened is not None and self.depth == self.base:
                    yield self.opened, "".join([*self.parts, text[begin:token.end()]])
                    self.parts, self.opened, begin = [], None, None
                if self.key is not None and self.depth < 2:
                    self.inside = False
        if self.opened is not None:
            self.parts.append(text[begin:])


def _cut(starts: dict[Key, Start], arrays: set[str], key: str | None):
    """Records, and parts of records, of each split: the split they began in and whether they are whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, walk, held, size = None, None, [], 0

        def rows() -> pa.RecordBatch:
            columns = list(zip(*held)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))],
                ["file", "opened", "start", "whole", "record"])

        def rest() -> list[tuple]:
            if walk is None or walk.opened is None or not walk.parts:
                return []
            return [(now[0], walk.opened, now[1], False, "".join(walk.parts))]

        for split, text in _pieces(batches):
            if split != now:
                held += rest()
                now, walk = split, _Walk(starts[split], split[1], key, split[0] in arrays)
            for opened, record in walk.take(text):
                held.append((split[0], opened, split[1], opened == split[1], record))
                size += len(record)
            if size > 1 << 20 or len(held) > 2000:
                yield rows()
                held, size = [], 0
        held += rest()
        yield rows()
    return run


def json_array_records(spark: SparkSession, path: str, record_list: str | None = None) -> DataFrame:
    """Files of JSON arrays of objects, or of objects that hold the array under the key `record_list` of
    their top level, to rows (record, file): each object as its text.

    Several values may follow each other in a file. Without `record_list` top-level objects are records too.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    found = pieces.mapInArrow(_sum_up(record_list), "file string, start long, sums string").collect()  # a row per split
    starts = _starts(found, record_list)
    first: dict[str, tuple[int, str]] = {}
    for row in found:
        if row["file"] not in first or row["start"] < first[row["file"]][0]:
            first[row["file"]] = (row["start"], json.loads(row["sums"])[0])
    arrays = {file for file, (_, head) in first.items() if head == "["}
    cut = pieces.mapInArrow(_cut(starts, arrays, record_list),
                            "file string, opened long, start long, whole boolean, record string")
    whole = cut.where("whole").select("record", "file")
    if all(state.opened is None for state in starts.values()):
        return whole
    # a record's parts, one per split it lies in
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    joined = cut.where("not whole").groupBy("file", "opened").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "").alias("record"))
    return whole.unionByName(joined.select("record", "file"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, record_list: str | None = None) -> DataFrame:
    """The records of JSON arrays as declared columns; keys that a record lacks are NULL."""
    records = json_array_records(spark, path, record_list)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")
