r"""Mail archives as a data source whose partitions are ranges of bytes, so many tasks read one archive.

``spark.read.format("mbox").load(root)`` gives (source_file, byte_offset,
from_line, message) of every ``*.txt`` below a root, in the files' byte offsets.
A range has the messages whose From line starts in it; the last one is read on
into the next range, to the next From line or the end of the file.  A task holds
one message and a buffer, whatever the size of the archive.

Where a message starts does not depend on where reading began.  A From line's
pattern is a run of nine words at most, and no place in such a run can start
another match: ``From`` could only be its second word or the one behind ``at``,
and what follows then is no address.  So the pattern at a line's start decides,
once so many words behind it have been read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltstone import lineage
from siltstone.functions import mail
from siltstone.sources import places

SCHEMA = "source_file string, byte_offset long, from_line string, message binary"
#: Bytes of a range, of a read, of a batch that a task hands on; words that decide whether a line is a From line.
RANGE, READ, BATCH, WORDS = 64 << 20, 1 << 20, 4 << 20, 10
#: Bytes of a task that takes many small ranges; so many tasks there are at least, if the ranges are that many.
TASK, TASKS = 8 << 20, 32


@dataclass
class Ranges(InputPartition):
    """(file below the root, from, to) that one task reads."""

    ranges: list[tuple[str, int, int]]


def planned(files: list[tuple[str, int]], size: int) -> list[Ranges]:
    """Large files cut into ranges of the size, small ones put together up to it."""
    out, held, room = [], [], size
    for name, length in files:
        for lo in range(0, length, size):
            one = (name, lo, min(lo + size, length))
            if held and one[2] - lo > room:
                out.append(Ranges(held))
                held, room = [], size
            held.append(one)
            room -= one[2] - lo
    return out + ([Ranges(held)] if held else [])


def dealt(parts: list[Ranges], size: int) -> list[Ranges]:
    """Small parts put together up to a size, so that tasks do not grow in number with every range; ranges that follow one another become one."""
    out: list[Ranges] = []
    room = 0
    for part in parts:
        n = sum(hi - lo for _, lo, hi in part.ranges)
        if not out or n > room:
            out.append(Ranges([]))
            room = size
        room -= n
        held = out[-1].ranges
        for name, lo, hi in part.ranges:
            if held and held[-1][0] == name and held[-1][2] == lo:
                held[-1] = (name, held[-1][1], hi)
            else:
                held.append((name, lo, hi))
    return out


def _starts(data: bytes, at: int, whole: bool, first: bool) -> tuple[list[int], int]:
    """Where From lines start in data from a place on, and the place up to which that is decided; ``whole``: nothing follows, ``first``: the data start a line."""
    found = []
    look = at if first or at else 1  # the byte before the range only tells whether a line starts behind it
    while True:
        here = look == 0 and data.startswith(b"From")
        p = 0 if here else data.find(b"\nFrom", max(0, look - 1)) + 1
        if not p and not here:
            return found, max(look, len(data) - 3)
        if not whole and not _decidable(data, p):
            return found, p
        if mail.BOUNDARY.match(data, p):
            found.append(p)
        look = p + 1


def _decidable(data: bytes, p: int) -> bool:
    """Whether so many words stand behind a place that no more bytes change what it is."""
    return any(len(data[p : p + n].split(None, WORDS)) > WORDS for n in (4096, len(data)))


def read_range(stream, lo: int, hi: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes with the From line) of the messages that start in a range of a file of this size."""
    base = max(0, lo - 1)
    stream.seek(base)
    data, decided, open_at = b"", 0, None
    while True:
        more = stream.read(min(READ, max(hi - base - len(data), 1 << 14)))
        data += more
        whole = base + len(data) >= size or not more
        found, decided = _starts(data, decided, whole, base == lo)
        for p in found:
            if open_at is not None:
                yield base + open_at, data[open_at:p]
            if base + p >= hi:
                return
            open_at = p
        if whole:
            if open_at is not None:
                yield base + open_at, data[open_at:]
            return
        if open_at is None and base + decided >= hi:
            return
        keep = decided - 1 if open_at is None else open_at  # a byte before what is undecided, to see its line's start
        if keep > 0:
            data, base, decided = data[keep:], base + keep, decided - keep
            open_at = None if open_at is None else 0


class MboxReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.size = int(options.get("rangebytes", RANGE))

    def partitions(self) -> list[Ranges]:
        files = places.files_below(self.root, ".txt")
        return dealt(planned(files, self.size), max(self.size, min(TASK, sum(n for _, n in files) // TASKS)))

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        where, root = places.reach(self.root)
        rows, held = [], 0
        for name, lo, hi in partition.ranges:
            path = f"{root.rstrip('/')}/{name}"
            with where.open_input_file(path) as f:
                for offset, raw in read_range(f, lo, hi, f.size()):
                    line = mail.BOUNDARY.match(raw)[0].decode("utf-8", "replace").strip()
                    rows.append((name, offset, line, raw.partition(b"\n")[2]))
                    held += len(raw)
                    if held >= BATCH:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["source_file", "byte_offset", "from_line", "message"])


class Mbox(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mbox"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MboxReader:
        return MboxReader(self.options)


def read(spark: SparkSession, root: str, range_bytes: int = RANGE) -> DataFrame:
    """The messages of all archives below root, by ranges of bytes."""
    lineage.ship(spark)
    spark.dataSource.register(Mbox)
    return spark.read.format("mbox").option("rangebytes", str(range_bytes)).load(root)
