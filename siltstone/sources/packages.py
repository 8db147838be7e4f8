"""Zip packages made by tasks: members are deflated apart, their places follow from sizes, and every task writes its own.

1. The tree's files, sorted by path into ranges, become members: a local header
   and deflated bytes, written as a table, so a lost executor costs its range.
2. A member's offset is the sum of the sizes before it: of the partitions in front,
   one row each, and of its own partition up to it.  The same is done for the
   records of the central directory.
3. On a local or mounted folder tasks write members and records at their offsets
   into a file beside the package's place; elsewhere one task writes them in order
   as a stream.  The file is then renamed over the old package.

Offsets over 4 GB and more than 65,535 members take the 64-bit records.  A member
is a row, so a file has 2 GB at most.
"""

from __future__ import annotations

import bz2
import io
import lzma
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone import lineage
from siltstone.sources import corpus, places, scans

# Fixed values of the format: versions, flags for UTF-8 names, deflate, the first day that it can say, limits of the 32-bit records.
_VERSION, _VERSION_64, _UTF8, _DEFLATE, _DAY = 20, 45, 0x800, 8, 0x21
_MOST, _MEMBERS = 0xFFFFFFFF, 0xFFFF
LEVEL = 6


def member(name: bytes, content: bytes) -> tuple[bytes, int, int, int]:
    """(local header and deflated bytes, checksum, deflated size, size)."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    packed = packer.compress(content) + packer.flush()
    crc = zlib.crc32(content)
    head = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", _VERSION, _UTF8, _DEFLATE, 0, _DAY, crc, len(packed), len(content), len(name), 0)
    return head + name + packed, crc, len(packed), len(content)


def record(name: bytes, crc: int, packed: int, size: int, offset: int) -> bytes:
    """A member's record in the central directory."""
    far = offset >= _MOST
    extra = struct.pack("<HHQ", 1, 8, offset) if far else b""
    return struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", _VERSION_64 if far else _VERSION, _VERSION_64 if far else _VERSION, _UTF8, _DEFLATE, 0, _DAY, crc, packed, size, len(name), len(extra), 0, 0, 0, 0, _MOST if far else offset) + name + extra


def end(members: int, directory: int, offset: int) -> bytes:
    """What stands behind the central directory."""
    out = b""
    if members >= _MEMBERS or directory >= _MOST or offset >= _MOST:
        out = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, _VERSION_64, _VERSION_64, 0, 0, members, members, directory, offset) + struct.pack("<4sIQI", b"PK\x06\x07", 0, offset + directory, 1)
    n = min(members, _MEMBERS)
    return out + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, n, n, min(directory, _MOST), min(offset, _MOST), 0)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):  # one member is in memory at a time
            entry, crc, packed, size = member(name.encode(), content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([crc]), pa.array([packed], type=pa.int64()), pa.array([size], type=pa.int64()), pa.array([len(entry)], type=pa.int64()), pa.array([entry])], names=["name", "crc", "packed", "size", "bytes", "entry"])


def _placed(rows: DataFrame, size: str, offset: str) -> DataFrame:
    """rows (block, at, size) with the sum of the sizes in front of each."""
    sums = rows.groupBy("block").agg(F.sum(size).alias("_n"))  # one row a partition
    before = sums.select("block", F.coalesce(F.sum("_n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.coalesce(F.sum(size).over(W.partitionBy("block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.join(before, "block").withColumn(offset, F.col("_before") + within).drop("_before")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [record(n.encode(), *x) for n, *x in zip(*(b.column(c).to_pylist() for c in ("name", "crc", "packed", "size", "offset")), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("block"), b.column("at"), pa.array([len(m) for m in made], type=pa.int64()), pa.array(made, type=pa.binary())], names=["block", "at", "bytes", "entry"])


def _written(path: str, base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "r+b") as f:
            for b in batches:
                for offset, entry in zip(b.column("offset").to_pylist(), b.column("entry").to_pylist(), strict=True):
                    f.seek(base + offset)
                    f.write(entry)
        yield pa.RecordBatch.from_pydict({"offset": pa.array([], type=pa.int64())})

    return run


def _streamed(path: str, tail: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, at = places.reach(path)
        with where.open_output_stream(at) as out:
            for b in batches:
                for entry in b.column("entry").to_pylist():
                    out.write(entry)
            out.write(tail)
        yield pa.RecordBatch.from_pydict({"offset": pa.array([], type=pa.int64())})

    return run


def pack(files: DataFrame, path: str, apart: bool | None = None) -> int:
    """(name, content) as a zip package at a path, members in the order of their names; the number of members. ``apart``: tasks write at offsets (the default on local and mounted folders) or one task writes a stream."""
    spark = files.sparkSession
    lineage.ship(spark)
    sorted_files = files.select("name", F.col("content").cast("binary").alias("content")).repartitionByRange("name").sortWithinPartitions("name")
    made = sorted_files.mapInArrow(_members, "name string, crc long, packed long, size long, bytes long, entry binary")
    members = lineage.cut(made.select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at")), "package-members")
    entries = _placed(members.select("block", "at", "name", "crc", "packed", "size", "bytes"), "bytes", "offset")
    listed = lineage.cut(entries.mapInArrow(_records, "block int, at long, bytes long, entry binary"), "package-records")
    n, offset = members.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    directory = listed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tail = end(n, directory, offset)
    where, goal = places.reach(path)
    part = f"{path}.{uuid.uuid4().hex}"
    where.create_dir(os.path.dirname(goal), recursive=True)
    if apart if apart is not None else where.type_name == "local":
        local = places.plain(part)
        with open(local, "wb") as f:
            f.truncate(offset + directory)
            f.seek(offset + directory)
            f.write(tail)
        _placed(members.select("block", "at", "bytes", "entry"), "bytes", "offset").select("offset", "entry").mapInArrow(_written(local, 0), "offset long").count()
        _placed(listed, "bytes", "offset").select("offset", "entry").mapInArrow(_written(local, offset), "offset long").count()
    else:
        both = members.select(F.lit(0).alias("kind"), "block", "at", "entry").unionByName(listed.select(F.lit(1).alias("kind"), "block", "at", "entry"))
        both.repartition(1).sortWithinPartitions("kind", "block", "at").select("entry").mapInArrow(_streamed(part, tail), "offset long").count()
    places.replace(where, places.reach(part)[1], goal)
    return n


@dataclass
class Directory:
    """Where a package's central directory lies, and by how much its offsets are less than the file's."""

    start: int
    size: int
    shift: int


def directory_of(f, size: int) -> Directory:
    """Read off the records behind the central directory."""
    back = min(size, (1 << 16) + 22 + 20 + 56)
    f.seek(size - back)
    tail = f.read(back)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > back or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > back):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise zipfile.BadZipFile("no end of a central directory")
    length, start = struct.unpack_from("<II", tail, at + 12)
    stop = size - back + at
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        stop -= 20 + 56
        f.seek(stop)
        far = f.read(56)
        if far[:4] != b"PK\x06\x06":
            raise zipfile.BadZipFile("no 64-bit end of a central directory")
        length, start = struct.unpack_from("<QQ", far, 40)
    if stop - length < 0:
        raise zipfile.BadZipFile("the central directory is cut off")
    return Directory(stop - length, length, stop - length - start)


_HEAD = struct.Struct("<4sHHHHHHIIIHHHHHII")


def _far(more: bytes, packed: int, size: int, offset: int) -> tuple[int, int, int]:
    """Deflated size, size and offset of a record, by its 64-bit fields where it has those."""
    k = 0
    while k + 4 <= len(more):
        kind, n = struct.unpack_from("<HH", more, k)
        if kind == 1:
            p = k + 4
            if size == _MOST:
                size, p = struct.unpack_from("<Q", more, p)[0], p + 8
            if packed == _MOST:
                packed, p = struct.unpack_from("<Q", more, p)[0], p + 8
            if offset == _MOST:
                offset = struct.unpack_from("<Q", more, p)[0]
        k += 4 + n
    return packed, size, offset


def _listed(data: bytes, at: int, stop: int) -> tuple[list[tuple], int]:
    """Records of a central directory from a place on that start before another, and where the next one starts; -1 if a record is none."""
    found = []
    while at < stop:
        if at + _HEAD.size > len(data):
            return found, -1
        sign, _, _, flags, method, _, _, crc, packed, size, name, extra, comment, _, _, _, offset = _HEAD.unpack_from(data, at)
        end_at = at + _HEAD.size + name + extra + comment
        if sign != b"PK\x01\x02" or end_at > len(data):
            return found, -1
        label, more = data[at + _HEAD.size : at + _HEAD.size + name], data[at + _HEAD.size + name : at + _HEAD.size + name + extra]
        try:
            found.append((label.decode("utf-8" if flags & _UTF8 else "cp437"), flags, method, crc, *_far(more, packed, size, offset)))
        except (UnicodeDecodeError, struct.error):
            return found, -1
        at = end_at
    return found, at


#: Bytes of a central directory, and of members, that a task takes, both about; the most bytes of a record of the directory.
DIRECTORY_RANGE, MEMBERS_RANGE, _RECORD = 8 << 20, 64 << 20, _HEAD.size + 3 * 0xFFFF


def _range(f, where: Directory, lo: int, hi: int, start: int | None = None) -> tuple[int, list[tuple], int]:
    """(start, records, end) of the records that start in a range of the directory: from its first place on from which records follow one another, or from a given one."""
    f.seek(where.start + lo)
    data = f.read(min(hi - lo + _RECORD, where.size - lo))
    at = start - lo if start is not None else data.find(b"PK\x01\x02")
    while 0 <= at < hi - lo:
        found, stop = _listed(data, at, hi - lo)
        if stop >= 0:
            return lo + at, found, lo + stop
        if start is not None:
            raise zipfile.BadZipFile("a record of the central directory is broken")
        at = data.find(b"PK\x01\x02", at + 1)
    return hi if start is None else start, [], hi if start is None else start


def _restored(raw: bytes, name: str, flags: int, method: int, crc: int, size: int) -> bytes:
    if flags & 1:
        raise RuntimeError(f"{name} is encrypted")
    if method == zipfile.ZIP_STORED:
        out = raw
    elif method == zipfile.ZIP_DEFLATED:
        out = zlib.decompress(raw, -15)
    elif method == zipfile.ZIP_BZIP2:
        out = bz2.decompress(raw)
    elif method == zipfile.ZIP_LZMA:  # its properties stand behind four bytes; a stream of the older format has the size there, or all ones with an end mark
        n = struct.unpack_from("<H", raw, 2)[0]
        out = lzma.decompress(raw[4 : 4 + n] + struct.pack("<Q", (1 << 64) - 1 if flags & 2 else size) + raw[4 + n :], format=lzma.FORMAT_ALONE)
    else:
        raise NotImplementedError(f"{name} is packed by method {method}")
    if zlib.crc32(out) != crc or len(out) != size:
        raise zipfile.BadZipFile(f"{name} is not what its checksum says")
    return out


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of the members of packages at a path, a member is a row.

    Tasks read the central directory by ranges of bytes: each begins at the first
    place in its range from which records follow one another.  Where that is not where
    the range before it ended, which names that look like records could bring about, the driver reads this
    range again from there.  Members are then dealt by their places in the package, so a task reads
    about ``MEMBERS_RANGE`` bytes.  Where only Spark's readers reach a package, it is a row, so of 2 GB at most.
    """
    lineage.ship(spark)
    if not places.reachable(path):
        return _unpacked_whole(spark, path)
    found = None
    for package_ in sorted(r["path"] for r in scans.listed(spark, path).collect()):
        one = _unpacked(spark, package_, path)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], "name string, content binary") if found is None else found


_ENTRIES = "name string, flags int, method int, crc long, packed long, size long, offset long"


def _unpacked(spark: SparkSession, file: str, root: str) -> DataFrame:
    fs = places.reach(root)[0]
    with fs.open_input_file(file) as f:
        where = directory_of(f, f.size())
    ranges = [(lo, min(lo + DIRECTORY_RANGE, where.size)) for lo in range(0, where.size, DIRECTORY_RANGE)]
    if not ranges:
        return spark.createDataFrame([], "name string, content binary")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with places.reach(root)[0].open_input_file(file) as f:
            for b in batches:
                for lo, hi in zip(b.column("lo").to_pylist(), b.column("hi").to_pylist(), strict=True):
                    start, _, stop = _range(f, where, lo, hi)
                    yield pa.RecordBatch.from_pydict({"lo": pa.array([lo]), "start": pa.array([start]), "stop": pa.array([stop])})

    rows = spark.createDataFrame(ranges, "lo long, hi long").repartition(len(ranges), "lo")
    told = {r["lo"]: (r["start"], r["stop"]) for r in rows.mapInArrow(ends, "lo long, start long, stop long").collect()}
    at, begun = 0, []
    for lo, hi in ranges:
        if at >= hi:  # a record of the range before reaches over this one
            continue
        begun.append((at, hi))
        start, stop = told[lo]
        if start != at:
            with fs.open_input_file(file) as f:
                stop = _range(f, where, at, hi, at)[2]
        at = stop

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with places.reach(root)[0].open_input_file(file) as f:
            for b in batches:
                for lo, hi in zip(b.column("lo").to_pylist(), b.column("hi").to_pylist(), strict=True):
                    records = _range(f, where, lo, hi, lo)[1]
                    for i in range(0, len(records), 1 << 14):
                        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                        columns = zip(*records[i : i + (1 << 14)], strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=["name", "flags", "method", "crc", "packed", "size", "offset"])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with places.reach(root)[0].open_input_file(file) as f:
            for b in batches:
                names, contents, held = [], [], 0
                for name, flags, method, crc, packed, size, offset in zip(*(b.column(c).to_pylist() for c in ("name", "flags", "method", "crc", "packed", "size", "offset")), strict=True):
                    f.seek(where.shift + offset)
                    head = f.read(30)
                    if head[:4] != b"PK\x03\x04":
                        raise zipfile.BadZipFile(f"{name} has no header")
                    f.seek(where.shift + offset + 30 + sum(struct.unpack_from("<HH", head, 26)))
                    names.append(name)
                    contents.append(_restored(f.read(packed), name, flags, method, crc, size))
                    held += size
                    if held >= scans.BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), pa.array(contents, type=pa.binary())], names=["name", "content"])
                        names, contents, held = [], [], 0
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), pa.array(contents, type=pa.binary())], names=["name", "content"])

    listed = lineage.cut(spark.createDataFrame(begun, "lo long, hi long").repartition(len(begun), "lo").mapInArrow(entries, _ENTRIES), "package-entries")
    tasks = max(-(-where.start // MEMBERS_RANGE), min(spark.sparkContext.defaultParallelism, -(-where.start // (1 << 20))), 1)
    block = F.floor(F.col("offset") / F.lit(max(1, -(-where.start // (4 * tasks)))))  # neighbours go to one task
    return listed.withColumn("block", block).repartition(tasks, "block").sortWithinPartitions("offset").drop("block").mapInArrow(members, "name string, content binary")


def _unpacked_whole(spark: SparkSession, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        yield pa.RecordBatch.from_pydict({"name": pa.array([name]), "content": pa.array([z.read(name)])})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "name string, content binary")


def package(spark: SparkSession, release_tree: str, packages_dir: str, name: str, run_dir: str, hosted: bool, today: date | None = None) -> str:
    """One dated package of a release tree, everything below a folder of its name; local runs add the run's last word to the file's name. Its path."""
    suffix = "" if hosted else "-" + run_dir.rstrip("/").rsplit("-", 1)[-1]
    path = f"{packages_dir.rstrip('/')}/{name}-{(today or date.today()).isoformat()}{suffix}.zip"
    found = corpus.contents(spark, release_tree)
    pack(found.select(F.concat(F.lit(f"{name}/"), corpus.relative(F.col("path"), release_tree)).alias("name"), "content"), path)
    return path
