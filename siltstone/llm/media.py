"""Media columns: content-defined payload chunks, stored once and put together again.

A payload is a text as UTF-8 with bytes 32 appended up to a positive multiple
of 192.  A rolling gear hash over its bytes cuts it into chunks where the hash
has ``AVERAGE_LOG2`` zero bits at the top, within a least and a most length.
Each chunk has a digest; the chunk store holds every distinct chunk once, as a
zstd frame, in a table bucketed by digest, and each payload is an ordered list
of digests.  Reading joins the lists with the store on the digest, puts the
chunks in order, checks every chunk against its digest and the whole against
its list, and computes the features from those bytes.

The stored form of a payload is its chunks' stored frames in order; one after
the other they are a valid zstd stream.  Payloads with equal bytes share a
list, so equal texts have equal values.

A digest that over ``HOT`` payload places name is joined apart: its frame is dealt
to ``SALTS`` places and the payloads' references among them, so no task reads a
third of all references because they share a chunk.

Defined cases: a null text counts as empty and has a payload of 192 spaces;
each input row gives one row, repeated rows and rows without an id too; a text of
any length is read whole, and one payload's frames are in memory at a time; an
empty table gives an empty result; columns besides doc_id and text are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

UNIT = 192
LEAST, AVERAGE_LOG2, MOST = 2048, 13, 32768
LEVEL = 6
HOT, SALTS = 2000, 64
#: Bytes of payloads for each bucket of the chunk store, if that gives more buckets than there are shuffle partitions.
BUCKET_BYTES = 64 << 20
#: The gear hash of a place depends on its last 32 bytes.
GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def payload(text: str | bytes | None) -> bytes:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw + b" " * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def gear(data: np.ndarray) -> np.ndarray:
    """At each place: the sum over j of GEAR[data[place - j]] << j, modulo 2**32; by doubling the width five times."""
    h = GEAR[data]
    for j in (1, 2, 4, 8, 16):
        h[j:] = h[j:] + (h[:-j] << np.uint32(j))
    return h


def cuts(data: bytes, least: int = LEAST, log2: int = AVERAGE_LOG2, most: int = MOST) -> list[int]:
    """Ends of the chunks. A cut depends on the 32 bytes before it and on the last cut only."""
    n = len(data)
    if n <= least:
        return [n]
    places = np.flatnonzero(gear(np.frombuffer(data, dtype=np.uint8)) >> np.uint32(32 - log2) == 0) + 1
    out, at = [], 0
    while n - at > least:
        i = int(np.searchsorted(places, at + least))
        end = int(places[i]) if i < len(places) and places[i] <= at + most else at + most
        if end >= n:
            break
        out.append(end)
        at = end
    return [*out, n]


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=20).digest()


LIST_SCHEMA = "doc_id long, n_bytes long, payload string, digests array<binary>"


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches):
        n, key, lists = [], [], []
        for t in part.column("text").cast(pa.binary()).to_pylist():
            data = payload(t)
            n.append(len(t or b""))
            key.append(hashlib.sha256(data).hexdigest())
            lists.append([digest(c) for c in chunks(data)])
        yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, type=pa.int64()), pa.array(key), pa.array(lists, type=pa.list_(pa.binary()))], names=["doc_id", "n_bytes", "payload", "digests"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct chunk of a task's texts. What a task has sent already is kept as digests, so copies go out once for each task."""
    pack = zstandard.ZstdCompressor(level=LEVEL)
    sent: set[bytes] = set()
    for part in common.slices(batches):
        new: dict[bytes, bytes] = {}
        for t in part.column("text").cast(pa.binary()).to_pylist():
            for c in chunks(payload(t)):
                if (d := digest(c)) not in sent:
                    sent.add(d)
                    new[d] = pack.compress(c)
        yield pa.RecordBatch.from_arrays([pa.array(list(new), type=pa.binary()), pa.array(list(new.values()), type=pa.binary())], names=["digest", "frame"])


RESULT_SCHEMA = "payload string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(data: bytes, n_chunks: int) -> str:
    """Of the samples read back: chunks, mean and mean absolute step in thousandths, distinct values, entropy in thousandths of a bit."""
    x = np.frombuffer(data, dtype=np.uint8)
    seen = np.bincount(x, minlength=256)
    p = seen[seen > 0] / len(x)
    step = np.abs(np.diff(x.astype(np.int16))).sum(dtype=np.int64)
    return f"chunks={n_chunks};mean={int(x.sum(dtype=np.int64)) * 1000 // len(x)};step={int(step) * 1000 // len(x)};values={len(p)};entropy={int(-(p * np.log2(p)).sum() * 1000 + 0.5)}"


def read_back(key: str, parts: list[tuple[bytes, bytes]]) -> tuple:
    """The row of a payload from its (digest, frame) list; a chunk or a whole that differs from what was stored is an error."""
    unpack = zstandard.ZstdDecompressor()
    data = []
    for d, frame in parts:
        data.append(unpack.decompress(frame))
        if digest(data[-1]) != d:
            raise ValueError(f"a stored chunk of {key} differs from its digest")
    whole = b"".join(data)
    sha = hashlib.sha256(whole).hexdigest()
    if sha != key:
        raise ValueError(f"the chunks of {key} don't make its payload")
    stored = hashlib.sha256()
    for _, frame in parts:
        stored.update(frame)
    return key, len(whole), sha, zlib.crc32(whole[-16:]), sum(len(f) for _, f in parts), stored.hexdigest(), feature(whole, len(parts))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    cols = list(zip(*rows, strict=True)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)], names=["payload", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [read_back(k, [(d, f)]) for k, d, f in zip(b.column("payload").to_pylist(), b.column("digest").to_pylist(), b.column("frame").to_pylist(), strict=True)]
        yield _table(rows)


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by payload and place: one payload's frames are in memory at a time."""
    key: str | None = None
    parts: list[tuple[bytes, bytes]] = []
    rows: list[tuple] = []
    for b in batches:
        for k, d, f in zip(b.column("payload").to_pylist(), b.column("digest").to_pylist(), b.column("frame").to_pylist(), strict=True):
            if k != key and parts:
                rows.append(read_back(key, parts))
                parts = []
            key = k
            parts.append((d, f))
        if rows:
            yield _table(rows)
            rows = []
    if parts:
        yield _table([read_back(key, parts)])


def store(docs: DataFrame) -> tuple[DataFrame, DataFrame, tuple[str, str], int]:
    """Chunk the payloads. Returns the lists (doc_id, n_bytes, payload, digests) and the chunk store (digest, frame), both written to the shared folder, the name and folder of the store's table, and its buckets."""
    spark = docs.sparkSession
    common.prepare(spark)
    texts = common.pick(docs, "doc_id", "text")
    lists = common.stash(texts.mapInArrow(_lists, LIST_SCHEMA), "media-lists")
    total = lists.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(common.shuffle_partitions(spark), -(-total // BUCKET_BYTES))  # a bucket of the store does not grow with the input
    bodies = texts.select("text").mapInArrow(_bodies, "digest binary, frame binary").repartition(parts, "digest").groupBy("digest").agg(F.first("frame").alias("frame"))
    name = f"media_chunks_{uuid.uuid4().hex}"
    path = f"{common.shared_dir(spark)}/{name}"
    bodies.write.option("compression", "uncompressed").option("path", path).bucketBy(parts, "digest").saveAsTable(name)
    common.release(spark)
    return lists, spark.table(name), (name, path), parts


def reconstruct(lists: DataFrame, chunks_at: DataFrame, hot: int = HOT, parts: int | None = None) -> DataFrame:
    """One row a payload, from the stored chunks; payloads of several are dealt to so many partitions."""
    wanted = lists.select("payload", "digests").dropDuplicates(["payload"])
    single = wanted.where(F.size("digests") == 1).select("payload", F.col("digests")[0].alias("digest"))
    single = single.join(chunks_at, "digest").select("payload", "digest", "frame").mapInArrow(_single, RESULT_SCHEMA)
    refs = wanted.where(F.size("digests") > 1).select("payload", F.posexplode("digests").alias("place", "digest"))
    often = common.stash(refs.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("digest"), "media-hot")  # a thousandth of the references at most
    cold = refs.join(often, "digest", "left_anti").join(chunks_at, "digest").select("payload", "place", "digest", "frame")
    salt = F.pmod(F.hash("payload", "place"), F.lit(SALTS)).alias("salt")
    dealt = chunks_at.join(often, "digest", "left_semi").select("digest", "frame", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    warm = refs.join(often, "digest", "left_semi").select("payload", "place", "digest", salt).join(dealt, ["digest", "salt"]).select("payload", "place", "digest", "frame")
    several = cold.unionByName(warm).repartition(parts or common.shuffle_partitions(lists.sparkSession), "payload").sortWithinPartitions("payload", "place").mapInArrow(_several, RESULT_SCHEMA)
    return single.unionByName(several)


def round_trip(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_bytes and what was read back from the store. The store itself is deleted when it has been read."""
    spark = docs.sparkSession
    lists, chunks_at, (name, path), parts = store(docs)
    found = common.stash(reconstruct(lists, chunks_at, hot, parts), "media-read")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    common.forget(spark, path)
    # lists name every payload, and many rows can share one: the join's hot keys are split by adaptive execution
    return lists.select("doc_id", "n_bytes", "payload").join(found, "payload").drop("payload")
