"""Blocks of documents, and the hash exchange between them.

Two operators ask, of every window of a text, whether an equal window starts
in a document with a smaller id.  Both work on blocks: some megabytes of whole
texts as the scan gives them, sorted by doc_id inside, each distinct text once.
Blocks are written to the shared folder first, so every pass sees the same
blocks after an executor is lost; no text is shuffled to make them.

A block sends each of its *distinct* hashes once, dealt into buckets, and gets
back one bit for each.  A window that a third of all documents hold is therefore
one entry per block, however many copies there are, and the answer is a bit and
not a row.  There are as many buckets as shuffle partitions, and more where the
text of a bucket's share would be over ``BUCKET_BYTES``, so what a task holds is
bounded whatever the input.

Two questions are answered: whether another block has an equal short hash (a
filter: it may say yes wrongly, never no), and whether another block has an
equal 128-bit digest with a smaller document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import common, kernels

BLOCK_BYTES = 4 << 20
#: Bytes of text that a kernel takes at once; what it needs of it stays in a core's cache.
PIECE_BYTES = 1 << 17
#: Bytes of text of which a bucket gets the hashes, at most on average.
BUCKET_BYTES = 64 << 20
BLOCK_SCHEMA = "block_id long, doc_ids array<long>, texts array<int>, sizes array<long>, n_bytes long, body binary"


class Block:
    """Rows of a block in the order of their doc_ids: ids, the distinct text of each, and the texts' bytes and offsets.

    Distinct texts are numbered by their first row, so their owners (the least doc_id) rise.
    """

    def __init__(self, row: dict, ids: np.ndarray, texts: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.row, self.ids, self.texts, self.data, self.offsets = row, ids, texts, data, offsets
        self.id = row["block_id"].as_py()
        self.first = np.flatnonzero(np.append(True, texts[1:] > np.maximum.accumulate(texts)[:-1])) if len(texts) else np.zeros(0, np.int64)
        self.owner = ids[self.first]


def _pack(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    pack = zstandard.ZstdCompressor(level=3)
    rows: list[tuple[int, bytes]] = []
    have = 0

    def block() -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        known: dict[bytes, int] = {}
        texts = [known.setdefault(t, len(known)) for _, t in rows]
        sizes = [len(t) for t in known]
        body = pack.compress(b"".join(known))
        return pa.RecordBatch.from_arrays(
            [pa.array([at], type=pa.int64()), pa.array([[r[0] for r in rows]], type=pa.list_(pa.int64())), pa.array([texts], type=pa.list_(pa.int32())), pa.array([sizes], type=pa.list_(pa.int64())), pa.array([sum(sizes)], type=pa.int64()), pa.array([body], type=pa.binary())],
            names=["block_id", "doc_ids", "texts", "sizes", "n_bytes", "body"],
        )

    for part in common.slices(batches, limit=block_bytes // 4):
        new = part.column("text").cast(pa.binary()).to_pylist()
        rows += zip(part.column("doc_id").to_pylist(), new, strict=True)
        have += sum(map(len, new))
        if have >= block_bytes:
            yield block()
            at, have = at + 1, 0
            rows.clear()
    if rows:
        yield block()


def pack(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the documents that have a doc_id, written to the shared folder."""
    common.prepare(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return common.stash(rows.mapInArrow(lambda b: _pack(b, block_bytes), BLOCK_SCHEMA), name, "uncompressed")


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names if n not in ("doc_ids", "texts", "sizes", "body")}
            sizes = batch.column("sizes")[i].values.to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            data = np.frombuffer(unpack.decompress(batch.column("body")[i].as_py(), max_output_size=max(1, int(offsets[-1]))), dtype=np.uint8)
            yield Block(row, *(batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("doc_ids", "texts")), data, offsets)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes; a text is not cut."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end
        at = end


def buckets(spark: SparkSession, packed: DataFrame) -> np.ndarray:
    """The bucket numbers for these blocks: one for each shuffle partition, or for each BUCKET_BYTES of text if that is more.

    Spark's hash deals them to as many different partitions, so that none gets several; one small job.
    """
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    n = max(common.shuffle_partitions(spark), -(-total // BUCKET_BYTES))
    tried = spark.range(0, 32 * n + 64, numPartitions=1).select(F.col("id").cast("int").alias("label"))
    rows = tried.groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("p")).agg(F.min("label").alias("label")).collect()
    found = sorted(r["label"] for r in rows)
    spare = (x for x in range(32 * n + 64, 34 * n + 64))  # a partition that no number hit, which is all but impossible
    return np.array(found + [next(spare) for _ in range(n - len(found))], dtype=np.int64)


def deal(keys: np.ndarray, labels: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Places of the hashes by bucket (of their high half), each in the order given."""
    bucket = ((keys >> np.uint64(32)) % np.uint64(len(labels))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    there, starts = np.unique(bucket[order], return_index=True)
    return [(int(labels[b]), x) for b, x in zip(there, np.split(order, starts[1:]), strict=True)] if len(order) else []


SENT_SCHEMA = "block_id long, bucket int, n int, frame binary"
REPLY_SCHEMA = "block_id long, bucket int, bits binary"


def sent_batch(block_id: int, out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array([block_id] * len(out), type=pa.int64()), *(pa.array(c, type=k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.binary()), strict=True))], names=["block_id", "bucket", "n", "frame"])


def short_frames(block_id: int, hashes: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> pa.RecordBatch:
    """The low halves of the hashes by bucket, and behind them a count of each if there is one (up to 65535)."""
    low = hashes.astype(np.uint32)
    much = None if counts is None else np.minimum(counts, 65535).astype(np.uint16)
    return sent_batch(block_id, [(b, len(x), low[x].tobytes() + (much[x].tobytes() if much is not None else b"")) for b, x in deal(hashes, labels)])


def digest_frames(block_id: int, digests: np.ndarray, docs: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    """Digests (n, 2) and the least document of each, by bucket; documents rise."""
    pack = zstandard.ZstdCompressor(level=1)
    out = []
    for b, x in deal(digests[:, 0], labels):
        out.append((b, len(x), digests[x].tobytes() + pack.compress(np.diff(docs[x], prepend=np.int64(0)).tobytes())))
    return sent_batch(block_id, out)


def shared_elsewhere(frames: list[tuple[int, bytes]]) -> Iterator[np.ndarray]:
    """Whether another block sent the hash, for each hash of each frame."""
    h = np.concatenate([np.frombuffer(f, dtype=np.uint32) for _, f in frames])
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h) + 1, dtype=bool)
    np.equal(h[order][1:], h[order][:-1], out=same[1:-1])
    found = np.empty(len(h), dtype=bool)
    found[order] = same[:-1] | same[1:]
    return iter(np.split(found, np.cumsum([n for n, _ in frames])[:-1]))


def shared_and_hot(frames: list[tuple[int, bytes]], hot: int) -> Iterator[np.ndarray]:
    """For each frame whether another block sent the hash, of all its hashes, and then whether the counts of a hash are over ``hot`` together, of all its hashes."""
    h = np.concatenate([np.frombuffer(f, dtype=np.uint32, count=n) for n, f in frames])
    much = np.concatenate([np.frombuffer(f, dtype=np.uint16, count=n, offset=4 * n) for n, f in frames])
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
    size = np.diff(np.append(new, len(h)))
    total = np.add.reduceat(much[order].astype(np.int64), new)
    shared, over = np.empty(len(h), dtype=bool), np.empty(len(h), dtype=bool)
    shared[order], over[order] = np.repeat(size > 1, size), np.repeat(total > hot, size)
    at = 0
    for n, _ in frames:
        yield np.concatenate((shared[at : at + n], over[at : at + n]))
        at += n


def smaller_elsewhere(frames: list[tuple[int, bytes]]) -> Iterator[np.ndarray]:
    """Whether another block sent the digest with a smaller document, for each digest of each frame."""
    unpack = zstandard.ZstdDecompressor()
    d = np.concatenate([np.frombuffer(f, dtype=np.uint64, count=2 * n).reshape(n, 2) for n, f in frames])
    doc = np.concatenate([np.cumsum(np.frombuffer(unpack.decompress(f[16 * n :]), dtype=np.int64)) for n, f in frames])
    of, n = groups(d)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    return iter(np.split(least[of] < doc, np.cumsum([k for k, _ in frames])[:-1]))


def groups(digests: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each row of digests (n, 2), equal for equal rows, and how many there are."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    s = digests[order]
    new = np.empty(len(s), dtype=bool)
    new[:1] = True
    np.any(s[1:] != s[:-1], axis=1, out=new[1:])
    out = np.empty(len(s), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out, int(new.sum())


def _answer(batches: Iterator[pa.RecordBatch], ask: Callable) -> Iterator[pa.RecordBatch]:
    by: dict[int, list[tuple[int, int, bytes]]] = {}
    for batch in batches:
        for block, bucket, n, frame in zip(*(batch.column(c).to_pylist() for c in ("block_id", "bucket", "n", "frame")), strict=True):
            by.setdefault(bucket, []).append((block, n, frame))
    for bucket in sorted(by):
        sent = by.pop(bucket)
        bits = [np.packbits(x).tobytes() for x in ask([(n, f) for _, n, f in sent])]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in sent], type=pa.int64()), pa.array([bucket] * len(sent), type=pa.int32()), pa.array(bits, type=pa.binary())], names=["block_id", "bucket", "bits"])


def exchange(sent: DataFrame, labels: np.ndarray, ask: Callable, name: str) -> DataFrame:
    """The bits for each hash or digest a block sent, as ``name``: one row a block, with all its replies."""
    replies = sent.repartition(len(labels), "bucket").mapInArrow(lambda b: _answer(b, ask), REPLY_SCHEMA)
    return replies.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def planes_of(block: Block, name: str, dealt: list[tuple[int, np.ndarray]], n: int, planes: int) -> np.ndarray:
    """The replies of a block as so many rows of flags of its n hashes; a block that sent none has none."""
    out = np.zeros((planes, n), dtype=bool)
    replies = block.row[name].as_py() if block.row.get(name) is not None else None
    by = {x["bucket"]: x["bits"] for x in replies or ()}
    for bucket, at in dealt:
        if bucket in by:
            out[:, at] = np.unpackbits(np.frombuffer(by[bucket], dtype=np.uint8), count=planes * len(at)).view(bool).reshape(planes, -1)
    return out


def bits_of(block: Block, name: str, dealt: list[tuple[int, np.ndarray]], n: int) -> np.ndarray:
    """The replies of a block as flags of its n hashes."""
    return planes_of(block, name, dealt, n, 1)[0]
