"""Suffix-array dedup: removes 50-byte strings that an earlier document has too.

Texts are UTF-8 bytes; matches never cross documents.  A byte goes if a 50-byte
string that covers it also starts in a document with a smaller doc_id; overlaps
count, and strings are judged on the input.

Equal strings must meet.  A 50-byte window is named by the least-hashed of its
24-byte substrings, its anchor (the leftmost at ties), which depends on the
window alone; neighbouring windows mostly share one, so a text falls into
segments, runs of at most 27 windows with equal anchors (50 to 76 bytes; a long
repetition of few bytes gives many equal segments, of which one is kept).
Blocks of documents first exchange their distinct anchors: a segment whose
anchor no other text has can't match.  The distinct segments left, compared byte
by byte, go to the bucket of their anchor, where a column-wise construction (see
bwt.py) builds the transform and the common prefixes of the strings whose anchor
several distinct ones have.
Places whose common prefixes reach 50 bytes form the classes of equal windows;
the smallest document of each class is its first, and every block gets a bit for
each window of its segments back.

An anchor that very many distinct segments have (a common phrase, ``HOT``) would
fill one bucket; the exchange of anchors counts them, and the segments of such an
anchor are cut into single windows, each in the bucket of its own hash.

Hashes choose anchors and buckets only; that windows are equal is always read
off the transform of their bytes.  Long texts are cut into overlapping pieces.

Defined cases: a null or empty text has no bytes and keeps none; rows of one
doc_id don't remove each other, in whatever blocks they lie; a row with a null
doc_id keeps all its bytes and removes none elsewhere; an empty table gives an
empty result; a text may have any length; columns besides doc_id and text are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import blocks, bwt, common, kernels

BYTES, ANCHOR = 50, 24
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary"
DIGEST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Symbols of one collection, about. Smaller ones stay in a core's cache; a group of equal anchors is never split.
COLLECTION = 1 << 17
#: Distinct segments of one anchor, over all blocks, beyond which its windows are dealt one by one.
HOT = 100_000
_PLACE = np.uint64((1 << 32) - 1)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _segments(data: np.ndarray, offsets: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of some texts: the first window of each segment, its windows, its text, its anchor's hash and the hash of all its bytes."""
    n = len(data)
    hasher = kernels.Hasher(kernels.BYTE_VALUES[data])
    hashes = hasher.raw_windows(anchor)
    value = hashes * _SPREAD  # ordered by the high bits of a product, ties by place
    value &= ~_PLACE
    value |= np.arange(len(hashes), dtype=np.uint64)
    least = (kernels.sliding_min(value, width - anchor + 1) & _PLACE).astype(np.int32)
    own = hashes[least]
    count = np.maximum(np.diff(offsets) - width + 1, 0)
    has = np.flatnonzero(count)
    new = np.zeros(n + 1, dtype=bool)
    new[1 : len(own)] = own[1:] != own[:-1]
    new[offsets[has]] = True  # windows don't run on into the next text
    at = np.flatnonzero(new)
    most = width - anchor + 1  # windows that one place of an anchor can have
    long = np.diff(at, append=len(own)) > most
    if long.any():
        pieces = np.maximum(-(-np.diff(at, append=len(own)) // most), 1)
        at = np.repeat(at, pieces) + kernels.ragged_arange(pieces) * most
    text = np.searchsorted(offsets, at, side="right") - 1
    limit = (offsets[:-1] + count)[text]
    real = at < limit
    first, text, limit = at[real], text[real], limit[real]
    windows = np.minimum(np.append(first[1:], n), limit) - first
    return first, windows, text, kernels.mix(own[first]) if len(first) else np.zeros(0, np.uint64), hasher.slices(first, first + windows + width - 1)


def _byte_pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the bytes that the kernels take at once; parts of a long text overlap, so that every window lies in one."""
    for i, j in blocks.pieces(offsets):
        a, end = int(offsets[i]), int(offsets[j])
        while j == i + 1 and end - a > 2 * blocks.PIECE_BYTES:
            yield a, a + blocks.PIECE_BYTES + width - 1
            a += blocks.PIECE_BYTES
        yield a, end


class Segments:
    """The segments of a block's distinct texts."""

    def __init__(self, block: blocks.Block, width: int, anchor: int):
        self.data, self.offsets, self.owner = block.data, block.offsets, block.owner
        found = []
        for a, b in _byte_pieces(block.offsets, width):
            at = int(np.searchsorted(block.offsets, a, side="right"))  # the text at a is the one before
            inside = block.offsets[at : np.searchsorted(block.offsets, b)] - a
            first, windows, text, key, whole = _segments(self.data[a:b], np.concatenate(([0], inside, [b - a])), width, anchor)
            found.append((first + a, windows, text + at - 1, key, whole))
        none = np.zeros(0, np.int64)
        self.first, self.windows, self.text, self.key, self.whole = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none, none.astype(np.uint64), none.astype(np.uint64))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes, which of them several texts of the block have, each segment's place in them, and how many distinct segments each has."""
        distinct, at, back = np.unique(self.key, return_index=True, return_inverse=True)
        several = np.zeros(len(distinct), dtype=bool)
        several[back[self.text != self.text[at][back]]] = True
        counts = np.bincount(back[np.unique(self.whole, return_index=True)[1]], minlength=len(distinct))
        return distinct, several, back, counts

    def kept(self, at: np.ndarray, alone: np.ndarray, width: int) -> Segments:
        """The segments at these places; those marked alone as windows of their own hashes."""
        split = at[alone]
        count = self.windows[split]
        first = np.repeat(self.first[split], count) + kernels.ragged_arange(count)
        hashes = [np.zeros(0, np.uint64)]
        for i in range(0, len(first), 1 << 14):
            part = kernels.BYTE_VALUES[self.data[first[i : i + (1 << 14), None] + np.arange(width)]]
            hashes.append(kernels.mix((part * kernels.powers(kernels.BASE, width)).sum(axis=1, dtype=np.uint64)))
        own = np.concatenate(hashes)
        cold = at[~alone]
        out = copy(self)
        out.first = np.concatenate((self.first[cold], first))
        order = np.argsort(out.first, kind="stable")  # in the order of the text again
        out.first = out.first[order]
        out.windows = np.concatenate((self.windows[cold], np.ones(len(first), np.int64)))[order]
        out.text = np.concatenate((self.text[cold], np.repeat(self.text[split], count)))[order]
        out.key, out.whole = (np.concatenate((x[cold], own))[order] for x in (self.key, self.whole))
        return out

    def bytes_of(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of these segments, one after the other, and their lengths."""
        n = self.windows[at] + width - 1
        return self.data[np.repeat(self.first[at], n) + kernels.ragged_arange(n)], n

    def distinct(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the distinct segments (the first text's) in the order of the text, and the distinct one of each segment.

        Segments of one hash are compared with the first of them; should their bytes differ, all are told apart by their bytes.
        """
        at = np.arange(len(self.first))
        _, first, back = np.unique(self.whole[at], return_index=True, return_inverse=True)
        again = np.flatnonzero(first[back] != np.arange(len(at)))
        for i in range(0, len(again), 1 << 16):
            a, b = at[again[i : i + (1 << 16)]], at[first[back[again[i : i + (1 << 16)]]]]
            (x, n), (y, m) = self.bytes_of(a, width), self.bytes_of(b, width)
            if not (np.array_equal(n, m) and np.array_equal(x, y)):
                body, size = self.bytes_of(at, width)
                ends = np.cumsum(size).tolist()
                known: dict[bytes, int] = {}
                raw = body.tobytes()
                back = np.array([known.setdefault(raw[e - k : e], len(known)) for e, k in zip(ends, size.tolist(), strict=True)], dtype=np.int64)
                first = np.unique(back, return_index=True)[1]
                break
        order = np.argsort(first)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return first[order], rank[back]


def _send_anchors(batches: Iterator[pa.RecordBatch], width: int, anchor: int, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in blocks.block_rows(batches):
        distinct, _, _, counts = Segments(block, width, anchor).anchors()
        if len(distinct):
            yield blocks.short_frames(block.id, distinct, labels, counts)


def _candidates(block: blocks.Block, width: int, anchor: int, labels: np.ndarray) -> tuple[Segments, np.ndarray, np.ndarray, list]:
    """A block's segments whose anchor another text has, the distinct ones among them, the distinct one of each, and the distinct ones dealt by anchor."""
    seg = Segments(block, width, anchor)
    anchors, several, back, _ = seg.anchors()
    elsewhere, hot = blocks.planes_of(block, "shared", blocks.deal(anchors, labels), len(anchors), 2)
    at = np.flatnonzero((several | elsewhere)[back])
    seg = seg.kept(at, hot[back[at]], width)
    distinct, of = seg.distinct(width)
    return seg, distinct, of, blocks.deal(seg.key[distinct], labels)


def _send_segments(batches: Iterator[pa.RecordBatch], width: int, anchor: int, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for block in blocks.block_rows(batches):
        seg, distinct, _, dealt = _candidates(block, width, anchor, labels)
        owner = seg.owner[seg.text[distinct]]
        out = []
        for bucket, x in dealt:
            body, n = seg.bytes_of(distinct[x], width)
            part = kernels.mix(seg.key[distinct[x]]).astype(np.uint32)
            step = np.diff(owner[x], prepend=np.int64(0))  # owners rise with the text
            out.append((bucket, len(x), pack.compress(step.tobytes() + part.tobytes() + n.astype(np.uint8).tobytes() + body.tobytes())))
        if out:
            yield blocks.sent_batch(block.id, out)


def earlier_windows(strings: np.ndarray, lengths: np.ndarray, keys: np.ndarray, width: int, **limits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct strings with a document key each: for every window of every string the least key among the strings that have it; and the strings' window offsets."""
    count = lengths.astype(np.int64) - width + 1
    offsets = np.concatenate(([0], np.cumsum(count)))
    collection = bwt.Collection(strings, lengths, **limits)
    of = collection.classes(width)
    group = np.empty(offsets[-1], dtype=np.int64)
    for j, which, at in collection.steps():
        if j >= width:
            group[offsets[which] + lengths[which].astype(np.int64) - j] = of[at]
    collection.close()
    least = np.full(int(of[-1]) + 1 if len(of) else 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, np.repeat(keys, count))
    return least[group], offsets


def _collections(parts: np.ndarray, lengths: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The strings in groups of about so many symbols; strings of one part stay together."""
    if not len(parts):
        return
    order = np.argsort(parts, kind="stable")
    size = np.cumsum(lengths[order].astype(np.int64))
    last = np.append(parts[order][1:] != parts[order][:-1], True)
    start, before = 0, 0
    for end in (np.flatnonzero(last) + 1).tolist():
        if size[end - 1] - before >= most or end == len(order):
            yield order[start:end]
            start, before = end, int(size[end - 1])


def _compare(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Per bucket: a bit for each window of each sent segment, whether a document before the segment's first has it."""
    unpack = zstandard.ZstdDecompressor()
    by: dict[int, list[tuple]] = {}
    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in ("block_id", "bucket", "n", "frame")), strict=True):
            by.setdefault(row[1], []).append(row)
    for bucket in sorted(by):
        sent = by.pop(bucket)
        known: dict[bytes, int] = {}
        keys: list[int] = []
        part_of: list[int] = []
        places = []
        own = []
        for _, _, count, frame in sent:
            raw = unpack.decompress(frame)
            body = raw[13 * count :]
            ends = np.cumsum(np.frombuffer(raw, dtype=np.uint8, count=count, offset=12 * count), dtype=np.int64).tolist()
            key = np.cumsum(np.frombuffer(raw, dtype=np.int64, count=count)).tolist()
            at, s = [], 0
            for e, k, part in zip(ends, key, np.frombuffer(raw, dtype=np.uint32, count=count, offset=8 * count).tolist(), strict=True):
                x = known.setdefault(body[s:e], len(keys))
                if x == len(keys):
                    keys.append(k)
                    part_of.append(part)
                elif k < keys[x]:
                    keys[x] = k
                at.append(x)
                s = e
            places.append(np.array(at, dtype=np.int64))
            own.append(np.array(key, dtype=np.int64))
        strings = list(known)
        known.clear()
        lens = np.fromiter(map(len, strings), dtype=np.uint8, count=len(strings))
        first = np.array(keys, dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum(lens.astype(np.int64) - width + 1)))
        least = np.repeat(first, np.diff(offsets))
        # equal windows have one anchor, so a string that is alone with its anchor is compared with none
        parts = np.array(part_of, dtype=np.int64)
        _, of, together = np.unique(parts, return_inverse=True, return_counts=True)
        several = np.flatnonzero(together[of] > 1) if len(parts) else np.zeros(0, np.int64)
        for group in _collections(parts[several], lens[several], COLLECTION):
            group = several[group]
            data = np.frombuffer(b"".join([strings[i] for i in group.tolist()]), dtype=np.uint8)
            found, _ = earlier_windows(data, lens[group], first[group], width)
            n = lens[group].astype(np.int64) - width + 1
            least[np.repeat(offsets[group], n) + kernels.ragged_arange(n)] = found
        out = []
        for (block, *_), at, key in zip(sent, places, own, strict=True):
            n = offsets[at + 1] - offsets[at]
            found = least[np.repeat(offsets[at], n) + kernels.ragged_arange(n)] < np.repeat(key, n)
            out.append((block, np.packbits(found).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], type=pa.int64()), pa.array([bucket] * len(out), type=pa.int32()), pa.array([x[1] for x in out], type=pa.binary())], names=["block_id", "bucket", "bits"])


def _apply(batches: Iterator[pa.RecordBatch], width: int, anchor: int, labels: np.ndarray, digest: bool) -> Iterator[pa.RecordBatch]:
    for block in blocks.block_rows(batches):
        seg, distinct, of, dealt = _candidates(block, width, anchor, labels)
        n = len(seg.data)
        flags = np.zeros(n, dtype=bool)
        if len(distinct):
            count = seg.windows[distinct]
            offsets = np.concatenate(([0], np.cumsum(count)))
            found = np.zeros(offsets[-1], dtype=bool)
            replies = {x["bucket"]: x["bits"] for x in (block.row["compared"].as_py() or ())}
            for bucket, x in dealt:
                k = count[x]
                found[np.repeat(offsets[x], k) + kernels.ragged_arange(k)] = np.unpackbits(np.frombuffer(replies[bucket], dtype=np.uint8), count=int(k.sum())).view(bool)
            k = count[of]
            inner = kernels.ragged_arange(k)
            later = block.owner[seg.text] > block.owner[seg.text[distinct]][of]
            gone = found[np.repeat(offsets[of], k) + inner] | np.repeat(later, k)
            flags = kernels.covered((np.repeat(seg.first, k) + inner)[gone], width, n)
        out, size = [], 0
        for doc, t in zip(block.ids.tolist(), block.texts.tolist(), strict=True):
            s, e = int(seg.offsets[t]), int(seg.offsets[t + 1])
            again = doc > block.owner[t] and e - s >= width  # every window of it is in the text's first row
            out.append(_row(doc, seg.data[s:e], np.ones(e - s, dtype=bool) if again else flags[s:e], digest))
            size += 0 if digest else len(out[-1][5])
            if size > common.BATCH_BYTES:
                yield _batch(out, digest)
                out, size = [], 0
        if out:
            yield _batch(out, digest)


def _row(doc: int | None, data: np.ndarray, flags: np.ndarray, digest: bool) -> tuple:
    starts, ends = kernels.runs(flags)
    kept = (data[~flags] if len(starts) else data).tobytes()
    last = hashlib.sha256(kept).hexdigest() if digest else kept
    return doc, len(data), int(flags.sum()), len(starts), [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)], last


def _batch(rows: list[tuple], digest: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    arrays = [pa.array(c, type=pa.int64()) for c in cols[:4]]
    if digest:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(cols[5], type=pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([*arrays, pa.array(cols[4], type=kind), pa.array(cols[5], type=pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def _alone(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch([_row(None, np.frombuffer((t or "").encode(), dtype=np.uint8), np.zeros(len((t or "").encode()), dtype=bool), digest) for t in b.column("text").to_pylist()], digest)


def remove_repeated(docs: DataFrame, width: int = BYTES, anchor: int = ANCHOR, digest: bool = False, hot: int = HOT) -> DataFrame:
    """One row a document: its bytes, removed bytes and maximal removed runs, the runs and the kept bytes; with digest, the SHA-256 of the kept bytes in place of the last two."""
    spark = docs.sparkSession
    docs = common.pick(docs, "doc_id", "text")
    packed = blocks.pack(docs, "suffix-blocks")
    labels = blocks.buckets(spark, packed)
    sent = packed.mapInArrow(lambda b: _send_anchors(b, width, anchor, labels), blocks.SENT_SCHEMA)
    shared = common.stash(blocks.exchange(sent, labels, lambda frames: blocks.shared_and_hot(frames, hot), "shared"), "suffix-anchors")
    segments = packed.join(shared, "block_id", "left").mapInArrow(lambda b: _send_segments(b, width, anchor, labels), blocks.SENT_SCHEMA)
    compared = segments.repartition(len(labels), "bucket").mapInArrow(lambda b: _compare(b, width), blocks.REPLY_SCHEMA)
    compared = common.stash(compared.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "bits")).alias("compared")), "suffix-compared")
    schema = DIGEST_SCHEMA if digest else RESULT_SCHEMA
    done = packed.join(shared.join(compared, "block_id", "left"), "block_id", "left").mapInArrow(lambda b: _apply(b, width, anchor, labels, digest), schema)
    alone = docs.where(F.col("doc_id").isNull()).select("text").mapInArrow(lambda b: _alone(b, digest), schema)
    return done.unionByName(alone)


def oracle_sql() -> str:
    """The digest rows of the documents table, in DuckDB: every window as its bytes."""
    return """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
places AS (SELECT r, doc_id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM t),
windows AS (SELECT r, doc_id, i, b[i:i + 49] AS k FROM places),
least_ AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM windows JOIN least_ USING (k) WHERE m < doc_id),
bytes AS (SELECT r, unnest(l) AS x, generate_subscripts(l, 1) AS j FROM (SELECT r, regexp_extract_all(hex(b), '..') AS l FROM t)),
kept AS (SELECT r, string_agg(x, '' ORDER BY j) AS body FROM bytes ANTI JOIN gone USING (r, j) GROUP BY r),
runs AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR j - before > 1) AS spans FROM (SELECT r, j, lag(j) OVER (PARTITION BY r ORDER BY j) AS before FROM gone) GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(body, ''))) AS kept_sha256 FROM t LEFT JOIN kept USING (r) LEFT JOIN runs USING (r)
"""
