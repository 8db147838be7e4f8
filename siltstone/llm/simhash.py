"""SimHash near-dedup with deletion-variant signatures.

Fingerprint: A-Z are lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``, a
shingle is three words joined by one space (fewer words: the whole sequence),
repeats included; each shingle's XXH64 with seed 42 votes for 64 bits, and a
bit is set if it is set in over half of the hashes.  A text without words has
fingerprint zero.

Links: two fingerprints link at three or fewer differing bits.  Such a pair,
cut into two segments of 32 bits, has a segment that differs in one bit at
most.  So each distinct fingerprint is indexed under its two segments and
under every variant of them with one bit left out, an equality join brings the
candidates together, and each is verified on all 64 bits.  The variants of a
pair whose segment is equal would all meet; such pairs are taken from the
whole-segment key, and under a left-out bit only pairs that differ in it.

A key that many fingerprints share is cut again instead of being compared in
full: what the key leaves free is 32 bits, whose two halves of 16 bits are
indexed with one bit left out likewise.  A group of the second cut has at most
2**17 fingerprints by construction, because its key fixes all but 16 or 17
bits.  Within a group a search over the group's own fingerprints emits a
spanning forest of the links, never all pairs.

Defined cases: null texts count as empty; rows with equal fingerprints are one
node with their smallest doc_id, repeated rows too; a null doc_id gives a null
component unless another row shares its fingerprint; an empty table gives an empty
result; a text of any length is read whole; columns besides doc_id and text are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common, graph

BITS = 3
SHINGLE = 3
#: Groups of the first cut with more fingerprints than this are cut again.
GROUP = 2048
LOW = (1 << 32) - 1

_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    if len(words) < size:
        return [xxhash.xxh64_intdigest(joined, 42)]
    starts = np.concatenate(([0], ends[:-1] + 1))
    h = xxhash.xxh64_intdigest
    return [h(joined[s:e], 42) for s, e in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def votes(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, 64): for each of n owners how many of its hashes have each bit."""
    out = np.empty((n, 64), dtype=np.int64)
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    for lane in range(8):
        seen = np.bincount(owner * 256 + lanes[:, lane], minlength=n * 256).reshape(n, 256)
        out[:, 8 * lane : 8 * lane + 8] = seen @ _BIT_TABLE
    return out


def majority(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Fingerprints: a bit is set if over half of the hashes have it."""
    return ((count * 2 > total[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


#: Bytes of a long text whose shingles are hashed together.
PIECE = 1 << 20


def _pieces(text: bytes, size: int = SHINGLE) -> Iterator[bytes]:
    """A long text in parts that end between words, each with the size - 1 words before it, so that every shingle is in one."""
    at, before = 0, b""
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        part = before + b" " + text[at:end]
        words = part.split()
        if len(words) >= size:
            yield part
            words = words[1 - size :]
        before, at = b" ".join(words), end
    if not len(text.split(None, size - 1)) >= size:
        yield text


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches):
        texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
        n = len(texts)
        count, total = np.zeros((n, 64), dtype=np.int64), np.zeros(n, dtype=np.int64)
        for some in ([x] for x in _pieces(texts[0])) if n == 1 and len(texts[0]) > PIECE else [texts]:
            hashes = [shingle_hashes(t) for t in some]
            sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=n)
            flat = np.fromiter((h for x in hashes for h in x), dtype=np.uint64, count=int(sizes.sum()))
            count += votes(flat, np.repeat(np.arange(n), sizes), n)
            total += sizes
        yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(majority(count, total).view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed long."""
    common.prepare(docs.sparkSession)
    return common.pick(docs, "doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def link_forest(fps: np.ndarray, must: int = 0, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of a spanning forest of the links among distinct fingerprints.

    must: a bit in which a link must differ, or 0.  Every place is taken once
    from those not reached yet, so a dense group costs little more than a pass
    for each member and links that close a cycle are not emitted.
    """
    left = np.arange(len(fps))
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while len(left) > 1:
        queue = [int(left[0])]
        left = left[1:]
        while queue and len(left):
            at = queue.pop()
            x = fps[left] ^ fps[at]
            near = np.bitwise_count(x) <= bits
            if must:
                near &= (x & np.uint64(must)) != 0
            if near.any():
                got = left[near]
                a.append(np.full(len(got), at))
                b.append(got)
                queue += got.tolist()
                left = left[~near]
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


EDGES = "a long, b long"


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, nodes, must = batch.column("fps"), batch.column("nodes"), batch.column("must").to_pylist()
        out_a, out_b = [], []
        for i in range(batch.num_rows):
            group, node = fps[i].values.to_numpy().view(np.uint64), nodes[i].values.to_numpy()
            a, b = link_forest(group, must[i] & ((1 << 64) - 1))
            out_a.append(node[a])
            out_b.append(node[b])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the first cut. tag: 64 * segment + left-out bit, or 64 * segment + 32 for the whole segment."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        node = batch.column("node").to_numpy()
        keys, tags = [], []
        for segment in range(2):
            value = (fp >> np.uint64(32 * segment)) & np.uint64(LOW)
            for bit in range(33):
                left = value & ~np.uint64(1 << bit) if bit < 32 else value
                keys.append(left)
                tags.append(np.full(len(fp), 64 * segment + bit, dtype=np.int64))
        key = np.concatenate(keys).astype(np.int64) | (np.concatenate(tags) << 32)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.tile(fp.view(np.int64), 66)), pa.array(np.tile(node, 66))], names=["key", "fp", "node"])


def must_differ(tag: int) -> int:
    """The bit in which a pair under this tag must differ, 0 for a whole segment; signed."""
    bit = tag % 64
    out = 0 if bit == 32 else 1 << (bit + 32 * (tag // 64))
    return out - (1 << 64) if out >= 1 << 63 else out


def _second_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """34 keys for each row of a large group: the halves of the other segment, whole or with one bit left out."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        segment = (key >> 38) & 1
        other = np.where(segment == 0, fp >> np.uint64(32), fp & np.uint64(LOW)).astype(np.int64)
        subs = []
        for half in range(2):
            value = (other >> (16 * half)) & 0xFFFF
            for bit in range(17):
                subs.append((value & ~(1 << bit) if bit < 16 else value) | (bit << 16) | (half << 21))
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(key, 34)), pa.array(np.concatenate(subs)), pa.array(np.tile(fp.view(np.int64), 34)), pa.array(np.tile(node, 34))], names=["key", "sub", "fp", "node"])


def links(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """(fp, node) with distinct fp to links (a, b) between nodes, enough to connect whatever is connected."""
    keyed = nodes.mapInArrow(_variants, "key long, fp long, node long")
    met = common.stash(common.shared_keys(keyed, F.count("*").alias("n")), "simhash-met")
    tag = (F.shiftrightunsigned("key", 32)).cast("int")
    bit = tag % 64
    must = F.when(bit == 32, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, cast(shiftrightunsigned(key, 32) % 64 + 32 * floor(shiftrightunsigned(key, 32) / 64) as int))"))
    small = met.where(F.col("n") <= group).groupBy("key").agg(F.collect_list(F.struct("fp", "node")).alias("m")).select(F.col("m.fp").alias("fps"), F.col("m.node").alias("nodes"), must.alias("must"))
    large = met.where(F.col("n") > group).select("key", "fp", "node").mapInArrow(_second_cut, "key long, sub long, fp long, node long")
    large = large.groupBy("key", "sub").agg(F.collect_list(F.struct("fp", "node")).alias("m")).where(F.size("m") > 1).select(F.col("m.fp").alias("fps"), F.col("m.node").alias("nodes"), must.alias("must"))
    return small.unionByName(large).mapInArrow(_forests, EDGES)


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links, itself included."""
    prints = common.stash(fingerprints(docs), "simhash-prints")
    nodes = common.stash(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    edges = links(nodes.where("node is not null"), group)
    parts = graph.connected_components(edges, "simhash-components")
    named = nodes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """As near_duplicates, with the fingerprint as 16 hex digits."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group: that of the smallest doc_id. Rows without a doc_id stay; repeated rows of the kept doc_id stay once."""
    kept = near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows, names, at = common.positional(docs)
    own = names[at["doc_id"]]
    once = rows.join(kept, rows[own] == F.col("kept_id"), "left_semi").dropDuplicates([own])
    return once.unionByName(rows.where(F.col(own).isNull())).toDF(*docs.columns)
