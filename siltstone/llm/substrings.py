"""Substring dedup: Rabin-Karp hashes of every window of 50 words, counted over all documents.

A window is 50 consecutive words of one document.  A word goes if a window
that covers it has a word sequence that also starts in a document with a
smaller doc_id; windows are judged on the input, not on what is left.

Each block of documents hashes all its windows by a rolling polynomial over
word hashes and sends the distinct ones to buckets, where equal ones of
different blocks meet and are counted.  That finds candidates only: of every
window whose hash another block or another text of the block has too, a 128-bit
BLAKE2 digest of its words goes out with the window's least document, and the
reply says whether a smaller document has the same digest.  So windows are equal
by a cryptographic digest of their words, and unequal windows with equal
polynomials are told apart.  The windows so marked merge into maximal removal
intervals.

Long texts are hashed in pieces; only numbers of a word are held for a whole
text.  A row whose text an earlier row of its block has too is not hashed again:
all its windows are there.

Defined cases: a null or empty text has no words and keeps none (the hash of
the empty string); rows of one doc_id don't remove each other, in whatever
blocks they lie; a null doc_id is smaller than none and larger than none, so such
a row keeps all its words and removes none elsewhere; an empty table gives an
empty result; a text may have any length; columns besides doc_id and text are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import blocks, common, kernels

WORDS = 50
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_text string"
DIGEST_SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"
#: Words whose windows are hashed at once, and words that are joined at once.
CHUNK, JOINED = 1 << 18, 1 << 12


class Words:
    """The words of a block's distinct texts: starts, ends and hashes, and each text's word offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a, b in _byte_pieces(data, offsets):
            part = data[a:b]
            inside = offsets[np.searchsorted(offsets, a, side="right") : np.searchsorted(offsets, b)] - a
            s, e, _ = kernels.word_bounds(part, np.concatenate(([0], inside, [b - a])))
            starts.append(s + a)
            ends.append(e + a)
            hashes.append(kernels.word_hashes(part, s, e))
        self.data = data
        self.starts, self.ends, self.hashes = np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
        self.of_text = np.searchsorted(self.starts, offsets)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first word, the text and the polynomial of each window."""
        count = np.maximum(np.diff(self.of_text) - width + 1, 0)
        first = np.repeat(self.of_text[:-1], count) + kernels.ragged_arange(count)
        text = np.repeat(np.arange(len(count), dtype=np.int32), count)
        rolled = [kernels.Hasher(self.hashes[a : a + CHUNK + width - 1]).windows(width) for a in range(0, max(0, len(self.hashes) - width + 1), CHUNK)]
        return first, text, np.concatenate(rolled)[first] if rolled else np.zeros(0, np.uint64)

    def digests(self, first: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
        """128-bit digests (n, 2) of the words, joined by one space, of these windows; in the order of the text."""
        out: list[bytes] = []
        digest = hashlib.blake2b
        if not len(first):
            return np.zeros((0, 2), np.uint64)
        runs = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (first[1:] - first[:-1] > width) | (np.arange(1, len(first)) % JOINED == 0)))
        for i, k in zip(runs.tolist(), np.append(runs[1:], len(first)).tolist(), strict=True):
            a, b = int(first[i]), int(first[k - 1]) + width
            body = memoryview(self.joined(a, b))
            ends = np.cumsum(self.ends[a:b] - self.starts[a:b] + 1) - 1
            begins = np.append(0, ends[:-1] + 1)
            at = first[i:k] - a
            out += [digest(body[s:e], digest_size=16).digest() for s, e in zip(begins[at].tolist(), ends[at + width - 1].tolist(), strict=True)]
        return np.frombuffer(b"".join(out), dtype=np.uint64).reshape(-1, 2)

    def joined(self, a: int, b: int) -> bytes:
        """The words a to b, joined by one space."""
        return b" ".join(self.data[self.starts[a] : self.ends[b - 1]].tobytes().split()) if b > a else b""


def _byte_pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bytes that cut no word: of several texts, or between two words of a long one."""
    for i, j in blocks.pieces(offsets):
        a, end = int(offsets[i]), int(offsets[j])
        while end - a > 2 * blocks.PIECE_BYTES:
            b = a + blocks.PIECE_BYTES
            while b < end and not (space := kernels.IS_SPACE[data[b : b + blocks.PIECE_BYTES]]).any():
                b += blocks.PIECE_BYTES
            b = min(end, b + int(space.argmax())) if b < end else end
            yield a, b
            a = b
        if end > a:
            yield a, end


def _send(batches: Iterator[pa.RecordBatch], width: int, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in blocks.block_rows(batches):
        rolled = kernels.distinct(Words(block.data, block.offsets).windows(width)[2])
        if len(rolled):
            yield blocks.short_frames(block.id, rolled, labels)


def _candidates(block: blocks.Block, width: int, labels: np.ndarray):
    """The words, the windows that something else may have too (first word, text), whether that is another block, and their digests."""
    words = Words(block.data, block.offsets)
    first, text, rolled = words.windows(width)
    distinct, at, back = np.unique(rolled, return_index=True, return_inverse=True)
    elsewhere = blocks.bits_of(block, "shared", blocks.deal(distinct, labels), len(distinct))
    several = np.zeros(len(distinct), dtype=bool)
    several[back[text != text[at][back]]] = True
    keep = np.flatnonzero((elsewhere | several)[back]) if len(back) else np.zeros(0, np.int64)
    return words, first[keep], text[keep], elsewhere[back[keep]], words.digests(first[keep], text[keep], width)


def _groups(text: np.ndarray, elsewhere: np.ndarray, digests: np.ndarray):
    """Of candidates: the group of each (by digest), the first of each group that goes out, and which groups those are."""
    of, n = blocks.groups(digests)
    at = np.full(n, len(text), dtype=np.int64)
    np.minimum.at(at, of, np.arange(len(text)))  # texts rise, so the first has the least document
    out = np.zeros(n, dtype=bool)
    out[of[elsewhere]] = True
    sent = np.flatnonzero(out)
    sent = sent[np.argsort(at[sent], kind="stable")]
    return of, at, sent


def _send_digests(batches: Iterator[pa.RecordBatch], width: int, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in blocks.block_rows(batches):
        _, _, text, elsewhere, digests = _candidates(block, width, labels)
        _, at, sent = _groups(text, elsewhere, digests)
        if len(sent):
            yield blocks.digest_frames(block.id, digests[at[sent]], block.owner[text[at[sent]]], labels)


def _removed(block: blocks.Block, width: int, labels: np.ndarray) -> Iterator[tuple[int, Words, int, int, np.ndarray]]:
    """Of each row of a block: its id, the block's words, the row's first and last word in them and flags of those that go."""
    words, first, text, elsewhere, digests = _candidates(block, width, labels)
    of, at, sent = _groups(text, elsewhere, digests)
    earlier = np.zeros(len(at), dtype=bool)
    earlier[sent] = blocks.bits_of(block, "earlier", blocks.deal(digests[at[sent], 0], labels), len(sent))
    gone = earlier[of] | (block.owner[text] > block.owner[text[at]][of])
    flags = kernels.covered(first[gone], width, int(words.of_text[-1]))
    for doc, t in zip(block.ids.tolist(), block.texts.tolist(), strict=True):
        a, b = int(words.of_text[t]), int(words.of_text[t + 1])
        again = doc > block.owner[t] and b - a >= width  # every window of it is in the text's first row
        yield doc, words, a, b, np.ones(b - a, dtype=bool) if again else flags[a:b]


def _kept(words: Words, a: int, flags: np.ndarray) -> Iterator[bytes]:
    """The kept words in parts that make the kept text one after the other."""
    starts, ends = kernels.runs(~flags)
    lead = b""
    for s, e in zip((starts + a).tolist(), (ends + a).tolist(), strict=True):
        for x in range(s, e, JOINED):
            yield lead + words.joined(x, min(e, x + JOINED))
            lead = b" "


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _table(rows: list[tuple], digest: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    arrays = [pa.array(c, type=pa.int64()) for c in cols[:4]]
    if digest:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(cols[5], type=pa.string())], names=["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256"])
    return pa.RecordBatch.from_arrays([*arrays, pa.array(cols[4], type=SPANS), pa.array(cols[5], type=pa.string())], names=["doc_id", "n_words", "n_removed", "n_spans", "spans", "kept_text"])


def _row(doc: int | None, words: Words, a: int, b: int, flags: np.ndarray, digest: bool) -> tuple:
    starts, ends = kernels.runs(flags)
    if digest:
        sha = hashlib.sha256()
        for x in _kept(words, a, flags):
            sha.update(x)
        return doc, b - a, int(flags.sum()), len(starts), None, sha.hexdigest()
    return doc, b - a, int(flags.sum()), len(starts), [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)], b"".join(_kept(words, a, flags)).decode("utf-8", "replace")


def _apply(batches: Iterator[pa.RecordBatch], width: int, labels: np.ndarray, digest: bool) -> Iterator[pa.RecordBatch]:
    for block in blocks.block_rows(batches):
        rows, size = [], 0
        for doc, words, a, b, flags in _removed(block, width, labels):
            rows.append(_row(doc, words, a, b, flags, digest))
            size += 0 if digest else len(rows[-1][5])
            if size > common.BATCH_BYTES:
                yield _table(rows, digest)
                rows, size = [], 0
        if rows:
            yield _table(rows, digest)


def _alone(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        rows = []
        for t in batch.column("text").cast(pa.binary()).to_pylist():
            data = np.frombuffer(t or b"", dtype=np.uint8)
            words = Words(data, np.array([0, len(data)]))
            rows.append(_row(None, words, 0, len(words.starts), np.zeros(len(words.starts), dtype=bool), digest))
        yield _table(rows, digest)


def remove_repeated(docs: DataFrame, width: int = WORDS, digest: bool = False) -> DataFrame:
    """One row a document: its number of words, of removed words and of maximal removal intervals, the intervals (in words) and the kept text; with digest, the SHA-256 of the kept text in place of the last two."""
    spark = docs.sparkSession
    docs = common.pick(docs, "doc_id", "text")
    packed = blocks.pack(docs, "substring-blocks")
    labels = blocks.buckets(spark, packed)
    rolled = packed.mapInArrow(lambda b: _send(b, width, labels), blocks.SENT_SCHEMA)
    shared = common.stash(blocks.exchange(rolled, labels, blocks.shared_elsewhere, "shared"), "substring-shared")
    digests = packed.join(shared, "block_id", "left").mapInArrow(lambda b: _send_digests(b, width, labels), blocks.SENT_SCHEMA)
    earlier = common.stash(blocks.exchange(digests, labels, blocks.smaller_elsewhere, "earlier"), "substring-earlier")
    joined = packed.join(shared.join(earlier, "block_id", "left"), "block_id", "left")
    schema = DIGEST_SCHEMA if digest else RESULT_SCHEMA
    alone = docs.where(F.col("doc_id").isNull()).select("text").mapInArrow(lambda b: _alone(b, digest), schema)
    return joined.mapInArrow(lambda b: _apply(b, width, labels, digest), schema).unionByName(alone)


def oracle_sql() -> str:
    """The digest rows of the documents table, in DuckDB: every window as its words."""
    return r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t),
windows AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM places),
least_ AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM windows JOIN least_ USING (k) WHERE m < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM t),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS body FROM words ANTI JOIN gone USING (r, j) GROUP BY r),
runs AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR j - before > 1) AS spans FROM (SELECT r, j, lag(j) OVER (PARTITION BY r ORDER BY j) AS before FROM gone) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(coalesce(body, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (r) LEFT JOIN runs USING (r)
"""
