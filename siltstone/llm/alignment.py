r"""Cross-tokenizer alignment: groups of tokens with common ends, and how often two ids are linked in the corpus.

A byte-level tokenizer A and a piece tokenizer B take every text behind a space.
Where an A token and a B token end at the same byte, the text is cut into groups,
and the two are linked.  A pair of ids is one int64, B's in the high half, so the
pairs of a B id stand together.  Every task counts its pairs by ``np.unique``;
the counts are sorted by range over the whole table and runs of equal keys summed,
which gives sorted shards without a key in two of them.  Spark hands the shards'
files to the executors, where they are memory-mapped, and a document's links are
looked up in them by ``searchsorted``.

What is handed out is bounded by the vocabularies and not by the data: tokens that
end together in a text are each other's suffixes, so there are no more pairs than
the tokens have bytes (times how many ids share their bytes).  ``pair_bound``
gives the number, 345,667 for the given vocabularies, and a count over it is
an error.

Texts are cut before every space that follows a character other than white space.
No token of either vocabulary crosses such a place (``cuts_are_safe`` tests that
when a vocabulary is loaded; with another one, whole texts are taken), so a
segment has the same tokens wherever it stands, both tokenizers end with it, and
each task encodes and aligns a segment once and keeps the result; when it has
``CACHED`` segments (the frequent ones come early) it takes others anew in each
slice of texts.  A segment whose tokens do not spell it sends its text to
both tokenizers whole.

Defined cases: null and empty texts have no tokens, nor have texts that either
tokenizer does not spell exactly; then all counts are zero and the groups empty.
Each row gives one row, repeated rows and rows without an id too, and repeated
texts count each time; texts of any length are taken whole, each by one task;
ids of any type are kept as they are; an empty table gives an empty result;
columns besides doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import tempfile
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

#: The vocabularies; every executor must have them at these paths.
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Segments that a task keeps, and the longest that it keeps.
CACHED, LONGEST = 1 << 17, 64
SPACE = "▁"
#: A segment starts at a space behind a character that is no white space.
CUT = re.compile(r"(?<=\S)(?= )")


@functools.cache
def byte_of() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones stand for themselves, the others for 256 and on."""
    plain = [b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)]
    shown = {chr(b): b for b in plain}
    return shown | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class Byte:
    """Tokenizer A: ids and bytes of a byte-level vocabulary."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            shown = byte_of()
            self.bytes[i] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        self.crosses = "ByteLevel" not in repr(self.model.pre_tokenizer) or self.model.normalizer is not None

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, which stands behind a space."""
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Piece:
    """Tokenizer B: ids and bytes of a vocabulary of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.crosses = any(re.search(rf"[^\s{SPACE}]{SPACE}", n) for n in names) or self.model.encode("a  b", out_type=str) != self.model.encode("a", out_type=str) + self.model.encode(" b", out_type=str)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, before which the tokenizer puts a space itself."""
        return self.model.encode(texts, num_threads=1)


@functools.cache
def tokenizers(byte_level: str, pieces: str) -> tuple[Byte, Piece]:
    return Byte(byte_level), Piece(pieces)


def cuts_are_safe(a: Byte, b: Piece) -> bool:
    return not (a.crosses or b.crosses)


def pair_bound(a: Byte, b: Piece) -> int:
    """How many pairs of ids can end together at most: for every token its suffixes that are tokens of the other one, and back."""
    from collections import Counter

    of_a, of_b = Counter(a.bytes), Counter(b.bytes)
    suffixes = lambda token, other: sum(other[token[i:]] for i in range(len(token) + 1))
    return sum(suffixes(t, of_b) for t in a.bytes) + sum(suffixes(t, of_a) for t in b.bytes)


def _flat(ids: list[list[int]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, the text of each, and where each ends in all texts put together by this tokenizer."""
    counts = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(counts.sum()))
    return flat, np.repeat(np.arange(len(ids)), counts), np.cumsum(sizes[flat]) if len(flat) else np.empty(0, dtype=np.int64)


#: Counts of A tokens, B tokens and groups in one integer, so that segments add up by one sum.
_BITS, _MASK = 40, (1 << 40) - 1


def _pack(a: int, b: int, groups: int) -> int:
    return a | b << _BITS | groups << 2 * _BITS


def _unpack(packed: int) -> tuple[int, int, int]:
    return packed & _MASK, packed >> _BITS & _MASK, packed >> 2 * _BITS


class Aligner:
    """Aligns texts by segments and keeps what it knows of them."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = tokenizers(byte_level, pieces)
        self.sizes = [np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (self.a, self.b)]
        digits = [[str(i) for i in range(len(x.bytes))] for x in (self.a, self.b)]
        self.shown = [[d + mark for d in digits[0] for mark in ",|"], [d + mark for d in digits[1] for mark in ",;"]]
        self.safe = cuts_are_safe(self.a, self.b)
        self.known: dict[str, tuple] = {}

    def align(self, texts: list[str]) -> list[tuple | None]:
        """(packed counts, groups as text with an end mark, bytes of the links' keys) of each text behind a space; None where the tokens do not spell it."""
        ids = (self.a.encode(texts), self.b.encode(texts))
        whole = [b" " + t.encode() for t in texts]
        (ia, ta, ea), (ib, tb, eb) = flat = [_flat(x, n) for x, n in zip(ids, self.sizes, strict=True)]
        if not all(self._spell(x, whole, *f) for x, f in zip((self.a, self.b), flat, strict=True)):
            spelt = [all(b"".join([x.bytes[i] for i in some]) == w for x, some in zip((self.a, self.b), both, strict=True)) for w, both in zip(whole, zip(*ids, strict=True), strict=True)]
            good = iter(self.align([t for t, s in zip(texts, spelt, strict=True) if s]) if any(spelt) else [])
            return [next(good) if s else None for s in spelt]
        at = np.minimum(np.searchsorted(eb, ea), len(eb) - 1)
        ends = ea[eb[at] == ea] if len(ea) else ea
        if len(ends) > 1:
            ends = ends[np.append(True, ends[1:] != ends[:-1])]
        # A token's group is that of the first common end at or behind its own end.
        ga, gb = np.searchsorted(ends, ea), np.searchsorted(ends, eb)
        last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
        # The text of the groups: A's ids and B's ids of each group in turn, each with its mark.
        na, nb = np.bincount(ga, minlength=len(ends)), np.bincount(gb, minlength=len(ends))
        place_a = np.arange(len(ia)) + (np.cumsum(nb) - nb)[ga]
        place_b = np.arange(len(ib)) + np.cumsum(na)[gb]
        marks = [""] * (len(ia) + len(ib))
        for place, code, shown in ((place_a, 2 * ia + last_a, self.shown[0]), (place_b, 2 * ib + last_b, self.shown[1])):
            for p, c in zip(place.tolist(), code.tolist(), strict=True):
                marks[p] = shown[c]
        # Links: all pairs whose ends are equal; tokens without bytes may share one.
        from_b, to_b = np.searchsorted(eb, ea, side="left"), np.searchsorted(eb, ea, side="right")
        times = to_b - from_b
        of = np.repeat(np.arange(len(ia)), times)
        to = np.repeat(from_b, times) + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        keys = (ib[to] << 32) | ia[of]
        n = len(texts)
        until = lambda which: np.cumsum(np.bincount(which, minlength=n)).tolist()
        of_group = np.repeat(0, len(ends)) if not len(ia) else ta[np.searchsorted(ga, np.arange(len(ends)))]
        ua, ub, ug, uk = until(ta), until(tb), until(of_group), until(ta[of])
        out, was = [], (0, 0, 0, 0)
        for now in zip(ua, ub, ug, uk, strict=True):
            out.append((_pack(now[0] - was[0], now[1] - was[1], now[2] - was[2]), "".join(marks[was[0] + was[1] : now[0] + now[1]]), keys[was[3] : now[3]].tobytes()))  # a copy: a view would keep the whole array
            was = now
        return out

    @staticmethod
    def _spell(x: Byte | Piece, whole: list[bytes], ids: np.ndarray, of: np.ndarray, ends: np.ndarray) -> bool:
        """Whether the tokens of all texts spell them: their bytes together, and each text's end among the tokens' ends."""
        if b"".join([x.bytes[i] for i in ids.tolist()]) != b"".join(whole):
            return False
        last = np.searchsorted(of, np.arange(len(whole)), side="right") - 1
        return len(whole) == 0 or bool((last >= 0).all() and (ends[last] == np.cumsum([len(w) for w in whole])).all())

    def texts(self, texts: list[str | None]) -> list[tuple | None]:
        """Every text by its segments; None has no tokens."""
        cut = [None if not t or SPACE in t else CUT.split(" " + t) if self.safe else [" " + t] for t in texts]
        known = self.known
        fresh = [s for s in dict.fromkeys(chain.from_iterable(c for c in cut if c)) if s not in known]
        if fresh:
            known.update(zip(fresh, self.align([s[1:] for s in fresh]), strict=True))
        out = []
        for text, segments in zip(texts, cut, strict=True):
            if segments is None:
                out.append(None)
                continue
            found = list(map(known.__getitem__, segments))
            if None in found:
                out.append(self.align([text])[0])
                continue
            counts, shown, keys = zip(*found, strict=True)
            out.append((sum(counts), "".join(shown), b"".join(keys)))
        room = CACHED - len(known) + len(fresh)
        for i, s in enumerate(fresh):
            if i >= room or len(s) > LONGEST:
                del known[s]
        return out


def aligned(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256 and the keys of all links of every document, in order, as int64s in a row."""
    rows = common.pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level, pieces)
        for batch in common.slices(batches, limit=1 << 19):
            found = [f or (0, "", b"") for f in aligner.texts(batch.column("text").to_pylist())]
            digests = [hashlib.sha256(f[1][:-1].encode()).hexdigest() if f[1] else "" for f in found]
            keys = pa.array([f[2] for f in found], type=pa.binary())
            counts = [pa.array(c, type=pa.int64()) for c in zip(*(_unpack(f[0]) for f in found), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digests, type=pa.string()), keys], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "keys"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, keys binary")


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """The keys of all rows of a batch."""
    return np.frombuffer(b"".join(batch.column("keys").to_pylist()), dtype=np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as distinct keys with their counts; what is held is bounded by the vocabularies."""
    keys, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for batch in batches:
        new, n = np.unique(_keys(batch), return_counts=True)
        keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, back, np.concatenate([counts, n]))
        counts = total
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])


def _run_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their keys: runs of equal ones summed, the last held back until the next batch."""
    held: tuple[int, int] | None = None
    for batch in batches:
        keys, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n"))
        if held is not None:
            keys, n = np.concatenate([[held[0]], keys]), np.concatenate([[held[1]], n])
        if not len(keys):
            continue
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, n = keys[starts], np.add.reduceat(n, starts)
        held = (int(keys[-1]), int(n[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(keys[:-1]), pa.array(n[:-1])], names=["key", "n"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]])], names=["key", "n"])


def pair_counts(links: DataFrame, shards: int = 8) -> DataFrame:
    """(key, n) of every pair of ids: sorted shards, no key in two of them."""
    parts = links.select("keys").mapInArrow(_counted, "key long, n long")
    return parts.repartitionByRange(shards, "key").sortWithinPartitions("key").mapInArrow(_run_lengths, "key long, n long")


class Shards:
    """The count shards of an executor: memory-mapped keys and counts, and the highest count of each B id."""

    def __init__(self, names: tuple[str, ...]):
        import pyarrow.parquet as pq

        self.maps: list[tuple[np.ndarray, np.ndarray]] = []
        for name in names:
            t = pq.read_table(SparkFiles.get(name))
            self.maps += [self._mapped(t)] if t.num_rows else []
        self.maps.sort(key=lambda m: int(m[0][0]))
        self.first = np.array([m[0][0] for m in self.maps], dtype=np.int64)
        self.best = np.zeros(1 + max((int(m[0][-1]) >> 32 for m in self.maps), default=0), dtype=np.int64)
        for keys, n in self.maps:
            b = np.asarray(keys) >> 32
            starts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            self.best[b[starts]] = np.maximum(self.best[b[starts]], np.maximum.reduceat(np.asarray(n), starts))

    @staticmethod
    def _mapped(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Both columns in a file of their own without a name, which goes with the process."""
        with tempfile.TemporaryFile() as f:
            for c in ("key", "n"):
                t.column(c).to_numpy().astype(np.int64).tofile(f)
            f.flush()
            both = np.memmap(f, dtype=np.int64, mode="r")
        return both[: t.num_rows], both[t.num_rows :]

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        shard = np.searchsorted(self.first, keys, side="right") - 1
        for s in np.unique(shard):
            here = shard == s
            out[here] = self.maps[s][1][np.searchsorted(self.maps[s][0], keys[here])]
        return out


@functools.lru_cache(maxsize=2)
def _shards(names: tuple[str, ...]) -> Shards:
    return Shards(names)


def report(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    common.prepare(spark)
    links = common.stash(aligned(docs, byte_level, pieces), "alignment-links")
    counts = common.stash(pair_counts(links), "alignment-counts", codec="none")
    bound, found = pair_bound(*tokenizers(byte_level, pieces)), counts.count()
    if found > bound:
        raise ValueError(f"{found} pairs of ids, but the vocabularies allow {bound}")
    # New executors fetch the files whenever they come, so they stay until the program ends.
    names = []
    for f in counts.inputFiles():
        spark.sparkContext.addFile(f)
        names.append(f.rsplit("/", 1)[1])
    names = tuple(sorted(names))
    kind = links.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _shards(names)
        for batch in batches:
            keys = _keys(batch)
            n = shards.look_up(keys)
            top = n == shards.best[keys >> 32]
            size = pa.compute.binary_length(batch.column("keys")).to_numpy(zero_copy_only=False).astype(np.int64) // 8
            until = np.cumsum(size)
            of = lambda x, until=until, size=size: (s := np.append(0, np.cumsum(x)))[until] - s[until - size]
            sums = [pa.array(v, type=pa.int64()) for v in (size, of(top.astype(np.int64)), of(n))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], *sums, batch.column("groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return links.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
