"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits of the lower-cased text (ASCII
punctuation and spaces separate; other characters belong to tokens).  A seed is
a run of ``LEAST`` tokens, or a whole item if it is shorter.  Documents keep the
seeds that a bitmap of the benchmark's seeds lets through, an equality join on
the seed finds the documents and items that share some, and each such pair is
tiled: the longest common run of unmarked tokens, found by running Karp-Rabin
hashes of falling length, is marked on both sides, again and again, until none of
``LEAST`` tokens is left.  A pair is reported if the tiles cover ``COVERAGE`` of
the item's tokens; tiles may stand in any order, so a passage whose parts were
moved is caught.

Tiles of ``LEAST`` tokens or more consist of seeds, so only the stretches of a
document that seeds cover travel with it.  A pair must share seeds at
``COVERAGE * tokens / LEAST`` places of the item at least, so a pair that can
reach the coverage shares one of the item's rarest ``places - need + 1`` seeds:
only those are joined, and a seed that many documents hold brings no pairs unless
an item has little else.

Defined cases: null or empty texts have no tokens and match nothing; an item of
fewer than ``LEAST`` tokens is found where all its tokens stand in a row; items
and documents are told apart by row, so null and repeated ids are searched for
and judged like others, each row by itself; an empty benchmark leaves all
documents clean, an empty table of documents gives an empty result; a text may
have any length; columns besides the id and text are not read, whatever their
names.  Tiles of one length are marked in the order of the item, then the
document.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm import common, kernels

LEAST, COVERAGE = 5, 0.8
#: Bits of the bitmap, as a power of two: from 2 to 32 MB.
BITMAP_LOG2, MOST_LOG2 = 24, 28

SEPARATES = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])
BREAK = np.uint64(1) << np.uint64(63)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 63-bit hash of every token, and the n + 1 token offsets of the texts."""
    data, offsets = kernels.text_buffer(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, ends, words = kernels.word_bounds(data, offsets, SEPARATES)
    return kernels.word_hashes(data, starts, ends) & ~BREAK, words


def seeds(token: np.ndarray, words: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first token and text of every run of least tokens."""
    count = np.maximum(np.diff(words) - least + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    first = np.repeat(words[:-1], count) + kernels.ragged_arange(count)
    h = kernels.Hasher(token).windows(least)[first] if len(first) else np.zeros(0, np.uint64)
    return kernels.mix(h ^ np.uint64(least)), first, text


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(item start, doc start, length) of the tiles, longest first, ties by item start, then doc start.

    Values with the top bit set are breaks that no tile crosses.
    """
    free_a, free_b = (item & BREAK) == 0, (doc & BREAK) == 0
    hash_a, hash_b = kernels.Hasher(item), kernels.Hasher(doc)

    def common_windows(s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and hashes of the unmarked windows of s tokens on both sides whose hash is on the other side too."""
        sides = []
        for free, h, n in ((free_a, hash_a, len(item)), (free_b, hash_b, len(doc))):
            if n < s:
                return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
            ok = np.concatenate(([0], np.cumsum(~free)))
            at = np.flatnonzero(ok[s:] == ok[:-s])
            sides.append((at, h.windows(s)[at]))
        (a, ha), (b, hb) = sides
        in_a, in_b = np.isin(ha, hb), np.isin(hb, ha)
        return a[in_a], b[in_b], ha[in_a], hb[in_b]

    out: list[tuple[int, int, int]] = []
    most = min(len(item), len(doc))
    while most >= least:
        low, high = least - 1, most  # a common run of s tokens holds one of s - 1
        while low < high:
            s = (low + high + 1) // 2
            if len(common_windows(s)[0]):
                low = s
            else:
                high = s - 1
        if low < least:
            break
        a, b, ha, hb = common_windows(low)
        before = len(out)
        at: dict[int, deque[int]] = {}
        for y, h in zip(b.tolist(), hb.tolist(), strict=True):
            at.setdefault(h, deque()).append(y)
        for x, h in zip(a.tolist(), ha.tolist(), strict=True):
            if not free_a[x : x + low].all():
                continue
            places = at.get(h, ())
            while places:
                y = places.popleft()
                if free_b[y : y + low].all() and (item[x : x + low] == doc[y : y + low]).all():
                    free_a[x : x + low] = free_b[y : y + low] = False
                    out.append((x, y, low))
                    break
        most = low if len(out) > before else low - 1
    return out


ITEM_SCHEMA = "item long, item_id long, tokens array<long>, least int, need int, seeds array<struct<seed:long,place:int>>"


def _row_base() -> int:
    return (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36


def _items(batches: Iterator[pa.RecordBatch], least: int, coverage: float) -> Iterator[pa.RecordBatch]:
    row = _row_base()
    for part in common.slices(batches):
        token, words = tokens(part.column("text"))
        size = np.diff(words)
        own = np.minimum(size, least)
        found = [[] for _ in range(part.num_rows)]
        for k in np.unique(own[own > 0]).tolist():
            h, first, text = seeds(token, words, k)
            for x, f, t in zip(h.view(np.int64).tolist(), first.tolist(), text.tolist(), strict=True):
                if own[t] == k:
                    found[t].append({"seed": x, "place": int(f - words[t])})
        need = np.where(size >= least, np.maximum(1, np.ceil(size * coverage / least - 1e-9)), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(part.num_rows)), part.column("item_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(words, type=pa.int32()), pa.array(token.view(np.int64))), pa.array(own, type=pa.int32()), pa.array(need, type=pa.int32()), pa.array(found, type=pa.list_(pa.struct([("seed", pa.int64()), ("place", pa.int32())])))],
            names=["item", "item_id", "tokens", "least", "need", "seeds"],
        )
        row += part.num_rows


HIT_SCHEMA = "row long, doc_id long, key string, seeds array<long>, tokens array<long>, places array<int>"


def _hits(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray, log2: int, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Documents with seeds in the bitmap: those seeds, and the tokens they cover with breaks between stretches."""
    row = _row_base()
    shift = np.uint64(64 - log2)
    if not lengths:  # no item has a token
        return
    for part in common.slices(batches):
        token, words = tokens(part.column("text"))
        cover = np.zeros(len(token), dtype=bool)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for k in lengths:
            h, first, text = seeds(token, words, k)
            slot = h >> shift
            keep = (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            kept.append((h[keep], text[keep]))
            cover |= kernels.covered(first[keep], k, len(token))
        h, text = (np.concatenate(x) for x in zip(*kept, strict=True))
        doc_ids = part.column("doc_id").cast(pa.int64()).to_pylist()
        rows: list[tuple] = []
        for t in np.unique(text).tolist():
            s, e = words[t], words[t + 1]
            starts, ends = kernels.runs(cover[s:e])
            pieces, places = [], []
            for k, (x, y) in enumerate(zip(starts, ends, strict=True)):
                pieces += [token[s + x : s + y], np.array([BREAK | np.uint64(k)])]
                places += [np.arange(x, y, dtype=np.int32), np.array([-1], dtype=np.int32)]
            key = hashlib.sha256(part.column("text")[t].as_py().encode()).hexdigest()
            rows.append((row + t, doc_ids[t], key, np.unique(h[text == t]).view(np.int64), np.concatenate(pieces).view(np.int64), np.concatenate(places)))
        row += part.num_rows
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], type=pa.int64()), pa.array(cols[1], type=pa.int64()), pa.array(cols[2], type=pa.string()), *(pa.array(list(c), type=pa.list_(k)) for c, k in zip(cols[3:], (pa.int64(), pa.int64(), pa.int32()), strict=True))], names=["row", "doc_id", "key", "seeds", "tokens", "places"])


PAIR_SCHEMA = "doc_id long, item_id long, n_tiles long, n_covered long, n_item_tokens long, coverage double, tiles array<struct<item_start:long,doc_start:long,length:long>>, key string"


def _tile(batches: Iterator[pa.RecordBatch], coverage: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i in range(b.num_rows):
            item = b.column("item_tokens")[i].values.to_numpy().view(np.uint64)
            doc = b.column("tokens")[i].values.to_numpy().view(np.uint64)
            places = b.column("places")[i].values.to_numpy()
            tiles = greedy_tiles(item, doc, b.column("least")[i].as_py())
            n = sum(x[2] for x in tiles)
            if n >= coverage * len(item):
                rows.append((b.column("doc_id")[i].as_py(), b.column("item_id")[i].as_py(), len(tiles), n, len(item), n / len(item), [{"item_start": x, "doc_start": int(places[y]), "length": s} for x, y, s in tiles], b.column("key")[i].as_py()))
        if rows:
            kinds = (*[pa.int64()] * 5, pa.float64(), pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())])), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "n_tiles", "n_covered", "n_item_tokens", "coverage", "tiles", "key"])


def seed_bitmap(item_seeds: DataFrame) -> tuple[np.ndarray, int]:
    """One bit for each value of a seed's top bits, and how many bits those are: 16 slots a seed, 2 MB at least and 32 MB at most, whatever the benchmark's size."""
    log2 = min(MOST_LOG2, max(BITMAP_LOG2, (16 * item_seeds.count()).bit_length()))
    slot = F.shiftrightunsigned("seed", 64 - log2)
    words = item_seeds.select(F.shiftright(slot, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - log2}) & 63 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (log2 - 6), dtype=np.int64)
    for w, bits in words.collect():
        out[w] = bits
    return out.view(np.uint8), log2


def _pairs(docs: DataFrame, benchmark: DataFrame, least: int, coverage: float) -> DataFrame:
    spark = docs.sparkSession
    common.prepare(spark)
    items = common.stash(common.pick(benchmark, "item_id", "text").mapInArrow(lambda b: _items(b, least, coverage), ITEM_SCHEMA).where(F.size("tokens") > 0), "tiling-items")
    item_seeds = items.select("item", "need", F.explode("seeds").alias("s")).select("item", "need", "s.seed", "s.place")
    found, log2 = seed_bitmap(item_seeds)
    lengths = sorted(r[0] for r in items.select("least").distinct().collect())
    bitmap = spark.sparkContext.broadcast(found)
    texts = common.pick(docs, "doc_id", "text")
    hits = texts.mapInArrow(lambda b: _hits(b, bitmap.value, log2, lengths), HIT_SCHEMA)
    hits = common.stash(hits, "tiling-hits")
    seen = hits.select("row", F.explode("seeds").alias("seed"))
    # of each item the rarest places - need + 1: a pair with need common places has one of them
    often = seen.groupBy("seed").agg(F.count("*").alias("often"))
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.coalesce("often", F.lit(0)), "place"))
    places = F.count("*").over(W.partitionBy("item"))
    rare = item_seeds.join(often, "seed", "left").select("item", "seed", rank.alias("rank"), (places - F.col("need") + 1).alias("most")).where("rank <= most").select("item", "seed").distinct()
    pairs = seen.join(rare, "seed").select("row", "item").distinct()
    tokens_of = items.select("item", "item_id", "least", F.col("tokens").alias("item_tokens"))
    return pairs.join(tokens_of, "item").join(hits.drop("seeds"), "row").mapInArrow(lambda b: _tile(b, coverage), PAIR_SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The (document, item) pairs at or over the coverage, with their tiles (in tokens)."""
    return _pairs(docs, benchmark, least, coverage).drop("key")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark item is found in. Whether one is depends on the text alone, so rows are looked up by their text, with or without an id."""
    found = common.stash(_pairs(docs, benchmark, LEAST, COVERAGE).select("key").distinct(), "tiling-found")
    rows, names, at = common.positional(docs)
    key = F.sha2(F.col(names[at["text"]]).cast("binary"), 256)
    return rows.join(found, key == F.col("key"), "left_anti").toDF(*docs.columns)
