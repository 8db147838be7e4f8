"""Mixing sources to target weights by iterative proportional fitting.

Every document belongs to a cell (source, language, topic) and weighs its
number of words.  The weights of the cells are raked: scaled, one marginal after
the other, until their sums by source, by language and by topic are the target
sums.  Then one factor is sought with which the calibrated probabilities
``min(1, factor * weight / words)`` of the cells keep a set share of all words,
and each document is sampled by its cell's probability and a hash of its id.

Topics are a parameter: any column may be given.  By default they are clusters of
the texts: spherical k-means in numpy over hashed words of four or more bytes,
weighted by their rarity and centred by language, so that a topic is no language
in disguise.  They are fitted on all distinct texts with such words: each becomes a row of counted
buckets, and a round of k-means is a pass of tasks whose sums Spark adds up, so
the driver has buckets times topics and buckets times languages, however many
texts there are.  Every document gets the nearest cluster.

By default a marginal's target is its share of the words to the power
``TEMPER``, made to sum to one: large sources and languages give way to small ones.

Cells are counted in Spark.  Up to ``DRIVER_CELLS`` of them are raked in the driver;
more stay in Spark, one row a source with its few cells: a round sends the factors
of languages and topics out and gets their sums back, and what a source's own factor
is follows from those, so nothing that grows with the sources comes to the driver.
Rounds, order of the marginals and tolerances are the same in both, and so are the
results but for the last digits of sums.  Languages times topics must fit a driver;
sources may be any number.  Where the targets can't all be met
(cells without words), raking ends after ``ROUNDS`` rounds and the largest gap
left in a marginal is in the result.

Defined cases: a null source or language is a value of its own, apart from any
text; a null or empty text, or one without words of four bytes, has the topic
``none``, and the first two weigh nothing; a cell without words is kept with
probability 1; rows of one doc_id, repeated rows among them, are judged by one
hash, so within a cell they stay or go together; documents without a doc_id are
judged by a hash of the text; at equal distance the first cluster is taken; a
text of any length is read whole; an empty table gives an empty result; columns
besides doc_id, text, source and lang are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm import common, kernels

TOPICS, TEMPER, KEEP_SHARE, SEED = 8, 0.5, 0.5, "mix"
DRIVER_CELLS, ROUNDS, CLOSE = 2_000_000, 2000, 1e-9
#: Buckets of words; rounds of k-means.
BUCKETS_LOG2, MEANS_ROUNDS = 12, 12
DIMS = ("source", "lang", "topic")


@dataclass
class Topics:
    table: np.ndarray  # buckets x topics: what a word adds to the nearness to each cluster
    offsets: dict[str | None, np.ndarray]  # by language: what its mean has of each cluster
    default: np.ndarray


def word_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words of four or more bytes, the text of each, and every text's number of words."""
    data, offsets = kernels.text_buffer(column)
    starts, ends, words = kernels.word_bounds(data, offsets)
    text = np.repeat(np.arange(len(words) - 1), np.diff(words))
    long = ends - starts >= 4
    h = kernels.word_hashes(kernels.LOWER[data], starts[long], ends[long])
    return (h >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64), text[long], np.diff(words)


VECTOR = "digest string, lang string, bucket binary, n binary"
#: Scaled: the entries of a text's vector before its language's mean is taken off, for length one after that.
UNITS = "digest string, lang int, scale double, bucket binary, x binary"


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary cells of the values between ends: Spark moves a cell at once, and numpy reads it as it is."""
    offsets = (np.asarray(ends) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of binary cells, and where each cell's begin and the last's end."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and their counts of the texts that have any."""
    for part in common.slices(batches, "text"):
        bucket, owner, _ = word_buckets(part.column("text"))
        cell, n = np.unique((owner << BUCKETS_LOG2) + bucket, return_counts=True)
        ends = np.searchsorted(cell >> BUCKETS_LOG2, np.arange(part.num_rows + 1))
        cells = [_packed((cell & ((1 << BUCKETS_LOG2) - 1)).astype(np.int16), ends), _packed(n.astype(np.int32), ends)]
        yield pa.RecordBatch.from_arrays([part.column("digest"), part.column("lang"), *cells], names=["digest", "lang", "bucket", "n"]).filter(pa.array(np.diff(ends) > 0))


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, bucket and share of the words of every entry of the batch's vectors."""
    bucket, ends = _unpacked(batch.column("bucket"), np.int16)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    n = _unpacked(batch.column("n"), np.int32)[0].astype(np.float64)
    return owner, bucket.astype(np.int64), n / np.bincount(owner, weights=n, minlength=batch.num_rows)[owner]


#: Sums are of whole numbers, this many a unit, so they are the same however the rows lie.
UNIT = float(1 << 30)


def _summed(vectors: DataFrame, part_of) -> dict[int, np.ndarray]:
    """The sums by key of what part_of(batch) gives (key, array of whole numbers): tasks add their own up, and one task a key those of the tasks."""

    def rows(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), type=pa.int32()), pa.array([v.tobytes() for v in total.values()], type=pa.binary())], names=["key", "v"])

    def added(pairs) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for key, values in pairs:
            if key in total:
                total[key] += values
            else:
                total[key] = values.copy()
        yield rows(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added(pair for batch in batches if batch.num_rows for pair in part_of(batch))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added((k, np.frombuffer(v, dtype=np.int64)) for b in batches for k, v in zip(b.column("key").to_pylist(), b.column("v").to_pylist(), strict=True))

    got = vectors.mapInArrow(run, "key int, v binary").repartition("key").mapInArrow(merge, "key int, v binary").collect()
    return {r["key"]: np.frombuffer(r["v"], dtype=np.int64) for r in got}


def _whole(key: np.ndarray, keys: int, values: np.ndarray) -> np.ndarray:
    """Sums by key of a batch's values, in units; whole numbers of this size are exact in doubles."""
    return np.bincount(key, weights=np.rint(values * UNIT), minlength=keys).astype(np.int64)


def fit_topics(vectors: DataFrame, topics: int = TOPICS) -> Topics | None:
    """Spherical k-means over all vectors; a round is a pass of the tasks, and the driver has buckets times topics and languages."""
    size = 1 << BUCKETS_LOG2
    named = sorted((r[0] for r in vectors.select("lang").distinct().collect()), key=lambda v: (v is not None, v or ""))
    if not named:
        return None
    code = {v: i for i, v in enumerate(named)}

    def counted(batch: pa.RecordBatch):
        owner, bucket, share = _sparse(batch)
        lang = np.array([code[v] for v in batch.column("lang").to_pylist()])
        for i in np.unique(lang):
            some = (lang == i)[owner]
            yield int(i), np.append(_whole(bucket[some], size, share[some]), (lang == i).sum())
        yield -1, np.append(np.bincount(bucket, minlength=size), batch.num_rows)

    sums = _summed(vectors, counted)
    seen = sums.pop(-1)
    rarity = np.log((1 + seen[-1]) / (1 + seen[:size]))
    means = np.stack([rarity * (sums[i][:size] / UNIT) / sums[i][size] for i in range(len(named))])
    square = (means**2).sum(axis=1)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries scaled so that the vectors, less their language's mean, have length one; language and scale of each."""
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, bucket, share = _sparse(batch)
            lang = np.array([code[v] for v in batch.column("lang").to_pylist()], dtype=np.int64)
            x = share * rarity[bucket]
            own = np.bincount(owner, weights=x * x, minlength=batch.num_rows)
            length = own - 2 * np.bincount(owner, weights=x * means[lang[owner], bucket], minlength=batch.num_rows) + square[lang]
            scale = np.where(length > np.maximum(1e-6 * own, 1e-12), 1 / np.sqrt(np.maximum(length, 1e-12)), 0)  # what is its language's mean has no direction
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            arrays = [batch.column("digest"), pa.array(lang, type=pa.int32()), pa.array(scale), batch.column("bucket"), _packed((x * scale[owner]).astype(np.float32), ends)]
            yield pa.RecordBatch.from_arrays(arrays, names=["digest", "lang", "scale", "bucket", "x"])

    units = common.stash(vectors.mapInArrow(scaled, UNITS), "mix-units")

    def near(batch: pa.RecordBatch, centres: np.ndarray):
        bucket, ends = _unpacked(batch.column("bucket"), np.int16)
        x = _unpacked(batch.column("x"), np.float32)[0].astype(np.float64)
        lang, scale = batch.column("lang").to_numpy(), batch.column("scale").to_numpy()
        table, by = np.ascontiguousarray(centres.T), np.empty((batch.num_rows, len(centres)))
        for i in range(0, batch.num_rows, 32):  # so many entries times centres stay in a core's cache
            to = ends[i : i + 33]
            by[i : i + 32] = np.add.reduceat(table[bucket[to[0] : to[-1]]] * x[to[0] : to[-1], None], to[:-1] - to[0])
        return bucket, ends, x, lang, scale, by - (means @ centres.T)[lang] * scale[:, None]

    def drawn(centres: np.ndarray | None) -> np.ndarray | None:
        """A vector far from the centres, with odds by the square of the distance: the least of exponential times, which follow from the digests."""
        turn = 0 if centres is None else len(centres)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                gap = np.ones(batch.num_rows) if centres is None else np.maximum(1 - near(batch, centres)[5].max(axis=1), 0).round(6) ** 2
                gap *= batch.column("scale").to_numpy() > 0
                u = np.array([(int(hashlib.md5(f"{turn}:{d}".encode()).hexdigest()[:13], 16) + 1) / float((1 << 52) + 1) for d in batch.column("digest").to_pylist()])
                time = np.divide(-np.log(u), gap, out=np.full(len(gap), np.inf), where=gap > 0)
                for i in np.flatnonzero(time == time.min()).tolist() if np.isfinite(time.min()) else ():
                    key = (float(time[i]), batch.column("digest")[i].as_py(), batch.column("lang")[i].as_py())
                    if best is None or key < best[0]:
                        best = key, pa.RecordBatch.from_arrays([pa.array([time[i]]), *(batch.column(c).slice(i, 1) for c in batch.schema.names)], names=["time", *batch.schema.names])
            if best is not None:
                yield best[1]

        r = units.mapInArrow(run, f"time double, {UNITS}").agg(F.min(F.struct("time", "digest", "lang", "scale", "bucket", "x")).alias("r")).first()["r"]
        if r is None:
            return None
        v = -means[r["lang"]] * r["scale"]
        v[np.frombuffer(r["bucket"], dtype=np.int16)] += np.frombuffer(r["x"], dtype=np.float32)
        return v

    centres = drawn(None)
    centres = np.zeros((1, size)) if centres is None else centres[None]
    while len(centres) < topics:
        more = drawn(centres)
        centres = np.vstack((centres, centres[0] if more is None else more))

    for _ in range(MEANS_ROUNDS):

        def added(batch: pa.RecordBatch, centres=centres):
            bucket, ends, x, lang, scale, by = near(batch, centres)
            of = by.round(6).argmax(axis=1)
            yield from enumerate(_whole(np.repeat(of << BUCKETS_LOG2, np.diff(ends)) + bucket, topics * size, x).reshape(topics, size))
            yield topics, _whole(of * len(named) + lang, topics * len(named), scale / 1024)  # the scales, by topic and language

        sums, last = _summed(units, added), centres
        total = np.stack([sums[k] for k in range(topics)]) / UNIT - (sums[topics].reshape(topics, len(named)) / UNIT * 1024) @ means
        length = np.linalg.norm(total, axis=1)
        some = length > 0
        centres = np.where(some[:, None], total / np.where(some, length, 1)[:, None], last)
        if np.array_equal(last, centres):
            break
    common.drop_stash(units)
    return Topics((centres * rarity).T, {lang: centres @ means[i] for i, lang in enumerate(named)}, np.zeros(topics))


def topic_model(docs: DataFrame) -> Topics | None:
    """Clusters of all distinct texts with words."""
    common.prepare(docs.sparkSession)
    named = common.pick(docs, "text", "lang").where(F.col("text").isNotNull()).select(F.md5("text").alias("digest"), "text", F.col("lang").cast("string").alias("lang"))
    vectors = common.stash(named.mapInArrow(_vectors, VECTOR).dropDuplicates(["digest", "lang"]), "mix-vectors")
    model = fit_topics(vectors)
    common.drop_stash(vectors)
    return model


def _weigh(batches: Iterator[pa.RecordBatch], model: Topics | None, text: str, lang: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[str]]]:
    """Each slice with the words and the topic of its texts."""
    for part in common.slices(batches, text):
        bucket, owner, words = word_buckets(part.column(text))
        n = part.num_rows
        seen = np.bincount(owner, minlength=n)
        if model is None:
            topic = ["none"] * n
        else:
            near = np.stack([np.bincount(owner, weights=model.table[bucket, k], minlength=n) for k in range(model.table.shape[1])], axis=1) / np.maximum(seen, 1)[:, None]
            near -= np.stack([model.offsets.get(v, model.default) for v in part.column(lang).to_pylist()])
            topic = [f"t{k}" if any_ else "none" for k, any_ in zip(near.round(12).argmax(axis=1).tolist(), (seen > 0).tolist(), strict=True)]
        yield part, words, topic


def weighed(docs: DataFrame, model: Topics | None = None) -> DataFrame:
    """(doc_id, place, source, lang, topic, n_tokens) of every document; place is its number in [0, 1) for sampling. Topics are fitted on docs if none are given."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or topic_model(docs))  # buckets x topics, whatever the documents are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n, topic in _weigh(batches, shared.value, "text", "lang"):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "place", "source", "lang")), pa.array(topic, type=pa.string()), pa.array(n, type=pa.int64())], names=["doc_id", "place", "source", "lang", "topic", "n_tokens"])

    rows = common.pick(docs, "doc_id", "text", "source", "lang")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), place(F.col("doc_id"), F.col("text")).alias("place"), "text", *[F.col(c).cast("string").alias(c) for c in ("source", "lang")])
    return rows.mapInArrow(run, "doc_id long, place double, source string, lang string, topic string, n_tokens long")


def place(doc_id: Column, text: Column) -> Column:
    h = F.when(doc_id.isNotNull(), F.xxhash64(doc_id.cast("string"), F.lit(SEED))).otherwise(F.xxhash64(text, F.lit(SEED)))
    return F.pmod(h, F.lit(1 << 40)) / float(1 << 40)


def tempered(shares: dict, power: float = TEMPER) -> dict:
    raw = {k: v**power for k, v in shares.items() if v > 0}
    total = sum(raw.values())
    return {k: v / total for k, v in raw.items()}


def rake(keys: list[tuple], words: np.ndarray, targets: list[dict], rounds: int = ROUNDS, close: float = CLOSE) -> tuple[np.ndarray, float]:
    """Weights of the cells (summing to one) whose marginals are the targets, starting from the shares of the words, and the largest gap that is left in a marginal.

    A value without a target, or with target 0, gets weight 0; targets of values
    that no cell has are left out and the others scaled to one.
    """
    dims = []
    for d, target in enumerate(targets):
        code: dict = {}
        at = np.array([code.setdefault(k[d], len(code)) for k in keys], dtype=np.int64)
        have = np.bincount(at, weights=words, minlength=len(code)) > 0
        want = np.where(have, [target.get(x, 0.0) for x in code], 0.0)
        dims.append((at, want / want.sum() if want.sum() else want))
    w = words / words.sum()
    worst = np.inf
    for _ in range(rounds):
        worst = 0.0
        for at, want in dims:
            now = np.bincount(at, weights=w, minlength=len(want))
            worst = max(worst, float(np.abs(now - want).max()))
            w = w * np.divide(want, now, out=np.zeros_like(want), where=now > 0)[at]
        if worst < close:
            break
    return w, max(float(np.abs(np.bincount(at, weights=w, minlength=len(want)) - want).max()) for at, want in dims)


def keep_factor(words: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The factor f with which sum(words * min(1, f * weight / words)) is this share of the words, or all that the cells of positive weight have."""
    goal = min(share * words.sum(), words[weight > 0].sum())
    ratio = np.divide(weight, words, out=np.zeros_like(weight), where=words > 0)
    order = np.argsort(-ratio, kind="stable")
    full = 0.0
    rest = weight.sum()
    for i in order:  # cells reach probability 1 in the order of their ratios
        if ratio[i] <= 0 or rest <= 0:
            break
        f = (goal - full) / rest
        if f * ratio[i] <= 1:
            return f
        full += words[i]
        rest -= weight[i]
    return float("inf")


def calibrate(keys: list[tuple], words: np.ndarray, share: float = KEEP_SHARE, targets: list[dict] | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Weight and probability of every cell, and the gap that raking left."""
    if not len(words) or words.sum() == 0:
        return np.zeros(len(words)), np.ones(len(words)), 0.0
    if targets is None:
        targets = []
        for d in range(len(DIMS)):
            sums: dict = {}
            for k, w in zip(keys, words, strict=True):
                sums[k[d]] = sums.get(k[d], 0.0) + float(w)
            targets.append(tempered(sums))
    weight, gap = rake(keys, words, targets)
    if gap > CLOSE:
        warnings.warn(f"raking left a gap of {gap:.3g} in a marginal: the targets can't all be met", stacklevel=2)
    f = keep_factor(words, weight, share)
    with np.errstate(invalid="ignore"):
        p = np.where(words > 0, np.minimum(1.0, np.where(weight > 0, f * np.divide(weight, words, out=np.ones_like(weight), where=words > 0), 0.0)), 1.0)
    return weight, p, gap


CELLS = "cell_source string, cell_lang string, cell_topic string, words double, weight double, probability double, gap double"


def probabilities(rows: DataFrame, share: float = KEEP_SHARE, targets: list[dict] | None = None, most: int = DRIVER_CELLS) -> DataFrame:
    """(source, lang, topic, words, weight, probability, gap) of every cell of the weighed rows."""
    spark = rows.sparkSession
    cells = common.stash(rows.groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("words")), "mix-cells")
    if cells.count() > most:
        return _probabilities_in_spark(cells, share, targets)
    found = sorted(cells.collect(), key=lambda r: tuple((r[d] is not None, r[d] or "") for d in DIMS))
    keys = [tuple(r[d] for d in DIMS) for r in found]
    words = np.array([r["words"] for r in found])
    weight, p, gap = calibrate(keys, words, share, targets)
    data = [(*k, float(n), float(w), float(x), gap) for k, n, w, x in zip(keys, words, weight, p, strict=True)]
    return spark.createDataFrame(data, CELLS)


def _marginal(cells: DataFrame, dim: str, targets: list[dict] | None) -> DataFrame:
    """(value, want) of a marginal: its target shares, scaled to one over the values that have words."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("words").alias("n"))
    if targets is None:
        raw = sums.select("value", "n", F.when(F.col("n") > 0, F.pow("n", F.lit(TEMPER))).otherwise(0.0).alias("t"))
    else:
        given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[DIMS.index(dim)].items()], "key string, t double")
        raw = sums.join(given, sums["value"].eqNullSafe(given["key"]), "left").select("value", "n", F.when(F.col("n") > 0, F.coalesce("t", F.lit(0.0))).otherwise(0.0).alias("t"))
    total = raw.agg(F.sum("t")).first()[0] or 1.0
    return raw.select("value", (F.col("t") / total).alias("want"))


def _probabilities_in_spark(cells: DataFrame, share: float, targets: list[dict] | None) -> DataFrame:
    """As calibrate(), with the sources' factors in Spark and those of languages and topics in the driver."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("words")).first()[0]
    if not total:
        return cells.select(*[F.col(d).alias(f"cell_{d}") for d in DIMS], "words", F.lit(0.0).alias("weight"), F.lit(1.0).alias("probability"), F.lit(0.0).alias("gap"))
    coded, want = [], []
    for d in DIMS[1:]:
        found = sorted(_marginal(cells, d, targets).collect(), key=lambda r: (r["value"] is not None, r["value"] or ""))
        coded.append({r["value"]: i for i, r in enumerate(found)})
        want.append(np.array([r["want"] for r in found]))
    own = _marginal(cells, "source", targets).withColumnRenamed("value", "of")
    listed = cells.groupBy("source").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("lang", F.lit("")).alias("l"), F.col("lang").isNull().alias("no_lang"), "topic", "words"))).alias("cells"))
    rows = common.stash(listed.join(own, listed["source"].eqNullSafe(own["of"])).select("source", "want", F.col("cells.l").alias("l"), F.col("cells.no_lang").alias("no_lang"), F.col("cells.topic").alias("topic"), F.col("cells.words").alias("words")), "mix-sources")

    def parsed(batch: pa.RecordBatch):
        """Per row: source, its target, places of language and topic, shares of the words, words."""
        for source, t, langs, none, topics, words in zip(*(batch.column(c).to_pylist() for c in ("source", "want", "l", "no_lang", "topic", "words")), strict=True):
            n = np.array(words)
            yield source, t, np.array([coded[0][None if x else v] for v, x in zip(langs, none, strict=True)]), np.array([coded[1][v] for v in topics]), n / total, n

    def factor(t: float, shares: np.ndarray, g: np.ndarray) -> float:
        now = float((shares * g).sum())
        return t / now if now > 0 else 0.0

    def sums(before: tuple, now: tuple, which: int) -> tuple[np.ndarray, float]:
        """With the sources' factors that follow from ``before``: the marginal (0 languages, 1 topics) of the weights under ``now``, and the largest gap of a source under ``now``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, worst = np.zeros(len(want[which])), 0.0
            for batch in batches:
                for _, t, l, k, shares, _ in parsed(batch):
                    w = factor(t, shares, before[0][l] * before[1][k]) * shares * now[0][l] * now[1][k]
                    np.add.at(out, (l, k)[which], w)
                    worst = max(worst, abs(float(w.sum()) - t))
            yield pa.RecordBatch.from_pydict({"out": pa.array([out.tolist()], type=pa.list_(pa.float64())), "worst": pa.array([worst])})

        got = rows.mapInArrow(run, "out array<double>, worst double").collect()
        return np.array([math.fsum(c) for c in zip(*(r["out"] for r in got), strict=True)]), max(r["worst"] for r in got)

    ratio = lambda t, now: np.divide(t, now, out=np.zeros_like(t), where=now > 0)
    before, now = None, tuple(np.ones(len(w)) for w in want)
    for _ in range(ROUNDS):
        worst = np.inf if before is None else sums(before, now, 0)[1]
        by_lang, _ = sums(now, now, 0)  # the sources have been scaled
        worst = max(worst, float(np.abs(by_lang - want[0]).max()))
        scaled = (now[0] * ratio(want[0], by_lang), now[1])
        by_topic, _ = sums(now, scaled, 1)
        worst = max(worst, float(np.abs(by_topic - want[1]).max()))
        before, now = now, (scaled[0], scaled[1] * ratio(want[1], by_topic))
        if worst < CLOSE:
            break
    left_lang, left_source = sums(before, now, 0)
    left_topic, _ = sums(before, now, 1)
    gap = max(left_source, float(np.abs(left_lang - want[0]).max()), float(np.abs(left_topic - want[1]).max()))
    if gap > CLOSE:
        warnings.warn(f"raking left a gap of {gap:.3g} in a marginal: the targets can't all be met", stacklevel=2)
    names = [{i: v for v, i in c.items()} for c in coded]

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for source, t, l, k, shares, n in parsed(batch):
                w = factor(t, shares, before[0][l] * before[1][k]) * shares * now[0][l] * now[1][k]
                out += [(source, names[0][a], names[1][b], float(x), float(y)) for a, b, x, y in zip(l, k, n, w, strict=True)]
            kinds = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=["cell_source", "cell_lang", "cell_topic", "words", "weight"])

    weights = common.stash(rows.mapInArrow(weighted, "cell_source string, cell_lang string, cell_topic string, words double, weight double"), "mix-weights")
    f = _keep_factor_in_spark(weights, share)
    p = F.when(F.col("words") > 0, F.least(F.lit(1.0), F.when(F.col("weight") > 0, F.lit(f) * F.col("weight") / F.col("words")).otherwise(0.0))).otherwise(1.0)
    return weights.select("*", p.alias("probability"), F.lit(gap).alias("gap"))


def _keep_factor_in_spark(weights: DataFrame, share: float) -> float:
    """As keep_factor(): the cells that reach probability 1 grow in number from step to step until none is added."""
    some = weights.where("weight > 0 and words > 0")
    words, able, weight = weights.agg(F.sum("words"), F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("words"))), F.lit(0.0)), F.sum("weight")).first()
    goal = min(share * words, able)
    f = goal / weight if weight else float("inf")
    while True:
        full, rest = some.agg(F.coalesce(F.sum(F.when(F.col("weight") * f > F.col("words"), F.col("words"))), F.lit(0.0)), F.coalesce(F.sum(F.when(F.col("weight") * f <= F.col("words"), F.col("weight"))), F.lit(0.0))).first()
        if rest <= 0:
            return float("inf")
        nxt = (goal - full) / rest
        if nxt <= f * (1 + 1e-12):
            return f
        f = nxt


def same_cell(source: Column, lang: Column, topic: Column) -> Column:
    return source.eqNullSafe(F.col("cell_source")) & lang.eqNullSafe(F.col("cell_lang")) & (topic == F.col("cell_topic"))


def mix(docs: DataFrame, share: float = KEEP_SHARE, targets: list[dict] | None = None) -> DataFrame:
    """One row a document: doc_id, cell, words, the cell's raked weight and probability, the gap that raking left in the marginals, and whether the document is sampled."""
    rows = common.stash(weighed(docs), "mix-rows")
    joined = rows.join(probabilities(rows, share, targets), same_cell(*map(F.col, DIMS)))
    return joined.select("doc_id", *DIMS, "n_tokens", "weight", "probability", "gap", (F.col("place") < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, share: float = KEEP_SHARE, targets: list[dict] | None = None) -> DataFrame:
    """The sampled documents, as they are."""
    model = topic_model(docs)
    p = probabilities(common.stash(weighed(docs, model), "mix-rows"), share, targets)
    rows, names, at = common.positional(docs)
    col = lambda n: F.col(names[at[n]])
    own = rows.select(*names, place(col("doc_id"), col("text")).alias("place"), col("source").cast("string").alias("own_source"), col("lang").cast("string").alias("own_lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, topic in _weigh(batches, shared.value, names[at["text"]], "own_lang"):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(topic, type=pa.string())], names=[*part.schema.names, "own_topic"])

    schema = T.StructType([*own.schema.fields, T.StructField("own_topic", T.StringType())])
    cell = same_cell(F.col("own_source"), F.col("own_lang"), F.col("own_topic"))
    return own.mapInArrow(run, schema).join(p, cell).where(F.col("place") < F.col("probability")).select(*names).toDF(*docs.columns)
