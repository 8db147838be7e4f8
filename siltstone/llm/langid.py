"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are byte trigrams of the letters (ASCII lower-cased, other ASCII
characters are spaces, one space in front and behind), hashed to buckets; a
text is the mean of its subwords' embeddings, and a linear softmax over it
gives the language.  Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on a bounded sample: about ``PER_LANG`` labelled rows
of each language and ``PER_LANG_BYTES`` bytes of text, chosen by a hash of doc_id
and text, whole texts (a single text over the bytes is not learned from).  Every
language that has a label is learned.  A part of the sample is held back from the
gradient; it sets the temperature of the softmax and the score under which a
prediction is rejected.

Defined cases: a null text, or one without letters (Unicode category L), is
``und`` with score 0 and is rejected; without labelled rows every text is ``und``;
each input row gives one row, repeated rows too; a repeated labelled row (same id,
language and text) is learned once; at equal scores the first language by name is
taken; a null doc_id is not held out and not learned from; a text of any length
is read whole; an empty table gives an empty result; columns besides doc_id, text
and lang are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common, kernels

#: Labelled rows of each language that a model is fitted on, and the bytes of their texts, both about.
PER_LANG, PER_LANG_BYTES = 600, 8 << 20
BUCKETS_LOG2, DIM, EPOCHS, RATE, BATCH, SEED = 14, 16, 6, 4.0, 32, 5
HELD_SHARE, REJECT_SHARE, REJECT_MOST = 0.2, 0.002, 0.5
LATIN = re.compile(r"[A-Za-z]")

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # buckets x languages: each subword's share of the logits
    bias: np.ndarray
    temperature: float
    reject_below: float


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L."""
    return LATIN.search(text) is not None or any(map(str.isalpha, text))


def _trigrams(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams whose middle byte is a letter, and the places of those bytes."""
    data = _FOLD[np.frombuffer(joined, dtype=np.uint8)]
    v = kernels.BYTE_VALUES[data]
    h = (v[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (v[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7)) ^ (v[2:] * np.uint64(0x165667B19E3779F9) << np.uint64(3))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    middle = np.flatnonzero(data[1:-1] != 32)
    return (h[middle] >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64), middle + 1


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the text of each. No subword crosses texts, because spaces part them."""
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    bucket, at = _trigrams(b" ".join([b"", *texts, b""]))
    return bucket, np.searchsorted(ends, at, side="right")


#: Bytes of a long text that are looked at together.
PIECE = 1 << 20


def _counted(text: bytes) -> np.ndarray:
    """How often each bucket is in a text, piece by piece; the bytes on both sides of a piece's border are seen by both."""
    seen = np.zeros(1 << BUCKETS_LOG2, dtype=np.int64)
    whole = memoryview(text)
    for i in range(0, len(text), PIECE):
        end = min(len(text), i + PIECE)
        before, after = bytes(whole[i - 1 : i]) if i else b" ", bytes(whole[end : end + 1]) or b" "
        seen += np.bincount(_trigrams(before + bytes(whole[i:end]) + after)[0], minlength=len(seen))
    return seen


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _means(texts: list[bytes], at: np.ndarray) -> np.ndarray:
    """A row for each chosen text: the share of each bucket in its subwords."""
    bucket, owner = subwords([texts[i] for i in at])
    x = np.bincount(owner * (1 << BUCKETS_LOG2) + bucket, minlength=len(at) << BUCKETS_LOG2).reshape(len(at), -1).astype(np.float32)
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1)


def train(texts: list[str], langs: list[str]) -> Model:
    names = sorted(set(langs))
    raw = [t.encode() for t in texts]
    y = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(raw))
    held = order[: int(len(raw) * HELD_SHARE)] if len(raw) >= 20 else order[:0]
    fit = order[len(held) :]
    emb = rng.normal(0, 0.1, (1 << BUCKETS_LOG2, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, len(names))).astype(np.float32)
    bias = np.zeros(len(names), dtype=np.float32)
    steps, step = EPOCHS * max(1, -(-len(fit) // BATCH)), 0
    for _ in range(EPOCHS):
        for i in range(0, len(fit), BATCH):
            at = fit[i : i + BATCH]
            x = _means(raw, at)
            mean = x @ emb
            p = softmax(mean @ out + bias)
            p[np.arange(len(at)), y[at]] -= 1
            p /= len(at)
            rate = RATE * (1 - step / steps)
            back = p @ out.T
            out -= rate * (mean.T @ p)
            bias -= rate * 0.1 * p.sum(axis=0)
            rows = np.flatnonzero(x.any(axis=0))
            emb[rows] -= rate * 20 * (x[:, rows].T @ back)
            step += 1
    scores = emb @ out
    model = Model(names, scores, bias, 1.0, 0.0)
    if len(held):
        logits = np.concatenate([_means(raw, held[i : i + 256]) @ scores + bias for i in range(0, len(held), 256)])
        nll = {t: -np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in np.geomspace(0.05, 5, 41)}
        model.temperature = float(min(nll, key=nll.get))
        best = softmax(logits / model.temperature).max(axis=1)
        model.reject_below = float(min(REJECT_MOST, np.quantile(best, REJECT_SHARE)))
    return model


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """A language and a score for each text."""
    raw = [(t or "").encode() for t in texts]
    n = len(raw)
    if n == 1 and len(raw[0]) > PIECE:
        seen = _counted(raw[0])
        logits = (seen @ model.scores.astype(np.float64) / max(1, seen.sum()))[None, :] + model.bias
    else:
        bucket, owner = subwords(raw)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        logits = np.stack([np.bincount(owner, weights=model.scores[bucket, j], minlength=n) / total for j in range(len(model.langs))], axis=1) + model.bias
    p = softmax(logits / model.temperature)
    lettered = np.fromiter((t is not None and has_letter(t) for t in texts), dtype=bool, count=n)
    best = p.argmax(axis=1)
    return [model.langs[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], np.where(lettered, p[np.arange(n), best], 0.0)


def in_fold(fold: int = 0, folds: int = 5):
    """Whether crc32 of doc_id as text falls in this fold; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_sample(docs: DataFrame, per_lang: int = PER_LANG, per_lang_bytes: int = PER_LANG_BYTES) -> tuple[list[str], list[str]]:
    """About per_lang labelled texts of each language, by a hash of id and text; never those of the held-out fold."""
    rows = common.pick(docs, "doc_id", "text", "lang").withColumn("size", F.octet_length("text"))
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold() & (F.col("size") <= per_lang_bytes))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()  # one row a language
    if not counts:
        return [], []
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, per_lang / r["n"], per_lang_bytes / max(1, r["bytes"]))) for r in counts], "lang string, rate double")
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(F.broadcast(rates), "lang").where(place < F.col("rate")).select("doc_id", "lang", "text").distinct().collect()
    chosen.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    chosen = [r for r in chosen if has_letter(r["text"])]
    return [r["text"] for r in chosen], [r["lang"] for r in chosen]


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    texts, langs = training_sample(docs, per_lang)
    return train(texts, langs) if texts else None


def _label(batches: Iterator[pa.RecordBatch], model: Model | None, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray, np.ndarray]]:
    for part in common.slices(batches, column):
        texts = part.column(column).to_pylist()
        langs, score = predict(model, texts) if model else (["und"] * len(texts), np.zeros(len(texts)))
        und = np.fromiter((x == "und" for x in langs), dtype=bool, count=len(langs))
        yield part, langs, score, und | (score < (model.reject_below if model else 1))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row a document: doc_id, whether it is held out, language, score and whether the prediction is rejected. Fits a model on docs if none is given."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))  # buckets x languages, whatever the documents are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, langs, score, rejected in _label(batches, shared.value):
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(langs, type=pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return common.pick(docs, "doc_id", "text").withColumn("held_out", in_fold()).mapInArrow(run, SCHEMA)


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents whose language is not rejected, as they are."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    rows, names, at = common.positional(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _, rejected in _label(batches, shared.value, names[at["text"]]):
            yield part.filter(pa.array(~rejected))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
