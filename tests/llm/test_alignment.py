"""Cross-tokenizer alignment against encoding every text whole and looping over its tokens."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa

from siltstone.llm import alignment as L

A, B = L.tokenizers(L.BYTE_LEVEL, L.PIECES)
ALPHABET = ["a", "the ", "  ", " ", "\n", "\t", "\r\n", "'s", "'ll", "123", "é", "ß", "中文", "\U0001f600", "\u00a0", "\u2003", "\u0085", L.SPACE, "<|endoftext|>", "<s>", "<unk>", "<0x41>", "\x00", "\x1c", "\u200b", "\u0301", "foo", "Bar", "_", "...", "\ufeff", "ﬁ", "\u3000"]


def plain(rows):
    """The contract's columns by whole texts and Python loops."""
    docs, count = [], collections.Counter()
    for _, text in rows:
        whole = b" " + (text or "").encode()
        ids = (A.encode([text or ""])[0], B.encode([text or ""])[0])
        if not text or any(b"".join(x.bytes[i] for i in some) != whole for x, some in zip((A, B), ids)):
            docs.append(None)
            continue
        at = []
        for x, some in zip((A, B), ids):
            end, ends = 0, []
            for i in some:
                end += len(x.bytes[i])
                ends.append(end)
            at.append(ends)
        of_b = dict(zip(at[1], ids[1]))
        links = [(i, of_b[e]) for i, e in zip(ids[0], at[0]) if e in of_b]
        groups, a, b = [], 0, 0
        for e in sorted(set(at[0]) & set(at[1])):
            to_a, to_b = (next((n for n in range(k, len(ends)) if ends[n] > e), len(ends)) for k, ends in ((a, at[0]), (b, at[1])))
            groups.append(",".join(map(str, ids[0][a:to_a])) + "|" + ",".join(map(str, ids[1][b:to_b])))
            a, b = to_a, to_b
        count.update(links)
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(((i, 0, 0, 0, 0, 0, 0, "") if d is None else (i, *d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for (i, _), d in zip(rows, docs)), key=repr)


def report(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, key long, keys string").repartition(parts)
    return sorted((tuple(r) for r in L.report(df).collect()), key=repr)


def test_odd_texts(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30)))) for i in range(1500)]
    rows += [(9999, None), (None, "no id"), rows[3], rows[3], (9998, "word " * 3000), (9997, "x" * 20_000)]
    want = plain(rows)
    assert sum(w[1] == 0 for w in want) > 10
    assert report(spark, rows) == want


def test_all_kinds_of_characters(spark):
    rows = [(c, f"x {chr(c)}{chr(c)} y{chr(c)} z {chr(c)}") for c in range(0, 0x30000, 37) if not 0xD800 <= c < 0xE000]
    assert report(spark, rows) == plain(rows)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert report(spark, rows) == plain(rows)


def test_no_rows(spark):
    assert report(spark, []) == [] and report(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_segments_are_kept_only_while_there_is_room(monkeypatch):
    monkeypatch.setattr(L, "CACHED", 3)
    r = random.Random(5)
    texts = [" ".join(r.choice(["one", "two", "three", "four!"]) for _ in range(20)) for _ in range(50)]
    kept, whole = L.Aligner(L.BYTE_LEVEL, L.PIECES), L.Aligner(L.BYTE_LEVEL, L.PIECES)
    for t in texts:
        (x,), (y,) = kept.texts([t]), whole.align([t])
        assert x == y and len(kept.known) <= 3


def test_runs_are_summed_over_batches():
    batch = lambda keys: pa.RecordBatch.from_arrays([pa.array(keys, type=pa.int64()), pa.array([1] * len(keys), type=pa.int64())], names=["key", "n"])
    got = [p for b in L._run_lengths(iter([batch([1, 1, 2]), batch([]), batch([2, 2]), batch([2, 5])])) for p in zip(b.column("key").to_pylist(), b.column("n").to_pylist())]
    assert got == [(1, 2), (2, 4), (5, 1)] and list(L._run_lengths(iter([]))) == []


def test_counts_are_sorted_shards(spark):
    df = spark.createDataFrame([(np.array(k, dtype=np.int64).tobytes(),) for k in ([5, 1, 1 << 33], [1], [])], "keys binary").repartition(2)
    counts = L.pair_counts(df, 3)
    assert [tuple(r) for r in counts.collect()] == [(1, 2), (5, 1), (1 << 33, 1)]


def test_pairs_are_bounded_by_the_vocabularies():
    assert 100_000 < L.pair_bound(A, B) < 2_000_000 and L.cuts_are_safe(A, B)
    assert np.all([len(b"".join([t])) >= 1 for t in B.bytes])
