import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import prose  # noqa: F401  (tests/llm/conftest.py)

from siltstone.llm import blocks, bwt, kernels, simhash, substrings, suffixes


def plain_substrings(rows, width):
    first = {}
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i : i + width])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        flags = [False] * len(w)
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                flags[i : i + width] = [True] * width
        out.append((d, len(w), sum(flags), hashlib.sha256(" ".join(x for x, f in zip(w, flags) if not f).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_substrings_equal_a_plain_version(odd):
    got = substrings.remove_repeated(odd, digest=True).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], key=repr) == plain_substrings(texts_of(odd), 50)
    assert any(r["n_removed"] for r in got)


def test_substrings_spans_and_text(odd):
    for r in substrings.remove_repeated(odd).collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
        assert len(r["kept_text"].split()) == r["n_words"] - r["n_removed"]


def plain_bytes(rows, width):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            if d is not None:
                first[b[i : i + width]] = min(d, first.get(b[i : i + width], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        flags = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - width + 1):
            if d is not None and first[b[i : i + width]] < d:
                flags[i : i + width] = True
        spans = int((np.diff(np.concatenate(([0], flags.astype(int)))) == 1).sum())
        out.append((d, len(b), int(flags.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~flags])).hexdigest()))
    return sorted(out, key=repr)


def test_suffixes_equal_a_plain_version(odd):
    got = suffixes.remove_repeated(odd, digest=True).collect()
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got], key=repr) == plain_bytes(texts_of(odd), 50)


def test_suffixes_on_a_small_alphabet(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 200)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeated(df, width=12, anchor=5, digest=True).collect()
    assert sorted([(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got], key=repr) == plain_bytes(rows, 12)


def test_empty_tables(nothing):
    for f in (substrings.remove_repeated, suffixes.remove_repeated, simhash.near_duplicates, simhash.keep_first):
        assert f(nothing).count() == 0


@pytest.mark.parametrize("chunk,in_memory", [(1 << 20, 1 << 20), (7, 3), (16, 1 << 20)])
def test_transform_and_prefixes_of_a_collection(chunk, in_memory):
    for seed in range(12):
        r = random.Random(seed)
        alphabet = r.choice(["ab", "abc", "abcdefghij"])
        strings = list(dict.fromkeys("".join(r.choice(alphabet) for _ in range(r.randint(4, 30))) for _ in range(r.randint(1, 30))))
        data, lengths = np.frombuffer("".join(strings).encode(), dtype=np.uint8), np.array([len(x) for x in strings], dtype=np.uint8)
        c = bwt.Collection(data, lengths, chunk=chunk, in_memory=in_memory)
        every = sorted(([ord(y) for y in strings[i][p:]] + [k - 1000], strings[i], p) for k, i in enumerate(c.order) for p in range(len(strings[i]) + 1))
        prefixes = [0]
        for (a, *_), (b, *_) in zip(every, every[1:]):
            prefixes.append(next(n for n in range(99) if a[n] != b[n]))
        assert list(c.sequence.symbols(0, c.sequence.n)) == [0 if p == 0 else ord(s[p - 1]) + 1 for _, s, p in every]
        assert list(c.sequence.prefixes(0, c.sequence.n)) == prefixes
        c.close()


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def components(fps):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    parent = {d: d for d in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash_equals_a_plain_version(odd):
    rows = {(d, t) for d, t in texts_of(odd) if d is not None}
    fps = {d: fingerprint(t) for d, t in rows}
    want = components(fps)
    for r in simhash.report(odd).collect():
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", want[r["doc_id"]])
    assert simhash.report(odd).count() == odd.count()


@pytest.mark.parametrize("group", [1, 4, 2048])
def test_links_connect_what_is_within_three_bits(spark, group):
    r = random.Random(group)
    centres = [r.getrandbits(64) for _ in range(6)]
    fps = {}
    for i in range(160):
        x = r.choice(centres)
        for b in r.sample(range(64), r.choice([0, 1, 2, 3, 4, 5])):
            x ^= 1 << b
        fps[i] = x
    first = {}
    for d, x in sorted(fps.items()):
        first.setdefault(x, d)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    nodes = spark.createDataFrame([(signed(x), d) for x, d in first.items()], "fp long, node long")
    from siltstone.llm.graph import connected_components

    got = {r["node"]: r["component"] for r in connected_components(simhash.links(nodes, group)).collect()}
    want = components({d: x for x, d in first.items()})
    assert {d: got.get(d, d) for d in want} == want


def test_keep_first_keeps_one_of_each_group(odd):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and 0 in ids and 1 not in ids


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


def test_words_that_polynomials_confuse_are_told_apart(spark):
    """Two words of 1024 bytes whose polynomials modulo 2**64 are equal for every odd base."""
    x = thue_morse(1024)
    y = x.translate(str.maketrans("ab", "ba"))
    common_words = prose(11, 49)
    rows = [(1, f"{x} {common_words}"), (2, f"{y} {common_words}"), (3, f"{x} {common_words} more")]
    got = substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string"), digest=True).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == plain_substrings(rows, 50)


def test_digests_depend_on_the_words_alone():
    words = substrings.Words(*kernels.text_buffer(pa.array(["a b c d e", "a b x d e", "a  b\tc"])))
    first, text, _ = words.windows(3)
    of, n = blocks.groups(words.digests(first, text, 3))
    assert n == 6 and [of[i] for i in range(len(of)) if text[i] == 2] == [of[0]]


def test_segments_of_one_hash_are_compared():
    r = random.Random(4)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 90)))) for i in range(30)]
    texts = [t.encode() for _, t in rows]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    block = type("B", (), {"data": data, "offsets": offsets, "owner": np.arange(len(rows))})()
    seg = suffixes.Segments(block, 12, 5)
    seg.whole = seg.whole & kernels.U64(7)  # all but all hashes collide
    distinct, of = seg.distinct(12)
    body = lambda i: bytes(data[seg.first[i] : seg.first[i] + seg.windows[i] + 11])
    assert all(body(a) == body(distinct[k]) for a, k in enumerate(of)) and len({body(i) for i in distinct}) == len(distinct)


def test_repetitions_long_texts_and_repeated_ids(spark):
    long = prose(21, 90_000)
    rows = [(5, "a" * 300_000), (6, "b" + "a" * 70), (7, long), (8, "x " + long[300_000:301_000] + " y"), (8, long[300_000:301_000]), (3, "z" * 200_000 + long[400_000:400_400]), (9, "ab" * 100), (10, "ab" * 90_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixes.remove_repeated(df, digest=True).collect()
    assert sorted([(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got], key=repr) == plain_bytes(rows, 50)
    got = substrings.remove_repeated(df, digest=True).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], key=repr) == plain_substrings(rows, 50)


def test_both_equal_plain_versions_on_a_whole_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    got = substrings.remove_repeated(docs, digest=True).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], key=repr) == plain_substrings(texts_of(docs), 50)
    got = suffixes.remove_repeated(docs, digest=True).collect()
    assert sorted([(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got], key=repr) == plain_bytes(texts_of(docs), 50)


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_common_anchors_are_dealt_by_windows(spark, hot):
    r = random.Random(hot)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 200)))) for i in range(60)] + [(60, "ab" * 90), (61, "b" + "ab" * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffixes.remove_repeated(df, width=12, anchor=5, digest=True, hot=hot).collect()
    assert sorted([(x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got], key=repr) == plain_bytes(rows, 12)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_of_chains_and_stars(spark, kind):
    from siltstone.llm.graph import connected_components

    r = random.Random(5)
    ident = (lambda i: i) if kind == "long" else (lambda i: f"{i:05}")
    pairs = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 200)] + [(3000, 3000), (2000, 2001)]
    r.shuffle(pairs)
    df = spark.createDataFrame([(ident(a), ident(b)) for a, b in pairs], f"a {kind}, b {kind}").repartition(7)
    got = {x["node"]: x["component"] for x in connected_components(df).collect()}
    assert got == {ident(i): ident(0) for i in range(401)} | {ident(1000 + i): ident(1000) for i in range(200)} | {ident(i): ident(2000) for i in (2000, 2001)}
    assert connected_components(df.limit(0)).count() == 0


def test_keys_are_never_broadcast(spark):
    """A node has 66 keys, of which Spark's estimates know nothing: keys of a small table would go through the driver."""
    from siltstone.llm import common, simhash

    nodes = spark.range(2000).selectExpr("xxhash64(id div 2) ^ (id % 2) as fp", "id as node")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None) is not None}
    try:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, "1g")
        plans, write = [], common.stash
        common.stash = lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a))[1]
        found = simhash.links(nodes).collect()
    finally:
        common.stash = write
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, kept[k]) if k in kept else spark.conf.unset(k)
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in found} >= {(2 * i, 2 * i + 1) for i in range(1000)}
    assert plans and not any("Broadcast" in p for p in plans)
