import re

import duckdb
import numpy as np
import pytest

from siltstone.llm import decontaminate, langid, licences, media, mixing, pii, urls

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(s):
    t = 0
    for i, c in enumerate(s[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def plain_spans(x):
    digits = lambda m: re.sub(r"\D", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(x)],
        "ip": [m.span() for m in IP.finditer(x) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(x) if 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(x) if 9 <= len(digits(m)) <= 15],
    }


def test_base_spans_equal_the_plain_patterns():
    r = np.random.default_rng(0)
    alphabet = list("a1@.-+ (),:\n_%") + ["é"]
    for _ in range(3000):
        x = "".join(r.choice(alphabet, r.integers(0, 60)))
        assert pii.base_spans(x) == plain_spans(x), x
    for x in ("a@b.c@d.e@f", "x@@y.z", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "+1 (555) 123-4567 +44", "@" * 50, "1" * 5000, "a" * 5000 + "@"):
        assert pii.base_spans(x) == plain_spans(x), x


def test_context_finds_what_no_base_pattern_has(spark):
    phones = ["+1 555 123 4567", "+1 555 123 4568", "+1 555 123 4569", "+1 555 123 4570", "+1 555 999 0000"]
    rows = [(i, f"text {i} please call me at {p} now") for i, p in enumerate(phones)] + [(9, "also call me at 5551234999 now"), (10, "order number is 5551234999x8")]
    got = {r["doc_id"]: r for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[9]
    at = text.index("5551234999")
    assert got[9]["spans"] == f"phone:{at}:{at + 10}" and got[9]["n_phone"] == 0 and got[9]["n_added"] == 1
    assert got[10]["spans"] == "" and got[0]["base"] == got[0]["spans"]


def test_one_copied_passage_induces_nothing(spark):
    rows = [(i, "please call me at +1 555 123 4567 now") for i in range(20)] + [(99, "please call me at 5551234999 now")]
    assert all(r["n_added"] == 0 for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_pii_rows_and_redaction(odd, nothing):
    assert pii.report(odd).count() == odd.count() and pii.report(nothing).count() == 0
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count() and pii.redact(nothing).count() == 0
    before = {(r["doc_id"], r["text"], r["n_chars"]) for r in odd.collect()}
    changed = [r for r in out.collect() if (r["doc_id"], r["text"], r["n_chars"]) not in before]
    assert [r["text"] for r in changed] == ["mail <EMAIL> and <PHONE>"] and changed[0]["n_chars"] == len(changed[0]["text"])


def test_masking_of_overlaps():
    assert pii.masked("ab 12 cd", "email:0:2,ip:3:5,card:4:5") == "<EMAIL> <IP> cd"


def test_tiles():
    a = np.arange(1, 31, dtype=np.uint64)
    moved = np.concatenate((a[20:], a[:20]))
    tiles = decontaminate.greedy_tiles(a, moved)
    assert tiles == [(0, 10, 20), (20, 0, 10)]
    assert decontaminate.greedy_tiles(a, a + np.uint64(100)) == []
    same = np.full(40, 5, dtype=np.uint64)
    assert sum(t[2] for t in decontaminate.greedy_tiles(same[:12], same)) == 12


def plain_tiles(a, b, least):
    """Greedy tiling by comparing every pair of places."""
    ua, ub, out = [False] * len(a), [False] * len(b), []
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ua[i + k] and not ub[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if best < least:
            return out
        for i, j in found:
            if not any(ua[i : i + best]) and not any(ub[j : j + best]):
                ua[i : i + best] = ub[j : j + best] = [True] * best
                out.append((i, j, best))


def test_tiles_equal_a_plain_version():
    r = np.random.default_rng(1)
    for _ in range(60):
        a, b = (r.integers(1, 4, r.integers(1, 30)).astype(np.uint64) for _ in range(2))
        assert decontaminate.greedy_tiles(a, b, 3) == plain_tiles(a.tolist(), b.tolist(), 3)


def test_contamination(odd, nothing, bench, spark):
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(odd, bench).collect()}
    assert {k[0] for k in got} >= {0, 1, 2} and {k[1] for k in got} == {0}
    assert all(r["coverage"] == 1.0 and r["n_covered"] == 30 for r in got.values())
    assert decontaminate.contaminated(odd, bench).where("doc_id = 0").count() == 2  # a repeated row is judged by itself
    words = bench.where("item_id = 0").first()["text"].split()
    turned = spark.createDataFrame([(1, "x " + " ".join(words[15:]) + " y z " + " ".join(words[:15])), (2, " ".join(words[:20]))], "doc_id long, text string")
    assert [(r["doc_id"], r["n_tiles"]) for r in decontaminate.contaminated(turned, bench).collect()] == [(1, 2)]
    kept = decontaminate.clean(odd, bench)
    # of the rows without an id the one that holds the item goes too
    assert kept.columns == odd.columns and not {0, 1, 2} & {r["doc_id"] for r in kept.collect()} and [r["text"] for r in kept.where("doc_id is null").collect()] == [None]
    assert decontaminate.clean(odd, bench.limit(0)).count() == odd.count() and decontaminate.clean(nothing, bench).count() == 0


def test_short_items_and_items_without_an_id(spark):
    items = spark.createDataFrame([(1, "red green blue teal"), (None, "one two three four five six"), (None, "x"), (5, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a Red, green blue TEAL b"), (2, "red green blue"), (3, "zero one two three four five six"), (4, "blue teal red green"), (5, "y x z")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or 0, r["n_tiles"], r["coverage"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(1, 1, 1, 1.0), (3, 0, 1, 1.0), (5, 0, 1, 1.0)]
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [2, 4]


def test_contamination_equals_a_plain_version_on_a_whole_table(spark):
    """Greedy tiling of every pair that has five tokens in a row in common; others have no tile."""
    sf = "/root/testdata/sf0.001"
    split = lambda t: re.findall(r"[^\W_]+" if (t or "").isascii() else r"(?:[a-z0-9]|[^\x00-\x7f])+", (t or "").lower())
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    wanted = [(r["item_id"], split(r["text"])) for r in items.collect()]
    want = {}
    for r in docs.collect():
        words = split(r["text"])
        mine = runs(words)
        for item, tokens in wanted:
            if mine & runs(tokens):
                tiles = plain_tiles(tokens, words, 5)
                n = sum(t[2] for t in tiles)
                if n >= 0.8 * len(tokens):
                    want[r["doc_id"], item] = (len(tiles), n)
    got = {(r["doc_id"], r["item_id"]): (r["n_tiles"], r["n_covered"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == want and len(want) >= 3


def test_licences(odd, nothing, spark):
    assert licences.scan(odd).count() == odd.count() and licences.scan(nothing).count() == 0
    texts = [
        "Some text.\nReleased under the MIT License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "LICENSED UNDER CC BY-NC 4.0!\n", "a licence of sorts", None, "Released under the MIT License. Released under the MIT License.",
    ]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i]["licence"] for i in range(6)] == ["MIT", "Apache-2.0", "CC-BY-NC-4.0", None, None, "MIT"]
    assert got[1]["n_sentences"] == 4 and got[5]["sentences"] == "MIT_NOTICE MIT_NOTICE" and got[5]["licences"] == "MIT"


def test_every_known_sentence_has_the_hint_and_is_normalised(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(s,) for s in licences.SENTENCES], "s string").select("s", licences.normalised(F.col("s")).alias("n"), F.col("s").rlike(licences.HINT).alias("hint")).collect()
    assert all(r["s"] == r["n"] and r["hint"] for r in rows)


def test_media(odd, nothing):
    import hashlib
    import zlib

    got = {}
    for r in media.round_trip(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == odd.count() and media.round_trip(nothing).count() == 0
    for t in odd.select("doc_id", "text").collect():
        raw = (t["text"] or "").encode()
        p = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        assert any((r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])) for r in got[t["doc_id"]])
    assert got[0][0]["media_sha256"] == got[1][0]["media_sha256"] and got[9][0]["feature"].startswith("chunks=") and not got[9][0]["feature"].startswith("chunks=1;")


def test_media_with_hot_chunks_and_no_table_left(spark, odd):
    head = "".join(chr(97 + (i * i // 7) % 26) for i in range(70_000))
    rows = [(i, head + f" {i} " * 900) for i in range(12)] + [(12, "short"), (13, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cold, hot = ({r["doc_id"]: r.asDict() for r in media.round_trip(docs, hot=h).collect()} for h in (10**9, 3))
    assert cold == hot and len(hot) == 14 and not [t.name for t in spark.catalog.listTables() if t.name.startswith("media_chunks")]


def test_suffixes_and_domains(spark):
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "www.x.com": ("x.com", "com"), "x.com:8080": ("x.com", "com"), "u@x.org": ("x.org", "org"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "[::1]": ("[::1]", "[::1]"), "": ("", ""), "localhost": ("localhost", "localhost"), "a.nic.uk": ("nic.uk", "uk"), "shop.com.br": ("shop.com.br", "com.br")}
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", urls.domain_of(F.col("host")).alias("d"), urls.suffix_of(F.col("host")).alias("s")).collect()
    assert {r["host"]: (r["d"], r["s"]) for r in rows} == hosts


def test_a_host_is_judged_against_the_rest(spark):
    pages = [(i, f"http://{'mixed' if i < 1000 else f'h{i % 40}'}.org/{i}") for i in range(5000)]
    labels = [(i, int(i % 10 < 5) if i < 1000 else int(i // 40 % 10 > 0)) for i in range(5000)]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r["host"] for r in got.where("verdict = 'block'").select("host").distinct().collect()} == {"mixed.org"}


def test_chunk_ends():
    r = np.random.default_rng(2)
    for n in (0, 1, 192, 2048, 2049, 50_000, 400_000):
        data = r.integers(0, 256, n).astype(np.uint8).tobytes()
        ends = media.cuts(data)
        assert b"".join(media.chunks(data)) == data and ends[-1] == n
        assert all(media.LEAST <= b - a <= media.MOST for a, b in zip([0, *ends], ends[:-1]))
    x = np.frombuffer(data[:500], dtype=np.uint8)
    plain = 0
    for i, b in enumerate(x[:100]):
        plain = ((plain << 1) + int(media.GEAR[b])) & 0xFFFFFFFF
        assert media.gear(x)[i] == plain
    # an insertion in front changes the first chunks only
    assert len(set(media.chunks(data)) & set(media.chunks(b"x" * 777 + data))) >= len(media.chunks(data)) - 3


def test_a_damaged_chunk_is_noticed():
    import zstandard

    c = media.payload("abc")
    frame = zstandard.ZstdCompressor().compress(c)
    with pytest.raises(ValueError):
        media.read_back("0" * 64, [(media.digest(c), frame)])
    with pytest.raises(ValueError):
        media.read_back("0" * 64, [(b"other", frame)])


def test_url_parts_and_rules(spark):
    urls_ = [(0, "http://A.Example.com/en/x?q#f"), (1, "https://www.example.com/en/"), (2, "x.net"), (3, None), (4, "ftp://foo.net/es/1"), (5, "http://foo.net/de/"), (6, "http://b.com"), (7, "http://b.com/?x"), (8, "a://b://c/d"), (9, "http://notexample.com/en/")]
    pages = spark.createDataFrame([(i, u, "h", "h2") for i, u in urls_], "page_id long, url string, host string, path string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, labels).collect()}
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", "block") and got[1] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[2] == got[3] == ("", "", None, "allow") and got[4] == ("foo.net", "/es/1", "net/es/", "block") and got[5][2:] == (None, "allow")
    assert got[6] == ("b.com", "", None, "allow") and got[7] == ("b.com", "/", "com/", "allow") and got[8] == ("b:", "//c/d", None, "allow") and got[9][2] == "com/"
    assert urls.judge(pages.limit(0), labels).count() == 0 and urls.judge(pages, labels.limit(0)).where("rule is null and verdict = 'block'").count() == 0


def test_bad_hosts_are_blocked_and_shrunk(spark):
    pages = [(i, f"http://{h}.org/{i}") for i, h in enumerate(["bad"] * 40 + ["good"] * 40 + ["new"])]
    labels = [(i, 0 if i < 40 else 1) for i in range(80)] + [(80, 0)]
    p, q = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["page_id"]: r for r in urls.judge(p, q).collect()}
    assert got[0]["verdict"] == "block" and got[40]["verdict"] == "allow" and got[80]["verdict"] == "allow"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER)")
    for r in pages:
        con.execute(f"INSERT INTO pages VALUES ({r[0]}, '{r[1]}')")
    for r in labels:
        con.execute(f"INSERT INTO labels VALUES ({r[0]}, {r[1]})")
    want = {r[0]: r[4] for r in con.execute(urls.oracle_sql()).fetchall()}
    assert want == {k: r["verdict"] for k, r in got.items()}


def test_raking_meets_the_marginals():
    r = np.random.default_rng(4)
    keys = [(s, l, t) for s in "abc" for l in "xy" for t in "12"]
    words = r.integers(1, 100, len(keys)).astype(float)
    targets = [{"a": 0.2, "b": 0.3, "c": 0.5}, {"x": 0.6, "y": 0.4}, {"1": 0.5, "2": 0.5}]
    w, gap = mixing.rake(keys, words, targets)
    assert gap < 1e-9
    for d, target in enumerate(targets):
        for v, want in target.items():
            assert abs(sum(x for k, x in zip(keys, w) if k[d] == v) - want) < 1e-6
    f = mixing.keep_factor(words, w, 0.4)
    assert abs(np.minimum(words, f * w).sum() - 0.4 * words.sum()) < 1e-6
    # weights keep the odds of the start: the interaction of two cells' ratios is unchanged
    ratio = lambda v: v[0] * v[3] / (v[1] * v[2])
    assert abs(ratio(w) / ratio(words) - 1) < 1e-9


def test_mixing(odd, nothing, spark):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and mixing.mix(nothing).count() == 0
    assert all(r["sampled"] for r in got if r["n_tokens"] == 0 and r["probability"] == 1.0)
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["sampled"] for r in got) and mixing.sample(nothing).count() == 0


def test_the_query_equals_a_plain_version(spark):
    """Cells, raking and sampling of the whole table by plain loops; topics and places are taken as given."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r.asDict() for r in mixing.weighed(docs).collect()]
    assert len({r["topic"] for r in rows}) > 4 and len(rows) == docs.count()
    by_text = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    assert all(r["n_tokens"] == by_text[r["doc_id"]] for r in rows)
    cells = {}
    for r in rows:
        k = (r["source"], r["lang"], r["topic"])
        cells[k] = cells.get(k, 0) + r["n_tokens"]
    total = sum(cells.values())
    want = []
    for d in range(3):
        sums = {}
        for k, n in cells.items():
            sums[k[d]] = sums.get(k[d], 0) + n
        root = {v: n**0.5 for v, n in sums.items()}
        want.append({v: x / sum(root.values()) for v, x in root.items()})
    w = {k: n / total for k, n in cells.items()}
    for _ in range(500):
        for d in range(3):
            now = {}
            for k, x in w.items():
                now[k[d]] = now.get(k[d], 0) + x
            w = {k: x * want[d][k[d]] / now[k[d]] for k, x in w.items()}
    low, high = 0.0, 1e9
    for _ in range(200):
        f = (low + high) / 2
        low, high = (f, high) if sum(min(n, f * w[k]) for k, n in cells.items()) < 0.5 * total else (low, f)
    p = {k: min(1, f * w[k] / n) for k, n in cells.items()}
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    for r in rows:
        k = (r["source"], r["lang"], r["topic"])
        g = got[r["doc_id"]]
        assert (g["source"], g["lang"], g["topic"]) == k and abs(g["probability"] - p[k]) < 1e-6 and g["gap"] <= 1e-6
        assert abs(r["place"] - p[k]) < 1e-6 or g["sampled"] == (r["place"] < p[k])


def test_targets_that_cannot_be_met_are_told(spark):
    rows = [(i, "word " * 9, "en" if i % 2 else "fr", "a" if i % 2 else "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="gap"):
        got = mixing.mix(docs, targets=[{"a": 0.5, "b": 0.5}, {"en": 0.9, "fr": 0.1}, {"none": 1.0, **{f"t{k}": 1.0 for k in range(8)}}]).collect()
    assert all(r["gap"] > 0.1 for r in got)


def test_a_null_source_is_no_text(spark):
    rows = [(i, "river mountain " * 5, "en", "(null)" if i % 2 else None) for i in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == 40 and {r["source"] for r in got} == {None, "(null)"} and len({(r["source"], r["weight"]) for r in got}) == 2


def test_language(spark):
    en = "the of and to in is that it was for on are with as this by".split()
    fr = "le la les des et est une dans pour que qui sur avec par pas au".split()
    r = np.random.default_rng(5)
    rows = [(i, " ".join(r.choice(en if i % 2 else fr, r.integers(3, 60))), "en" if i % 2 else "fr") for i in range(400)]
    rows += [(900, None, "en"), (901, "", None), (902, "123 ½ ² ³ Ⅷ !!!", "en"), (903, "the of and to in is", None), (None, "le la les des et", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in langid.identify(docs).collect()}
    held = [i for i in range(400) if got[i]["held_out"]]
    assert 40 < len(held) < 120 and np.mean([got[i]["lang_pred"] == ("en" if i % 2 else "fr") for i in held]) > 0.97
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 and got[i]["rejected"] for i in (900, 901, 902))
    assert got[903]["lang_pred"] == "en" and got[None]["lang_pred"] == "fr" and not got[None]["held_out"]
    assert all(0 <= x["score"] <= 1 for x in got.values())
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and not {900, 901, 902} & {x["doc_id"] for x in kept.collect()}


def test_language_ignores_labels_ids_and_the_held_out_fold(spark):
    en, fr = "the of and to in is that " * 5, "le la les des et est une " * 5
    rows = [(i, en if i % 2 else fr, "en" if i % 2 else "fr", "s") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(docs)
    held = {r["doc_id"] for r in docs.where(langid.in_fold()).collect()}
    other = spark.createDataFrame([(d, t, "zz" if d in held else l, s) for d, t, l, s in rows], docs.schema)
    again = langid.fit(other)
    assert again.langs == model.langs == ["en", "fr"] and np.array_equal(again.scores, model.scores)


def test_language_without_labels(nothing, odd):
    assert langid.identify(nothing).count() == 0
    got = langid.identify(odd.where("lang is null")).collect()
    assert all(r["lang_pred"] == "und" for r in got)
    assert langid.identify(odd).count() == odd.count() and langid.accepted(odd).columns == odd.columns


def test_long_texts_in_pieces(spark, monkeypatch):
    """Fingerprints and languages of long texts are the same, whatever the pieces."""
    from siltstone.llm import simhash

    r = np.random.default_rng(9)
    words = ["".join(r.choice(list("abcdéf"), r.integers(1, 9))) for _ in range(300)]
    texts = [" ".join(r.choice(words, 4000)), "  \n".join(r.choice(words, 500)) + "\t", "x" * 9000, "one " + "y" * 5000, " " * 9000 + "one two", "a b c" + " " * 7000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    whole = [simhash.majority(simhash.votes(np.array(h, dtype=np.uint64), np.zeros(len(h), np.int64), 1), np.array([len(h)]))[0] for h in (simhash.shingle_hashes(t.encode()) for t in texts)]
    monkeypatch.setattr(simhash, "PIECE", 700)
    for t, want in zip(texts, whole):
        import pyarrow as pa

        (out,) = simhash._fingerprints(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [t]})]))
        assert out.column("fp")[0].as_py() % (1 << 64) == int(want), t[:30]
    model = langid.train([" ".join(r.choice(words[:150], 50)) for _ in range(40)] + [" ".join(r.choice(words[150:], 50)) for _ in range(40)], ["a"] * 40 + ["b"] * 40)
    want = [langid.predict(model, [t]) for t in texts]
    monkeypatch.setattr(langid, "PIECE", 700)
    got = [langid.predict(model, [t]) for t in texts]
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1][0] for g in got], [w[1][0] for w in want])
    assert docs.count() == len(texts)


def test_columns_that_clash(spark, odd):
    """Names with dots and names that differ in case only, through every operator."""
    from siltstone.llm import near_copies, simhash, substrings, suffixes

    clash = odd.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", "1 as `meta.x`", "'t' as `Text`", "2 as `Doc_ID`", "'z' as `LANG`")
    bench = spark.createDataFrame([(0, odd.where("doc_id = 0").first()["text"], "x", 1)], "item_id long, text string, Text string, `a.b` long")
    n = clash.count()
    for run in (simhash.report, substrings.remove_repeated, suffixes.remove_repeated, licences.scan, media.round_trip, pii.report, mixing.mix, langid.identify):
        assert run(clash).count() == n
    assert decontaminate.contaminated(clash, bench).count() > 0
    for run in (simhash.keep_first, near_copies.keep_one, pii.redact, mixing.sample, langid.accepted, lambda d: decontaminate.clean(d, bench)):
        out = run(clash)
        assert out.columns == clash.columns and 0 < out.count() <= n
    pages = spark.createDataFrame([(1, "http://a.org/1", "x", 3)], "page_id long, url string, URL string, `p.q` long")
    labels = spark.createDataFrame([(1, 1, 2)], "doc_id long, quality int, Quality int")
    assert urls.judge(pages, labels).count() == 1


def test_media_buckets_follow_the_bytes(spark, odd, monkeypatch):
    """Many buckets for few bytes: the same payloads are read back."""
    want = sorted((tuple(r) for r in media.round_trip(odd).collect()), key=repr)
    monkeypatch.setattr(media, "BUCKET_BYTES", 1 << 14)
    _, chunks, (name, path), parts = media.store(odd)
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions")) and chunks.count() > 0
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert sorted((tuple(r) for r in media.round_trip(odd).collect()), key=repr) == want
