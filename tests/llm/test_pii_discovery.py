"""Identifiers that no base pattern has, planted under contexts; and the bootstrap against a plain version of it."""

import random

from conftest import prose

from siltstone.llm import pii

SF = "/root/testdata/sf0.001"


def planted(n=240):
    """Texts with seeds, texts with identifiers of other forms in like contexts, and texts with numbers that are none."""
    r = random.Random(8)
    seeds, hidden, clean = [], [], []
    ip = lambda: ".".join(str(r.randint(1, 254)) for _ in range(4))
    word = lambda i: prose(1000 + i, 1)
    for i in range(n):
        lead, tail = prose(i, 12), prose(5000 + i, 12)
        line = [("you can reach me on", f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", "during office hours"), ("please write to", f"{word(i)}{i}@example.org", "for more"), ("connections came from address", ip(), "last night"), ("auth", f'token = "{r.getrandbits(160):040x}"', "in config")][i % 4]
        seeds.append(f"{lead} {' '.join(line)} {tail}")
    for i in range(n):
        lead, tail = prose(7000 + i, 12), prose(9000 + i, 12)
        kind, before, what, after = [
            ("phone", "you can reach me on", f"{r.randint(200, 999)} 555 {r.randint(1000, 9999)}", "during office hours"),
            ("phone", "you can reach me on", f"0{r.randint(200, 999)}555{r.randint(1000, 9999)}", "on weekdays"),
            ("email", "please write to", f"{word(i)}{i} (at) example (dot) org", "for more"),
            ("email", "please write to", f"{word(i)}{i} [at] mail.example.org", "or call"),
            ("ip", "connections came from address", f"fe80:{r.randint(1000, 9999)}:0:{r.randint(1000, 9999)}::1", "last night"),
            ("secret", "auth token =", f"{r.getrandbits(120):030x}", "in config"),
        ][i % 6]
        at = len(lead) + 1 + len(before) + 1
        hidden.append((f"{lead} {before} {what} {after} {tail}", (kind, at, at + len(what))))
    for i in range(n):
        what = [f"invoice number {r.randint(10**9, 10**10)} was paid", f"version {r.randint(10, 99)}.{r.randint(10, 99)}.{r.randint(100, 999)}-rc1 is out", f"commit {r.getrandbits(160):040x} fixes it", f"published on {r.randint(10, 28)}/11/{r.randint(1990, 2024)} by them"][i % 4]
        clean.append(f"{prose(11000 + i, 12)} {what} {prose(13000 + i, 12)}")
    return seeds, hidden, clean


def test_recall_and_precision_on_planted_identifiers(spark):
    seeds, hidden, clean = planted()
    texts = seeds + [t for t, _ in hidden] + clean
    got = {r["doc_id"]: r for r in pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = {(d, x) for d, r in got.items() if r["spans"] for x in set(r["spans"].split(",")) - set(r["base"].split(","))}
    want = {(len(seeds) + i, f"{k}:{s}:{e}") for i, (_, (k, s, e)) in enumerate(hidden)}
    named = {x for x in found if x[0] < len(seeds)}
    assert all(not pii.base_spans(t)["phone"] and not pii.base_spans(t)["email"] and not pii.base_spans(t)["ip"] for t, _ in hidden)
    recall, precision = len(want & found) / len(want), len(want & found) / len(found - named)
    assert recall >= 0.95 and precision >= 0.98, (recall, precision)
    assert len(named) == len(seeds) // 4  # the quoted tokens


def plain_bootstrap(seen, rounds=3, support=3, reliable=0.8, accept=0.8):
    edges = {}
    for kind, surface, pattern, seed in seen:
        edges[kind, surface, pattern] = edges.get((kind, surface, pattern), False) or seed
    seeds = {(k, s) for (k, s, _), seed in edges.items() if seed}
    known = dict.fromkeys(seeds, 1.0)
    for _ in range(rounds):
        reliability = {}
        for kind, pattern in {(k, p) for k, _, p in edges if k != pii.OTHER}:
            own = {s: seed for (k, s, p), seed in edges.items() if (k, p) == (kind, pattern)}
            every = sum(p == pattern for _, _, p in edges)
            score = [known[kind, s] for s in own if (kind, s) in known]
            if len(score) >= support and len(own) > sum(own.values()):
                r = round(sum(score) / (len(score) + min(every - len(own), len(own) - len(score))), 9)
                if r >= reliable:
                    reliability[kind, pattern] = r
        miss = {}
        for (k, s, p), seed in edges.items():
            if not seed and (k, p) in reliability:
                miss[k, s] = miss.get((k, s), 1.0) * (1 - min(reliability[k, p], 1 - 1e-9))
        for key, x in miss.items():
            if round(1 - x, 9) >= accept:
                known[key] = max(known.get(key, 0.0), round(1 - x, 9))
    return set(known) - seeds


def test_the_bootstrap_equals_a_plain_version(spark):
    seeds, hidden, clean = planted(48)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + seeds + [t for t, _ in hidden] + clean
    seen = [(m[0], m[3], p, m[5]) for t in texts for m in pii.mentions(t, pii.base_spans(t)) for p in m[4]]
    got = pii.bootstrap(spark.createDataFrame(seen, "kind string, surface string, pattern string, seed boolean")).collect()
    want = plain_bootstrap(seen)
    assert {(r["kind"], r["surface"]) for r in got} == want and len(want) > 30


def test_the_whole_table_by_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    found = {d: pii.mentions(t, pii.base_spans(t)) for d, t in texts.items()}
    accepted = plain_bootstrap([(m[0], m[3], p, m[5]) for ms in found.values() for m in ms for p in m[4]])
    for r in pii.report(docs).collect():
        want = sorted({(pii.SPAN_KINDS.index(m[0]), m[1], m[2]) for m in found[r["doc_id"]] if m[5] or (m[0], m[3]) in accepted})
        assert r["spans"] == ",".join(f"{pii.SPAN_KINDS[k]}:{s}:{e}" for k, s, e in want)


def test_forms():
    forms = {"555-123-4567": "phone", "4111.1111.1111.1112": "card", "fe80:12:0:1::1": "ip", "10.0.0[.]12": "ip", "a@b": "email", "24be64439e3e49cf46b2": pii.SECRET, "1234.5678.99x": pii.OTHER, "word": None, "12:30": None, "abcdefghijklmnopqrst": None}
    assert {k: pii.kind_of(k) for k in forms} == forms
    for t in ("x" * 200_000, "1 " * 100_000, "a at " * 50_000, "token = " * 30_000, "12-" * 60_000, "[at]" * 50_000, '"' * 100_000):
        pii.mentions(t, pii.base_spans(t))
