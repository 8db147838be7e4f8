"""The crawl as a stream: the rules one by one, replays against batch plans, starting again."""

import random
from types import SimpleNamespace as N

import pytest

from siltstone.streaming import crawl

CUT = "2024-01-01T00:00:00"
LONG, OTHER, TINY = "enough text to be a page. " * 10, "another text that is a page. " * 10, "tiny"


def fetch(**given):
    return N(**({"url": "u", "seq": 1, "status": 200, "raw": LONG, "last_modified": None, "is_error": None, "stored_hash": None} | given))


def kept(raw, **given):
    h = crawl.page_hash(raw)
    return (h, None if given.get("reason") else crawl.content_hash(h), given.get("modified"), given.get("reason"))


OUT = crawl.content_hash(crawl.page_hash(LONG))


@pytest.mark.parametrize(
    ("record", "given", "action"),
    [
        (None, {}, "convert"),
        (kept(LONG), {"status": 304, "raw": None, "stored_hash": OUT}, "skip"),
        (kept(LONG), {"stored_hash": OUT}, "skip"),
        (kept(LONG), {"stored_hash": OUT, "last_modified": "2022-01-01T00:00:00"}, "expired"),
        (kept(LONG), {"stored_hash": OUT, "raw": OTHER}, "convert"),
        (kept(LONG), {"stored_hash": "corrupted"}, "refetch"),
        (kept(LONG), {"stored_hash": None, "raw": OTHER}, "refetch"),
        (kept(LONG), {"status": None, "raw": None, "stored_hash": OUT}, "reuse"),
        (kept(LONG), {"is_error": True, "stored_hash": OUT}, "reuse"),
        (kept(LONG), {"status": 503, "stored_hash": "corrupted"}, "fail"),
        (None, {"status": 503}, "fail"),
        (None, {"raw": TINY}, "short"),
        (kept(TINY, reason="short"), {"raw": TINY}, "short"),
        (kept(TINY, reason="short"), {"raw": LONG}, "convert"),
        (None, {"status": 304, "raw": None}, "fail"),
    ],
)
def test_rules(record, given, action):
    assert crawl.judged(record, fetch(**given), CUT, crawl.SHORT)[0] == action


def crawls(n, urls):
    """Fetches of some urls in n crawls, with all that can happen; what is stored follows from nothing here but chance."""
    r, out = random.Random(5), []
    texts = [LONG, OTHER, TINY, ""]
    hashes = [crawl.content_hash(crawl.page_hash(t)) for t in texts] + [None, "x"]
    for seq in range(n):
        out.append([(f"u{u}", seq, r.choice([200, 200, 200, 304, 503, None]), r.choice([*texts, LONG, None]), r.choice([None, "2025-01-01", "2023-01-01"]), r.choice([None, False, False, True]), r.choice([hashes[0], hashes[0], *hashes])) for u in range(urls) if r.random() < 0.9] + [(None, seq, 200, LONG, None, None, None)])
    return out


def test_replays_equal_batch_plans_and_go_on_after_a_restart(spark, tmp_path):
    found = crawls(5, 60)
    landed, out, check = (str(tmp_path / n) for n in ("landed", "out", "check"))
    for some in (found[:2], found[2:]):  # the second run starts anew from the checkpoint
        for rows in some:
            spark.createDataFrame(rows, crawl.FETCH).coalesce(1).write.parquet(f"{landed}/{rows[0][1]}")
        crawl.run(spark, landed, out, check, CUT, files_a_batch=1 if some is found[:2] else 1000)
    got = spark.read.parquet(out)
    state = spark.createDataFrame([], "url string, raw_hash string, content_hash string, last_modified string, skip_reason string")
    want = []
    for rows in found:
        done = crawl.plan(spark.createDataFrame(rows, crawl.FETCH), state, CUT).collect()
        want += [tuple(r) for r in done]
        now = {r["url"]: tuple(r)[3:] for r in done}
        old = {r["url"]: tuple(r)[1:] for r in state.collect()}
        merged = {u: now[u] if u in now else old[u] for u in {*now, *old}}
        state = spark.createDataFrame([(u, *v) for u, v in merged.items() if v[0] is not None], state.schema)
    assert sorted(map(tuple, got.select("url", "seq", "action", "raw_hash", "content_hash", "last_modified", "skip_reason").collect()), key=repr) == sorted(want, key=repr)
    assert len({w[2] for w in want}) == 7
    assert sorted(map(tuple, crawl.records(got).collect()), key=repr) == sorted(map(tuple, state.collect()), key=repr)


def test_pages_take_rows_one_by_one_and_write_what_changed():
    """A page costs no frame of its own, and a record that stays is not written again."""

    class Kept:
        value, calls = None, []

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v
            self.calls.append("update")

        def clear(self):
            self.value = None
            self.calls.append("clear")

    pages = crawl.Pages(CUT, crawl.SHORT)
    pages.kept = kept_now = Kept()

    def taken(*fetches):
        return [(r["seq"], r["action"]) for r in pages.handleInputRows(("u",), iter(fetches), None)]

    assert taken(fetch(status=503)) == [(1, "fail")] and kept_now.calls == []
    assert taken(fetch(seq=3, stored_hash=OUT), fetch(seq=2)) == [(2, "convert"), (3, "skip")] and kept_now.calls == ["update"]
    assert taken(fetch(seq=4, status=304, raw=None, stored_hash=OUT)) == [(4, "skip")] and kept_now.calls == ["update"]
    assert taken(fetch(seq=5, last_modified="2020-01-01")) == [(5, "expired")] and kept_now.calls == ["update", "clear"]
    assert taken(fetch(seq=6, last_modified="2020-01-01")) == [(6, "expired")] and kept_now.calls == ["update", "clear"]
