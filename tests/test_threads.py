import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import fixed, text
from siltstone.operators import threads


def plain_root(ident, parents):
    """Climb to parents that exist, until one was visited; the start is not visited."""
    seen, at = set(), ident
    while (p := parents.get(at)) and p not in seen and p in parents:
        seen.add(p)
        at = p
    return at


VECTORS = {"a": None, "b": "a", "c": "b", "d": "missing", "p": "q", "q": "p", "t": "p", "s": "s"}


def test_roots_of_chains_and_cycles(spark):
    got = {r["id"]: r["root"] for r in threads.roots(spark.createDataFrame(list(VECTORS.items()), "id string, parent string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "p": "p", "q": "q", "t": plain_root("t", VECTORS), "s": "s"}


@pytest.mark.parametrize("seed", range(3))
def test_roots_equal_a_plain_climb(spark, seed):
    import random

    r = random.Random(seed)
    parents = {f"m{i}": r.choice([None, f"m{r.randint(0, 45)}", f"m{max(0, i - 1)}"]) for i in range(40)}
    got = {x["id"]: x["root"] for x in threads.roots(spark.createDataFrame(list(parents.items()), "id string, parent string")).collect()}
    assert got == {i: plain_root(i, parents) for i in parents}


def test_roots_of_nothing_nulls_and_repeats(spark):
    schema = "id string, parent string, ordinal long"
    assert threads.roots(spark.createDataFrame([], schema)).count() == 0
    got = threads.roots(spark.createDataFrame([("a", None, 0), ("b", None, 1), ("b", "a", 2), (None, "a", 3)], schema)).collect()
    assert {r["id"]: r["root"] for r in got} == {"a": "a", "b": "a"} and len(got) == 2


def test_a_deep_chain(spark):
    rows = [(f"m{i}", f"m{i - 1}" if i else None) for i in range(300)]
    assert {r["root"] for r in threads.roots(spark.createDataFrame(rows, "id string, parent string")).collect()} == {"m0"}


def messages(spark, rows):
    base = spark.createDataFrame(rows, "id string, root string, sender string, subject string, body string, date_iso string, byte_offset long, ordinal long, source_file string")
    b = F.col("body")
    return base.select("*", b.alias("body_no_diff"), F.lit("").alias("archive_url"), text.file_references(b).alias("files"), text.commits(b).alias("commits"), text.categories(F.concat_ws("\n", "subject", b)).alias("categories"), text.signals(b).alias("signals"))


ROWS = [
    ("1", "r", "a@x", "[PATCH v2] fix malloc", "It is broken. See package/x/y.c and deadbeef1 there. NAK", "2024-01-02T00:00:00", 5, 0, "f1"),
    ("2", "r", "b@x", "Re: [PATCH v2] fix malloc", "You should use calloc instead. foo.c:1:2: error: no", "2024-01-01T00:00:00", 9, 1, "f2"),
    ("3", "r", "", "Re: x", "NACK from me", None, 1, 2, "f1"),
    ("4", "s", "c@x", "bump to 1.2", "nothing here", None, 1, 3, "f1"),
]


def test_rollup_and_score(spark):
    got = {r["thread_id"]: r for r in threads.rollup(messages(spark, ROWS)).collect()}
    r, s = got["r"], got["s"]
    assert (r["message_count"], r["author_count"], r["source_files"]) == (3, 2, 2)
    assert r["subject"] == "Re: [PATCH v2] fix malloc" and r["first_date"] == "2024-01-01T00:00:00" and r["last_date"] is None
    assert r["files"] == ["package/x/y.c"] and r["commits"] == ["deadbeef1"]
    assert [x["message_id"] for x in r["source_refs"]] == ["2", "1", "3"]
    # problem 30, correction 30, authors 15, references 10, messages 10, revision 5, NACK 5, compiler error 25: over 100
    assert r["score_cents"] == 100 and r["score"] == 1.0
    assert s["score_cents"] == 0  # -20 for a lone bump


def test_every_term_of_the_score(spark):
    for k, v in fixed.SCORE.items():
        flags = {n: F.lit(n == k) for n in fixed.SCORE}
        assert spark.range(1).select(threads.score(flags).alias("s")).first()["s"] == max(0, v)


def test_lessons(spark):
    m = messages(spark, ROWS)
    kept = threads.passing(threads.rollup(m))
    (x,) = threads.lessons(m, kept).collect()
    # the first problem is in the earliest message; no message of another author has a correction
    assert x["lesson_id"] == "lesson-0001" and x["title"] == "fix malloc: recurring problem pattern" and x["fix"] is None
    assert x["problem"]["from"] == "b@x" and x["problem"]["message_id"] == "2" and x["completeness"]["level"] == "searchable"
    signals = {r["signal"]: r["rank"] for r in threads.common_signals(threads.lessons(m, kept)).collect()}
    assert max(signals.values()) <= 12 and "memory-management" in signals


def test_numbers_follow_score_then_subject(spark):
    rows = [("t1", "beta", 50), ("t2", "Alpha", 50), ("t3", "gamma", 90), ("t4", "alpha", 50)]
    got = threads.numbered(spark.createDataFrame(rows, "thread_id string, subject string, score_cents int")).collect()
    assert {r["thread_id"]: r["lesson_id"] for r in got} == {"t3": "lesson-0001", "t2": "lesson-0002", "t4": "lesson-0003", "t1": "lesson-0004"}


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()["x"]


def test_needed_words_are_in_every_match():
    for p in (*fixed.KEYWORDS, *fixed.CATEGORIES.values(), fixed.PROBLEM, fixed.CORRECTION, fixed.BOT_SENDER):
        assert len(text.needed(p)) == len(text.alternatives(p))
    assert text.alternatives(r"a|b(?:c|d)|[|]e|f\|g") == ["a", "b(?:c|d)", "[|]e", r"f\|g"]
    assert text.needed(r"\[VOTE\]|\b(?:CI|x)\b") is None and text.needed(r"https?://x") == ["http"] and text.needed(r"ab(?:cd)?ef*") == ["ab"]


def test_a_plain_search_first_changes_nothing(spark):
    rows = [("It \u017fhould be \u0131n\u0131t.d, a MEMORY\u00a0LEAK",), ("DON'T use-after-free",), ("see https://github.com/x and HTTP://bugs.x",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    for p in (*fixed.KEYWORDS, *fixed.CATEGORIES.values(), fixed.PROBLEM, fixed.CORRECTION, fixed.QUOTED_CORRECTION):
        for r in df.select(text.matches(F.col("t"), p).alias("a"), F.col("t").rlike(text.BLIND + p).alias("b")).collect():
            assert r["a"] == r["b"], p


def test_flags_and_extractors(spark):
    c = F.col("t")
    assert one(spark, text.keywords(c), t="Error: the BUG, a mutex") == sorted(["error:", "bug", "mutex"])
    assert one(spark, text.categories(c), t="nothing") == ["uncategorized"]
    assert one(spark, text.categories(c), t="ubus over a socket and malloc")[:1] == ["memory-management"]
    assert one(spark, text.commits(c), t="1234567 DEADBEEF xyz 123456 abcdef012345 abcdef0123456") == ["1234567", "abcdef012345", "deadbeef"]
    assert one(spark, text.sentences(c), t="One two. Three\n\nfour! Five? six") == ["One two.", "Three.\nfour!", "Five? six"]
    assert one(spark, text.sentences(c), t="  ") == []
    assert one(spark, text.body_hash(c), t="é") == "4a99557e4033"
    assert one(spark, text.message_ids(c), t="<a@b> <c@d>") == ["<a@b>", "<c@d>"] and one(spark, text.message_ids(c), t=" plain ") == ["plain"] and one(spark, text.message_ids(c), t=None) == []
    assert one(spark, text.email(c), t=" <joe at example.org> ") == "joe@example.org"
    assert one(spark, text.part_filename(F.lit(1)), t="") == "bundled-reference.part-01.md"
    assert one(spark, text.file_references(c), t='see package/a/b.mk, and "luci/x.js" or other/y.c') == ["package/a/b.mk", "luci/x.js"]


@pytest.mark.parametrize(
    "sender,subject,body,reply,want",
    [
        ("noreply@github.com", "x", "long enough body with an error: in it", None, "dropped"),
        ("noreply at github.com", "x", "y", None, "dropped"),
        ("a@b", "[VOTE] new", "y", "<p>", "sidelined"),
        ("a@b", "CI result", "y", None, "sidelined"),
        ("a@b", "CIrcle", "short", None, "dropped"),
        ("a@b", "hi", "short", "<p>", "primary"),
        ("a@b", "some subject here", "no words of interest in it at all, none", None, "dropped"),
        ("a@b", "some subject here", "no words of interest in it at all, none of them", None, "primary"),
        ("a@b", "some subject here now", "a bug", None, "primary"),
    ],
)
def test_disposition(spark, sender, subject, body, reply, want):
    got = one(spark, text.disposition(F.col("s"), F.col("j"), F.col("b"), text.keywords(F.concat_ws("\n", "j", "b")), F.col("r")), s=sender, j=subject, b=body, r=reply)
    assert got == want


def test_descriptions_and_provenance(spark):
    a, b, c, d = (F.col(x) for x in "abcd")
    pick = text.short_description(a, b, c, d)
    assert one(spark, pick, a="Routing.", b="Summary.", c="Author.", d="Body.") == "Routing."
    assert one(spark, pick, a=" ", b="Summary.", c="Author.", d="Body.") == "Summary."
    assert one(spark, pick, a=None, b="", c="Author.", d="Body.") == "Author."
    assert one(spark, pick, a=None, b=None, c=None, d="# Head\n\nThis is the sentence. And more.") == "This is the sentence."
    block = text.provenance_block(a, b, c, d)
    got = one(spark, block, a="wiki_page", b="https://example.org/x", c=None, d="2026-03-22T12:00:00")
    assert got.split("\n") == ["> **Source:** https://example.org/x", "> **Kind:** wiki_page", "> **Method:** scraped from the wiki", "> **Normalized:** 2026-03-22"]
    assert "Source" not in one(spark, block, a="authored", b=None, c=None, d="2026-03-22") and "**Commit:** abc1234" in one(spark, block, a="js_source", b="u", c="abc1234", d="2026-03-22")
    url = text.source_url(a, b, c)
    assert one(spark, url, a="https://h/r/", b="abc", c="/x/y.c") == "https://h/r/blob/abc/x/y.c" and one(spark, url, a="h", b=None, c="x") is None


def test_payload_checks(spark):
    ok = text.payload_ok(F.col("s"), F.col("w"), F.split("t", ","))
    good = dict(s="A summary that is long enough.", w="Use it.", t="a, b")
    assert one(spark, ok, **good)
    for bad in (dict(s="short"), dict(s=None), dict(w=" "), dict(s="A summary <SCRIPT src=x> that is long"), dict(w="javascript:x"), dict(t=" , "), dict(t=None), dict(w="a\x01b")):
        assert not one(spark, ok, **{**good, **bad})


def test_hints(spark):
    got = one(spark, text.search_hints(F.split("c", ","), F.split("f", ",")), c="networking,unknown,networking", f=",".join(f"a/b{i}.c" for i in range(7)))
    assert got[0] == fixed.SEARCH_HINTS["networking"][0] and got[1:] == [f'grep -R "b{i}.c" .' for i in range(5)]
    assert not re.search("b5", " ".join(got))
