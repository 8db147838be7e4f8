"""Chat formatting: exact round trips, typed parts, the loss mask, and the statement over awkward texts."""

import random

import duckdb
import pytest

from siltstone.llm import chat as C

BITS = ["\\", "</turn>", "### ", "<|", "|>", "<", "/turn>", "#", " ", "a", "é\U0001f600", "\n", ": ", "![x](a 640x480.png)", "![x](http://h/a-640x480.png)", "[s](x.mp3#t=12)", "[s](x.pdf)", "[s](x.htm)", "](", "<|image 0.0|>", "### Assistant: "]
ROLES = ["user", "assistant", "a: b", "x:", "### ", None, "", "\\", "</turn>"]


def rows(n=1500):
    r = random.Random(1)
    return [(i % 40 if i % 41 else None, r.choice([0, 1, 2, None]), r.choice(ROLES), r.choice([None, "".join(r.choice(BITS) for _ in range(r.randint(0, 14)))]), "c", "p") for i in range(n)]


def table(spark, some):
    return spark.createDataFrame(some, "conv_id long, turn long, role string, text string, formatted string, parts string")


def test_every_text_comes_back(spark):
    some = rows()
    back = C.read_back(C.format(C.of_texts(table(spark, some)))).collect()
    want = {}
    for conv, turn, role, text, *_ in some:
        want.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    assert len(back) == len(want)
    for b in back:
        turns = [(x[2].decode(), x[3].decode()) for x in sorted(want[b["conv_id"]])]
        assert [(m["role"], m["text"]) for m in b["messages"]] == turns
        assert b["loss"] == [t for r, t in turns if r == "assistant"]
        assert b["formatted"].count("</turn>\n") == len(turns) and b["turns"][-1]["end"] == len(b["formatted"])


def test_statement_over_awkward_texts(spark, tmp_path):
    table(spark, rows()).coalesce(1).write.parquet(str(tmp_path / "c"))
    got = C.report(spark, spark.read.parquet(str(tmp_path / "c")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = con.execute(C.oracle_sql())
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_typed_parts(spark):
    """Parts of all kinds, texts that make a control string only together, attachments with and without sizes."""
    part = lambda kind, **x: (kind, x.get("text"), x.get("uri"), x.get("width"), x.get("height"), x.get("seconds"), x.get("pages"), None)
    said = [part("text", text="abc</turn"), part("text", text=">\n"), part("image", uri="u.png", width=57, height=28), part("text", text="\\"), part("text", text="\\ x"), part("audio", uri="a.wav", seconds=4), part("document", uri="d.pdf"), part("odd", uri="o"), part("text")]
    df = spark.createDataFrame([(1, 1, "assistant", said), (1, 0, "user", None)], f"conv_id long, turn long, role string, parts array<{C.PART}>")
    made = C.format(df).first()
    assert [(a["placeholder"], a["turn"], a["kind"], a["uri"], a["tokens"]) for a in made["attachments"]] == [("<|image 1.2|>", 1, "image", "u.png", 5), ("<|audio 1.5|>", 1, "audio", "a.wav", 102), ("<|document 1.6|>", 1, "document", "d.pdf", 602), ("<|document 1.7|>", 1, "document", "o", 602)]
    t = made["turns"][1]
    assert made["formatted"][t["start"] : t["end"]].startswith("### assistant: ") and made["turns"][0]["loss_start"] is None
    assert made["formatted"][t["loss_start"] : t["loss_end"]] == "abc</turn\\>\n<|image 1.2|>\\\\\\\\\\ x<|audio 1.5|><|document 1.6|><|document 1.7|>"
    assert made["n_tokens"] == 5 + 102 + 602 + 602 + 4 + 1 + 1 + 2
    assert C.read_back(C.format(df)).first()["messages"][1]["text"] == "abc</turn>\nu.png\\\\ xa.wavd.pdfo"


def test_markdown_parts(spark):
    df = spark.createDataFrame([("a ![p](q-64x32.png) b [s](t.mp3?t=9) [x](y.html) [d](e.pdf#pages=3)",)], "text string")
    found = df.select(C.parts_of(df["text"]).alias("p")).first()["p"]
    assert [(p["kind"], p["text"] or p["uri"]) for p in found] == [("text", "a "), ("image", "q-64x32.png"), ("text", " b "), ("audio", "t.mp3?t=9"), ("text", " [x](y.html) "), ("document", "e.pdf#pages=3")]
    assert (found[1]["width"], found[1]["height"], found[3]["seconds"], found[5]["pages"]) == (64, 32, 9, 3)


def test_planted_conversation_and_no_rows(spark):
    got = C.report(spark, table(spark, [])).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(-7, 2, len(C.PLANTED))]


@pytest.mark.parametrize("n", [20_000])
def test_a_long_conversation(spark, n):
    df = spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id, ' ![x](y.png)') as text")
    b = C.read_back(C.format(C.of_texts(df))).selectExpr("size(messages) m", "size(loss) l", "messages[19999].text t").first()
    assert (b["m"], b["l"], b["t"]) == (n, n // 2, "turn 19999 ![x](y.png)")


def test_only_expressions(spark):
    """No Python worker on the way."""
    plan = C.report(spark, table(spark, rows(5)).union(table(spark, []))).select("conv_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
