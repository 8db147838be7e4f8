"""Personal data: base patterns, and bootstrapped contextual extraction beside them.

Base spans are leftmost and non-overlapping for each kind (email, ip, card,
phone); a match that fails its test (parts of an address over 255, a bad Luhn
sum, a wrong number of digits) is dropped without another try.  They are found
in time linear in the text: every pattern starts only where no earlier start
could have matched.

The bootstrap: base spans are the seed entities, and so are quoted values behind
a secret's name and ``=`` or ``:`` (kind secret, which is no base kind).  What
stands around a mention is generalised (lower case, digits masked, punctuation at
a word's edges dropped) to four lexical patterns: the two words before it; the
second and third word before it, with any word between; the two words behind it;
the words on both sides.  Candidates are what looks like an identifier but
matches no base pattern: numbers in groups, local phone numbers, numbers that
fail the Luhn sum, IPv6 and defanged addresses, ``name (at) host (dot) tld``,
random strings of letters and digits; those of no kind's form are the kind OTHER.
Spark scores the graph of patterns and instances in rounds: a pattern's
reliability for a kind is the mean score of the distinct known instances of the
kind that it meets, where each instance of another kind or form that it meets
counts zero.  Candidates not known yet say nothing, however many they are; only
where they lower the mean less than those of other kinds do, they count zero in
their place.  A candidate's score is ``1 - prod(1 - reliability)`` over its
patterns.  Candidates at or over the threshold are known instances from the next
round on; after the last one, their mentions are added as spans.  A pattern
needs ``support`` distinct known instances, seeds or accepted ones, so one
passage that is copied often induces nothing.

Defined cases: a null text counts as empty and has no spans; offsets are code
points, ends are exclusive; each input row gives one row, repeated rows too, and
equal texts have equal spans; ids are not read, so null ids change nothing; of
candidates that overlap the one that starts first, then the longest, counts; a
text of any length is read whole; an empty table gives an empty result; columns
besides doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

KINDS = ("email", "ip", "card", "phone")
#: Found by the method only, with the base kinds in the order of the result.
SECRET = "secret"
SPAN_KINDS = (*KINDS, SECRET)
#: An identifier of no kind's form: never a span, but evidence against the patterns it stands under.
OTHER = "other"
ROUNDS, SUPPORT, RELIABLE, ACCEPT = 3, 3, 0.8, 0.8
CONTEXT_CHARS = 64

LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++")
GROUPED = re.compile(r"(?<![\w+./-])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,4}(?!\w)")
AT = re.compile(r"\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s(?=[A-Za-z0-9-]{1,63}\s(?:dot|[(\[{<]))", re.IGNORECASE)
SPELT = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s|\.)[A-Za-z0-9-]{1,63}){1,6}", re.IGNORECASE)
IP_FORM = re.compile(r"[0-9]{1,3}(?:\[?[.:]\]?[0-9]{1,3}){3,}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}")
NUMBER_FORM = re.compile(r"[0-9(][0-9 ()./-]*[0-9]")
RANDOM_FORM = re.compile(r"(?=(?:[^0-9]*[0-9]){3})(?=(?:[^A-Za-z]*[A-Za-z]){3})[A-Za-z0-9_+/=-]{16,128}")
# Names of secrets.
NAMED = re.compile(r"(?<![A-Za-z0-9])(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|password|passwd)[\"']?[ \t]{0,3}[:=][ \t]{0,3}([\"'])(?=[^\"'\s]*[0-9])(?=[^\"'\s]*[A-Za-z])([^\"'\s]{12,128})\1", re.IGNORECASE)
EDGES = ".,;:!?\"'()[]{}<>*#$%&|"
LUHN = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def emails(text: str) -> list[tuple[int, int]]:
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL_CHARS))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += LUHN[d] if i % 2 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if DIGIT.search(text):
        if "." in text:
            found["ip"] = [m.span() for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m.groups())]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return found


def kind_of(token: str) -> str | None:
    """The kind that the form of an unrecognised identifier suggests; OTHER for one of no kind's form."""
    digits = len(DIGIT.findall(token))
    if token.count("@") == 1 and token[0] != "@" and token[-1] != "@":
        return "email"
    if digits >= 4 and IP_FORM.fullmatch(token):
        return "ip"
    if digits < 6 and len(token) < 16:
        return None
    if NUMBER_FORM.fullmatch(token):
        return None if digits < 6 else "card" if digits >= 12 else "phone"
    return SECRET if RANDOM_FORM.fullmatch(token) else OTHER if digits >= 6 else None


def general(words: list[str]) -> list[str]:
    return [DIGIT.sub("0", w.strip(EDGES) or w).lower() for w in words]


def patterns(text: str, start: int, end: int) -> list[str]:
    """What stands around a mention, on its line."""
    left = general(text[max(0, start - CONTEXT_CHARS) : start].rsplit("\n", 1)[-1].split()[-3:])
    right = general(text[end : end + CONTEXT_CHARS].split("\n", 1)[0].lstrip(EDGES).split()[:2])
    out = []
    if len(left) >= 2:
        out.append(f"{left[-2]} {left[-1]} _")
    if len(left) >= 3:
        out.append(f"{left[-3]} {left[-2]} * _")
    if len(right) >= 2:
        out.append(f"_ {right[0]} {right[1]}")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


def secrets(text: str) -> list[tuple[int, int]]:
    """Quoted values behind a secret's name."""
    return [m.span(2) for m in NAMED.finditer(text)] if '"' in text or "'" in text else []


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what looks like an identifier, in the order of the text; overlaps are left in."""
    out = []
    if DIGIT.search(text) or "@" in text:
        for m in TOKEN.finditer(text):
            token = m[0].strip(EDGES)
            if 6 <= len(token) <= 128 and (kind := kind_of(token)):
                start = m.start() + m[0].index(token)
                out.append((kind, start, start + len(token)))
        for m in GROUPED.finditer(text):
            n = len(DIGIT.findall(m[0]))
            if 7 <= n <= 19:
                out.append(("phone" if n < 12 else "card", *m.span()))
    for m in AT.finditer(text):
        start = m.start() - len(tail) if (tail := _tail(text, m.start())) else None
        host = SPELT.match(text, m.end()) if start is not None else None
        if host:
            out.append(("email", start, host.end()))
    return sorted(out, key=lambda c: (c[1], -c[2]))


def _tail(text: str, end: int) -> str:
    """The characters of an address's local part in front of a place, 64 at most."""
    piece = text[max(0, end - 64) : end]
    return piece[len(piece.rstrip(LOCAL_CHARS)) :]


def mentions(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple]:
    """(kind, start, end, surface, patterns, is a seed, is a base span) of base spans, named secrets and candidates."""
    seeds = [(k, s, e, True) for k in KINDS for s, e in base[k]]
    taken = sorted((s, e) for _, s, e, _ in seeds)
    bound: list[int] = []  # the furthest end up to each taken span
    for _, e in taken:
        bound.append(max(e, bound[-1] if bound else 0))

    def free(start: int, end: int) -> bool:
        i = bisect_left(taken, (end, -1))  # those that start before the end
        return not i or bound[i - 1] <= start

    named = [(SECRET, s, e, False) for s, e in secrets(text) if free(s, e)]
    out = [(k, s, e, text[s:e].lower(), patterns(text, s, e), True, own) for k, s, e, own in seeds + named]
    done = sorted((s, e) for _, s, e, _ in named)
    at = last = 0
    for kind, s, e in candidates(text):
        while at < len(done) and done[at][1] <= s:
            at += 1
        if s < last or not free(s, e) or (at < len(done) and done[at][0] < e):
            continue
        last = e
        if found := patterns(text, s, e):
            out.append((kind, s, e, text[s:e].lower(), found, False, False))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (SPAN_KINDS.index(x[0]), x[1], x[2])))


MENTION = "array<struct<kind:string,start:long,end:long,surface:string,patterns:array<string>,seed:boolean,base:boolean>>"
SCAN_SCHEMA = f"row long, doc_id long, key string, n_email long, n_ip long, n_card long, n_phone long, base string, mentions {MENTION}"
MENTION_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surface", pa.string()), ("patterns", pa.list_(pa.string())), ("seed", pa.bool_()), ("base", pa.bool_())]))


def text_key(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    for part in common.slices(batches):
        cols: list[list] = [[] for _ in range(8)]
        for t in part.column("text").to_pylist():
            text = t or ""
            base = base_spans(text)
            spans = [(k, s, e) for k in KINDS for s, e in base[k]]
            found = mentions(text, base)
            row += 1
            for c, x in zip(cols, (row, text_key(text) if any(x[0] != OTHER for x in found) else None, *(len(base[k]) for k in KINDS), joined(spans), [dict(zip(("kind", "start", "end", "surface", "patterns", "seed", "base"), x, strict=True)) for x in found]), strict=True):
                c.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], type=pa.int64()), part.column("doc_id").cast(pa.int64()), pa.array(cols[1], type=pa.string()), *(pa.array(c, type=pa.int64()) for c in cols[2:6]), pa.array(cols[6], type=pa.string()), pa.array(cols[7], type=MENTION_TYPE)],
            names=["row", "doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", "mentions"],
        )


def bootstrap(seen: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, reliable: float = RELIABLE, accept: float = ACCEPT) -> DataFrame:
    """(kind, surface, pattern, seed) mentions to the accepted (kind, surface, score)."""
    edges = common.stash(seen.groupBy("kind", "surface", "pattern").agg(F.max("seed").alias("seed")), "pii-edges")
    seeds = edges.where("seed").select("kind", "surface").distinct().withColumn("score", F.lit(1.0))
    own = edges.groupBy("kind", "pattern").agg(F.count("*").alias("own"))
    every = own.groupBy("pattern").agg(F.sum("own").alias("every"))
    edges_of_kinds = edges.where(F.col("kind") != OTHER)
    known = seeds
    for _ in range(rounds):
        scored = edges_of_kinds.join(known, ["kind", "surface"], "left")
        patterns = scored.groupBy("kind", "pattern").agg(F.sum("score").alias("total"), F.count("score").alias("known"), F.count_if("seed").alias("seeds"), F.count("*").alias("n"))
        patterns = patterns.where((F.col("known") >= support) & (F.col("n") > F.col("seeds"))).join(every, "pattern")
        # against it: instances of other kinds and forms; the unknown ones of its own kind instead where they are fewer
        against = F.least(F.col("every") - F.col("n"), F.col("n") - F.col("known"))
        # rounded, so that the order of a sum decides nothing at a threshold
        patterns = patterns.select("kind", "pattern", F.round(F.col("total") / (F.col("known") + against), 9).alias("reliability")).where(F.col("reliability") >= reliable)
        # a pattern below certainty adds log(1 - r); a certain one is kept off the logarithm's pole
        scores = edges_of_kinds.where(~F.col("seed")).join(patterns, ["kind", "pattern"]).groupBy("kind", "surface").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.least("reliability", F.lit(1 - 1e-9))))), 9).alias("score"))
        learned = scores.where(F.col("score") >= accept)
        known = common.stash(known.unionByName(learned).groupBy("kind", "surface").agg(F.max("score").alias("score")), "pii-known")
    return known.join(edges.where("seed").select("kind", "surface").distinct(), ["kind", "surface"], "left_anti")


def detect(docs: DataFrame, **limits: float) -> DataFrame:
    """One row a document: doc_id, key (of the text, null if nothing was found), counts of base spans, base and all spans as strings and the number of added spans."""
    common.prepare(docs.sparkSession)
    scan = common.stash(common.pick(docs, "doc_id", "text").mapInArrow(_scan, SCAN_SCHEMA), "pii-scan")
    every = scan.where(F.size("mentions") > 0).select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    found = bootstrap(every.select("kind", "surface", F.explode("patterns").alias("pattern"), "seed"), **limits)
    added = every.where("not seed").join(found.select("kind", "surface"), ["kind", "surface"], "left_semi")
    added = added.select("row", "kind", "start", "end").unionByName(every.where("seed and not base").select("row", "kind", "start", "end"))
    added = added.groupBy("row").agg(F.collect_list(F.concat_ws(":", "kind", "start", "end")).alias("added"))
    whole = scan.drop("mentions").join(added, "row", "left")
    # sorted by kind as listed, then start: the base spans are in that order already
    order = F.create_map(*[F.lit(x) for p in zip(SPAN_KINDS, range(len(SPAN_KINDS)), strict=True) for x in p])
    ranked = F.array_sort(F.transform(F.concat(F.filter(F.split("base", ","), lambda x: x != ""), F.col("added")), lambda x: F.struct(order[F.split(x, ":")[0]].alias("k"), F.split(x, ":")[1].cast("long").alias("s"), x.alias("x"))))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_join(F.transform(ranked, lambda r: r["x"]), ","))
    return whole.select("doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))


def report(docs: DataFrame) -> DataFrame:
    """As detect, with the SHA-256 of the base spans."""
    return detect(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", F.when(F.col("n_added") < 0, 0).otherwise(F.col("n_added")).alias("n_added"))


def masked(text: str, spans: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in angle brackets."""
    cuts = sorted((int(s), -int(e), k) for k, s, e in (x.split(":") for x in spans.split(",")))
    out, at = [], 0
    for s, e, k in cuts:
        if s >= at:
            out += [text[at:s], f"<{k.upper()}>"]
        at = max(at, -e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and n_chars set anew where it is there; texts without any stay as they are."""
    found = detect(docs).where("spans <> ''").select("key", "spans").dropDuplicates(["key"])
    rows, names, at = common.positional(docs)
    text, n_chars = at["text"], at.get("n_chars")
    key = F.md5(F.coalesce(names[text], F.lit("")).cast("binary"))
    joined = rows.join(found, key == F.col("key"), "left").select(*names, "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arrays, spans = list(b.columns[:-1]), b.column(b.num_columns - 1).to_pylist()
            if any(spans):
                new = [masked(t, s) if s else t for t, s in zip(arrays[text].to_pylist(), spans, strict=True)]
                arrays[text] = pa.array(new, type=arrays[text].type)
                if n_chars is not None:
                    old = arrays[n_chars]
                    arrays[n_chars] = pa.array([len(t) if s else n for t, s, n in zip(new, spans, old.to_pylist(), strict=True)], type=old.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(apply, rows.schema).toDF(*docs.columns)
