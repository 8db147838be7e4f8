"""Column functions over texts: hashes, flags, categories, extractors, sentences and tokens.

Patterns written for Unicode-aware, case-blind matching get the flags (?iuU) in
Java: without them ``\\w``, ``\\b`` and case folding are ASCII only.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from siltstone.functions import fixed

BLIND = "(?iuU)"


def body_hash(text: Column, width: int = 12) -> Column:
    """The first hex digits of the SHA-256 of the text as UTF-8: 12 for a record's body, 8 for a raw document."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, width)


def alternatives(pattern: str) -> list[str]:
    """The pattern's parts between bars that stand outside brackets."""
    out, depth, at, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[at:i])
            at = i + 1
        i += 1
    return [*out, pattern[at:]]


def needed(pattern: str) -> list[str] | None:
    """Lower-case words of which every match holds one at least, or None if the pattern has none: of each alternative the longest plain run outside groups."""
    out = []
    for part in alternatives(pattern):
        bare = re.sub(r"\\.|\[[^\]]+\][*+?]?", " ", part)
        while (shorter := re.sub(r"\([^()]*\)[*+?]?", " ", bare)) != bare:
            bare = shorter
        bare = re.sub(r".[*?]|.\{\d+,?\d*\}", " ", bare)  # what may be missing
        runs = re.findall(r"[A-Za-z0-9_:/'-]+", bare)
        if not runs:
            return None
        out.append(max(runs, key=len).lower())
    return out


def folded(text: Column) -> Column:
    """Lower case, with the two letters that match s and i without being their capitals."""
    return F.replace(F.replace(F.lower(text), F.lit("\u017f"), F.lit("s")), F.lit("\u0131"), F.lit("i"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def literal(part: str) -> str | None:
    """The lower-case word that an alternative is found by exactly: plain characters, with an optional group behind them; else None."""
    plain = re.sub(r"\(\?:[^()]*\)\?$", "", part)
    bare = re.sub(r"\\(\W)", "", plain)
    return re.sub(r"\\(\W)", r"\1", plain).lower() if plain and not re.search(r"[\\.^$*+?{}\[\]|()]", bare) else None


class Flags:
    """Many patterns at once: one automaton finds all words that decide or admit them, and only admitted ones are searched for.

    An alternative that is a word is decided by it; for another, the words of which
    every match holds one are looked up, and the pattern runs on the texts that
    have one.  So a text is read once, whatever the number of patterns.
    """

    def __init__(self, patterns: dict[str, str]):
        import ahocorasick

        self.names = list(patterns)
        words: dict[str, list[int]] = {}  # of each word the patterns that it decides and those that it admits, as bits
        self.rest: list[tuple[int, re.Pattern]] = []
        self.always = 0
        for bit, pattern in enumerate(patterns.values()):
            parts = alternatives(pattern)
            rest = "|".join(p for p in parts if literal(p) is None)
            for w in (x for p in parts if (x := literal(p)) is not None):
                words.setdefault(w, [0, 0])[0] |= 1 << bit
            if rest:
                self.rest.append((1 << bit, re.compile(rest, re.IGNORECASE)))
                admit = needed(rest)
                for w in admit or ():
                    words.setdefault(w, [0, 0])[1] |= 1 << bit
                self.always |= 0 if admit else 1 << bit
        self.words = sorted(words)
        self.automaton = ahocorasick.Automaton()
        for w, bits in words.items():
            self.automaton.add_word(w, tuple(bits))
        self.automaton.make_automaton()

    def found(self, text: str) -> list[int]:
        """The places of the patterns that a text has."""
        decided, admitted = 0, self.always
        for d, a in {bits for _, bits in self.automaton.iter(text.lower().replace("\u017f", "s").replace("\u0131", "i"))}:
            decided |= d
            admitted |= a
        for bit, pattern in self.rest:
            if admitted & bit and not decided & bit and pattern.search(text):
                decided |= bit
        return [i for i in range(len(self.names)) if decided >> i & 1]


@functools.cache
def flags_of(kind: str) -> Flags:
    if kind == "keywords":
        return Flags({p: p for p in fixed.KEYWORDS})
    return Flags(fixed.CATEGORIES if kind == "categories" else {k: p for k, p in fixed.SIGNALS.items() if k != "has_code_block"})


def _flags(kind: str) -> Callable[[Column], Column]:
    """A column function: the names of the patterns of a kind that a text has, in declared order; null for a null text."""

    @pandas_udf(T.ArrayType(T.StringType()))
    def found(texts: pd.Series) -> pd.Series:
        flags = flags_of(kind)
        return pd.Series([None if t is None else [flags.names[i] for i in flags.found(t)] for t in texts], dtype=object)

    return found


def matches(text: Column, pattern: str) -> Column:
    """Whether the pattern is found, without regard to case. A plain search for words that every match holds spares most texts the pattern."""
    words = needed(pattern)
    if words is None:
        return text.rlike(BLIND + pattern)

    def look(low: Column) -> Column:
        hint = low.contains(words[0])
        for w in words[1:]:
            hint = hint | low.contains(w)
        return hint & text.rlike(BLIND + pattern)

    return bound(folded(text), look)


def keywords(text: Column) -> Column:
    """The keyword patterns that the text has, sorted."""
    return F.coalesce(F.array_sort(_flags("keywords")(text)), F.array().cast("array<string>"))


def categories(text: Column) -> Column:
    """The categories that fit, in declared order; ``uncategorized`` alone if none does."""
    return bound(_flags("categories")(text), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit("uncategorized"))))


def primary_category(found: Column) -> Column:
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("uncategorized"))


def signals(text: Column) -> Column:
    """A struct of the structural flags. The code-block pattern is the only one that minds case."""
    block = text.rlike("(?U)" + fixed.SIGNALS["has_code_block"])
    return bound(_flags("signals")(text), lambda found: F.struct(*[(block if k == "has_code_block" else F.array_contains(found, k)).alias(k) for k in fixed.SIGNALS]))


def segments(pattern: str) -> list[list[str]]:
    """The alternatives in which a line end can stand, cut at their white space.

    Other alternatives can't match over a line end.  White space that is not
    ``\\s+`` outside groups, or a class that a line end is in, is an error.
    """
    out = []
    for part in alternatives(pattern):
        cut = part.split(r"\s+")
        if any(re.search(r"\\[sWDS]|\[\^|\(\?s|\n", x) for x in cut):
            raise ValueError(f"a line end can stand in {part!r} in a way that is not known")
        out += [cut] if len(cut) > 1 else []
    return out


def border(body: Column, pattern: str) -> Column:
    """What a text does to a match that runs through it, when texts are joined by line ends: a map of states.

    A state is how many segments of an alternative stand at the end of what was
    read, with nothing but white space behind them.  For each alternative: ``through``
    (from state i to j, by a text that is just these segments), ``ends`` (from i to
    the whole match), ``opens`` (the states that the text makes by itself).
    """
    joined = lambda some: r"\s+".join(some)
    test = lambda p: F.coalesce(matches(body, p), F.lit(False))
    maps = []
    for cut in segments(pattern):
        k = len(cut)
        through = F.array(*[F.array(*[F.lit(False) if not 0 < i < j < k else test(rf"\A\s*{joined(cut[i:j])}\s*\z") for j in range(k)]) for i in range(k)])
        ends = F.array(*[F.lit(False) if not i else test(rf"\A\s*{joined(cut[i:])}") for i in range(k)])
        opens = F.array(*[F.lit(False) if not j else test(rf"{joined(cut[:j])}\s*\z") for j in range(k)])
        maps.append(F.struct(through.alias("through"), ends.alias("ends"), opens.alias("opens")))
    blank = F.coalesce(~body.rlike(r"(?U)\S"), F.lit(True))
    none = F.array().cast("array<struct<through:array<array<boolean>>,ends:array<boolean>,opens:array<boolean>>>")
    return F.struct(blank.alias("blank"), (F.array(*maps) if maps else none).alias("maps"))


def crosses(borders: Column, pattern: str) -> Column:
    """Whether a match runs over line ends between texts, from the ordered array of their borders: the maps are composed from left to right."""
    sizes = [len(cut) for cut in segments(pattern)]
    if not sizes:
        return F.lit(False)
    start = F.struct(F.array(*[F.array(*[F.lit(False)] * k) for k in sizes]).alias("open"), F.lit(False).alias("hit"))

    def step(state: Column, b: Column) -> Column:
        hit, opened = state["hit"], []
        for a, k in enumerate(sizes):
            at, m = state["open"][a], b["maps"][a]
            for i in range(1, k):
                hit = hit | (at[i] & m["ends"][i])
            into = lambda j, at=at, m=m: functools.reduce(lambda x, i: x | (at[i] & m["through"][i][j]), range(1, j), m["opens"][j] | (b["blank"] & at[j]))
            opened.append(F.array(F.lit(False), *[into(j) for j in range(1, k)]))
        return F.struct(F.array(*opened).alias("open"), hit.alias("hit"))

    return F.aggregate(borders, start, step, lambda s: s["hit"])


def letters(text: Column) -> Column:
    """Number of ASCII letters."""
    return F.length(F.regexp_replace(text, "[^A-Za-z]", ""))


def disposition(sender: Column, subject: Column, body: Column, found: Column, in_reply_to: Column) -> Column:
    """What becomes of a message: dropped, sidelined or primary; the first rule that fits decides."""
    reply = F.coalesce(in_reply_to, F.lit("")) != ""
    few = letters(F.concat_ws(" ", subject, body)) < 20
    empty = (F.size(found) == 0) & (F.length(body) < 40)
    return (
        F.when(matches(sender, fixed.BOT_SENDER), "dropped")
        .when(matches(subject, fixed.VOTE_SUBJECT), "sidelined")
        .when(~reply & (few | empty), "dropped")
        .otherwise("primary")
    )


def sentences(text: Column) -> Column:
    """Blank lines end a sentence; so does ``. ! ?`` before white space and a capital or digit."""
    joined = F.regexp_replace(F.replace(text, F.lit("\r"), F.lit("")), "\n{2,}", ".\n")
    parts = F.transform(F.split(joined, r"(?U)(?<=[.!?])\s+(?=[A-Z0-9])"), strip)
    return F.filter(parts, lambda x: x != "")


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode's too."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def file_references(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(BLIND + fixed.FILE_REFERENCE), F.lit(0))


def commits(text: Column) -> Column:
    """Words that look like abbreviated commit ids, pure digits too; sorted, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(BLIND + fixed.COMMIT), F.lit(0))))


def words(text: Column) -> Column:
    """White-space separated tokens."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def report_tokens(text: Column) -> Column:
    """Tokens of a report: a letter and two or more of ``A-Za-z0-9_.:-``, lower-cased, without stop words; repeats stay."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[A-Za-z][A-Za-z0-9_.:-]{2,}"), F.lit(0))
    return F.filter(found, lambda x: ~x.isin(*fixed.STOP_WORDS))


def topics(values: Column) -> Column:
    """Stripped topics without the empty ones; null counts as none."""
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")


def payload_ok(summary: Column, when_to_use: Column, related: Column) -> Column:
    """Whether a generated payload may be used: both texts there, the summary of 20 characters or more, nothing unsafe, a topic."""
    a, b = F.trim(F.coalesce(summary, F.lit(""))), F.trim(F.coalesce(when_to_use, F.lit("")))
    return (F.length(a) >= 20) & (b != "") & ~a.rlike(fixed.UNSAFE_PAYLOAD) & ~b.rlike(fixed.UNSAFE_PAYLOAD) & (F.size(topics(related)) > 0)


def email(value: Column) -> Column:
    """An address with `` at `` undone and without angle brackets."""
    return F.btrim(F.replace(strip(value), F.lit(" at "), F.lit("@")), F.lit("<>"))


def message_ids(value: Column) -> Column:
    """All ``<...>`` of a header, else the whole without white space around it; a missing or empty header has none."""
    found = F.regexp_extract_all(value, F.lit("<[^>]+>"), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(value, F.lit("")) == "", none).when(F.size(found) > 0, found).otherwise(F.array(strip(value)))


def sort_date(date_iso: Column) -> Column:
    """ISO text compared as text; a missing date comes last."""
    return F.coalesce(F.when(date_iso != "", date_iso), F.lit(fixed.NO_DATE))


def short_description(routing: Column, summary: Column, description: Column, body: Column | None = None) -> Column:
    """The first non-empty of routing summary, summary and description; else the first sentence of the body."""
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    options = [some(routing), some(summary), some(description)]
    if body is not None:
        prose = F.filter(F.split(body, "\n"), lambda x: ~x.rlike(r"^\s*(#|$)"))
        options.append(F.try_element_at(sentences(F.array_join(prose, " ")), F.lit(1)))
    return F.coalesce(*options)


# How each kind of origin came to be, as a provenance block words it.
METHODS = {"authored": "hand-authored", "wiki_page": "scraped from the wiki"}
GIT_ORIGINS = ("c_source", "example_app", "header_api", "hotplug_event", "js_source", "makefile_meta", "readme", "uci_schema")


def provenance_block(origin: Column, url: Column, commit: Column, timestamp: Column) -> Column:
    """A quoted block: Source only with a url, Kind, Method, Commit only if there is one, the date of normalisation."""
    methods = F.create_map(*[F.lit(x) for p in METHODS.items() for x in p])
    line = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"> **{name}:** "), value))
    method = F.coalesce(F.try_element_at(methods, origin), F.lit("extracted from source"))
    return F.concat_ws("\n", line("Source", url), line("Kind", origin), line("Method", method), line("Commit", commit), line("Normalized", F.substring(timestamp, 1, 10)))


def source_url(base: Column, commit: Column, path: Column) -> Column:
    """``base/blob/commit/path``, without a slash in front of the path; null if any part is missing."""
    clean = F.ltrim(path, F.lit("/"))
    return F.when((F.coalesce(commit, F.lit("")) != "") & (F.coalesce(clean, F.lit("")) != ""), F.concat(F.rtrim(base, F.lit("/")), F.lit("/blob/"), commit, F.lit("/"), clean))


def is_commit(value: Column) -> Column:
    return F.coalesce(F.trim(value).rlike("^[0-9a-fA-F]{7,40}$"), F.lit(False))


def part_filename(number: Column) -> Column:
    return F.format_string("bundled-reference.part-%02d.md", number)


def search_hints(found: Column, files: Column) -> Column:
    """Hints of the categories in their order, then one for each of the first five files; each once."""
    known = F.create_map(*[x for k, v in fixed.SEARCH_HINTS.items() for x in (F.lit(k), F.array(*[F.lit(h) for h in v]))])
    none = F.array().cast("array<string>")
    by_category = F.flatten(F.transform(found, lambda c: F.coalesce(F.try_element_at(known, c), none)))
    by_file = F.transform(F.slice(files, 1, 5), lambda f: F.concat(F.lit('grep -R "'), F.element_at(F.split(f, "/"), -1), F.lit('" .')))
    return F.array_distinct(F.concat(by_category, by_file))


def lesson_title(subject: Column, thread_id: Column, has_problem: Column, has_fix: Column) -> Column:
    """The subject without its reply and bracket prefixes; a suffix says what the thread has. An empty subject gives way to the id, but not where there is a problem."""
    bare = strip(F.regexp_replace(subject, r"^(?:Re:\s*)*(?:\[[^\]]+\]\s*)+", ""))
    return (
        F.when(has_problem & has_fix, F.concat(bare, F.lit(": mistake and correction")))
        .when(has_problem, F.concat(bare, F.lit(": recurring problem pattern")))
        .otherwise(F.coalesce(F.when(bare != "", bare), thread_id, F.lit("untitled thread")))
    )
