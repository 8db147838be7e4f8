"""Markdown and wiki clean-up: frontmatter, fences, imports, tables, footnotes.

What a line's meaning depends on the lines before it, or needs an HTML parser, is
an Arrow-batched function over whole texts; the rest are column expressions.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

try:
    import yaml
except ImportError:  # then plain keys, scalars and lists are read
    yaml = None

FRONTMATTER = r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n?(.*)"


def has_frontmatter(content: Column) -> Column:
    return content.rlike(FRONTMATTER)


def frontmatter(content: Column) -> Column:
    """The stripped header text, null without one."""
    return F.when(has_frontmatter(content), F.trim(F.regexp_extract(content, FRONTMATTER, 1)))


def body(content: Column) -> Column:
    """What follows the header, null without one."""
    return F.when(has_frontmatter(content), F.regexp_extract(content, FRONTMATTER, 2))


def plain_yaml(source: str) -> dict:
    """Keys with scalars, inline lists or dashed lists; a line of any other shape is an error."""
    out: dict = {}
    last = None
    for line in source.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if (m := re.match(r"\s*-\s+(.*)", line)) and last is not None:
            if not isinstance(out[last], list):
                out[last] = []
            out[last].append(_scalar(m[1]))
        elif m := re.match(r"([A-Za-z_][\w-]*):(?:\s+(.*))?$", line):
            last, value = m[1], (m[2] or "").strip()
            out[last] = [_scalar(x) for x in value[1:-1].split(",") if x.strip()] if value[:1] == "[" and value[-1:] == "]" else _scalar(value)
        else:
            raise ValueError(f"not understood: {line!r}")
    return out


def _scalar(value: str):
    value = value.strip()
    if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
        return value[1:-1]
    if value in ("", "null", "~"):
        return None
    return int(value) if re.fullmatch(r"-?\d+", value) else value


def safe_yaml(source: str):
    """As yaml.safe_load, by the library's parser in C if it is there; what that refuses the other one reads or names the fault of."""
    if hasattr(yaml, "CSafeLoader"):
        try:
            return yaml.load(source, Loader=yaml.CSafeLoader)
        except yaml.YAMLError:
            pass
    return yaml.safe_load(source)


def read_header(source: str | None) -> tuple[str | None, str | None]:
    """(the header as JSON, null) or (null, what is wrong with it)."""
    if source is None:
        return None, "no frontmatter"
    try:
        found = safe_yaml(source) if yaml else plain_yaml(source)
    except Exception as e:
        return None, f"frontmatter can't be read: {str(e).splitlines()[0]}"
    if not isinstance(found, dict):
        return None, "frontmatter is no mapping"
    return json.dumps(found, ensure_ascii=False, default=str), None


@pandas_udf(T.StructType([T.StructField("header", T.StringType()), T.StructField("problem", T.StringType())]))
def header(sources: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_header(s) for s in sources], columns=["header", "problem"], dtype=object)


FENCE = re.compile(r"^([ \t]*)(`{3,}|~{3,})[ \t]*([^\s`]*)[^\n]*$")


def code_blocks(markdown: str) -> list[tuple[str, str]]:
    """(language, code) of each closed fence; the fence's own indent is taken off the code."""
    out, opened, lines = [], None, []
    for line in (markdown or "").splitlines():
        m = FENCE.match(line)
        if opened is None:
            if m:
                opened, lines = m, []
        elif m and m[2][0] == opened[2][0] and len(m[2]) >= len(opened[2]) and not m[3]:
            out.append((opened[3], "\n".join(lines)))
            opened = None
        else:
            n = len(opened[1])
            lines.append(line[n:] if line[:n].isspace() or not n else line.lstrip())
    return out


def guess_language(code: str, default: str) -> str:
    """What a fence without a language holds: shell, JSON, prose-like pseudo-code, else the default."""
    stripped = code.strip()
    if re.search(r"(?m)^\s*(?:\$|#)\s+\S", stripped) or re.match(r"(?:sudo|apt|opkg|git|cd|make|wget|curl)\s", stripped):
        return "bash"
    if stripped[:1] in "{[" and stripped:
        try:
            json.loads(stripped)
        except ValueError:
            pass
        else:
            return "json"
    return "text" if "…" in stripped or "..." in stripped or not stripped else default


def normalise_fences(markdown: str, default: str) -> str:
    """Fences without a language get one."""
    lines = (markdown or "").split("\n")
    opened = None
    for i, line in enumerate(lines):
        m = FENCE.match(line)
        if not m:
            continue
        if opened is None:
            opened = (i, m)
        elif not m[3] and m[2][0] == opened[1][2][0]:
            if not opened[1][3]:
                at, start = opened
                lines[at] = f"{start[1]}{start[2]}{guess_language(chr(10).join(lines[at + 1 : i]), default)}"
            opened = None
    return "\n".join(lines)


def without_fences(content: Column) -> Column:
    """The text without its closed fenced blocks."""
    return F.regexp_replace(content, r"(?ms)^[ \t]*(`{3,}|~{3,})[^\n]*\n.*?^[ \t]*\1[ \t]*$\n?", "")


IMPORT = r"(?m)^\s*import\s+(?:[^'\";]*?\sfrom\s+)?['\"]([^'\"]+)['\"]"


def imports(code: Column) -> Column:
    """Modules that a script imports, in any of the three forms; sorted, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(code, F.lit(IMPORT), F.lit(1))))


_BY_NAME = re.compile(r"import\s*\{([^}]*)\}\s*from\s*(['\"])(\w+)\2;?")


def namespaced_imports(code: str) -> str:
    """An import of the reserved name ``const`` from a module becomes one of the whole module, and what it brought is called through it from there on."""
    for m in _BY_NAME.finditer(code):
        names = [n.strip() for n in m[1].split(",")]
        if "const" not in names:
            continue
        called = "|".join(re.escape(n) for n in names if n and n != "const")
        tail = re.sub(r"(?<![\w.])const(?=\.)", f"{m[3]}.const", code[m.end() :])
        if called:
            tail = re.sub(rf"(?<![\w.])({called})(?=\()", rf"{m[3]}.\1", tail)
        return f"{code[: m.start()]}import * as {m[3]} from '{m[3]}';{tail}"
    return code


class _Table(HTMLParser):
    """Rows of inline-rendered cells of one table; spans over several cells are noticed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[bool, list[str]]] = []
        self.spans = self.image = False
        self.cell: list[str] | None = None
        self.head = False
        self.href: list[str] = []

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == "tr":
            self.rows.append((False, []))
        elif tag in ("td", "th"):
            self.spans |= any(at.get(k, "1") != "1" for k in ("rowspan", "colspan"))
            self.cell, self.head = [], tag == "th"
        elif self.cell is not None:
            if tag == "br":
                self.cell.append("\n")
            elif tag == "code":
                self.cell.append("`")
            elif tag in ("b", "strong", "u"):
                self.cell.append("**")
            elif tag == "a":
                self.href.append(at.get("href") or "")
                self.cell.append("[")
            elif tag == "img":
                self.image = True
            elif tag == "table":
                self.spans = True

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append((False, []))
            was, cells = self.rows[-1]
            parts = [re.sub(r"\s+", " ", p).strip() for p in "".join(self.cell).split("\n")]
            cells.append("\n".join(p for p in parts if p))
            self.rows[-1] = (was or self.head, cells)
            self.cell = None
        elif self.cell is not None:
            if tag == "code":
                self.cell.append("`")
            elif tag in ("b", "strong", "u"):
                self.cell.append("**")
            elif tag == "a" and self.href:
                self.cell.append(f"]({self.href.pop()})")

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


WIDE = 5


def convert_table(source: str) -> str:
    """A pipe table; a TSV block from five columns on; an admonition for an icon beside a text; spans leave it as it is."""
    t = _Table()
    t.feed(source)
    rows = [(h, cells) for h, cells in t.rows if cells]
    if t.spans or not rows:
        return source
    if t.image and len(rows) == 1 and len(rows[0][1]) == 2 and not rows[0][1][0]:
        return "> [!WARNING]\n" + "\n".join(f"> {line}" for line in rows[0][1][1].split("\n"))
    width = max(len(c) for _, c in rows)
    flat = [(h, [x.replace("\n", "; ") for x in c] + [""] * (width - len(c))) for h, c in rows]
    once = [r for i, r in enumerate(flat) if r not in flat[:i]]
    if width >= WIDE:
        return "```tsv\n" + "\n".join("\t".join(x.replace("\t", " ") for x in c) for _, c in once) + "\n```"
    head = once.pop(0)[1] if once[0][0] else [""] * width
    line = lambda c: "| " + " | ".join(x.replace("|", "\\|") for x in c) + " |"
    return "\n".join([line(head), line(["---"] * width), *(line(c) for _, c in once)])


# Marks that the wiki's own syntax leaves behind.
RESIDUE = (r"\\?</?WRAP[^>]*>", r"\\?</?color[^>]*>", r"\\?</?sortable[^>]*>", r"\\?</?nowiki[^>]*>", r"~~[A-Z]+~~")


def clean_wiki(title: str, raw: str) -> str:
    """A wiki page's converted Markdown without wrap, colour and sorting marks, with tables, footnotes and inline HTML as Markdown and a repeated first heading once."""
    out = (raw or "").replace("\\<", "<").replace("\\>", ">")
    for p in RESIDUE:
        out = re.sub(p, "", out, flags=re.IGNORECASE)
    out = re.sub(r"(?is)<table\b.*?</table>", lambda m: convert_table(m[0]), out)
    notes = []
    for block in re.findall(r"(?is)<aside[^>]*footnotes[^>]*>(.*?)</aside>", out):
        for number, text in re.findall(r'(?is)<li id="fn(\d+)"[^>]*>(.*?)</li>', block):
            text = re.sub(r"(?is)<a\b[^>]*footnote-back[^>]*>.*?</a>", "", text)
            notes.append(f"[^{number}]: " + re.sub(r"<[^>]+>", "", text).strip())
    out = re.sub(r"(?is)<aside[^>]*footnotes[^>]*>.*?</aside>", "\n".join(notes), out)
    out = re.sub(r'(?is)<a\b[^>]*href="#fn(\d+)"[^>]*>.*?</a>', r"[^\1]", out)
    out = re.sub(r"(?is)</?u>", "**", out)
    lines = out.split("\n")
    first = next((i for i, x in enumerate(lines) if x.strip()), None)
    if first is not None and lines[first].startswith("# "):
        after = next((i for i in range(first + 1, len(lines)) if lines[i].strip()), None)
        if after is not None and re.match(r"##\s", lines[after]) and lines[after].lstrip("#").strip().casefold() == lines[first].lstrip("#").strip().casefold():
            del lines[after]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines))


@pandas_udf(T.StringType())
def cleaned(titles: pd.Series, raws: pd.Series) -> pd.Series:
    return pd.Series([clean_wiki(t, r) for t, r in zip(titles, raws, strict=True)], dtype=object)


@pandas_udf(T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("code", T.StringType())])))
def blocks(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"lang": a, "code": b} for a, b in code_blocks(t)] for t in texts], dtype=object)


def duplicate_heading(content: Column) -> Column:
    """Whether the first heading is repeated one level down right behind it, without regard to case."""
    pattern = r"\A\s*#[ \t]+([^\n]*?)[ \t]*\n\s*##[ \t]+([^\n]*?)[ \t]*(?:\n|\z)"
    a, b = F.regexp_extract(content, pattern, 1), F.regexp_extract(content, pattern, 2)
    return (a != "") & (F.lower(a) == F.lower(b))


# Residue that a cleaned wiki corpus is searched for.
ARTIFACTS = {"wrap": r"(?i)</?WRAP", "color": r"(?i)</?color", "sortable": r"(?i)<sortable", "html_table": r"(?i)<table", "footnote_html": r"(?i)footnote-(?:ref|back)"}
LEAST_PAGES = 80


def artifact_census(pages, content: str = "content"):
    """One row: pages, and for each kind of residue the pages that have it and how often, with the verdict on the whole."""
    c = F.col(content)
    per = [x for k, p in ARTIFACTS.items() for x in (F.coalesce(F.sum(F.coalesce(c.rlike(p), F.lit(False)).cast("long")), F.lit(0)).alias(f"{k}_files"), F.coalesce(F.sum(F.regexp_count(c, F.lit(p)).cast("long")), F.lit(0)).alias(f"{k}_count"))]
    row = pages.agg(F.count("*").alias("files"), *per, F.coalesce(F.sum(F.coalesce(duplicate_heading(c), F.lit(False)).cast("long")), F.lit(0)).alias("duplicate_headings"))
    residue = F.col("duplicate_headings")
    for k in ARTIFACTS:
        residue = residue + F.col(f"{k}_files")
    return row.withColumn("status", F.when((F.col("files") < LEAST_PAGES) | (residue > 0), "abnormal").otherwise("normal"))


LINKED_OUTSIDE = re.compile(r"(?s)(```.*?```|~~~.*?~~~|`[^`\n]*`|\[[^\]]*\]\([^)]*\)|<[^>]+>)")


def link_symbols(content: str, targets: dict[str, str]) -> str:
    """The first mention of each known symbol outside code, links and tags becomes a link to its target."""
    if not content or not targets:
        return content
    names = sorted(targets, key=lambda x: (-len(x), x))
    pattern = re.compile(r"(?<![\w.])(" + "|".join(map(re.escape, names)) + r")(?![\w])(\(\))?")
    seen: set[str] = set()

    def once(m: re.Match) -> str:
        if m[1] in seen:
            return m[0]
        seen.add(m[1])
        return f"[{m[0]}]({targets[m[1]]})"

    return "".join(x if i % 2 else pattern.sub(once, x) for i, x in enumerate(LINKED_OUTSIDE.split(content)))
