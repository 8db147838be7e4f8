"""Ordered packing, drift between snapshots, links, tree plans and output checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.lineage import cut


def _steps(sizes: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document as the start of a part: the start of the next part in the block (or its length), and what
    the last part of the block holds and how many parts start from here on if this one does."""
    n = len(sizes)
    sums = np.concatenate(([0], np.cumsum(sizes)))
    following = np.maximum(np.searchsorted(sums, sums[:-1] + budget, side="right") - 1, np.arange(1, n + 1))
    following = np.minimum(following, n)
    used, count = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        k = following[i]
        used[i], count[i] = (used[k], count[k] + 1) if k < n else (sums[n] - sums[i], 1)
    return following, used, count


def _first_start(sizes: np.ndarray, used: int, budget: int) -> int:
    """The first document of a block that starts a new part if the running one holds so much already."""
    return int(np.searchsorted(np.cumsum(sizes), budget - used, side="right"))


def _summary(block: pd.DataFrame, budget: int) -> pd.DataFrame:
    """What a block does to a running part: for each document that can be the first to start one, up to which size of the
    running part that is so, and what comes out; a document that can't be reached from any size is left out."""
    sizes = block["n"].to_numpy()
    sums = np.cumsum(sizes)
    _, used, count = _steps(sizes, budget)
    reach = np.concatenate(([True], sums[:-1] <= budget))  # every size from 0 on keeps what is before
    at = np.flatnonzero(reach)
    return pd.DataFrame({"block": [block["block"].iloc[0]], "total": [int(sums[-1])], "sums": [sums[at].tolist()], "used": [used[at].tolist()], "parts": [count[at].tolist()]})


def _composed(first: tuple, second: tuple, budget: int) -> tuple:
    """What two neighbouring runs of blocks, as (total, sums, used, parts), do one after the other; as long as what a part can reach."""
    total, sums, used, parts = first
    t2, s2, u2, p2 = second
    if len(s2):
        at = np.searchsorted(s2, budget - used, side="right")  # where the second run starts a part if it is entered so
        there = at < len(s2)
        i = np.minimum(at, len(s2) - 1)
        used, parts = np.where(there, u2[i], used + t2), parts + np.where(there, p2[i], 0)
        reach = np.concatenate(([total <= budget or not len(sums)], total + s2[:-1] <= budget))  # from a running part of any size
        sums, used, parts = np.concatenate((sums, total + s2[reach])), np.concatenate((used, u2[reach])), np.concatenate((parts, p2[reach]))
    else:
        used = used + t2
    return total + t2, sums, used, parts


def _arrays(r) -> tuple:
    return int(r.total), *(np.asarray(x, dtype=np.int64) for x in (r.sums, r.used, r.parts))


def _folded(blocks: pd.DataFrame, budget: int) -> pd.DataFrame:
    """The summaries of a run of blocks as one."""
    out = None
    for r in blocks.sort_values("block").itertuples():
        out = _arrays(r) if out is None else _composed(out, _arrays(r), budget)
    return pd.DataFrame({"total": [out[0]], "sums": [out[1].tolist()], "used": [out[2].tolist()], "parts": [out[3].tolist()]})


def _chained(blocks: pd.DataFrame, budget: int) -> pd.DataFrame:
    """The size and number of the running part in front of each block of a run, from those in front of the run (``before``, ``first_part``; a size below 0: nothing is there yet)."""
    blocks = blocks.sort_values("block")
    out, used, part = [], int(blocks["before"].iloc[0]), int(blocks["first_part"].iloc[0])
    for r in blocks.itertuples():
        out.append((r.block, used if used >= 0 else budget + 1, part))
        total, sums, last, parts = _arrays(r)
        i = 0 if used < 0 else int(np.searchsorted(sums, budget - used, side="right"))
        if i < len(sums):
            used, part = int(last[i]), part + int(parts[i])
        else:
            used += total
    return pd.DataFrame(out, columns=["block", "before", "part"])


def _numbered(block: pd.DataFrame, budget: int) -> np.ndarray:
    """The part of each document of a block, from the size and number of the part that runs in front of it."""
    sizes = block["n"].to_numpy()
    following, _, _ = _steps(sizes, budget)
    starts, i = np.zeros(len(sizes), dtype=np.int64), _first_start(sizes, int(block["before"].iloc[0]), budget)
    while i < len(sizes):
        starts[i] = 1
        i = int(following[i])
    return int(block["first_part"].iloc[0]) + np.cumsum(starts)


#: Summaries of blocks that one task puts together.
FAN = 64


def shards(documents: DataFrame, budget: int, group: str = "module", order: str = "file", size: str = "token_count", fan: int = FAN) -> DataFrame:
    """(group, order, size, part): greedy parts in order; a document starts a new part if it would take the running one over the budget.

    A part's sum restarts where the last one ended, so this is no window sum.  The
    pairs (order, size) are sorted by range into blocks, so a group may span many.
    Each block tells what it does to a part that runs into it (a few numbers for
    each document that such a part can reach).  These summaries are put together in
    runs of ``FAN`` blocks, the runs in runs of their own, until one is left, and
    the running parts in front of each are handed down again; then every block
    numbers its documents by itself.  The time is linear in the documents, and no
    task holds more than a block, or ``FAN`` summaries of what one part can reach.
    """
    key = documents.schema[group].dataType.simpleString()
    place = documents.schema[order].dataType.simpleString()
    pairs = documents.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n"))
    sorted_pairs = pairs.repartitionByRange("g", "o").sortWithinPartitions("g", "o", "n")
    blocks = cut(sorted_pairs.select(F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at"), "g", "o", "n"), "shard-blocks")
    kinds = "total long, sums array<long>, used array<long>, parts array<long>"
    own = lambda d: None if pd.isna(d["g"].iloc[0]) else d["g"].iloc[0]

    def summed(d: pd.DataFrame) -> pd.DataFrame:
        return _summary(d.sort_values("at"), budget).assign(g=[own(d)])

    def folded(d: pd.DataFrame) -> pd.DataFrame:
        return _folded(d, budget).assign(block=[int(d["block"].iloc[0]) // fan], g=[own(d)])

    def chained(d: pd.DataFrame) -> pd.DataFrame:
        return _chained(d, budget).assign(g=own(d))

    levels = [cut(blocks.groupBy("g", "block").applyInPandas(summed, f"block int, {kinds}, g {key}"), "shard-summary")]
    last = blocks.agg(F.max("block")).first()[0] or 0
    while last:  # a level for each power of fan
        last //= fan
        levels.append(cut(levels[-1].groupBy("g", F.floor(F.col("block") / fan)).applyInPandas(folded, f"block int, {kinds}, g {key}"), "shard-level"))
    running = levels[-1].select("g", "block", F.lit(-1).cast("long").alias("before"), F.lit(0).cast("long").alias("part"))
    for level in reversed(levels[:-1]):
        above = running.select(F.col("g").alias("ag"), F.col("block").alias("ab"), "before", F.col("part").alias("first_part"))
        entered = level.join(above, F.col("g").eqNullSafe(F.col("ag")) & (F.floor(F.col("block") / fan) == F.col("ab")))
        running = cut(entered.groupBy("g", "ab").applyInPandas(chained, f"block int, before long, part long, g {key}"), "shard-running")
    if len(levels) == 1:  # a single block
        running = running.withColumn("before", F.lit(budget + 1).cast("long"))
    running = running.select(F.col("g").alias("rg"), F.col("block").alias("rb"), "before", F.col("part").alias("first_part"))
    joined = blocks.join(running, F.col("g").eqNullSafe(F.col("rg")) & (F.col("block") == F.col("rb")))

    def number(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values("at")
        return pd.DataFrame({"g": d["g"], "o": d["o"], "n": d["n"], "part": _numbered(d, budget).astype(np.int32)})

    out = joined.groupBy("g", "block").applyInPandas(number, f"g {key}, o {place}, n long, part int")
    return out.select(F.col("g").alias(group), F.col("o").alias(order), F.col("n").alias(size), "part")


def part_totals(sharded: DataFrame, group: str = "module", size: str = "token_count") -> DataFrame:
    return sharded.groupBy(group, "part").agg(F.count("*").alias("n_docs"), F.sum(size).alias("tokens"), F.max(text.part_filename(F.col("part"))).alias("file"))


def drift(old: DataFrame, new: DataFrame, key: str = "symbol", value: str = "signature") -> DataFrame:
    """(key, change, before, after) of what was added, removed or changed between two snapshots."""
    a, b = old.select(key, F.col(value).alias("before"), F.lit(True).alias("was")), new.select(key, F.col(value).alias("after"), F.lit(True).alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change"), "before", "after").where("change is not null")


def module_drift(current: DataFrame, baseline: DataFrame | None) -> DataFrame:
    """(module, change); a baseline without module data reports nothing."""
    if baseline is None:
        return current.select("module", F.lit("added").alias("change")).limit(0)
    added = current.join(baseline, "module", "left_anti").select("module", F.lit("added").alias("change"))
    return added.unionByName(baseline.join(current, "module", "left_anti").select("module", F.lit("removed").alias("change")))


def missing_on_rerun(existing: DataFrame, incoming: DataFrame, key: str = "module") -> DataFrame:
    """What a partial rerun would lose: existing without incoming, but only if the incoming are a strict subset."""
    fresh = incoming.join(existing, key, "left_anti").agg(F.count("*").alias("fresh"))  # one row
    lost = existing.join(incoming, key, "left_anti").select(key).distinct()
    return lost.join(F.broadcast(fresh), F.col("fresh") == 0).select(key)


LINK = r"\[[^\]]*\]\(([^)\s]+)\)"


def links(pages: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, target, resolved): the relative Markdown links of pages, without anchors; external and anchor links are left out."""
    found = pages.select(path, F.explode(F.array_distinct(F.regexp_extract_all(F.col(content), F.lit(LINK), F.lit(1)))).alias("target"))
    bare = F.regexp_replace("target", "[#?].*$", "")
    local = found.where(~F.col("target").rlike("^[A-Za-z][A-Za-z0-9+.-]*:|^//|^#")).withColumn("bare", bare).where("bare <> ''")
    folder = F.when(F.col("bare").startswith("/"), F.lit("")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    parts = F.filter(F.split(F.concat(folder, "bare"), "/"), lambda x: (x != "") & (x != "."))
    out = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when((x == "..") & (F.size(acc) > 0), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    return local.select(path, "target", F.array_join(out, "/").alias("resolved"))


def dead_links(pages: DataFrame, paths: DataFrame, path: str = "path", content: str = "content", suffix: str = ".md") -> DataFrame:
    """Links to files with the suffix that are not among the paths."""
    wanted = links(pages, path, content).where(F.col("resolved").endswith(suffix))
    return wanted.join(paths.select(F.col(path).alias("resolved")).distinct(), "resolved", "left_anti").select(path, "target", "resolved")


def rewrite_links(content, target: str):
    """``../module/file.md`` links of an authored page for one of three trees; deeper ``../../`` links stay as they are.

    target: ``stable`` goes through the semantic layer's folder, ``release`` to a
    module's chunked pages, ``chunked`` likewise from one level deeper.
    """
    to = {"stable": "](../L2-semantic/$1/$2)", "release": "](../$1/chunked-reference/$2)", "chunked": "](../../$1/chunked-reference/$2)"}[target]
    return F.regexp_replace(content, r"\]\(\.\./((?!\.\.)[^/()\s]+)/([^/()\s]+\.md(?:#[^()\s]*)?)\)", to)


def sync_plan(source: DataFrame, target: DataFrame, delete_extra: bool, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(path, action) from two listings (path, size, mtime in seconds, is_link): copy, skip or delete.

    A file is copied if it is new, its size differs or its time differs by over
    0.01 s.  Links and excluded names are left alone on both sides.
    """
    name = F.element_at(F.split("path", "/"), -1)
    usable = lambda d: d.where(~F.coalesce("is_link", F.lit(False)) & ~(name.isin(*exclude) if exclude else F.lit(False)))
    s = usable(source).select("path", F.col("size").alias("s_size"), F.col("mtime").alias("s_mtime"), F.lit(True).alias("in_s"))
    t = usable(target).select("path", F.col("size").alias("t_size"), F.col("mtime").alias("t_mtime"), F.lit(True).alias("in_t"))
    differs = ~F.col("s_size").eqNullSafe(F.col("t_size")) | (F.abs(F.col("s_mtime") - F.col("t_mtime")) > 0.01)
    action = F.when(F.col("in_t").isNull() | (F.col("in_s") & differs), "copy").when(F.col("in_s").isNull(), "delete" if delete_extra else "keep").otherwise("skip")
    return s.join(t, "path", "full_outer").select("path", action.alias("action"))


def content_mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Paths of a whose content (path, content) is not equal in b, or missing there."""
    digest = lambda d, n: d.select("path", F.sha2(F.col("content").cast("binary"), 256).alias(n))
    return digest(a, "x").join(digest(b, "y"), "path", "left").where(~F.col("x").eqNullSafe(F.col("y"))).select("path")


#: Files that a release tree has, at its root and in every module.
ROOT_FILES = ("llms.txt", "llms-full.txt", "README.md", "AGENTS.md", "index.html")
MODULE_FILES = ("llms.txt", "map.md", "bundled-reference.md")
#: Fields that the header of a page no longer has, and what a page says that is an error and no page.
STALE_FIELDS = r"(?m)\A---\n(?:[^\n]*\n)*?(?:original_url|upstream_path|language):"
ERROR_PAGE = r"(?i)\A\s*(?:<!doctype html>\s*)?(?:<html[^>]*>\s*)?(?:<head>\s*)?(?:<title>)?\s*(?:404|403|500|502|503)\b|this topic does not exist yet"


def _all(frames: list[DataFrame]) -> DataFrame:
    every = frames[0]
    for d in frames[1:]:
        every = every.unionByName(d)
    return every


def page_problems(tree: DataFrame) -> DataFrame:
    """(check, subject) of what the index, the router and the pages of a release tree (path, content) have wrong: an index that does not mirror the tree, a router without its parts, stale header fields, pages that are no Markdown or an error."""
    parts = tree.select("path", "content", F.split("path", "/").alias("p"))
    problem = lambda d, check, subject: d.select(F.lit(check).alias("check"), subject.alias("subject"))
    text_page = F.col("path").rlike("[.](md|html|txt)$")
    hrefs = parts.where(F.col("path") == "index.html").select("path", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit("href=[\"']([^\"'#?]+)"), F.lit(1)))).alias("target")).where(~F.col("target").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"))
    listed = hrefs.select(F.regexp_replace("target", r"^\./", "").alias("path"))
    entries = tree.where(F.col("path").endswith("/llms.txt")).select("path")
    router = tree.where(F.col("path") == "llms.txt")
    out = [
        problem(listed.join(tree.select("path"), "path", "left_anti"), "index names a file that is not there", F.col("path")),
        problem(entries.join(listed, "path", "left_anti"), "index lacks a module", F.col("path")),
        problem(router.where(~F.col("content").rlike("(?m)^# ") | ~F.col("content").rlike(r"(?m)^- \[[^\]]+\]\(")), "router without a title or entries", F.col("path")),
        problem(tree.where(F.col("path").endswith(".md") & F.col("content").rlike(STALE_FIELDS)), "stale field", F.col("path")),
        problem(parts.where((F.size("p") > 2) & (F.col("p")[1] == "chunked-reference") & ~F.col("path").endswith(".md")), "not Markdown", F.col("path")),
        problem(tree.where(text_page & F.col("content").rlike(ERROR_PAGE)), "error page", F.col("path")),
    ]
    return _all(out)


def tree_problems(tree: DataFrame, modules: DataFrame, least_modules: int = 4, router_bytes: int = 512, most_bytes: int = 2_000_000) -> DataFrame:
    """(check, subject) of what a release tree (path, content) lacks or has too much of. modules: those that must be there."""
    spark = tree.sparkSession
    parts = tree.select("path", "content", F.split("path", "/").alias("p"))
    found = parts.where(F.size("p") > 1).select(F.col("p")[0].alias("module")).distinct()
    problem = lambda d, check, subject: d.select(F.lit(check).alias("check"), subject.alias("subject"))
    root = spark.createDataFrame([(x,) for x in ROOT_FILES], "path string")
    each = found.select(F.explode(F.array(*[F.concat("module", F.lit("/" + x)) for x in MODULE_FILES])).alias("path"))
    chunked = parts.where((F.size("p") > 2) & (F.col("p")[1] == "chunked-reference")).select(F.col("p")[0].alias("module")).distinct()
    few = found.agg(F.count("*").alias("n")).where(F.col("n") < least_modules)
    body = F.octet_length("content")
    out = [
        problem(root.join(tree, "path", "left_anti"), "root file missing", F.col("path")),
        problem(each.join(tree, "path", "left_anti"), "module file missing", F.col("path")),
        problem(found.join(chunked, "module", "left_anti"), "no chunked pages", F.col("module")),
        problem(found.join(modules, "module", "left_anti"), "module not expected", F.col("module")),
        problem(modules.join(found, "module", "left_anti"), "module missing", F.col("module")),
        problem(few, "too few modules", F.col("n").cast("string")),
        problem(tree.where((F.col("path") == "llms.txt") & (body <= router_bytes)), "router too small", F.col("path")),
        problem(tree.where(body > most_bytes), "file too large", F.col("path")),
        problem(tree.where(F.col("path").endswith(".html") & F.col("content").rlike("href=[\"']\\.\\./")), "link out of the tree", F.col("path")),
        problem(dead_links(tree, tree), "dead link", F.concat_ws(" -> ", "path", "resolved")),
    ]
    return _all(out)


def incomplete_catalogue(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files (path) that a catalogue (path) does not list."""
    return files.join(listed, "path", "left_anti").select("path")


def known_false_positives(found: DataFrame, known: DataFrame) -> DataFrame:
    """Findings (path, message) without those that are known, by exact pair."""
    return found.join(known, ["path", "message"], "left_anti")


def cache_plan(arrivals: DataFrame, cache: DataFrame, cutoff: str, complete: bool = True) -> DataFrame:
    """(url, action) of an incremental fetch: arrivals (url, status, raw_hash, last_modified, is_error) against a cache (url, raw_hash, corrupted).

    expired: older than the cutoff, even with an equal hash; reuse: a failed fetch
    or an error page of a cached url; fail: of another; refetch: the cached output
    is corrupted; skip: not modified, or the hash is equal; convert: the rest;
    orphan: cached but not found any more, only if the discovery was complete.
    """
    a = arrivals.select("*", F.lit(True).alias("found"))
    c = cache.select("url", F.col("raw_hash").alias("cached_hash"), "corrupted", F.lit(True).alias("cached"))
    bad = (F.col("status") >= 400) | F.coalesce("is_error", F.lit(False)) | F.col("status").isNull()
    action = (
        F.when(F.col("found").isNull(), "orphan" if complete else "keep")
        .when(F.col("last_modified") < cutoff, "expired")
        .when(bad & F.col("cached"), "reuse")
        .when(bad, "fail")
        .when(F.col("corrupted"), "refetch")
        .when((F.col("status") == 304) | F.coalesce(F.col("raw_hash") == F.col("cached_hash"), F.lit(False)), "skip")
        .otherwise("convert")
    )
    return a.join(c, "url", "full_outer").select("url", action.alias("action"))
