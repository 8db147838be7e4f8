"""Discussion threads: roots of reply chains, rollup, score, lessons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions import fixed, text
from siltstone.lineage import cut


def _climbed(linked: DataFrame, steps: int | None = None) -> DataFrame:
    """(id, parent) to (id, up, done) by pointer doubling: done where up is the end of the chain. Without steps until all are done, else until so many steps were made."""
    state, made = linked.select("id", F.coalesce("parent", "id").alias("up"), F.col("parent").isNull().alias("done")), 1
    while (steps is None or made <= steps) and not state.where("not done").isEmpty():
        there = state.select(F.col("id").alias("at"), F.col("up").alias("further"), F.col("done").alias("ended"))
        open_ = state.where("not done").join(there, F.col("up") == F.col("at")).select("id", F.col("further").alias("up"), F.col("ended").alias("done"))
        state = cut(state.where("done").unionByName(open_), "roots-doubled")
        made *= 2
    return state


def roots(messages: DataFrame) -> DataFrame:
    """(id, parent) to (id, root): the last id reached by climbing to parents that exist.

    The climb ends at a missing parent or where a parent was visited before; the
    message it starts from does not count as visited.  So a member of a cycle is its
    own root, and a message whose chain leads into a cycle climbs once around it and
    ends at the member whose parent is the one it came in by.

    Chains are climbed by pointer doubling, whose rounds grow with the logarithm of
    the depth.  What is still open after as many steps as there are messages stands
    on a cycle; the ids stood on are all members of cycles, and a second climb that
    ends at them finds where each tail comes in.  Of repeated ids the last (by
    ``ordinal``, if there is one) counts.  A null id is no message.
    """
    real = messages.where(F.col("id").isNotNull())
    latest = F.max_by("parent", "ordinal") if "ordinal" in messages.columns else F.max("parent")
    last = real.groupBy("id").agg(latest.alias("parent"))
    ids = last.select(F.col("id").alias("known"))
    linked = cut(last.join(ids, last.parent == ids.known, "left").select("id", F.col("known").alias("parent")), "roots-linked")
    state = _climbed(linked, linked.count())
    ended = state.where("done").select("id", F.col("up").alias("root"))
    stuck = state.where("not done")
    return ended if stuck.isEmpty() else ended.unionByName(_cyclic(linked, stuck))


def _cyclic(linked: DataFrame, stuck: DataFrame) -> DataFrame:
    """Roots of the messages whose chain leads into a cycle, and of the cycles' members, on which they all stand now."""
    members = cut(stuck.select(F.col("up").alias("member")).distinct(), "roots-members")
    mine = linked.join(stuck.select("id"), "id", "left_semi").join(members, F.col("id") == F.col("member"), "left")
    into = _climbed(mine.select("id", F.when(F.col("member").isNull(), F.col("parent")).alias("parent")))
    before = linked.join(members, F.col("id") == F.col("member"), "left_semi").select(F.col("parent").alias("entry"), F.col("id").alias("last"))
    met = into.join(before, F.col("up") == F.col("entry"))
    return met.select("id", F.when(F.col("id") == F.col("entry"), F.col("id")).otherwise(F.col("last")).alias("root"))


def score(flags: dict[str, Column]) -> Column:
    """The sum of the points of the terms that hold, in hundredths, kept between 0 and 100."""
    terms = [F.when(flags[k], F.lit(v)).otherwise(F.lit(0)) for k, v in fixed.SCORE.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("int")


#: Patterns that are looked for in a thread's bodies joined by line ends.
JOINED = {"is_problem": fixed.PROBLEM, "is_correction": fixed.CORRECTION, "is_nack": r"\bNACK?\b"}


def rollup(messages: DataFrame) -> DataFrame:
    """Primary messages with a ``root`` to one row a thread, with its score.

    A message has id, sender, subject, body, date_iso, source_file, archive_url,
    byte_offset, ordinal, files, commits, categories, signals.  Whole bodies are
    not gathered: flags are found on each message and combined, and the thread
    keeps references to its messages in their order.  The problem, the correction and
    the NACK may also run over any number of messages: of each the thread keeps
    what it does to a match that runs through it (``text.border``, some truth
    values), and these maps are composed in order.
    """
    place = F.struct(text.sort_date(F.col("date_iso")).alias("date"), F.col("byte_offset").alias("byte_offset"), F.col("ordinal").alias("ordinal"))
    found = lambda c: [text.matches(c, p).alias(n) for n, p in JOINED.items()]
    running = {n: p for n, p in JOINED.items() if text.segments(p)}
    borders = [text.border(F.col("body"), p).alias(f"border_{n}") for n, p in running.items()]
    flat = messages.select("*", place.alias("place"), *found(F.col("body")), *borders)
    ordered = lambda value: F.transform(F.array_sort(F.collect_list(F.struct("place", value))), lambda x: x[value])
    grouped = flat.groupBy("root").agg(
        F.min_by("subject", "place").alias("subject"),
        F.count("*").alias("message_count"),
        F.countDistinct(F.when(F.col("sender") != "", F.col("sender"))).alias("author_count"),
        F.min_by("date_iso", "place").alias("first_date"),
        F.max_by("date_iso", "place").alias("last_date"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("files")))).alias("files"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("commits")))).alias("commits"),
        F.array_distinct(F.flatten(ordered("categories"))).alias("categories"),
        *[F.bool_or(F.col(f"signals.{k}")).alias(k) for k in fixed.SIGNALS],
        F.bool_or("is_problem").alias("is_problem"),
        F.bool_or("is_correction").alias("is_correction"),
        F.bool_or("is_nack").alias("is_nack"),
        *[text.crosses(ordered(f"border_{n}"), p).alias(f"across_{n}") for n, p in running.items()],
        F.countDistinct("source_file").alias("source_files"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "source_file", "archive_url", "id", "byte_offset"))), lambda x: F.struct(x["source_file"].alias("source_file"), x["archive_url"].alias("archive_url"), x["id"].alias("message_id"), x["byte_offset"].alias("byte_offset"))).alias("source_refs"),
    )
    either = lambda n: F.col(n) | F.col(f"across_{n}") if n in running else F.col(n)
    two, subject = F.col("author_count") >= 2, F.col("subject")
    flags = {
        "problem": either("is_problem"),
        "correction": either("is_correction"),
        "two_authors": two,
        "references": (F.size("files") > 0) | (F.size("commits") > 0),
        "two_messages": F.col("message_count") >= 2,
        "subject_revision": text.matches(subject, r"\[PATCH\s+v[2-9]"),
        "nack": either("is_nack"),
        "compiler_error": F.col("has_compiler_error"),
        "stack_trace": F.col("has_stack_trace"),
        "build_error": F.col("has_build_error"),
        "code_block": F.col("has_code_block") & two,
        "reference_urls": F.col("has_reference_urls"),
        "body_revision": F.col("has_patch_revision"),
        "lone_bump": text.matches(subject, "bump to") & ~two,
    }
    scored = grouped.withColumn("score_cents", score(flags)).withColumn("score", F.col("score_cents") / 100.0)
    return scored.withColumnRenamed("root", "thread_id").drop(*JOINED, *[f"across_{n}" for n in running])


def passing(threads: DataFrame, threshold: int = fixed.PASSING) -> DataFrame:
    return threads.where(F.col("score_cents") >= threshold)


def numbered(threads: DataFrame) -> DataFrame:
    """lesson_id by falling score, then subject without case, then thread_id.

    Ranks come from a range sort of the keys and the sizes of its partitions, not
    from a window over one partition, so threads of one score are spread too.
    """
    keys = threads.select("thread_id", "score_cents", F.lower("subject").alias("low")).repartitionByRange(F.desc("score_cents"), "low", "thread_id").sortWithinPartitions(F.desc("score_cents"), "low", "thread_id")
    placed = cut(keys.select("thread_id", F.spark_partition_id().alias("block"), (F.monotonically_increasing_id() % (1 << 33)).alias("at")), "numbered")
    sizes = placed.groupBy("block").agg(F.count("*").alias("n"))  # one row a partition
    before = sizes.select("block", F.coalesce(F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = placed.join(before, "block").select("thread_id", (F.col("before") + F.col("at") + 1).cast("int").alias("number"))
    return threads.join(ranked, "thread_id").withColumn("lesson_id", F.format_string("lesson-%04d", F.col("number")))


def snippets(messages: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(root, place, sender, message_id, and a column for each pattern): of every message the first sentence that matches, with one before and two behind; null if none does."""
    place = F.struct(text.sort_date(F.col("date_iso")), "byte_offset", "ordinal")
    parts = messages.select("root", "sender", F.col("id").alias("message_id"), place.alias("place"), text.sentences(F.col("body_no_diff")).alias("s"))

    def around(pattern: str) -> Column:
        at = F.array_position(F.transform("s", lambda x: text.matches(x, pattern)), F.lit(True)).cast("int")
        return text.bound(at, lambda i: F.when(i > 0, F.array_join(F.slice("s", F.greatest(F.lit(1), i - 1), F.when(i == 1, 3).otherwise(4)), " ")))

    return parts.select("root", "place", "sender", "message_id", *[around(p).alias(n) for n, p in patterns.items()])


def first_snippet(found: DataFrame, name: str) -> DataFrame:
    """(root, sender, snippet, message_id) of each thread's first message that has one."""
    rows = found.where(F.col(name).isNotNull()).select("root", "place", F.struct("sender", F.col(name).alias("snippet"), "message_id").alias("m"))
    return rows.groupBy("root").agg(F.min_by("m", "place").alias("m")).select("root", "m.*")


def lessons(messages: DataFrame, threads: DataFrame) -> DataFrame:
    """One row a thread: problem and fix snippets, title, hints and completeness, numbered.

    The fix is looked for among the messages of others than the problem's
    author, unless the thread has none.
    """
    mine = messages.join(threads.select(F.col("thread_id").alias("root")), "root", "left_semi")
    # both patterns are looked for once, in one pass over the bodies; what is joined after that are snippets
    mine = cut(snippets(mine, {"problem": fixed.PROBLEM, "fix": fixed.CORRECTION}), "lesson-snippets")
    problem = first_snippet(mine, "problem").select("root", F.struct(F.col("sender").alias("from"), "snippet", "message_id").alias("problem"))
    with_author = mine.join(problem.select("root", F.col("problem.from").alias("author")), "root", "left")
    other = ~F.col("sender").eqNullSafe(F.col("author")) | (F.coalesce("author", F.lit("")) == "")
    others = with_author.where(other)
    alone = with_author.join(others.select("root").distinct(), "root", "left_anti")
    fix = first_snippet(others.unionByName(alone).drop("author"), "fix").select("root", F.struct(F.col("sender").alias("from"), "snippet", "message_id").alias("fix"))
    rows = numbered(threads).withColumn("root", F.col("thread_id")).join(problem, "root", "left").join(fix, "root", "left")
    has_problem, has_fix = F.coalesce(F.col("problem.snippet"), F.lit("")) != "", F.coalesce(F.col("fix.snippet"), F.lit("")) != ""
    files = F.size("files") > 0
    level = F.when(has_problem & has_fix, "complete").when(has_problem & files, "searchable").when(has_problem, "problem-only").otherwise("fragmentary")
    return rows.select(
        "lesson_id",
        "thread_id",
        text.lesson_title(F.col("subject"), F.col("thread_id"), has_problem, has_fix).alias("title"),
        "score",
        "score_cents",
        "categories",
        "problem",
        "fix",
        F.col("files").alias("mentioned_files"),
        F.col("commits").alias("mentioned_commits"),
        "source_refs",
        text.search_hints(F.col("categories"), F.col("files")).alias("codebase_search_hints"),
        F.struct(has_problem.alias("has_problem"), has_fix.alias("has_fix"), files.alias("has_file_refs"), (F.size("commits") > 0).alias("has_commit_refs"), level.alias("level")).alias("completeness"),
    )


def score_bands(threads: DataFrame, width: int = 10) -> DataFrame:
    """(low, n): threads by score in bands of so many hundredths; the full score is in the last band."""
    low = (F.least(F.col("score_cents"), F.lit(99)) / width).cast("int") * width
    return threads.groupBy(low.alias("low")).agg(F.count("*").alias("n"))


def completeness_counts(found: DataFrame) -> DataFrame:
    """(level, n) of lessons."""
    return found.groupBy(F.col("completeness.level").alias("level")).agg(F.count("*").alias("n"))


def distinct_categories(found: DataFrame) -> DataFrame:
    """(category) that any lesson has, once each."""
    return found.select(F.explode("categories").alias("category")).distinct()


def thread_totals(threads: DataFrame) -> DataFrame:
    """One row: threads, those whose messages come from several files, and their messages."""
    return threads.agg(F.count("*").alias("threads_created"), F.count_if(F.col("source_files") > 1).alias("cross_month_threads"), F.coalesce(F.sum("message_count"), F.lit(0)).alias("messages_threaded"))


def reduction(texts: DataFrame, before: str, after: str) -> DataFrame:
    """One row: bytes of two columns, and by how many per cent the second is less, to one decimal."""
    row = texts.agg(F.coalesce(F.sum(F.octet_length(before).cast("long")), F.lit(0)).alias("bytes_in"), F.coalesce(F.sum(F.octet_length(after).cast("long")), F.lit(0)).alias("bytes_out"))
    return row.withColumn("percent", F.when(F.col("bytes_in") > 0, F.round((F.col("bytes_in") - F.col("bytes_out")) * 100 / F.col("bytes_in"), 1)).otherwise(0.0))


def common_signals(found: DataFrame, top: int = 12) -> DataFrame:
    """(category, signal, n, rank): of each primary category the most frequent categories and snippet tokens of its lessons.

    Ties go to what was seen first over the lessons by falling score, then title.
    Tokens are counted before they are ranked, so a category's window holds its
    distinct tokens only.
    """
    base = found.select(text.primary_category(F.col("categories")).alias("category"), F.struct(-F.col("score_cents"), F.lower("title"), "lesson_id").alias("place"), F.concat("categories", F.coalesce(text.report_tokens(F.col("problem.snippet")), F.array().cast("array<string>"))).alias("signals"))
    each = base.select("category", "place", F.posexplode("signals").alias("at", "signal"))
    counted = each.groupBy("category", "signal").agg(F.count("*").alias("n"), F.min(F.struct("place", "at")).alias("first"))
    rank = F.row_number().over(W.partitionBy("category").orderBy(F.desc("n"), F.col("first")))
    return counted.withColumn("rank", rank).where(F.col("rank") <= top).select("category", "signal", "n", "rank")
