"""The mail pipeline as one plan: archives to records, threads, lessons and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import mail
from siltstone.lineage import cut
from siltstone.operators import threads
from siltstone.sources import corpus, sinks


def stages(parsed: DataFrame, threshold: int = 30) -> dict[str, DataFrame]:
    """messages, threads, passing and lessons from parsed records; each is written once and read by the next."""
    parsed = cut(parsed, "mail-parsed")
    primary = cut(mail.for_threads(parsed), "mail-primary")
    rooted = cut(primary.join(threads.roots(primary.select("id", "parent", "ordinal")), "id"), "mail-rooted")
    every = cut(threads.rollup(rooted), "mail-threads")
    kept = threads.passing(every, threshold)
    return {"messages": parsed, "rooted": rooted, "threads": every, "passing": kept, "lessons": cut(threads.lessons(rooted, kept), "mail-lessons")}


def run(spark: SparkSession, root: str, out: str, prefixes: dict[str, str] | None = None, seed: int = 13) -> dict[str, DataFrame]:
    """Process the archives below root and write every stage below out."""
    s = stages(corpus.parsed_archives(spark, root, prefixes))
    for kind in ("primary", "sidelined", "dropped"):
        sinks.json_lines(s["messages"].where(F.col("disposition") == kind), f"{out}/parsed/messages-{kind}")
    sinks.json_lines(mail.parse_stats(s["messages"]), f"{out}/parsed/stats")
    sinks.json_lines(s["threads"], f"{out}/threaded/threads")
    sinks.json_lines(s["passing"], f"{out}/scored/threads-passing")
    sinks.json_lines(s["lessons"], f"{out}/lessons/lesson_candidates")
    sinks.samples_report(s["lessons"], "lesson_id", seed, f"{out}/lessons/samples.md")
    sinks.problem_report(threads.common_signals(s["lessons"]), s["lessons"], f"{out}/reports/common-problems.md")
    sinks.search_guide(s["lessons"], f"{out}/reports/search-guide.md")
    return s
