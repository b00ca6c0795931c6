"""An audit's log as text lines, and lines of such logs back into rows.

A line says what it is only together with the heading and the item above it. Every line gets its place in its file (the range that Spark's reader took
it from, and its number there), and what stood above it is carried along by ``ordered.last_before``: ranges of lines are looked through side by side, and
what was last before a range is added. So a log is read by as many tasks as it has ranges.

Lines of neither grammar are passed over; an issue without a project, or a link without a title since the last heading or link, is none; an empty file
gives nothing; rows that stand twice come back twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions.text import strip, text
from noticeloom.operators.ordered import last_before

# Headings of the two sections, and what begins their lines.
UNKNOWN_HEAD, ISSUES_HEAD = "【类型1】未识别公告", "【类型2】有链接但字段提取失败"
TITLE, LINK, PROJECT, ISSUE = "标题:", "链接:", "项目:", "- "
RULE = "-" * 40


def log_lines(unknown: DataFrame, issues: DataFrame, now: Column) -> DataFrame:
    """(part, place, value): the log of unknown notices (raw_title, link) and of issues (project, fields as an array), in the order of part and place."""
    spark = unknown.sparkSession
    line = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else text(p) for p in parts))
    head = unknown.agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), F.lit("").alias("place"), F.concat_ws("\n", F.lit("自检日志"), line("生成时间: ", F.date_format(now, "yyyy-MM-dd HH:mm:ss")), F.lit(""), line(f"{UNKNOWN_HEAD}（共", F.col("n"), "条）"), F.lit(RULE)).alias("value"))
    first = unknown.select(F.lit(1).alias("part"), text(F.col("link")).alias("place"), F.concat_ws("\n", line("  ", TITLE, " ", F.col("raw_title")), line("  ", LINK, " ", F.col("link")), F.lit("")).alias("value"))
    between = spark.range(1).select(F.lit(2).alias("part"), F.lit("").alias("place"), F.lit(f"\n{ISSUES_HEAD}\n{RULE}").alias("value"))
    second = issues.select(F.lit(3).alias("part"), text(F.col("project")).alias("place"), F.concat_ws("\n", line("  ", PROJECT, " ", F.col("project")), F.array_join(F.transform("fields", lambda f: F.concat(F.lit(f"    {ISSUE}"), text(f))), "\n"), F.lit("")).alias("value"))
    return head.unionByName(first).unionByName(between).unionByName(second)


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(unknown: file, pos, raw_title, link; issues: file, pos, project, issue) of the logs under a path; ``pos`` orders the rows of a file."""
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("pos"), strip(F.col("value")).alias("line"))
    begins = lambda w: F.startswith("line", F.lit(w))
    lines = lines.where(begins("【") | begins(TITLE) | begins(LINK) | begins(PROJECT) | begins(ISSUE))
    after = lambda w: strip(F.substring(F.col("line"), len(w) + 1, 1 << 30))
    # one carried value: heads, projects, titles and links follow each other; an issue stands under all of them
    kind = F.when(begins(UNKNOWN_HEAD), "unknown").when(begins(ISSUES_HEAD), "issues").when(begins("【"), "other")
    lines = lines.withColumn("head", F.when(begins("【"), F.struct("pos", kind.alias("kind")))).withColumn("item", F.when(~begins(ISSUE), F.struct("pos", F.when(begins(TITLE), "title").when(begins(PROJECT), "project").otherwise("").alias("kind"), F.when(begins(TITLE), after(TITLE)).when(begins(PROJECT), after(PROJECT)).alias("said"))))
    seen = last_before(last_before(lines, ["file"], "pos", "head", "under"), ["file"], "pos", "item", "behind")
    unknown = seen.where(begins(LINK) & (F.col("under.kind") == "unknown") & (F.col("behind.kind") == "title")).select("file", "pos", F.col("behind.said").alias("raw_title"), after(LINK).alias("link")).where("raw_title <> '' AND link <> ''")
    # titles and links within the issues' section are no projects: the last of all items decides, as a heading does
    issues = seen.where(begins(ISSUE) & (F.col("under.kind") == "issues") & (F.col("behind.kind") == "project")).select("file", "pos", F.col("behind.said").alias("project"), after(ISSUE).alias("issue"))
    return unknown, issues
