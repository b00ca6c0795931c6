"""Command line: look up and count stored announcements, collect landed list pages of chosen sections, run a registered query."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators import audit, pages, relations


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("noticeloom")
    does = p.add_subparsers(dest="does", required=True)
    q = does.add_parser("query", help="announcements by keyword, category and type, latest first")
    q.add_argument("table")
    q.add_argument("--keyword", default="")
    q.add_argument("--category", default="")
    q.add_argument("--type", default="", dest="ann_type")
    q.add_argument("--limit", type=int, default=20)
    s = does.add_parser("stats", help="announcements of each category and type")
    s.add_argument("table")
    c = does.add_parser("sections", help="items of landed list pages (section, page, html) of the last days")
    c.add_argument("pages")
    c.add_argument("--sections", default="", help="keys, comma-separated; all without")
    c.add_argument("--days", type=int, default=4)
    c.add_argument("--today", default=None, help="YYYY-MM-DD; the session's date without")
    return p


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.does == "query":
        return relations.find_announcements(spark.read.parquet(a.table), a.keyword, a.category, a.ann_type, a.limit)
    if a.does == "stats":
        return relations.announcement_counts(spark.read.parquet(a.table)).orderBy("category", "ann_type")
    landed = spark.read.parquet(a.pages)
    cutoff = F.date_sub(F.lit(a.today).cast("date") if a.today else F.current_date(), a.days)
    keys = pages.chosen_sections(a.sections)
    if not keys:
        raise SystemExit(f"no such section: {a.sections}")
    return audit.union_all([pages.section_rows(landed.where(F.col("section") == k), k, cutoff).withColumn("section", F.lit(k)) for k in keys])


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    run(SparkSession.builder.appName("noticeloom").getOrCreate(), a).show(1000, truncate=False)


if __name__ == "__main__":
    main()
