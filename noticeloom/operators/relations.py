"""Rows with rows: fill-ins, first of a group, lookups of announcements, and inserts that happen once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import first_of, text


def spread(rows: DataFrame, pieces: int = 4, by: str | None = None) -> DataFrame:
    """Rows of a scan dealt to all cores, ``pieces`` for each core or each split of the scan, ahead of costly work on every row. Splits do not tell
    how rows lie: a row group is read by one of them whole, so a table of one row group comes as one full piece and empty ones. Named
    as a number, so that pieces which are small in bytes and long in work are not put together again. ``by``: rows of an equal value together."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return rows.repartition(pieces * n, by) if by else rows.repartition(pieces * n)


#: Rows up to which a table that others are joined to is broadcast.
FEW_ROWS = 100_000


def spread_join(rows: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """``rows`` with the rows of ``other`` that have their key, dealt to all cores as ``spread`` does. Few rows are broadcast; beyond that the join's
    exchange is what deals the rows: they are written to disk once, where a deal ahead of the join would write them twice."""
    on = F.col(key) == F.col(other_key)
    if other.count() <= FEW_ROWS:
        return spread(rows).join(F.broadcast(other), on)
    return spread(rows, by=key).join(other.hint("merge"), on)


def first_k(rows: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each group; Spark prunes to k in the map tasks."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def ranked_k(rows: DataFrame, group: list[str], order: list[str], k: int, rank: str) -> DataFrame:
    """The first k rows of each group with their rank."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def top_n(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """A sort with a limit is one top-n: no full sort, no full shuffle."""
    return rows.orderBy(*order).limit(n)


def filled(main: DataFrame, key: str, sources: list[DataFrame], columns: list[str], order: str | None = None) -> DataFrame:
    """``main`` with ``columns`` from the first source that has a value, main's own first, then each of ``sources`` in turn. Of several
    rows of a source for a key the one counts whose values come first in their order, whatever order the rows come in."""
    out = main
    for i, s in enumerate(sources):
        own = [c for c in columns if c in s.columns]
        one = s.groupBy(key).agg(F.min(F.struct(*(F.col(c).alias(f"_{i}_{c}") for c in own))).alias("_one")) if own else s.select(key).distinct()
        out = out.join(one.select(key, "_one.*") if own else one, key, "left")

    def pick(c: str) -> Column:
        own = [F.col(c)] if c in main.columns else []
        return first_of(*(text(x) for x in own), *(text(F.col(f"_{i}_{c}")) for i, s in enumerate(sources) if c in s.columns)).alias(c)

    got = out.select(*(F.col(c) for c in main.columns if c not in columns), *(pick(c) for c in columns))
    return got.orderBy(order) if order else got


def distinct_items(items: DataFrame, order: list[str], link: str = "link", title: str = "raw_title") -> DataFrame:
    """Each link once, or title where there is no link; the first in ``order`` stays."""
    key = first_of(text(F.col(link)), text(F.col(title)))
    return first_k(items.withColumn("_key", key), ["_key"], order, 1).drop("_key")


def not_in(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been seen."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def insert_if_absent(existing: DataFrame, new: DataFrame, order: list[str], key: str = "url") -> DataFrame:
    """The rows of ``new`` that an insert keeps: unknown keys, of each the first. What was written first stays for ever."""
    return not_in(first_k(new.where(F.col(key).isNotNull()), [key], order, 1), existing, key)


def as_announcements(items: DataFrame, now: Column) -> DataFrame:
    """Any items as rows of the announcement table: missing columns empty, status valid, stamped with ``now``."""
    fixed = {"status": F.lit("有效"), "crawled_at": F.date_format(now, "yyyy-MM-dd HH:mm:ss")}
    return items.select(*((F.coalesce(text(F.col(c)), fixed.get(c, F.lit(""))) if c in items.columns else fixed.get(c, F.lit(""))).alias(c) for c in V.ANNOUNCEMENT_COLUMNS))


def find_announcements(rows: DataFrame, keyword: str = "", category: str = "", ann_type: str = "", limit: int = 20) -> DataFrame:
    """Announcements with a keyword in the title (``%`` and ``_`` are wildcards, case ignored), of a category and a type, latest first."""
    tests = [F.col("title").ilike(f"%{keyword}%")] if keyword else []
    tests += [F.col(c) == v for c, v in (("category", category), ("ann_type", ann_type)) if v]
    kept = rows.where(reduce(lambda a, b: a & b, tests)) if tests else rows
    tie = "id" if "id" in rows.columns else "url"
    return top_n(kept, [F.col("crawled_at").desc(), F.col(tie)], limit)


def announcement_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category", "ann_type").agg(F.count("*").alias("cnt"))


def crawl_log(items: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """New rows of each category and page, zeros included."""
    n = items.select("category", "page", "url").distinct().join(new.select("url").distinct().withColumn("_new", F.lit(1)), "url", "left")
    return n.groupBy("category", "page").agg(F.coalesce(F.sum("_new"), F.lit(0)).alias("count")).withColumn("run_at", F.date_format(now, "yyyy-MM-dd HH:mm:ss"))


def recent(rows: DataFrame, date: str, today: Column, days: int) -> DataFrame:
    """Rows of the last ``days`` days; those without a date stay."""
    return rows.where(F.col(date).isNull() | (F.col(date) >= F.date_sub(today, days)))


def attachments(details: DataFrame, texts: DataFrame) -> DataFrame:
    """The attachments of portal details (d), each id once, with their extracted text (file_id, text) where there is one."""
    own = F.array(F.struct(text(F.col("d.fileId")).alias("file_id"), text(F.col("d.fileName")).alias("name")), F.struct(text(F.col("d.pdfFile")).alias("file_id"), F.lit("").alias("name")))
    parts = F.flatten(F.transform(F.coalesce(F.col("d.bidAnnouncementSectionDOS"), F.array()), lambda x: F.array(F.struct(text(x["fileId"]).alias("file_id"), text(x["fileName"]).alias("name")), F.struct(text(x["pdfFile"]).alias("file_id"), text(x["sectionName"]).alias("name")))))
    rows = details.select(F.col("d.annId").alias("annId"), F.posexplode(F.concat(own, parts)).alias("pos", "a")).select("annId", "pos", "a.*").where("file_id <> ''")
    return first_k(rows, ["annId", "file_id"], ["pos"], 1).join(texts, "file_id", "left")
