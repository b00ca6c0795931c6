"""Sections that close themselves in a stream: the first list page with an older item, or the last by its size, is a section's end.

Pages land in any order, so a page's items may only be stored when all pages before it are there and none of them was the end. What has landed is a
table in buckets by section: a batch adds its pages, finds for each section and run how far they go without a gap, stores the items of pages up to there
or to the end, and forgets the items of these and of pages behind the end. A later run of a section opens it anew and ends the run before: whatever stands behind a gap
then is stored up to the end, as the batch rule does it. ``flush`` does the same for all.

A batch that is run again, or a page that lands twice, changes nothing: pages are known by section, run and page, items are stored once by their key. Rows without a
section or page are left out. Pages count from ``first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import unescape
from noticeloom.functions.values import detail_url, list_date
from noticeloom.operators.pages import section_links
from noticeloom.sources import buckets, keyed


def page_items(landed: DataFrame, cutoff: Column, sections: list[str] | None = None) -> DataFrame:
    """section, run, page, closes, items of landed list pages (section, run, page, html): stateless, for streams and batches alike."""
    links = F.coalesce(*(F.when(F.col("section") == s, section_links(F.col("html"), V.SECTIONS[s][1])) for s in sections or V.SECTIONS))
    dated = F.transform(F.coalesce(links, F.array()), lambda x: F.struct(x["detail_id"].alias("detail_id"), x["title"].alias("title"), x["place"].alias("place"), x["date"].alias("date"), F.coalesce(list_date(x["date"]) < cutoff, F.lit(False)).alias("old")))
    rows = landed.where("section IS NOT NULL AND page IS NOT NULL").select("section", F.coalesce("run", F.lit("")).alias("run"), F.col("page").cast("long").alias("page"), dated.alias("_all"))
    return rows.select("section", "run", "page", F.exists("_all", lambda x: x["old"]).alias("closes"), F.filter("_all", lambda x: ~x["old"]).alias("items"))


def _ready(pages: DataFrame, first: int, over: bool) -> DataFrame:
    """Pages with ``end`` (the page behind which nothing counts, if it is known) and ``upto`` (how far items may be stored)."""
    own = Window.partitionBy("section", "run")
    whole = F.row_number().over(own.orderBy("page")) == F.col("page") - first + 1
    rows = pages.withColumn("_whole", whole).withColumn("_run_over", F.lit(over) | (F.col("run") < F.max("run").over(Window.partitionBy("section"))))
    counts = F.col("closes") & (F.col("_whole") | F.col("_run_over"))
    rows = rows.withColumn("end", F.min(F.when(counts, F.col("page"))).over(own)).withColumn("_far", F.max(F.when(F.col("_whole"), F.col("page"))).over(own))
    upto = F.when(F.col("_run_over"), F.coalesce("end", F.lit((1 << 63) - 1))).otherwise(F.least("_far", "end"))
    return rows.withColumn("upto", upto).drop("_whole", "_run_over", "_far")


def _store(spark: SparkSession, root: str, out: str, sections: DataFrame, first: int, over: bool) -> None:
    """Store the items that may be stored, then forget those and what lies behind an end."""
    state = _ready(buckets.read_buckets(spark, root).join(sections.select("section").distinct(), "section"), first, over)
    items = state.where("items IS NOT NULL AND page <= upto").select("section", "page", F.posexplode("items").alias("pos", "i")).select("section", "page", "pos", "i.detail_id", unescape(F.col("i.title")).alias("title"), F.col("i.place").alias("place"), F.translate("i.date", "/", "-").alias("date"))
    urls = items.select("*", F.coalesce(*(F.when(F.col("section") == s, detail_url(F.lit(s), F.col("detail_id"))) for s in V.SECTIONS)).alias("detail_url"))
    keyed.insert_once(urls, out, ["page", "pos"], key="detail_url")

    def forget(old: DataFrame, _: DataFrame) -> DataFrame:
        known = _ready(old, first, over)
        return known.select("section", "run", "page", "closes", F.when((F.col("page") <= F.coalesce("upto", F.lit(first - 1))) | (F.col("page") > F.coalesce("end", F.lit((1 << 63) - 1))), None).otherwise(F.col("items")).alias("items"))

    buckets.merge_batch(sections.select("section").distinct(), root, "section", forget)


def store_sections(pages: DataFrame, root: str, out: str, checkpoint: str, first: int = 1):
    """Start the stream: ``pages`` as ``page_items`` makes them, ``root`` the table of what has landed, ``out`` the items (``keyed`` table)."""

    def add(old: DataFrame, batch: DataFrame) -> DataFrame:
        known = old.unionByName(batch.join(old.select("section", "run", "page"), ["section", "run", "page"], "left_anti").dropDuplicates(["section", "run", "page"]))
        return known

    def one(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        buckets.merge_batch(batch, root, "section", add, n=16)
        _store(batch.sparkSession, root, out, batch, first, False)
        batch.unpersist()

    return pages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def flush(spark: SparkSession, root: str, out: str, first: int = 1) -> None:
    """End all runs: what stands behind a gap is stored up to its section's end."""
    table = buckets.read_buckets(spark, root)
    if table is not None:
        _store(spark, root, out, table.select("section").distinct(), first, True)
