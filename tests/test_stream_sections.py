"""Sections that close themselves, whatever the order in which their pages land."""

import datetime as dt
import random

from pyspark.sql import functions as F

from noticeloom.operators import pages
from noticeloom.sources import buckets, keyed, writers
from noticeloom.streaming import sections

CUTOFF = dt.date(2026, 4, 1)
SCHEMA = "section string, run string, page long, html string"


def page(section: str, k: int, old: bool = False) -> str:
    item = lambda n, date: f'<a href="/x/{"jyxxgc" + section[2:]}/{n}.jhtml"><span>项目{n}</span> [太原] {date}</a>'
    return item(1000 * k + 1, "2026/05/01") + item(1000 * k + 2, "2026/01/01" if old else "2026/05/02")


def run(spark, folder, root, out, name):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)
    sections.store_sections(sections.page_items(stream, F.lit(CUTOFF)), root, out, writers.scratch(spark, name)).awaitTermination()


def stored(spark, out):
    got = keyed.read_keyed(spark, out)
    return set() if got is None else {(r.section, r.detail_url) for r in got.collect()}


def batch_rule(spark, rows):
    want = set()
    for s in {r[0] for r in rows}:
        df = spark.createDataFrame([r for r in rows if r[0] == s], SCHEMA)
        want |= {(s, r.detail_url) for r in pages.section_rows(df, s, F.lit(CUTOFF)).collect()}
    return want


def test_pages_in_any_order(spark):
    rows = [("gczb", "1", k, page("gczb", k, old=k == 4)) for k in range(1, 8)] + [("gchxr", "1", k, page("gchxr", k)) for k in range(1, 5) if k != 3]
    want = batch_rule(spark, rows)
    draw = random.Random(3)
    draw.shuffle(rows)
    folder, root, out = (writers.scratch(spark, x) for x in ("pages", "state", "items"))
    for i in range(0, len(rows), 3):
        spark.createDataFrame([*rows[i : i + 3], rows[0]], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, root, out, "p1")
    got = stored(spark, out)
    # page 3 of the second section never came: what is behind it waits
    assert got == {x for x in want if not (x[0] == "gchxr" and "/4001" in x[1] or x[0] == "gchxr" and "/4002" in x[1])}
    sections.flush(spark, root, out)
    assert stored(spark, out) == want
    left = buckets.read_buckets(spark, root)
    assert left.where("items IS NOT NULL").count() == 0 and left.count() == 10


def test_a_later_run_opens_a_section_anew(spark):
    folder, root, out = (writers.scratch(spark, x) for x in ("pages", "state", "items"))
    one = [("gczb", "1", 2, page("gczb", 2)), ("gczb", "1", 5, page("gczb", 5, old=True)), ("gczb", "1", 7, page("gczb", 7))]
    spark.createDataFrame(one, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, root, out, "p1")
    assert stored(spark, out) == set()
    spark.createDataFrame([("gczb", "2", 1, page("gczb", 9))], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, root, out, "p2")
    ids = sorted(int(u.rsplit("/", 1)[1].split(".")[0]) for _, u in stored(spark, out))
    assert ids == [2001, 2002, 5001, 9001, 9002]
