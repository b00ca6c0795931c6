"""Keyword search by an index, beside the rule over all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import projects, relations, search
from noticeloom.sources import writers

WORDS = ["公路", "工程", "招标", "Bridge", "监理", "采购", "100%达标", "a_b"]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(3000).select("id", F.concat(F.element_at(F.array(*map(F.lit, WORDS)), (F.col("id") % 8 + 1).cast("int")), F.element_at(F.array(*map(F.lit, WORDS)), (F.col("id") / 8 % 8 + 1).cast("int")), F.when(F.col("id") == 1234, "罕见词语").otherwise("")).alias("title"), F.lpad("id", 6, "0").alias("crawled_at"), F.lit("c").alias("category"), F.lit("t").alias("ann_type"))
    rows = rows.unionByName(spark.createDataFrame([(9001, None, "x", "c", "t"), (9002, "", "x", "c", "t"), (9003, "公", "x", "c", "t")], "id long, title string, crawled_at string, category string, ann_type string"))
    root = writers.scratch(spark, "index")
    for k in range(3):
        assert search.insert_indexed(rows.where(F.col("id") % 3 == k).repartition(4), root) == k + 1
    return rows, root


@pytest.mark.parametrize("keyword", ["公路", "公", "bridge", "路工", "公路%监理", "公_工", r"100\%", "%", "", "罕见词语", "没有这个", "BRIDGE招标", r"a\_b"])
def test_the_same_as_over_all_rows(spark, table, keyword):
    rows, root = table
    ids = lambda df: [r.id for r in df.collect()]
    assert ids(search.search(spark, root, keyword, limit=500)) == ids(relations.find_announcements(rows, keyword, limit=500))


def test_only_files_that_have_all_pairs_are_opened(spark, table):
    _, root = table
    assert len(search.candidate_files(spark, root, "罕见词语")) == 1 and search.candidate_files(spark, root, "没有这个") == []
    assert search.candidate_files(spark, root, "公") is None and len(search.candidate_files(spark, root, "公路")) == 12
    assert search.keyword_grams(r"ab%c_de\%f") == ["%f", "ab", "de", "e%"]


def test_history_of_the_last_days(spark):
    own = spark.createDataFrame([("大桥工程",)], "`项目名称` string")
    notices = spark.createDataFrame([("大桥工程招标", "2026-01-01", "招标公告"), ("大桥工程中标", "2010-01-01", "中标结果"), ("大桥工程变更", "无", "变更公告"), ("大桥工程更正", None, "变更公告")], "raw_title string, date string, channel string")
    day = F.lit(dt.date(2026, 6, 1))
    assert {r.raw_title for r in projects.history_of(own, notices, today=day).collect()} == {"大桥工程招标", "大桥工程变更", "大桥工程更正"}
    assert projects.history_of(own, notices).count() == 4 and projects.history_of(own, notices, today=day, days=10).count() == 2


def test_fill_ins_do_not_depend_on_the_order_of_rows(spark):
    main = spark.createDataFrame([(1, "")], "k int, v string")
    for rows in ([(1, "b"), (1, "a")], [(1, "a"), (1, "b")]):
        assert relations.filled(main, "k", [spark.createDataFrame(rows, "k int, v string")], ["v"]).first().v == "a"
