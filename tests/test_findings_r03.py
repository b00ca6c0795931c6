"""What the third round's findings named."""

from noticeloom.functions import scan
from noticeloom.llm import decontam
from noticeloom.operators import pages, relations
from noticeloom.plans import catalogue, roundtrips
from noticeloom.sources.pdf import Font


def test_a_range_of_codes_is_worked_out_as_it_is_asked_for():
    font = Font(width=2, known=False, codes={5: "x"})
    font.put_range(0, 65535, b"\x00\x00")
    font.codes[0x62DB] = "y"
    assert len(font.codes) == 1 and font.text("招标\x05".encode("utf-16-be")) == "y标\x05" and len(font.codes) == 3
    font.put_range(0x41, 0x42, b"\x00\x61")
    assert font.text("ABC".encode("utf-16-be")) == "abC"


def test_probe_titles_resolve_one_reference_alone(spark, tmp_path):
    html = "<html><head><title> a&amp &quot;b &amp;amp;  c&amp;</title></head></html>"
    spark.createDataFrame([(1, html), (2, "<h1>x &lt</h1>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in roundtrips.probe_titles(spark, str(tmp_path)).collect()}
    assert got == {1: "a&amp &quot;b &amp; c&", 2: "x &lt"}


def test_long_runs_of_names_and_digits_do_not_deepen_the_stack(spark):
    names, digits = "a " + "Bc " * 200_000, "1.2," * 200_000
    docs = spark.createDataFrame([(1, names), (2, digits), (3, names + digits)], "doc_id long, text string")
    rows = docs.select(decontam.template(decontam.F.col("text")).alias("t"), decontam._words(decontam.F.col("text")).alias("w")).collect()
    assert [len(r.w) for r in rows] == [200_001, 1, 200_002] and all(r.t for r in rows)


def test_rows_are_dealt_out_whatever_the_splits(spark):
    many = spark.range(0, 100, 1, 8)
    assert relations.spread(many).rdd.getNumPartitions() >= 32 and relations.spread(many.coalesce(1)).rdd.getNumPartitions() >= 16


def test_list_pages_are_parsed_once_on_each_side_and_behind_the_exchange(spark):
    rows = relations.spread(spark.createDataFrame([("u", "c", 1, "<p>")], "url string, channel string, page int, html string"))
    plan = pages.list_rows(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2


def test_labels_that_a_notice_lacks_are_not_looked_for(monkeypatch):
    lines = ["招标人：甲", "地址： 某路", "续", "电话：1"]
    asked = []
    behind = scan.Dialect.behind
    monkeypatch.setattr(scan.Dialect, "behind", lambda self, label, line: asked.append(label) or behind(self, label, line))
    assert scan.labelled(lines, ["开标时间", "地址"]) == "某路 续" and set(asked) == {"地址"}
    assert scan.labelled(lines, ["开标时间"]) == "" and scan.block(lines, ["地址"], ["无"]) == lines[1:] and scan.block(lines, ["无"], []) == []


def test_issues_are_counted_where_they_arise(spark, tmp_path):
    spark.range(5).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    plan = catalogue.audit_issues(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not [x for x in plan if "Exchange hashpartitioning(" in x and "issue#" in x and "项目名称#" in x]
