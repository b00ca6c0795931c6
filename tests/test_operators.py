import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.operators import audit, enrich, extract, pages, projects, relations
from noticeloom.sources import readers, writers
from noticeloom.streaming import incremental

LIST = '<div class="cs_two_content"><a class="cs_two_c_2" href="/jyxxgczb/1.jhtml"><p class="cs_bz_cont">甲工程招标公告</p><span class="cs_bz_cont_1_time">2026-06-20</span><p class="cs_bz_cont_1"><span>交易场所：太原市</span></p></a><a class="cs_two_c_2"><p class="cs_bz_cont">无链接</p></a></div>'


def test_list_pages_stop_at_the_first_empty_page(spark):
    rows = [("u", "招标公告", 1, LIST), ("u", "招标公告", 2, "<p>"), ("u", "招标公告", 3, LIST), ("u", "变更公告", 1, None)]
    got = pages.list_rows(spark.createDataFrame(rows, "url string, channel string, page int, html string")).collect()
    assert [(r.title, r.link, r.date, r.place, r.ann_type) for r in got] == [("甲工程", "https://prec.sxzwfw.gov.cn/jyxxgczb/1.jhtml", "2026-06-20", "太原市", "招标公告")]


def test_section_pages_stop_after_an_old_item_and_keep_undated_ones(spark):
    a = lambda i, d: f'<a href="/jyxxgczb/{i}.jhtml"><i>工程{i}</i> [某地] {d}</a>'
    rows = [(1, a(1, "2026-06-20") + a(2, "2026-01-01") + a(3, "")), (2, a(4, "2026-06-20"))]
    got = pages.section_rows(spark.createDataFrame(rows, "page int, html string"), "gczb", F.lit("2026-06-01").cast("date")).collect()
    assert sorted((r.detail_id, r.place) for r in got) == [("1", "某地"), ("3", "某地")]


def test_markup(one):
    assert one(pages.table_pairs, "<table class=bid_msgTable><tr><td><b>项目类型（a）：</b><td>房建<td><b>招标方式</b></table>") == {"项目类型": "房建", "招标方式": ""}
    assert one(pages.candidate_names, "<table><tr><th>序号<th>中标候选人名称<tr><td>1<td>甲公司<tr><td>2<td>乙公司</table>") == ["甲公司", "乙公司"]
    assert one(pages.file_url, "<a href=b.pdf>x</a><iframe src='//h/a.PDF'>", "http://x/") == "https://h/a.PDF"
    assert one(pages.content_text, "<table class='gycq-table'><tr><td>甲　乙<br>丙</td></tr></table>") == "甲 乙\n丙"
    assert one(pages.body_text, "<div class='div-article2'>a  b<script>x</script><p>c</div>") == "a b\nc"
    assert one(pages.page_title, "<h1>短</h1><p style='text-align:center'>某某工程公告</p>") == "某某工程公告"
    assert one(lambda c: pages.main_content(c)["source"], "<nav>n</nav><div class=content>" + "字" * 300 + "</div>") == ".content"
    assert one(pages.file_links, "<a href='/download?id=1'>附件</a><a href='javascript:x'>附件</a> /y.pdf", "http://h/a") == ["http://h/download?id=1", "http://h/y.pdf"]
    for f in (pages.table_pairs, pages.candidate_names, pages.content_text, pages.body_text, pages.page_title, pages.list_items, pages.frame_items):
        one(f, None), one(f, ""), one(f, "<div><p>" * 3000)


def test_file_ids_and_page_counts(one):
    assert one(pages.file_ids, "openFileById?fileType=2&id=ab1") == ("2", "ab1") and one(pages.file_ids, "x") is None
    assert one(pages.total_pages, "共 <label> 7 </label> 页") == 7 and one(pages.total_pages, None) == 1


def test_matches_prefer_the_equal_name_and_need_five_characters(spark):
    names = spark.createDataFrame([("甲乙丙丁戊己", 0), ("甲乙丙丁戊", 1), ("短名", 2)], "n string, o int")
    probes = spark.createDataFrame([("甲乙丙丁戊",), ("前甲乙丙丁戊己后",), ("短名字",), ("短名",), (None,)], "p string")
    got = {r.p: r.o for r in projects.blocked_matches(probes, names, "p", "n", "o").collect()}
    assert got == {"甲乙丙丁戊": 1, "前甲乙丙丁戊己后": 0, "短名": 2}


def _history(spark):
    rows = [
        ("P", "招标计划", 1, "P招标计划", "l1", "2026-06-01", None, None, "无", None),
        ("P", "招标公告", 2, "P招标公告", "l2", "2026-06-02", None, "t1", "a", "正文"),
        ("P", "招标公告", 3, "P二次招标公告", "l3", "2026-06-03", None, "t2", "b", "正文2"),
        ("P", "变更公告", 4, "P延期公告", "l4", None, None, "t3", "c", None),
        ("P", "中标结果", 5, "P中标结果公示", "l5", "2026-06-05", None, "t4", "d", None),
    ]
    return spark.createDataFrame(rows, "project string, channel string, pos int, raw_title string, link string, date string, kind string, `开标时间` string, `招标人` string, `公告内容` string")


def test_project_rows_merge_by_stage(spark):
    (r,) = projects.project_rows(_history(spark)).collect()
    assert (r["开标时间"], r["招标人"], r["公告内容"]) == ("t1", "d", "正文")
    assert r["公告类型"] == "招标计划；招标公告；延期公告；中标结果公示" and r["发布日期"] == "招标计划-2026.6.1；招标公告-2026.6.2；中标结果公示-2026.6.5"
    assert r["公告历史"].split("；") == ["P招标计划|l1", "P招标公告|l2", "P延期公告|l4", "P中标结果公示|l5"] and r["发布网站"] == V.SITE_NAME
    assert list(r.asDict()) == V.PROJECT_COLUMNS


def test_audit_names_a_field_twice_when_both_rules_fire(spark):
    rows = projects.as_projects(spark.createDataFrame([("P", "招标公告；中标结果公示", "局")], "`项目名称` string, `公告类型` string, `监督部门` string"))
    got = [r.issue for r in audit.issues(rows).collect()]
    assert got.count("监督部门联系方式未提取") == 2 and "监督部门未提取" not in got
    assert [r.issue for r in audit.issues(rows, distinct=True).collect()].count("监督部门联系方式未提取") == 1


def test_repair_fills_only_what_is_empty(spark):
    rows = spark.createDataFrame([("", "X12345", "（招标编号：AB-99999） 中标人：甲公司\n"), ("名", "", "招标编号：AB-99999 一、"), ("", "", None)], "`中标人` string, `招标编号` string, `全文文本` string")
    got = extract.repaired(rows, "gcgs").collect()
    assert [(r["中标人"], r["招标编号"], r.changed) for r in got] == [("甲公司", "X12345", ["中标人"]), ("名", "AB-99999", ["招标编号"]), ("", "", [])]


def test_portal_records_and_attachments(spark):
    d = {"annTitle": "某工程", "annContent": "<p>2.1 项目规模：大</p><p>五、联系方式</p><p>招标代理机构：乙</p><p>地址：某路</p>", "bidAnnouncementSectionDOS": [{"sectionCode": "001", "documentPrice": "5", "fileId": "f1"}], "documentPriceWay": "2"}
    rows = extract.portal_details(spark.createDataFrame([(json.dumps(d, ensure_ascii=False),), ("broken",)], "json string"))
    att = rows.withColumn("attachments", F.array(F.struct(F.lit("件").alias("name"), F.lit("字" * 30).alias("text"))))
    for kind, fields in extract.PORTAL_FIELDS.items():
        got = extract.portal_records(att, kind).collect()
        assert got[0].__fields__ == fields and len(got) == 2
    r = extract.portal_records(rows, "zbgg").first()
    assert r["项目规模"] == "大" and r["招标代理机构地址"] == "某路" and r["发布网站"] == V.PORTAL_SITE
    assert rows.select(extract.section_prices().alias("p")).first().p == "001标段 5元(人民币)"
    assert [x.file_id for x in relations.attachments(rows, spark.createDataFrame([("f1", "t")], "file_id string, text string")).collect()] == ["f1"]


def test_section_records(spark):
    html = "<a class=cs_dyk>某某工程招标公告</a>发布日期：2026-06-20 10:00 信息来源：太原<div class='div-article2'>招标公告\n招标人：甲公司\n地 址：某路 电话：1\n所属行业：房建。</div>"
    plan = "<title>某计划-山西省公共资源交易平台</title><table class=bid_msgTable><tr><td><b>项目类型</b><td>水利</table>"
    got = extract.section_records(spark.createDataFrame([("u", "1", html, False), ("v", "2", plan, True)], "url string, detail_id string, html string, plan boolean")).collect()
    assert got[0]["项目名称"] == "某某工程招标公告" and got[0]["所属行业"] == "房建" and got[0]["招标人地址"] == "某路" and got[0]["公共类型"] == "招标公告"
    assert got[1]["所属行业"] == "水利" and got[1]["项目名称"] == "某计划"


def test_announcement_details(spark):
    html = "<div class=cs_xq_content>招标编号：AB-1 估算金额：500万元 招标人：甲公司 地址</div>"
    r = extract.announcement_details(spark.createDataFrame([("u", html, "招标公告")], "url string, html string, ann_type string")).first()
    assert (r.project_no, r.budget, r.tenderee) == ("AB-1", "500万元", "甲公司 ") or r.tenderee == "甲公司"


def test_model_seam(spark):
    items = spark.createDataFrame([("l", "某工程招标公告")], "link string, raw_title string")
    assert enrich.model_kinds(items).first().kind == "notice"
    assert enrich.model_kinds(items, lambda p: '```json\n{"type": "result", "confidence": 0.5}\n```').first().kind == "result"
    assert enrich.model_kinds(items, lambda p: "no").first().kind == "unknown"
    page = spark.createDataFrame([("P", "l", "t", ["招标人", "开标时间"])], "project string, link string, text string, fields array<string>")
    answers = enrich.model_fields(page, lambda p: '{"招标人": ["甲", "乙"], "开标时间": null, "x": 1}')
    assert answers.first()["values"] == {"招标人": "甲、乙"}
    rows = projects.as_projects(spark.createDataFrame([("P", "旧")], "`项目名称` string, `开标时间` string"))
    r = enrich.supplemented(rows, answers).first()
    assert (r["招标人"], r["开标时间"]) == ("甲、乙", "旧")


def test_csv_json_and_snapshots_round_trip(spark, tmp_path):
    rows = projects.project_rows(_history(spark))
    writers.write_csv(rows, f"{tmp_path}/csv", V.PROJECT_COLUMNS, V.DEFAULT)
    got = readers.read_projects(spark, f"{tmp_path}/csv").first()
    assert got["公告内容"] == "正文" and got["监督部门"] is None and got["公告类型"].startswith("招标计划")
    assert writers.read_snapshot(spark, f"{tmp_path}/s") is None
    writers.write_snapshot(rows, f"{tmp_path}/s")
    writers.write_snapshot(rows.limit(0), f"{tmp_path}/s")
    assert writers.read_snapshot(spark, f"{tmp_path}/s").count() == 0
    writers.write_by_kind(spark.createDataFrame([("a", "x")], "_subtype_ string, `项目名称` string"), f"{tmp_path}/k", {"a": ["项目名称"], "b": ["项目名称"]})
    assert spark.read.json(f"{tmp_path}/k/a/json").count() == 1
    writers.write_envelope(rows, f"{tmp_path}/e", "s", F.lit(dt.datetime(2026, 6, 1)), 3, V.SECTION_FIELDS)
    assert spark.read.json(f"{tmp_path}/e/metadata").first().total_count == 1
    writers.write_lines(audit.index_lines(rows, F.lit(1)), f"{tmp_path}/t")


def test_files_by_magic_and_chain_of_extractors(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"<html>")

    def broken(_):
        raise ValueError

    got = readers.file_texts(readers.read_files(spark, str(tmp_path)), broken, lambda b: "文" + b[5:8].decode()).collect()
    assert [r.text for r in got] == ["文1.4"]


def test_streams_store_once(spark, tmp_path):
    land, table = f"{tmp_path}/land", f"{tmp_path}/table"
    rows = spark.createDataFrame([("u1", "c", 1, "h", dt.datetime(2026, 6, 1)), ("u1", "c", 2, "h", dt.datetime(2026, 6, 1)), ("u2", "c", 1, "h", dt.datetime(2026, 6, 1))], readers.LIST_PAGES)
    for _ in range(2):
        rows.write.mode("append").parquet(land)
        incremental.store_announcements(incremental.landed(spark, land), table, f"{tmp_path}/cp", ["page"]).awaitTermination()
    assert sorted((r.url, r.page) for r in spark.read.parquet(table).collect()) == [("u1", 1), ("u2", 1)]
    assert incremental.once_by_url(incremental.landed(spark, land)).isStreaming


def test_store_and_counts(spark):
    items = spark.createDataFrame([("u1", "甲Abc", 1), ("u1", "乙", 2), (None, "丙", 3)], "url string, title string, pos int")
    new = relations.insert_if_absent(items.limit(0), items, ["pos"])
    assert [(r.url, r.title) for r in new.collect()] == [("u1", "甲Abc")]
    rows = relations.as_announcements(new, F.lit(dt.datetime(2026, 6, 1)))
    assert rows.columns == V.ANNOUNCEMENT_COLUMNS and relations.find_announcements(rows, "ABC").count() == 1
    assert relations.find_announcements(rows, "a_c").count() == 1 and relations.find_announcements(rows, "x").count() == 0
    assert relations.announcement_counts(rows).first().cnt == 1


@pytest.mark.parametrize("mode, want", [("replace", "无"), ("fill", "旧"), ("merge", "旧")])
def test_upserts(spark, mode, want):
    old = spark.createDataFrame([("P", "旧", "招标计划")], "`项目名称` string, `招标人` string, `公告类型` string")
    new = spark.createDataFrame([("P", "无", "招标公告"), ("Q", "新", "招标公告")], old.schema)
    got = {r["项目名称"]: r for r in projects.upsert(old, new, mode).collect()}
    assert got["P"]["招标人"] == want and got["Q"]["招标人"] == "新"
    if mode != "replace":
        assert got["P"]["公告类型"] == "招标计划；招标公告"


def test_notice_records(spark):
    t = "八、监督部门\n监督部门：某局\n电话：0351-1234567\n九、联系方式\n招标人：甲\n地址：乙路\n招标代理机构：丙\n电话：1"
    r = extract.notice_records(spark.createDataFrame([(1, t), (2, None)], "i int, text string")).collect()
    assert (r[0]["招标人"], r[0]["招标人地址"], r[0]["招标代理机构"], r[0]["监督部门"], r[0]["监督部门联系方式"]) == ("甲", "乙路", "丙", "某局", "0351-1234567")
    assert r[1]["公告内容"] == r[1]["招标人"] == "无" and set(V.NOTICE_REQUIRED) <= set(r[0].asDict())


def test_titles_lose_all_their_suffixes(one):
    from noticeloom.functions import titles

    assert one(titles.canonical_title, "某工程" + "招标公告" * 5) == "某工程"
    assert one(titles.canonical_title, "某工程招标公告 变更公告　中标结果公示。") == "某工程"
    assert one(titles.canonical_title, "招标公告招标公告") == "招标公告招标公告"


def test_a_common_beginning_finds_nobody(spark):
    """All names begin alike; each is found by what is its own, and no pair is compared for the beginning's sake."""
    names = spark.range(4000).select(F.concat(F.lit("山西省太原市某某区第"), F.col("id").cast("string"), F.lit("号工程")).alias("n"), F.col("id").alias("o"))
    probes = names.select(F.concat("n", F.lit("施工")).alias("p"))
    pairs = projects.containing(names, probes, "n", "p", 5)
    assert pairs.count() == 4000
    got = projects.blocked_matches(probes, names, "p", "n", "o")
    assert got.count() == 4000 and got.where(~F.contains("p", F.concat(F.lit("第"), F.col("o").cast("string"), F.lit("号")))).count() == 0


def test_history_from_a_stage_on(spark):
    own = spark.createDataFrame([("甲乙丙丁工程",), ("短",), (None,)], "`项目名称` string")
    notices = spark.createDataFrame([("某甲乙丙丁工程招标计划", "招标计划"), ("甲乙丙丁工程变更公告", "变更公告"), ("甲乙丙丁工程", "其他栏目"), (None, "变更公告")], "raw_title string, channel string")
    assert projects.history_of(own, notices).count() == 3
    assert sorted(r.channel for r in projects.history_of(own, notices, from_step=3).collect()) == ["其他栏目", "变更公告"]


def test_a_write_that_breaks_off_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert writers.read_snapshot(spark, root) is None
    writers.write_snapshot(spark.range(3), root)
    # the version is written, its commit is not
    monkeypatch.setattr(writers, "_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        writers.write_snapshot(spark.range(5), root)
    monkeypatch.undo()
    assert writers.read_snapshot(spark, root).count() == 3
    writers.write_snapshot(spark.range(7), root)
    assert writers.read_snapshot(spark, root).count() == 7


def test_broken_tables_are_set_aside(spark, tmp_path):
    path = tmp_path / "p.csv"
    assert readers.read_projects_or_set_aside(spark, str(path), "1").count() == 0
    path.write_bytes(b"\x00\x01 no table\n\xff")
    assert readers.read_projects_or_set_aside(spark, str(path), "20260601").count() == 0
    assert not path.exists() and (tmp_path / "p.csv.bad_20260601").exists()
    path.write_text("﻿项目名称,招标人\n甲,无\n")
    assert [(r["项目名称"], r["招标人"]) for r in readers.read_projects_or_set_aside(spark, str(path), "1").collect()] == [("甲", None)]


def test_counts_are_ordered_and_first_seen_breaks_ties(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 5), ("b", 4), ("c", 3), ("", 6)], "`公共类型` string, i int")
    assert [r[0] for r in audit.kind_counts(rows, order="i").collect()] == ["b", "a", "c", "未识别"]
    assert [r[0] for r in audit.place_counts(rows, "公共类型").collect()] == ["a", "b", "", "c"]


def test_lists_end_by_their_count(spark):
    pad = "x" * 120
    rows = [("u", "c", i, LIST + pad + f",count: {n}") for i, n in ((1, 25), (2, 25), (3, 25), (4, 25))] + [("u", "d", 1, LIST + pad), ("u", "d", 2, LIST + pad), ("u", "e", 1, "short"), ("u", "e", 2, LIST + pad)]
    df = spark.createDataFrame(rows, "url string, channel string, page int, html string")
    got = pages.list_rows(df, counted=True).select("channel", "page").collect()
    assert sorted((r.channel, r.page) for r in got) == [("c", 1), ("c", 2), ("c", 3), ("d", 1)]
    assert pages.list_rows(df, True, F.lit("2026-07-01").cast("date")).count() == 0 and pages.list_rows(df, title="没有").count() == 0


def test_api_lists_end_in_four_ways(spark):
    page = lambda ids, total=0, of=0: json.dumps({"data": {"records": [{"annId": i} for i in ids], "total": total, "pages": of}})
    rows = [("short", 1, page("ab")), ("short", 2, page("c")), ("short", 3, page("zz")), ("total", 1, page("ab", 3)), ("total", 2, page("cd", 3)), ("total", 3, page("ef", 3))]
    rows += [("pages", 1, page("ab", 0, 1)), ("pages", 2, page("cd", 0, 1)), ("cap", 1, page("ab")), ("cap", 2, page("bc")), ("cap", 3, page("de")), ("broken", 1, "{")]
    got = pages.api_rows(spark.createDataFrame(rows, "section string, page int, json string"), "struct<annId:string>", page_size=2, limit=3).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.section, r.page, r.pos)):
        found.setdefault(r.section, []).append(r.annId)
    assert found == {"short": ["a", "b", "c"], "total": ["a", "b", "c"], "pages": ["a", "b"], "cap": ["a", "b", "c"]}


def test_sections_are_chosen_by_key():
    assert list(pages.chosen_sections("gcgs, zbjh")) == ["zbjh", "gcgs"] and list(pages.chosen_sections("")) == list(V.SECTIONS) and pages.chosen_sections("?") == {}


def test_portal_records_of_an_unknown_kind_are_empty(spark):
    rows = extract.portal_details(spark.createDataFrame([('{"annId": "1", "annTitle": "t"}',), ("{",)], "json string"))
    assert [tuple(r) for r in extract.portal_records(rows, "?").collect()] == [("", "", "", "")] * 2


def test_attachments_go_to_the_first_empty_field(spark):
    js = '{"annId": "1", "annTitle": "t", "bidAnnCandidateDOS": [{"candidateName": "甲", "bidPrice": "1"}]}'
    rows = extract.portal_details(spark.createDataFrame([(js,)], "json string")).withColumn("attachments", F.array(F.struct(F.lit("a").alias("name"), F.lit("x" * 30).alias("text"))))
    got = extract.portal_records(rows, "hxr").first().asDict()
    assert got["所属行业"].endswith("x" * 30) and sum("附件内容" in (v or "") for v in got.values()) == 1


def test_notices_and_errors_have_names(one):
    from noticeloom.functions import values

    assert one(values.is_pdf_notice, None, "f") and one(values.is_pdf_notice, "<IFRAME src=x>", None) and not one(values.is_pdf_notice, "正文", "f") and not one(values.is_pdf_notice, "", "")
    label = lambda k, m: one(values.error_label, k, m)
    assert label("SSLError", "x") == "TLS/SSL失败" and label("ConnectionError", "Remote end closed connection") == "远端关闭连接" and label("ConnectionError", "?") == "连接失败" and label("KeyError", "") == "KeyError"
    assert one(lambda c: values.thousands(c), "1234567") == "1,234,567"


def test_command_line(spark, tmp_path):
    from noticeloom import __main__ as cli

    link = lambda s, i: f'<a href="/{V.SECTIONS[s][1]}/{i}.jhtml">工程{i} 2026-06-20</a>'
    spark.createDataFrame([(s, 1, link(s, i)) for i, s in enumerate(V.SECTIONS)], "section string, page int, html string").write.parquet(str(tmp_path / "p"))
    got = cli.run(spark, cli.parser().parse_args(["sections", str(tmp_path / "p"), "--sections", "gcgs,zbjh", "--today", "2026-06-22"])).collect()
    assert sorted(r.section for r in got) == ["gcgs", "zbjh"]
    assert cli.run(spark, cli.parser().parse_args(["sections", str(tmp_path / "p"), "--days", "1", "--today", "2026-06-22"])).count() == 0
    spark.createDataFrame([("a", "x", "甲工程", "1", "u1"), ("a", "y", "乙", "2", "u2")], "category string, ann_type string, title string, crawled_at string, url string").write.parquet(str(tmp_path / "t"))
    assert [r.url for r in cli.run(spark, cli.parser().parse_args(["query", str(tmp_path / "t"), "--keyword", "工程"])).collect()] == ["u1"]
    assert [r.cnt for r in cli.run(spark, cli.parser().parse_args(["stats", str(tmp_path / "t")])).collect()] == [1, 1]
