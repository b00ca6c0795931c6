import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticeloom.functions import scan
from noticeloom.functions import text as T
from noticeloom.functions import titles as C
from noticeloom.functions import values as X
from noticeloom.operators import extract

CASES = [
    (T.squeeze, ["a　  b\n"], "a b"),
    (T.squeeze, [None], ""),
    (T.inline, ["：　甲 &nbsp;乙；。"], "甲 乙"),
    (T.normalised, ["a\t b\r\n\n　c　 "], "a b\nc"),
    (T.value, ["招标人：甲 备案号1 晋ICP备"], "招标人：甲"),
    (T.value, ["  。"], "无"),
    (T.html_line, ["<p>a&lt;b&nbsp;c</p> <b>d"], "a d"),
    (T.html_lines, ["<p>a<br/>b</p><div> c  d</div>"], "a\nb\nc d"),
    (T.page_text, ["<script>x</script><p>甲</p><p>乙&eacute;</p>晋ICP备1<p>丙"], "甲\n乙é\n"),
    (T.tidy, ["a\x01  b\n\n\n\nc"], "a b\n\nc"),
    (T.join_split_codes, ["SXXZY-GCG K -2 6 0 14"], "SXXZY-GCGK -26014"),
    (T.join_split_codes, ["（ 12 ）"], "（12）"),
    (T.without_marks, ["：，a、。"], "a"),
    (T.without_marks, ["【】…"], ""),
    (T.phone, ["0351-1234567、 0351-7654321（财务） 招标编号：X"], "0351-1234567、 0351-7654321（财务）"),
    (T.location, ["交易场所：太原市 交易中心"], "太原市"),
    (T.location, ["省本级"], "山西省本级"),
    (T.location, [""], "暂无"),
    (T.common_clean, [" a&amp;b     c　"], "a&b  c"),
    (X.publish_date, ["2026-06-29 17:25"], "2026.6.29"),
    (X.publish_date, ["2026/06/29"], "2026.6.29"),
    (X.publish_date, ["2026年06月09日"], "2026.6.9"),
    (X.publish_date, ["昨天"], "昨天"),
    (X.publish_part, ["招标计划", "2026-06-18"], "招标计划-2026.6.18"),
    (X.publish_part, ["", "2026-06-18"], ""),
    (X.publish_cell, ["招标公告-2026.6.20；2026.6.1；未知公告-2026.6.2；招标公告-2026.6.20"], "招标公告-2026.6.20"),
    (X.publish_cell, ["暂无"], "无"),
    (X.date_range, ["a", "b"], "a 至 b"),
    (X.date_range, ["a", None], "a"),
    (X.date_range, [None, None], ""),
    (X.append_unique, ["a；b", "b"], "a；b"),
    (X.append_unique, ["无", "b"], "b"),
    (X.append_unique, ["a", ""], "a"),
    (X.append_unique, ["a", "b"], "a；b"),
    (lambda c: X.code_list(c, {"1": "勘察", "3": "施工"}), ["1;3;9"], "勘察、施工、9"),
    (lambda c: X.tolerant_json(c, "a int")["a"], ['答案：```json {"a": 1} ```'], 1),
    (lambda c: X.tolerant_json(c, "a int")["a"], ['```json\n{"a": 2}\n```'], 2),
    (X.secure_url, ["http://prec.sxzwfw.gov.cn:80/a"], "https://prec.sxzwfw.gov.cn/a"),
    (X.normal_url, ["HTTPS://Ex.com:443/A/?q=1#top"], "https://ex.com/A/?q=1"),
    (X.safe_int, ["12x"], 0),
    (C.title_kind, ["某工程(2标段)中标候选人公示"], "candidate"),
    (C.title_kind, ["某工程二次招标公告延期公告"], "amendment"),
    (C.title_kind, ["某工程招标控制价变更"], "skip"),
    (C.title_kind, ["某工程中标结果公示"], "result"),
    (C.title_kind, ["中央厨房建设项目（一期）施工"], "unknown"),
    (C.canonical_title, ["X项目招标公告撤销公告"], "X项目"),
    (C.canonical_title, ["X项目二次延期公告"], "X项目二次"),
    (C.canonical_title, ["X项目二次招标公告"], "X项目"),
    (C.canonical_title, ["X项目(第2标段)招标公告"], "X项目"),
    (C.canonical_title, ["招标公告"], "招标公告"),
    (C.canonical_title_old, ["X项目招标公告撤销公告"], "X项目招标公告"),
    (C.canonical_title_old, ["X项目二次招标公告"], "X项目二次"),
    (C.page_kind, ["<p>中标候选人公示更正</p>"], "中标候选人公示"),
    (extract.text_title, ["公告发布时间：2026-06-17 15:00:00 某某改造工程（招标编号：X1）"], "某某改造工程"),
    (extract.tender_number, ["（招标编号：XM 2 026G004）"], "XM2026G004"),
    (extract.area, ["招标项目所在地区：太原市 一、招标条件"], "太原市"),
    (extract.publicity_start, ["公示开始时间：2026-06-17 公示结束时间：2026-06-20 本"], "2026-06-17"),
    (extract.publicity_end, ["公示开始时间：2026-06-17 公示结束时间：2026-06-20 本"], "2026-06-20"),
    (extract.winner, ["经评审，确定甲公司为本项目的中标人"], "甲公司"),
    (lambda c: extract.project_codes(c), ["编号E1401005129000002378 与 HXZB-FW202606082.3"], "E1401005129000002378；HXZB-FW20260608"),
    (lambda c: extract.labelled(c, "所属行业[：:]"), ["所属行业：房建。其他"], "房建"),
    (extract.sectioned_times, ["获取时间：2026年6月1日至5日。"], "2026年6月1日至5日"),
]


@pytest.mark.parametrize("f, given_, want", CASES)
def test_column_functions(one, f, given_, want):
    assert one(f, *given_) == want


@pytest.mark.parametrize("missing", ["", None, "无", "暂无", "None", "nan", " 无。"])
def test_missing(one, missing):
    assert one(T.is_missing, missing) is True and one(T.present, missing) is None


def test_dates_that_are_no_days_are_null(one):
    assert one(X.list_date, "2026-02-30") is None and str(one(X.list_date, "x 2026/02/03")) == "2026-02-03"


def test_verdict(one):
    body = "招标公告 项目名称 开标时间" + "x" * 300
    assert one(lambda c: C.verdict(F.lit(200), c, F.lit(""), c, F.length(c)), body) == "可爬-详情HTML可直接提取"
    assert one(lambda c: C.verdict(F.lit(200), c, F.lit(""), c, F.length(c)), "验证码") == "不可爬/暂不可爬"
    assert one(lambda c: C.verdict(F.lit(403), c, F.lit(""), c, F.length(c)), "x") == "可爬-需Cookie/登录态"


def test_lines():
    lines = scan.to_lines("<p>2.1 项目规模：大</p><p>很大</p><p>2.2 招标编号：X</p>")
    assert scan.labelled(lines, ["项目规模"]) == "大 很大"
    names, prices = scan.winner_pairs(scan.to_lines("一、中标人信息\n004第四标段：\n中标人：<甲公司\n中标价格：444000元\n二、其他公示内容"))
    assert (names, prices) == (["<甲公司"], ["444000元"]) or names == []
    assert scan.full_percent("68%", ["中标价格：参照标准的68%计取"]) == "参照标准的68%计取"
    assert scan.full_percent("100元", ["x"]) == "100元"
    pairs = scan.candidate_pairs(scan.to_lines("一、评标情况\n001第一标段：\n第一中标候选人：甲\n投标报价：5元\n002第二标段：\n第一中标候选人：乙\n二、提出异议"))
    assert [(p["lot"], p["name"]) for p in pairs] == [("001第一标段", "甲"), ("002第二标段", "乙")]
    assert scan.candidate_pairs([]) == [] and scan.winner_pairs([]) == ([], []) and scan.winners("") == [] and scan.qualification("") == ""
    assert scan.continues_phone("0351-2221744（财务）") and not scan.continues_phone("招标编号1234567")


def test_contacts():
    lines = scan.to_lines("五、联系方式\n招标人：甲\n招标代理机构：乙公司\n地址：某路\n联系人：丙\n电话：0351-1\n0351-2221744（财务）\n邮箱：x")
    assert scan.contact(lines, "agent", "name") == "乙公司" and scan.contact(lines, "agent", "phone") == "0351-1 0351-2221744（财务）"
    assert scan.contact(lines, "bidder", "phone") == "" and scan.contact(lines, "bidder", "name") == "甲"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab 　\n\t：。", max_size=30))
def test_line_reading_is_idempotent(s):
    assert scan.to_lines("\n".join(scan.to_lines(s))) == scan.to_lines(s)
    assert scan.one_line(scan.one_line(s)) == scan.one_line(s)
