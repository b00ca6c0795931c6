"""What the third round's findings on sizes named: the same results for less work."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeloom.functions import scan
from noticeloom.functions import text as T
from noticeloom.llm import _common
from noticeloom.operators import extract, ordered, projects
from noticeloom.plans import roundtrips
from test_ordered import folded


def _customers(spark, tmp_path, n=6):
    spark.range(n).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), (F.col("id") % 3).cast("int").alias("c_nationkey"), F.lit("M").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_f4_f13_a_detail_is_read_once_for_all_its_kinds(spark, tmp_path):
    rows = roundtrips.portal_kinds(spark, _customers(spark, tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("from_json(") == 1 and rows.count() == 42


def test_f4_f13_one_pass_gives_the_records_of_each_kind(spark):
    texts = [
        '{"annId": "1", "annContent": "<p>一、评标情况</p><p>第一中标候选人：甲</p><p>四、联系方式</p><p>招标人：乙</p><p>地址：路&copy;</p>", "annTitle": "更正公告"}',
        '{"annId": "2", "otherContent": "招标代理机构：丙", "bidContactInformation": "<p>招标人：丁</p>", "annNature": "4"}',
        '{"annId": "3", "supervisionUnitName": "四、联系方式<br>招标人：戊<br>招标代理机构：己"}',
        "broken",
    ]
    rows = spark.createDataFrame([(i, t, [("n", "x" * 30)] if i % 2 else None) for i, t in enumerate(texts)], "i long, json string, attachments array<struct<name:string,text:string>>")
    details, kinds = extract.portal_details(rows), [*extract.PORTAL_FIELDS, "?"]
    got = extract.portal_records_of(details, lambda kind, record: F.struct(F.lit(kind).alias("kind"), F.array(*record.values()).alias("cells")), kinds, "https://x", keep=("i",))
    got = {(r.i, r.kind): r.cells for r in got.collect()}
    for kind in kinds:
        for r in extract.portal_records(details, kind, "https://x", keep=("i",)).collect():
            assert got[r.i, kind] == list(r)[1:], (kind, r.i)
    # without a contact section candidates' parties are looked for in the whole body
    assert "戊" not in got[2, "zbjg"] and "己" in got[2, "hxr"]


def test_f4_f13_fragments_of_an_array_are_read_as_single_ones(spark):
    parts = ["<p>a&amp;lt;b</p>c", "", None, "&copy; <br/>x  y", "&lt;p&gt;z", "&am", "p;", "<b", ">"]
    rows = spark.createDataFrame([(parts,), ([p for p in parts if p != "&copy; <br/>x  y"],)], "p array<string>")
    once = T.html_lines_each(rows, F.col("p"), "l").select("p", "l").collect()
    for r in once:
        single = spark.createDataFrame([(x,) for x in r.p], "x string").select(T.html_lines(F.col("x")).alias("l")).collect()
        assert r.l == [x.l for x in single]


def test_f16_f19_a_rule_is_tried_where_its_words_stand():
    tried = []
    rules = [(role, words, lambda line, look=look, role=role: tried.append((role, line)) or look(line), *groups) for role, words, look, *groups in scan._CANDIDATES]
    lines = ["001标段：", "第一中标候选人：甲", "投标报价：1元", "无"]
    assert [e.role for e in scan.events(lines, rules)] == ["lot", "name", "quote", ""]
    assert tried == [("lot", lines[0]), ("aside", lines[1]), ("name", lines[1]), ("quote", lines[2])]


def test_f16_f19_tags_entities_and_gaps_are_still_resolved():
    assert scan.to_lines("a\t b<br>&lt;p&gt;c&nbsp;d &amp;nbsp;e\xa0f\n\n") == ["a b", "c d e f"]
    assert scan.to_lines(None) == [] and scan.winner_pairs(scan.to_lines("无")) == ([], []) and scan.candidate_pairs(scan.to_lines("001标段：")) == []


def test_pipeline_workers_give_memory_back_when_a_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(_common, "give_back", lambda: given.append(1))
    got = _common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(got) == 2 and not given and list(got) == [3] and given == [1]
    monkeypatch.setattr(_common, "_given_back", _common.time.monotonic())
    same = _common.lean_groups(lambda t: t)
    large = pa.table({"x": [b"x" * (1 << 20)]})
    assert same(pa.table({"x": [1]})).num_rows == 1 and given == [1] and same(large) is large and given == [1, 1]


def test_f8_sections_end_at_their_nearest_stop_and_blanks_are_all_of_unicodes(spark):
    text = "监督部门\n六、监督部门：甲\u3000\n十一、联系方式：乙\n九、监督部门"
    row = spark.createDataFrame([(text,)], "t string").select(extract.supervision_section(F.col("t")).alias("s"), T.strip(F.lit("".join(T.BLANKS) + "a b" + "".join(T.BLANKS))).alias("b")).first()
    assert row.s == "六、监督部门：甲" and row.b == "a b"
    blank = spark.createDataFrame([(chr(i),) for i in range(0x3100)], "c string")
    assert blank.where(F.col("c").rlike(r"(?U)^\s$") != (T.strip(F.col("c")) == "")).count() == 0
    plan = spark.createDataFrame([(text,)], "t string").select(extract.supervision_section(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract(" in plan and "btrim(" in plan


def test_f20_names_and_their_windows_are_not_sent_to_the_driver(spark, tmp_path):
    rows = roundtrips.aligned_names(spark, _customers(spark, tmp_path, 12))
    assert {(r.known, r.probe) for r in rows.collect()} == {(f"工程第{i}号", f"工程第{i}号" if i % 2 else f"某市工程第{i}号施工") for i in range(12)}
    titles = spark.range(12).select(F.concat(F.lit("某地工程第"), "id", F.lit("号施工")).alias("raw_title"), F.lit("变更公告").alias("channel"))
    found = projects.history_of(spark.range(12).select(F.concat(F.lit("工程第"), "id", F.lit("号")).alias("项目名称")), titles)
    assert found.count() == 12
    for got in (rows, found):
        got.collect()
        # the plan as it ran, where measured sizes may have changed it
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("most", "few", "rename"), [(1, 0, True), (12, 0, True), (ordered.MOST, 0, True), (12, 6, True), (12, 6, False), (12, ordered.FEW, True), (12, ordered.FEW, False)])
def test_f21_names_of_many_rows_and_of_few_are_seen_alike(spark, monkeypatch, most, few, rename):
    """In rounds, by ranges or in one task each, in one pass, and all side by side: what a fold over a list gives."""
    monkeypatch.setattr(ordered, "FEW", few)
    looked = []
    monkeypatch.setattr(ordered, "MOST", most)
    monkeypatch.setattr(ordered, "last_before", lambda *args, by=ordered.last_before: looked.append(1) or by(*args))
    known, draw = ["alpha road", "alpha road A B"], random.Random(3)
    new = [draw.choice(["alpha road", "alpha road A", "lot alpha road", "beta bridge", "beta bridge", "delta dam", None]) for _ in range(18)]
    old = spark.createDataFrame([(n, i) for i, n in enumerate(known)], "name string, o int")
    rows = spark.createDataFrame([(n, 100 + i) for i, n in enumerate(new)], "name string, t long").repartition(3)
    places = folded(known, new, rename)
    want = {i: (p, None) if p < len(known) else (None, 100 + places.index(p)) for i, p in enumerate(places)}
    resolved = ordered.resolved(rows, old, "t", "o", "name", rename)
    assert {r.t - 100: (r.slot.known, r.slot.founder) for r in resolved.collect()} == want
    assert (resolved._rounds == 0) == (few == 500)
    # rows are dealt by range, written and joined again for names of many rows alone
    assert bool(looked) == (most < 1_000_000 and few < 500 and rename)
