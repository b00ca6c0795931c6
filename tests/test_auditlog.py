"""Audit logs read back by ranges."""

import re

from pyspark.sql import functions as F

from noticeloom.operators import auditlog


def plain(content: str):
    """The two sections by what follows their headings, line by line."""
    section, title, project, unknown, issues = "", None, None, [], []
    for line in map(str.strip, content.splitlines()):
        if line.startswith("【"):
            section, title, project = line, None, None
        elif line.startswith("标题:"):
            title, project = line[3:].strip(), None
        elif line.startswith("链接:"):
            if title and line[3:].strip() and section.startswith("【类型1】未识别公告"):
                unknown.append((title, line[3:].strip()))
            title = project = None
        elif line.startswith("项目:"):
            project, title = line[3:].strip(), None
        elif line.startswith("- ") and project is not None and section.startswith("【类型2】"):
            issues.append((project, line[2:].strip()))
    return unknown, issues


def read(spark, path):
    unknown, issues = auditlog.read_log(spark, str(path))
    return [tuple(r) for r in unknown.orderBy("file", "pos").select("raw_title", "link").collect()], [tuple(r) for r in issues.orderBy("file", "pos").select("project", "issue").collect()]


def test_a_log_of_several_ranges(spark, tmp_path):
    unknown = spark.range(300).select(F.concat(F.lit("标题 "), "id").alias("raw_title"), F.concat(F.lit("http://x/"), F.lpad("id", 4, "0")).alias("link"))
    issues = spark.range(300).select(F.concat(F.lit("项目"), F.lpad("id", 4, "0")).alias("project"), F.when(F.col("id") % 2 == 0, F.array(F.lit("甲未提取"), F.lit("乙未提取"))).otherwise(F.array(F.lit("丙未提取"))).alias("fields"))
    lines = auditlog.log_lines(unknown, issues, F.lit("2026-06-01 00:00:00").cast("timestamp"))
    content = "\n".join(r.value for r in lines.orderBy("part", "place").collect())
    assert re.search(r"【类型1】未识别公告（共300条）\n-+\n", content)
    (tmp_path / "check.log").write_text(content, encoding="utf-8")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = read(spark, tmp_path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = plain(content)
    assert got == want and len(want[0]) == 300 and len(want[1]) == 450


def test_odd_lines(spark, tmp_path):
    content = "标题: before\n链接: u\n【类型1】未识别公告（共1条）\n-----\n  标题: a\n  other\n  链接: u1\n  链接: u2\n  标题:\n  链接: u3\n  标题: b\n  标题: c\n  链接:\n- x\n【类型2】有链接但字段提取失败\n----\n    - lost\n  项目: p\n    - one\n    - one\n  项目:\n    - two\n【类型3】\n  项目: q\n    - three\n"
    (tmp_path / "a.log").write_text(content, encoding="utf-8")
    (tmp_path / "b.log").write_text("", encoding="utf-8")
    assert read(spark, tmp_path) == plain(content) == ([("a", "u1")], [("p", "one"), ("p", "one"), ("", "two")])
