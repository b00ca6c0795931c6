"""Character sets, answers that are kept, counters that ride on a write."""

import pytest
from pyspark.sql import functions as F

from noticeloom.functions import values as X
from noticeloom.operators import audit, enrich, pages
from noticeloom.sources import writers

CHINESE = "山西省公共资源交易平台关于某某工程施工招标公告的通知，投标人应当在规定的时间内递交投标文件，逾期不予受理。本项目已由有关部门批准建设，资金来自国有投资，现对该项目的监理进行公开招标。"
TRADITIONAL = "國家發展委員會關於政府採購公告的說明，投標廠商應於規定時間內遞送文件，逾期不予受理。本計畫業經主管機關核准辦理，經費來源為中央補助，現就該項目之監造進行公開招標。"
LATIN = "Les soumissionnaires sont invités à présenter leurs offres avant la date limite fixée par l'autorité concédante; les délais dépassés entraînent le rejet. Größe, Straße, München, año, señal, días. "


def test_charsets_of_generated_pages(spark):
    import random

    draw = random.Random(4)
    rows = []
    for text, codecs in ((CHINESE, ("utf-8", "gb18030")), (TRADITIONAL, ("utf-8", "big5")), (LATIN, ("utf-8", "iso-8859-1"))):
        for codec in codecs:
            for _ in range(60):
                words = "".join(draw.choices(text, k=400)) if text is not LATIN else " ".join(draw.choices(text.split(), k=90))
                body = f"<html><body><p>{words}</p>".encode(codec)
                rows.append((bytearray(body[: len(body) - draw.randint(0, 2) - 4]), codec))
    got = spark.createDataFrame(rows, "body binary, codec string").select("codec", X.charset_guess(F.col("body")).alias("g"), pages.decoded(F.col("body"), F.col("codec")).alias("t")).collect()
    assert sum(r.g == r.codec for r in got) >= 0.99 * len(got)
    assert all(r.t.startswith("<html><body><p>") for r in got)


@pytest.mark.parametrize(("header", "body", "want"), [("text/html; charset=GBK", b"", "gbk"), ("", b"<meta charset='Big5'>\xb0\xa1", "big5"), ("", b"", "utf-8"), (None, None, "utf-8"), ("", b"plain", "utf-8"), ("", "招标公告".encode("gb18030") * 30, "gb18030"), ("", b"\xff\xff\x00\xfe" * 20, "utf-8")])
def test_charset_of_header_page_or_bytes(spark, header, body, want):
    df = spark.createDataFrame([(header, None if body is None else bytearray(body))], "h string, b binary")
    r = df.select(X.charset(F.col("h"), F.col("b")).alias("c"), pages.decoded(F.col("b"), F.lit("no-such-set")).alias("t")).first()
    assert r.c == want and isinstance(r.t, str)


def test_answers_are_asked_for_once(spark, tmp_path):
    log, store = tmp_path / "asked", str(tmp_path / "store")
    log.mkdir()

    def model(prompt):
        import uuid

        (log / uuid.uuid4().hex).write_text(prompt)
        if prompt == "bad":
            raise TimeoutError
        return prompt.upper(), {"prompt_tokens": len(prompt), "completion_tokens": 2}

    calls = lambda: sorted(f.read_text() for f in log.iterdir())
    asked = spark.createDataFrame([("kind", "a"), ("kind", "b"), ("fields", "b"), ("fields", "ccc"), ("fields", "bad"), ("kind", None)], "phase string, prompt string")
    got = enrich.answered(asked, model, store, "v1", tasks=2, round_size=2, retries=1)
    rows = {(r.phase, r.prompt): r for r in got.collect()}
    assert calls() == ["a", "b", "bad", "bad", "ccc"] and rows["kind", "b"].answer == rows["fields", "b"].answer == "B"
    assert rows["fields", "bad"].error == "TimeoutError" and rows["fields", "bad"].calls == 2 and rows["kind", None].answer is None
    totals = {r.phase: (r.calls, r.prompt_tokens, r.completion_tokens) for r in audit.token_totals(enrich.usage(got)).collect()}
    assert totals == {"kind": (1, 1, 2), "fields": (3, 4, 4)}
    again = enrich.answered(asked.unionByName(spark.createDataFrame([("kind", "d")], asked.schema)), model, store, "v1", retries=0).collect()
    assert calls() == ["a", "b", "bad", "bad", "bad", "ccc", "d"] and len(again) == 7
    enrich.answered(asked.where("prompt = 'a'"), model, store, "v2").count()
    assert calls().count("a") == 2 and enrich.answered(asked.limit(0), model, store, "v2").count() == 0


def test_a_task_that_is_run_again_asks_only_its_own(spark, tmp_path):
    """A run that breaks off keeps what its rounds have written."""
    log, store = tmp_path / "asked", str(tmp_path / "store")
    log.mkdir()

    def model(prompt, broken=True):
        import uuid

        (log / uuid.uuid4().hex).write_text(prompt)
        if broken and len(list(log.iterdir())) > 25:
            raise SystemExit  # not an answer that failed: the worker itself
        return prompt

    asked = spark.range(40).select(F.lit("p").alias("phase"), F.col("id").cast("string").alias("prompt"))
    with pytest.raises(Exception):  # noqa: B017, PT011
        enrich.answered(asked, model, store, "v", tasks=1, round_size=5).collect()
    kept = spark.read.parquet(store).count()
    assert kept >= 5
    before = len(list(log.iterdir()))
    assert enrich.answered(asked, lambda p: model(p, False), store, "v").where("answer IS NULL").count() == 0
    assert len(list(log.iterdir())) == before + 40 - kept


def test_counters_ride_on_the_write(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("项目名称"), F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "x").alias("公共类型"))
    tracker, group = spark.sparkContext.statusTracker(), "counted"
    spark.sparkContext.setJobGroup(group, group)
    told = writers.write_counted(rows, lambda r: r.write.json(str(tmp_path / "j")), total=F.count("*"), odd=F.count_if(F.col("项目名称").cast("int") % 2 == 1))
    assert told == {"total": 10, "odd": 5} and len(tracker.getJobIdsForGroup(group)) == 1
    spark.sparkContext.setJobGroup("", "")
    got = writers.write_envelope(rows, str(tmp_path / "e"), "s", F.lit("2026-06-01 00:00:00").cast("timestamp"), 3, ["项目名称", "公共类型"])
    assert got == {"total": 10, "项目名称": 10, "公共类型": 3}
    assert writers.write_envelope(rows.limit(0), str(tmp_path / "n"), "s", F.current_timestamp(), 3, ["项目名称"]) == {"total": 0, "项目名称": 0}
    assert spark.read.json(str(tmp_path / "n" / "metadata")).first().total_count == 0 and not (tmp_path / "n" / "csv").exists()
