"""Envelopes read by ranges, against a plain parse of the whole file."""

import json
import random

import pytest

from noticeloom.sources.envelopes import read_envelopes

FIELDS = ["项目名称", "a", "b"]


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def record(draw: random.Random) -> dict:
    odd = ['{"x": "}"}', '}\\"{[', "a\\", '"', "}}}", "新\n行", "", "plain " * 30, "[[{", None, 7, {"n": [1, "}"]}, ["{", "]"]]
    return {k: draw.choice(odd) for k in draw.sample(FIELDS, draw.randint(1, 3))}


def plain(rows: list[dict]) -> list[tuple]:
    text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    return sorted((tuple(text(r.get(f)) for f in FIELDS) for r in rows), key=str)


def read(spark, path) -> list[tuple]:
    return sorted((tuple(r) for r in read_envelopes(spark, str(path), FIELDS).collect()), key=str)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [151, 997])
def test_ranges_give_what_the_whole_file_holds(spark, tmp_path, small_ranges, indent, size):
    draw = random.Random(size)
    rows = [record(draw) for _ in range(60)]
    head = {"metadata": {"source": 's"}{', "fields": ["a", "}"]}, "data": rows}
    (tmp_path / "one.json").write_text(json.dumps(head, ensure_ascii=False, indent=indent) + "\n", encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps({"data": rows[:3], "after": {"x": "{"}}, ensure_ascii=indent is None), encoding="utf-8")
    small_ranges(size)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert read(spark, tmp_path) == plain(rows + rows[:3])


def test_a_record_over_many_ranges_and_a_file_that_breaks_off(spark, tmp_path, small_ranges):
    long = [{"a": "}{" * 3000, "b": "x"}, {"a": "y"}]
    whole = json.dumps({"data": long + [{"a": "last", "b": "half"}]})
    (tmp_path / "a.json").write_text(whole[: whole.rindex('"half') + 3])
    small_ranges(500)
    assert read(spark, tmp_path) == plain(long)


def test_nothing_and_elements_that_are_no_records(spark, tmp_path):
    for k, text in enumerate(['{"data": []}', "", "[]", "{}", '{"data": [1, "x", [2], {"a": "1"}, null]}']):
        (tmp_path / f"{k}.json").write_text(text)
    assert read(spark, tmp_path) == [(None, "1", None)]
