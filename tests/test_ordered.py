"""Upserts in order against a fold that puts one row after the other into a list."""

import random

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import ordered

NAMES = ["alpha road", "alpha road A", "alpha road A B", "lot alpha road", "lot alpha road A", "beta bridge", "beta bridge north", "beta", "bet", "road A B", "x alpha road A B y"]


def found(table: list[str | None], name: str) -> int:
    if name in table:
        return table.index(name)
    for i, known in enumerate(table):
        if known is not None and len(known) >= 5 and len(name) >= 5 and (name in known or known in name):
            return i
    return -1


def folded(snapshot: list[str], new: list[str | None], rename: bool) -> list[int]:
    """The place in the table that every new row takes."""
    table, places = list(snapshot), []
    for name in new:
        i = -1 if name is None else found(table, name)
        if i < 0:
            i = len(table)
            table.append(name)
        elif rename:
            table[i] = name
        places.append(i)
    return places


@pytest.mark.parametrize("rename", [True, False])
def test_rows_see_the_rows_before_them(spark, rename):
    draw = random.Random(7)
    for case in range(2):
        snapshot = draw.sample(NAMES, draw.randint(0, 4))
        new = [draw.choice([*NAMES, None] if case else NAMES[:5]) for _ in range(draw.randint(14, 22))]
        places = folded(snapshot, new, rename)
        old = spark.createDataFrame([(n, i * 10) for i, n in enumerate(snapshot)], "name string, o int")
        rows = spark.createDataFrame([(n, 100 + i) for i, n in enumerate(new)], "name string, t long").repartition(3)
        got = {r.t - 100: r.slot for r in ordered.resolved(rows, old, "t", "o", "name", rename).collect()}
        founder = {p: places.index(p) for p in places}
        want = {i: (p * 10, None) if p < len(snapshot) else (None, 100 + founder[p]) for i, p in enumerate(places)}
        assert {i: (s.known, s.founder) for i, s in got.items()} == want


def test_chain_in_every_order(spark):
    import itertools

    old = spark.createDataFrame([], "name string, o int")
    chain = ["bridge", "bridge two", "bridge two b"]
    runs = [[f"{k}{chain[i]}" for i in order] for k, order in enumerate(itertools.permutations(range(3)))]
    rows = [(n, 10 * k + at) for k, names in enumerate(runs) for at, n in enumerate(names)]
    got = {r.t: r.slot.founder for r in ordered.resolved(spark.createDataFrame(rows, "name string, t long"), old, "t", "o", "name").collect()}
    for k, names in enumerate(runs):
        places = folded([], names, True)
        assert [got[10 * k + at] for at in range(3)] == [10 * k + places.index(p) for p in places]


def test_repeats_are_one_visit_and_rounds_do_not_follow_rows(spark):
    new = [("harbour wall", i) for i in range(500)] + [("harbour wall east", 500)] + [(f"other site {i:04d}", 501 + i) for i in range(300)]
    got = ordered.resolved(spark.createDataFrame(new, "name string, t long"), spark.createDataFrame([("harbour", 1)], "name string, o int"), "t", "o", "name")
    assert got._rounds <= 3 and got.where("slot.known = 1").count() == 501 and got.where("slot.founder = t").count() == 300


def test_last_before_over_ranges(spark):
    df = spark.range(2000).select((F.col("id") % 3 * F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v")).repartition(4)
    for r in ordered.last_before(df, ["k"], "t", "v", "last").collect():
        want = max((x for x in range(0, r.t, 7) if x % 3 * x % 2 == r.k), default=None)
        assert r["last"] == want


@pytest.mark.parametrize("mode", ["replace", "fill", "merge"])
def test_upsert_in_order(spark, mode):
    schema = "`项目名称` string, `招标人` string, `开标时间` string, `公告类型` string"
    old = spark.createDataFrame([("alpha road", "old", "无", "招标计划", "a"), ("gamma", "g", "d", "招标计划", "b")], schema + ", o string")
    new = spark.createDataFrame([("alpha road A", "one", "d1", "招标公告", 1), ("alpha road", "", "d2", "中标结果；招标公告", 2), ("delta dam", "n", "d3", "招标公告", 3), ("delta dam two", "m", "", "变更", 4)], schema + ", t long")
    got = {r.o: (r.项目名称, r.招标人, r.开标时间, r.公告类型) for r in ordered.upsert_in_order(old, new, "t", "o", F.concat(F.lit("n"), F.col("t")), mode).collect()}
    assert set(got) == {"a", "b", "n3"} and got["b"] == ("gamma", "g", "d", "招标计划")
    if mode == "replace":
        assert got["a"] == ("alpha road", "", "d2", "中标结果；招标公告") and got["n3"] == ("delta dam two", "m", "", "变更")
    else:
        assert got["a"] == ("alpha road", "old" if mode == "fill" else "one", "d1", "招标计划；招标公告；中标结果")
        assert got["n3"] == ("delta dam", "n" if mode == "fill" else "m", "d3", "招标公告；变更")
    empty = ordered.upsert_in_order(old.limit(0), new.limit(0), "t", "o", F.lit("x"), mode)
    assert empty.count() == 0 and ordered.upsert_in_order(old, new.limit(0), "t", "o", F.lit("x"), mode).count() == 2
