"""The prefix trie against a dictionary of prefixes, collisions, and odd rows."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from noticeloom.llm import convtrie as ct
from noticeloom.llm._common import shared_dir

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_turns(rows) -> dict[int, list[tuple[str, str]]]:
    out = defaultdict(list)
    digest = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, digest(r))):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return out


def plain_rebuilt(rows) -> dict[int, list]:
    turns = plain_turns(rows)
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - c % 20, [])[: h[c]] + t[h[c] :] for c, t in turns.items()}


def plain_trie(turns: dict[int, list]) -> set[tuple]:
    members = defaultdict(list)
    for c, t in turns.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = own + sum(saved[c] for c in children[p])
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(turns[c]) == len(p)).encode()).hexdigest()
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], ends(p)) for p, m in members.items()}


def random_rows(draw: random.Random, n: int) -> list[tuple]:
    rows = []
    for c in range(n):
        for k in range(draw.choice([1, 2, 3, 5, 9])):
            rows.append((c * draw.choice([1, 1, 3]), draw.choice([k, k, k, None]), draw.choice(["user", "assistant", None]), draw.choice(["a b", "c", "", None, "a  b", "x y z é"])))
    return rows


def test_products_and_powers_are_those_of_whole_numbers():
    draw = random.Random(1)
    a, b = ([draw.choice([0, 1, ct.PRIME - 1, draw.randrange(ct.PRIME)]) for _ in range(2000)] for _ in range(2))
    assert ct.times(ct.np.array(a), ct.np.array(b)).tolist() == [x * y % ct.PRIME for x, y in zip(a, b, strict=True)]
    e = [0, 1, 2, 399, 10**9, 10**12]
    assert ct.powers(ct.BASE, ct.np.array(e)).tolist() == [pow(ct.BASE, x, ct.PRIME) for x in e]


def test_running_sums_of_keys_that_span_partitions(spark):
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)).cast("long").alias("k"), "id", (F.col("id") % 11 - 5).alias("v"), F.lit("x").alias("run"))
    got = ct.running(df, "k", [F.col("id").desc()], ["v"], "t").select("k", "id", "run_v").collect()
    want = df.select("k", "id", F.sum("v").over(Window.partitionBy("k").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_conversations(spark, seed):
    rows = random_rows(random.Random(seed), 60)
    got = ct.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {tuple(r) for r in got} == plain_trie(plain_turns(rows)) and len(got) == len({(r.conv_id, r.depth) for r in got})


def test_collisions_are_found_and_split(spark):
    rows = [(c, k, "user", f"{c if k else c % 3}-{k}") for c in range(12) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = ct.materialise(ct.numbered(ct.turns_of(df)), "t")
    prefixes = ct.fingerprints(turns.withColumn("salt", F.lit(0).cast("long")), modulus=97)
    groups = prefixes.groupBy("depth", "f_low", "f_high").agg(F.count_distinct("digest", "p_low", "p_high").alias("n"))
    assert groups.where("n > 1").count() > 0, "the modulus is to make collisions"
    assert {tuple(r) for r in ct.conversation_trie(df, modulus=97).collect()} == plain_trie(plain_turns(rows))


def test_contract_rebuilds_conversations(spark):
    draw = random.Random(5)
    rows = [(c, k, draw.choice(["user", None]), draw.choice(["a b", "c", "d e f"])) for c in [*range(0, 45), 60, 61, 87, 88, 89] for k in range(draw.choice([1, 2, 3, 6]))]
    turns, members = ct.rebuilt(ct.materialise(ct.numbered(ct.turns_of(spark.createDataFrame(rows, SCHEMA))), "t"))
    want = plain_rebuilt(rows)
    assert any(not t for t in want.values()), "one is to have no turn left"
    assert {tuple(r) for r in members.collect()} == {(c, len(t)) for c, t in want.items()}
    assert {tuple(r) for r in ct.prefix_trie(turns, members).collect()} == plain_trie(want)


def test_long_chains_and_paths_that_hang_on_each_other(spark):
    rows = [(5, k, "u", str(k)) for k in range(400)] + [(6 + c, k, "u", str(k) if k < 10 * (9 - c) else f"{c}.{k}") for c in range(9) for k in range(100)]
    rows += [(20 + c, k, "u", str(k) if k <= c else f"n{min(c, 3)}") for c in range(5) for k in range(c + 2)]
    assert {tuple(r) for r in ct.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()} == plain_trie(plain_turns(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, "", ""), (1, 2, "user", "w " * 100000), (2, 2, "user", "w"), (2, 2, "user", "w"), (-20, 1, "a", "b"), (-19, 1, "a", "b")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", digest string, depth int, words int")
    assert {tuple(r) for r in ct.conversation_trie(df).collect()} == plain_trie(plain_turns(rows))
    assert ct.conversation_trie(df.limit(0)).count() == 0 and ct.conversation_trie(df.where("conv_id IS NULL")).count() == 0


def test_ids_that_end_at_a_node_are_packed_in_order(spark, monkeypatch):
    monkeypatch.setattr(ct, "PACK_BYTES", 64)
    ends = spark.range(-50, 1000).select((F.col("id") % 2 * F.col("id") % 3).alias("k"), F.col("id").alias("conv_id")).repartition(5)
    got = {r.k: r.ends_sha256 for r in ct.ends_digest(ends, ["k"]).collect()}
    want = defaultdict(list)
    for r in ends.collect():
        want[r.k].append(r.conv_id)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}


def test_one_table_is_left_behind(spark):
    folder = shared_dir(spark).removeprefix("file:") + "/noticeloom"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ct.conversation_trie(spark.createDataFrame([(1, 1, "u", "a"), (2, 1, "u", "a"), (2, 2, "u", "b")], SCHEMA))
    assert [x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before] == ["conversation_trie"]
