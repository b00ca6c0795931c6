"""Periodic runs against a plain search, and odd rows."""

import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from noticeloom.llm import runs


def plain(words: list[str], min_length: int, min_times: int) -> list[tuple[int, int, int]]:
    """Every run by comparing all words at every distance."""
    n, out = len(words), []
    for q in range(1, n // min_times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_times * q) and not any(words[i : i + length - p] == words[i + p : i + length] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out)


def fibonacci(n: int) -> list[str]:
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize(("min_length", "min_times"), [(1, 2), (4, 2), (6, 3), (24, 3)])
def test_runs_of_random_words(min_length, min_times):
    draw = random.Random(min_length)
    for _ in range(150):
        texts = [fibonacci(draw.randint(0, 60)), ["x"] * draw.randint(0, 60)]
        for _ in range(3):
            words = [draw.choice("abcde"[: draw.choice([1, 2, 3, 5])]) for _ in range(draw.randint(0, 60))]
            a, p = draw.randint(0, len(words)), draw.randint(1, 9)
            texts.append([w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)])
        draw.shuffle(texts)
        got = [[tuple(r) for r in found.tolist()] for _, found in runs.piece_runs([" ".join(t).encode() for t in texts], min_length, min_times)]
        assert got == [plain(t, min_length, min_times) for t in texts]


def test_equal_texts_in_one_piece_do_not_meet():
    text = b"one two three four " * 2
    assert [len(r) for _, r in runs.piece_runs([text] * 5)] == [0] * 5


def test_strongest_run_is_told_by_the_exact_fraction():
    rows = runs.np.array([[0, 10**17 + 1, 10**8], [5, 10**17, 10**8], [9, 20, 2], [3, 20, 2]])
    assert runs.strongest(rows) == {"start": 0, "length": 10**17 + 1, "period": 10**8}
    assert runs.strongest(rows[2:]) == {"start": 3, "length": 20, "period": 2} and runs.strongest(rows[:0]) is None


def test_collapsed_leaves_out_what_any_run_repeats():
    words = ("k " + "a b c " * 9 + "d " + "e " * 30).encode().split()
    (_, found), = runs.piece_runs([b" ".join(words)])
    assert found.tolist() == [[1, 27, 3], [29, 30, 1]] and runs.collapsed(words, found) == b"k a b c d e"


def test_work_follows_the_smaller_half():
    """Words looked at, all lengths together, stay within the logarithm's bound."""
    for words in (["a"] * 3000, fibonacci(3000), [random.Random(1).choice("ab") for _ in range(3000)]):
        ids = runs.np.append(runs.np.unique(words, return_inverse=True)[1], 10**6)
        c, touched = runs.Classes(ids, runs.np.full(len(ids), len(ids))), 0
        going = True
        while going:
            touched += len(c.small)
            going = c.refine()
        assert touched <= 3001 * 13


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 100), (4, "a " * 100), (None, "x y z " * 50000), (5, "\x1c.\x85 é " * 30), (6, "b")]
    docs = spark.createDataFrame([(i, t, 1, "s", [1]) for i, t in rows], "doc_id long, text string, runs long, strongest string, collapsed array<int>")
    got = {(r.doc_id, len(r.runs)): r for r in runs.periodic_runs(docs, piece_bytes=300).collect()}
    assert len(got) == 7 and runs.periodic_runs(docs).count() == len(rows) and runs.periodic_runs(docs.limit(0)).count() == 0
    assert [got[i, 0].collapsed for i in (1, 2, 3, 6)] == ["", "", "", "b"] and got[1, 0].strongest is None
    assert got[4, 1].collapsed == "a" and got[4, 1].strongest.asDict() == {"start": 0, "length": 100, "period": 1}
    assert got[None, 1].collapsed == "x y z" and got[5, 1].collapsed == "\x1c.\x85 é"


def test_documents_without_an_id_are_not_looped(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (21, "a b c d e f g h")], "doc_id long, text string")
    got = [r[0] for r in docs.select(runs.looped(F.col("text"), F.col("doc_id"))).collect()]
    assert got[0] == "a b c d"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_query_equals_its_oracle(spark):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = sorted((tuple(r) for r in runs.op11_runs(spark, sf).collect()), key=lambda r: r[0])
    want = sorted(duck.sql(runs.ORACLES["op11_runs"]).fetchall(), key=lambda r: r[0])
    assert got == want and any(r[1] for r in got) and {r[6] for r in got if not r[1]} == {hashlib.sha256(b"").hexdigest()}
