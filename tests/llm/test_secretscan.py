"""Secret scans against the stated patterns, and the models on strings they were not trained on."""

import hashlib
import random
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from noticeloom.llm import secretscan as ss

STATED = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def plain(text: str) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, (p, fine) in enumerate(STATED.values()) for m in p.finditer(text) if fine(m))


def random_string(draw: random.Random, chars: str, n: int) -> str:
    return "".join(draw.choices(chars, k=n))


_HEX, _BASE64 = "0123456789abcdef", string.ascii_letters + string.digits + "+/"
PIECES = st.sampled_from(["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "AKIA", "A1B2", "0f", "deadbeef", "é", "ſ", "K", "abc", ".", "-", "\n", "x9/+"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_base_spans_are_those_of_the_stated_patterns(text):
    model = ss.Model(ss.np.zeros(ss.SIZE**2), 0.0)
    assert ss.scan(text.encode(), model) == plain(text)


def test_a_match_that_is_too_short_still_takes_its_place():
    assert [m[1] for m in plain("secret: password: abcdefghijklmnop")] == []
    assert ss.base_spans(b"secret: password: abcdefghijklmnop") == []


WORDS = "get set user account name identifier connection pool size value string request response handler config server client error message buffer index update delete create table query".split()


def names(draw: random.Random, n: int) -> list[str]:
    out = []
    for _ in range(n):
        ws = draw.choices(WORDS, k=draw.randint(3, 6))
        out.append(draw.choice([ws[0] + "".join(w.capitalize() for w in ws[1:]), "_".join(ws), "_".join(ws).upper(), "-".join(ws), "/".join(["", *ws])]) + draw.choice(["", "", "2", "01"]))
    return out


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(1)
    rows = [(x, 0) for x in names(draw, 3000)] + [(random_string(draw, draw.choice([_HEX, _BASE64]), 32), 1) for _ in range(500)] + [(None, 0), ("skipped", 7), ("x", None)]
    return ss.fit(ss.sample_transitions(spark.createDataFrame(rows, "text string, label int").repartition(3)))


def test_models_tell_random_strings_from_names(model):
    draw = random.Random(2)
    ordinary = [x for x in names(draw, 3000) if len(x) >= ss.MIN_TOKEN]
    secret = [random_string(draw, chars, 32) for chars in (_HEX, _HEX.upper(), _BASE64, string.ascii_letters + string.digits) for _ in range(300)]
    assert sum(ss.is_random(x.encode(), model) for x in ordinary) <= 0.001 * len(ordinary)
    assert sum(ss.is_random(x.encode(), model) for x in secret) >= 0.99 * len(secret)
    assert not ss.is_random(b"=" * 40, model) and not ss.is_random(b"-" * 40, model)


def test_method_adds_spans_and_base_ones_stay(model):
    key = "Zx8Kq2Vw9Rt4Lm7Pj3Hs"
    text = f"é {key} and token={key} then 0123456789abcdef0 getUserAccountIdentifier"
    got = ss.scan(text.encode(), model)
    assert [x for x in got if x[1] < 3] == plain(text) and [(s, e) for s, k, e in got if k == 3] == [(2, 22)]
    assert text[2:22] == key


def test_corpus_is_its_own_sample(spark):
    draw = random.Random(3)
    texts = [" ".join(names(draw, 20)) + f" token = {random_string(draw, _HEX, 40)} " for _ in range(60)] + [None, "", " "]
    hidden = [random_string(draw, _HEX.upper(), 40) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate([*texts, *hidden])], "doc_id long, text string, spans string, label int")
    model = ss.fit(ss.corpus_transitions(docs))
    got = {r.doc_id: r.spans for r in ss.find_secrets(docs, model).collect()}
    assert all(any(s.kind == "assign" for s in got[i]) and not any(s.kind == "markov" for s in got[i]) for i in range(60))
    assert [got[60], got[61], got[62]] == [[], [], []] and all([(s.kind, s.start, s.end) for s in got[63 + i]] == [("markov", 0, 40)] for i in range(20))


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (2, "token=" + "a1b2" * 50000), (3, "é token='AbCdEf123456'"), (3, "é token='AbCdEf123456'")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    empty = ss.fit(ss.corpus_transitions(docs.limit(0)))
    assert empty.mean == 0 and ss.find_secrets(docs.limit(0), empty).count() == 0
    got = ss.find_secrets(docs, empty).collect()
    assert len(got) == 5 and [len(r.spans) for r in got if r.doc_id in (None, 1)] == [0, 0]
    assert all([(s.kind, s.start, s.end) for s in r.spans] == [("assign", 2, 21)] for r in got if r.doc_id == 3)
    (long,) = (r.spans for r in got if r.doc_id == 2)
    assert [(s.kind, s.start, s.end) for s in long] == [("assign", 0, 200006), ("hex", 6, 200006)]


def test_query_against_the_stated_patterns(spark):
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables are not here")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = ss.op12_secrets(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        line = ",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and ",".join(x for x in r.spans.split(",") if not x.startswith("markov")) == line


def test_sql_form_finds_the_same(spark):
    """Planted keys, names, base spans of every kind, marks of the SQL form's own and odd rows, beside DuckDB."""
    import duckdb

    draw = random.Random(9)
    hidden = [random_string(draw, chars, 24) for chars in (_HEX.upper(), _BASE64, string.ascii_letters) for _ in range(10)]
    texts = [" ".join(draw.sample([*names(draw, 12), *draw.choices(hidden, k=1), f"token={random_string(draw, _HEX, 20)}", f"Secret : '{random_string(draw, _BASE64, 14)}'", "AKIA" + random_string(draw, string.ascii_uppercase, 16), "é\x01ö\x02", random_string(draw, _HEX, 33), "ſecret=abcdefghijklmn"], 14)) for _ in range(80)]
    docs = spark.createDataFrame([*enumerate([*texts, None, "", "\x03", texts[0]])], "doc_id long, text string")
    found = ss.find_secrets(docs, ss.fit(ss.corpus_transitions(docs))).collect()
    got = {r.doc_id: ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans) for r in found}
    duck = duckdb.connect()
    duck.register("documents", docs.toArrow())
    want = {r[0]: r[5] for r in duck.sql(ss.sql_form()).fetchall()}
    assert got == want and sum("markov" in x for x in got.values()) > 20
