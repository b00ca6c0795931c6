import os

import pytest

import corpus_pipeline as P
from noticeloom.llm import exactdup
from noticeloom.llm._common import materialise

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in P.STAGES:
        got = materialise(stage(spark, docs, SF), "t")
        assert 0 < got.count() <= n
        if name != "mixing":
            assert got.columns == columns and got.schema.simpleString() == docs.schema.simpleString()
            docs, n = got, got.count()
    assert {"doc_id", "weight", "copies"} <= set(got.columns)


def test_stages_bear_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(90))
    rows = [(1, base, "en", "s", 1, "x"), (1, base, "en", "s", 1, "x"), (2, base + " end", None, None, None, "x"), (3, None, "en", "s", 0, "x"), (4, "", "en", "s", 0, "x"), (None, "null id", "en", "s", 1, "x"), (5, "é " * 400, "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _op_score string")
    left = P.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == [(False, 1), (False, 3), (False, 4), (False, 5), (True, 0)]
    cut = {r.doc_id: r for r in P.cut_repeated_passages(spark, docs, SF).collect()}
    assert cut[3].text is None and cut[1].text == "" and cut[2].text.endswith("end") and cut[2].n_chars == len(cut[2].text)
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0).select(docs.columns[:5]), SF).count() == 0
    assert exactdup.LENGTH == 200


def _corpus(seed=3):
    """Texts with copies, near copies, a passage that several share, benchmark questions, one id with two texts, and odd rows."""
    import random

    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(500)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage, base = say(70), say(80)
    item = "A train leaves Paris at 7 hours and covers 300 km before it meets another train from Lyon in the old station"
    near = base.split()
    near[40] = "changed"
    texts = [(i, say(rng.randint(5, 90))) for i in range(20)]
    texts += [(20 + i, say(20) + " " + passage + " " + say(20)) for i in range(4)] + [(30, base), (31, base), (32, " ".join(near)), (33, base + " " + say(3))]
    texts += [(40, say(10) + ". " + item + ". " + say(10)), (41, say(30)), (41, say(12) + ". " + item), (42, None), (43, ""), (None, base), (44, "é " * 300), (45, "é " * 300), (46, say(9)), (46, base)]
    return [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "x", 1.0) for i, t in texts], item


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on its own input, by plain means; extra columns bear the names that stages use."""
    import duckdb

    from noticeloom.llm import mixing, toxicity

    rows, item = _corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long, is_toxic string, weight double"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, int(i % 2), 1) for i in range(20)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    sf, plain = str(tmp_path), [r[:2] for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=key)

    # toxicity: every text by itself
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~toxicity.is_held_out())
    state = model.start()
    want = [p for p in plain if toxicity.score_text(None if p[1] is None else p[1].encode(), model, state)[0] < 0.7]
    got = P.reject_toxic(spark, docs, sf)
    assert got.columns == docs.columns and pairs(got) == sorted(want, key=key)

    # near duplicates: all pairs of (id, text), the smallest id of a component stays; equal rows leave once
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    nodes = sorted({p for p in plain if p[0] is not None}, key=key)
    label = {p: p[0] for p in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                x, y = shingles(a[1]), shingles(b[1])
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    want = [p for p in nodes if label[p] == p[0]] + [p for p in plain if p[0] is None]
    assert pairs(P.drop_near_duplicates(spark, docs, sf)) == sorted(want, key=key)

    # passages: every string of 200 bytes is counted
    from collections import Counter

    raw = [(t or "").encode() for _, t in plain]
    count = Counter(r[i : i + 200] for r in raw for i in range(len(r) - 199))
    want = []
    for (i, t), r in zip(plain, raw, strict=True):
        gone = {j for p in range(len(r) - 199) if count[r[p : p + 200]] > 1 for j in range(p, p + 200)}
        runs = exactdup.merged((j, j + 1) for j in gone)
        want.append((i, None if t is None else exactdup.cut(r, exactdup.whole_characters(r, runs)).decode()))
    got = P.cut_repeated_passages(spark, docs, sf)
    assert pairs(got) == sorted(want, key=key) and all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None)

    # decontamination: who holds the question goes; another text under the same id stays
    want = [p for p in plain if item not in (p[1] or "")]
    assert len(want) == len(plain) - 2 and pairs(P.drop_contaminated(spark, docs, sf)) == sorted(want, key=key)

    # mixing: the operator's SQL form on the same rows
    got = P.mix_sources(spark, docs, sf)
    duck = duckdb.connect()
    duck.register("documents", docs.select("doc_id", "text", "source").toArrow())
    names = ["doc_id", "source", "n_tokens", "weight", "full_epochs", "copies", "block"]
    text = lambda r: str([round(x, 6) if isinstance(x, float) else x for x in r])
    assert sorted(text(r) for r in got.select(names).collect() for r in [tuple(r)]) == sorted(text(r) for r in duck.sql(mixing.ORACLE).select(*names).fetchall())
