"""Operators over the whole corpus, against brute force on small tables with copies, near copies, shared passages and odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from noticeloom.llm import decontam, exactdup, graph, induced, lm, mixing, neardup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig string, anchor long, component_id long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{0 if (i or 0) % 3 else i}", 1, "x", 1, 2) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared, base = say(60), say(90)
    out = [say(rng.randint(1, 120)) for _ in range(25)]
    out += [say(20) + " " + shared + " " + say(15) for _ in range(8)]
    for _ in range(12):
        words = base.split()
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    out += [base.upper()] * 3 + ["one", "one", "a" * 700, "é" * 150 + "ü" * 150, "ab" * 300]
    return [*enumerate(out), (900, None), (901, ""), (902, " \n"), (None, base), (903, base), (903, base)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return docs_of(spark, texts)


@pytest.mark.parametrize("memory", [1 << 20, 600])
def test_induced_sorting(memory):
    rng = random.Random(memory)
    for _ in range(150):
        t = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 50))] * rng.choice([1, 1, 2])
        t = np.array([*t, 0])
        order = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        prefix = lambda a, b: next(k for k in range(len(t)) if t[a + k] != t[b + k])
        sa, lcp = induced.suffix_array(t, memory)
        assert sa.tolist() == order and lcp.tolist() == [0] + [prefix(a, b) for a, b in zip(order, order[1:], strict=False)]


@pytest.mark.parametrize("group, shard", [(2000, 1 << 20), (1, 512)])
def test_exact_passages(docs, texts, group, shard):
    length = 60
    raw = [(t or "").encode() for _, t in texts]
    count = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    want = []
    for (i, _), r in zip(texts, raw, strict=True):
        runs = exactdup.runs_of(np.array([count[r[p : p + length]] > 1 for p in range(max(0, len(r) - length + 1))], bool), length)
        runs = exactdup.merged(runs)
        want.append((i, len(r), sum(b - a for a, b in runs), len(runs), hashlib.sha256(exactdup.cut(r, runs)).hexdigest()))
    got = [tuple(x) for x in exactdup.dedup_report(docs, length=length, seed=20, group=group, shard=shard).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exactdup.dedup_report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("group", [2000, 3])
def test_exact_passages_at_full_length(spark, group):
    """Strings of 200 bytes against a count of all of them: a passage that very many texts share, with edges of their own; half passages; runs
    of one byte, and of a short period, longer than a chunk."""
    rng = random.Random(11)
    say = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, part = say(420), say(190)
    texts = [say(rng.randint(0, 300)) + shared + say(rng.randint(0, 300)) for _ in range(40)]
    texts += [say(30) + part + say(rng.randint(0, 60)) for _ in range(40)] + [say(50) + shared[:230] + say(9), shared[100:310], "x" * 70_000, "y" * 230, "ab" * 40_000, say(250), "", "é" * 150]
    rows = [*enumerate(texts), (5, texts[0]), (None, shared[:205])]
    raw = [t.encode() for _, t in rows]
    count = Counter(r[i : i + 200] for r in raw for i in range(len(r) - 199))
    want = []
    for (i, _), r in zip(rows, raw, strict=True):
        runs = exactdup.merged(exactdup.runs_of(np.array([count[r[p : p + 200]] > 1 for p in range(max(0, len(r) - 199))], bool), 200))
        want.append((i, len(r), sum(b - a for a, b in runs), len(runs), hashlib.sha256(exactdup.cut(r, runs)).hexdigest()))
    got = [tuple(x) for x in exactdup.dedup_report(docs_of(spark, rows), group=group, shard=4096).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_text_of_one_byte_is_one_run(spark):
    rows = exactdup._anchor_rows(docs_of(spark, [(1, "x" * 200_000)]), 200, 64).collect()
    assert sum(r.n for r in rows) == 199_801 and sum(len(r.cover) for r in rows) <= 3


def test_sorting_needs_no_more_heap_for_a_longer_text():
    """A text of twelve times ``memory`` is sorted on disk, through recursion, in the heap that one of a fifth of its length needs."""
    import tracemalloc

    rng, memory, peaks = np.random.default_rng(1), 1 << 13, []
    for n in (10_000, 50_000):
        x = rng.integers(1, 4, n)
        x[n // 2 : n // 2 + n // 4] = x[: n // 4]
        text = np.append(x, 0).astype(np.int16)
        tracemalloc.start()
        pieces = 0
        for pos, _ in induced.descending_suffixes(text, memory, 200, 4):
            pieces += len(pos)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert pieces == n + 1
    assert text.nbytes > 12 * memory and peaks[1] < 1.5 * peaks[0]
    short = np.append(x[:3000], 0)
    order = sorted(range(len(short)), key=lambda i: short[i:].tolist())
    assert induced.suffix_array(short, memory)[0].tolist() == order


def test_cutting_keeps_characters_whole():
    raw = "aéb".encode()
    assert exactdup.cut(raw, exactdup.whole_characters(raw, [(0, 2)])) == "éb".encode() and exactdup.cut(b"abc", []) == b"abc"


@pytest.mark.parametrize("k, tile", [(2, 512), (2, 4), (5, 512)])
def test_near_duplicates(docs, texts, k, tile):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in texts if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = neardup.near_duplicates(docs, k=k, tile=tile).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_near_duplicates_of_nothing(docs):
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_posterior_bounds_keep_pairs_at_the_threshold():
    least = neardup.least_matches(200, 20, 0.8, 1e-9)
    assert [n for n, _ in least] == list(range(20, 201, 20)) and all(m <= 0.8 * n for n, m in least) and least[-1][1] > 100
    a = np.zeros((3, 200), np.uint16)
    b = a.copy()
    b[1, ::5] = 1
    b[2, :150] = 1
    assert neardup.surviving(a, b, least).tolist() == [0, 1]


def test_components(spark):
    links = [(5, 9), (9, 2), (2, 2), (7, 8), (None, 1)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {2: 2, 5: 2, 9: 2, 7: 7, 8: 7} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 231)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block_bytes, parts, order", [(1 << 20, 1, 2), (600, 8, 2), (1, 8, 3), (2000, 2, 4)])
def test_backoff_scores(docs, texts, block_bytes, parts, order):
    words = [(t or "").lower().split() for _, t in texts]
    grams = lambda ws, n: [tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    every = Counter(g for ws in words for n in range(1, order + 1) for g in grams(ws, n))
    total = sum(map(len, words))
    want = []
    for (i, _), ws in zip(texts, words, strict=True):
        own = Counter(g for n in range(1, order + 1) for g in grams(ws, n))
        other = lambda g, own=own: every[g] - own[g]

        def log_s(g, ws=ws, other=other):
            if len(g) == 1:
                return np.log10(max(other(g), lm.UNSEEN)) - np.log10(max(total - len(ws), 1))
            return np.log10(other(g)) - np.log10(other(g[:-1])) if other(g) else np.log10(lm.BACKOFF) + log_s(g[1:])

        s = sum(log_s(tuple(ws[max(0, j - order + 1) : j + 1])) for j in range(len(ws)))
        want.append((i, len(ws), sum(other(g) == 0 for g in grams(ws, 2)), sum(other((w,)) == 0 for w in ws), round(s / len(ws), 5) if ws else None))
    got = [(r.doc_id, r.n_words, r.n_backoff, r.n_unseen, None if r.score is None else round(r.score, 5)) for r in lm.backoff_scores(docs, block_bytes=block_bytes, parts=parts, order=order).collect()]
    near = lambda a, b: a[:4] == b[:4] and (a[4] == b[4] or abs(a[4] - b[4]) < 1e-4)
    assert all(near(a, b) for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True))
    assert lm.backoff_scores(docs.limit(0)).count() == 0


def test_backoff_scores_of_a_long_text_and_null_ids(spark):
    rows = [(None, "a b c"), (None, "a b c"), (1, "a b c " * 20_000)]
    got = lm.backoff_scores(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=50_000, parts=4).collect()
    assert sorted(r.n_words for r in got) == [3, 3, 60_000] and len({r.score for r in got if r.n_words == 3}) == 1


def test_mixing_spends_its_budget(docs, texts):
    rows = mixing.mix(docs, budget_share=1.5, block_tokens=50).collect()
    assert len(rows) == len(texts)
    spent, total = sum(r.copies * r.n_tokens for r in rows), sum(r.n_tokens for r in rows)
    assert 1.5 * total * 0.85 <= spent <= 1.5 * total and {r.doc_id: r.n_tokens for r in rows}[900] == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_exponent_meets_its_targets(spark):
    tokens = [10_000, 500, 300, 20]
    measure = mixing.measure_list(tokens, 10_820)
    a = mixing.exponent(measure, 1.2, None)
    assert abs(measure(a)[0] - 1.2) < 1e-6 and mixing.exponent(measure, None, None) == 1.0
    b = mixing.exponent(measure, 1.2, 3.0)
    assert b > a and abs(measure(b)[1] - 3.0) < 1e-6 and mixing.exponent(measure, 9.0, None) == 0.0
    other = mixing.measure_table(spark.createDataFrame([(t,) for t in tokens], "tokens long"), sum(tokens), 10_820)
    assert np.allclose(other(0.4), measure(0.4))


ITEM = "The farmer Anna Berg sold 12 apples and later Anna Berg bought 30 kg of flour for 12 neighbours in the old village market"


@pytest.mark.parametrize(
    "text, found",
    [
        ("Intro words here. " + ITEM + " and more words follow.", True),
        ("x\n" + ITEM.upper().lower().replace("anna berg", "Anna Berg"), True),
        ("Once upon. " + ITEM.replace("Anna Berg", "Otto").replace("12", "77").replace("30", "5"), True),
        ("Once upon. " + ITEM.replace("Anna Berg sold", "Otto sold").replace("12 apples", "77 apples"), False),
        ("The farmer sold apples. Later we bought flour in the market.", False),
        ("", False),
        (None, False),
    ],
)
def test_contamination(spark, text, found):
    bench = spark.createDataFrame([(1, ITEM, "x"), (2, "too short", "x"), (3, None, "x"), (None, "a b c d e f g", "x"), (1, ITEM, "x")], "item_id long, text string, tokens string")
    got = decontam.contamination(docs_of(spark, [(5, text), (5, text), (6, "other words entirely")]), bench).where("contaminated").collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(5, 1)] if found else [])


def test_contamination_at_every_alignment(spark):
    """Items with few windows of enough words, beside one SQL form that skips no window."""
    import duckdb

    items = ["Find the mean of the numbers 12, 15, 18, 21, 24, 27, 30, 33, 36 and 39", "Sort these numbers " + " ".join(map(str, range(1, 15))), "Solve: " + " ".join(map(str, range(3, 16))) + " for the smallest", ITEM]
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    docs = docs_of(spark, [(10 * i + k, " ".join("abcde"[:k]) + ". " + t + " . and so on") for i, t in enumerate(items) for k in range(6)])
    got = sorted(tuple(r) for r in decontam.contamination(docs, benchmark).collect())
    assert [r[:2] for r in got if r[-1]] == [(10 * i + k, i) for i in range(len(items)) for k in range(6)]
    duck = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", benchmark)):
        duck.register(name, df.toArrow())
    assert got == sorted(duck.sql(decontam.ORACLES["op8_decontamination"]).fetchall())


def test_contamination_judges_every_place(spark):
    item = "The boy with 3 apples and the girl with 5 pears went to the market to buy some bread"
    mixed, other = item.replace("3", "4").replace("5", "4"), item.replace("3", "8").replace("5", "9")
    docs = docs_of(spark, [(1, f"{mixed}. {item}."), (2, f"{mixed}. {mixed}. So. {other}."), (3, f"{mixed}. {mixed}."), (4, f"{item}. {mixed}.")])
    got = decontam.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: True, 3: False, 4: True}


def test_contamination_by_scattered_windows(spark):
    """Windows that match on two diagonals reach the share together, wherever the text begins."""
    import duckdb

    item = "the farmer carried baskets of fruit across the old bridge"
    text = "the farmer carried baskets of fruit of fruit across the old bridge"
    docs = docs_of(spark, [(i, " ".join(["zq"] * i) + " " + text) for i in range(8)] + [(9, "the farmer carried fruit"), (10, None), (10, "")])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted(tuple(r) for r in decontam.contamination(docs, benchmark).collect())
    assert [r[:2] for r in got if r[-1]] == [(i, 1) for i in range(8)]
    duck = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", benchmark)):
        duck.register(name, df.toArrow())
    assert got == sorted(duck.sql(decontam.ORACLES["op8_decontamination"]).fetchall())


def test_contamination_on_random_tables(spark):
    """Texts cut and joined from items' words, beside the SQL form that skips nothing: all in one table, an item and a text a number."""
    import duckdb

    rng = random.Random(5)
    words = ["red", "blue", "stone", "river", "house", "Anna", "Otto", "12", "7", "30 kg", "under", "over", "the", "bridge", "market"]
    items = [" ".join(rng.choices(words, k=rng.randint(8, 25))) for _ in range(30)]
    texts = []
    for _ in range(200):
        a = rng.choice(items).split()
        b = a[rng.randint(0, 3) :]
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice(words)
        texts.append(" ".join(rng.choices(["so", "then", "x"], k=rng.randint(0, 4)) + b))
    docs = docs_of(spark, [*enumerate(texts)])
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    duck = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", benchmark)):
        duck.register(name, df.toArrow())
    # with a short run its rule comes into play, and the windows in a row by which runs are found
    for run in (decontam.RUN, 7):
        rows = sorted(duck.sql(decontam.sql_form(run)).fetchall())
        assert sorted(tuple(r) for r in decontam.contamination(docs, benchmark, run=run).collect()) == rows and len(rows) > 100


def test_runs_of_long_items_are_found_wherever_they_lie(spark):
    """Stretches of a long item whose windows are common elsewhere: every run must meet one of the chosen windows."""
    import duckdb

    rng = random.Random(8)
    item = ["w" + chr(97 + i % 26) + chr(97 + i // 26) if i % 3 else "common" for i in range(260)]
    texts = [" ".join(["zz"] * rng.randint(0, 5) + item[a : a + n] + ["qq"]) for a in range(0, 230, 9) for n in (20, 24, 25, 30)]
    docs = docs_of(spark, [*enumerate(texts)])
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    duck = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", benchmark)):
        duck.register(name, df.toArrow())
    want = sorted(duck.sql(decontam.sql_form(24)).fetchall())
    assert sorted(tuple(r) for r in decontam.contamination(docs, benchmark, run=24).collect()) == want and 50 < len(want) < len(texts)


def test_bare_answers_are_left_out(spark):
    benchmark = spark.createDataFrame([(1, "Yes"), (2, "42"), (3, "Paris"), (4, None), (5, "What is 17 * 24 + 6?"), (6, "in the year 1999")], "item_id long, text string")
    docs = docs_of(spark, [(1, "Yes, in Paris there are 42 bridges, built in the year 1999."), (2, "So what is 17 * 24 + 6? Yes")])
    assert [(r.doc_id, r.item_id) for r in decontam.contamination(docs, benchmark).collect()] == [(2, 5)]
    assert {r.item_id: r.n_words for r in decontam.left_out(benchmark).collect()} == {1: 1, 2: 1, 3: 1, 4: 0, 6: 4}
    assert [(r.doc_id, r.item_id) for r in decontam.contamination(docs, benchmark, min_words=4).collect() if r.item_id == 6] == [(1, 6)]


def test_contamination_searches_every_item_and_text(spark):
    words = "".join(chr(97 + i // 26) + chr(97 + i % 26) + "x " for i in range(450)).split()
    short, numbers, passage = "Define entropy", "What is 17 * 24 + 6?", " ".join(words[100:300])
    benchmark = spark.createDataFrame([(1, short), (2, numbers), (3, " ".join(words)), (4, "?!"), (5, ITEM)], "item_id long, text string")
    texts = [(1, "please Define entropy. Now"), (2, "so he asks What is 17 * 24 + 6? Then"), (3, "Say What is 17 * 24 + 7?"), (4, f"Quote: {passage}. End"), (5, " ".join(words[100:140])), (6, "define entropyless"), (None, f"Here. {ITEM} now"), (None, "clean words of nobody at all")]
    docs = docs_of(spark, texts)
    got = decontam.contamination(docs, benchmark).where("contaminated").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(2, 2), (4, 3), (None, 5)} and len(got) == 3, "two words identify nothing"
    left = decontam.without_contaminated(docs, benchmark)
    assert left.columns == docs.columns and {(r.doc_id, r.text) for r in left.collect()} == {texts[i] for i in (0, 2, 4, 5, 7)}


def test_mixing_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c", "s", 0.5, "x", 9), (2, None, None, 0.1, None, 8), (3, "d e", "s", 0.2, "y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double, n_tokens string, block int")
    got = mixing.mix(docs, keep=("doc_id", "source", "weight", "n_tokens", "block")).collect()
    assert {(r.doc_id, r.weight, r.n_tokens, r.block) for r in got} == {(1, 0.5, "x", 9), (2, 0.1, None, 8), (3, 0.2, "y", 7)}
    assert {r.doc_id: r.n_tokens_ for r in got} == {1: 3, 2: 0, 3: 2} and all(r.weight_ in (0.0, 1.0) and r.block_ is not None for r in got)


def test_contamination_of_nothing(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = docs_of(spark, [(1, ITEM)])
    assert decontam.contamination(docs.limit(0), bench).count() == 0 and decontam.contamination(docs, bench.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    page = "<p>" + "é" * 120
    rows = [(1, "http://a/%0A\nb", page), (2, None, page), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (2, None, page), (None, "u", page)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    segments = warc.write_archives(pages, segment_bytes=300)
    got = warc.read_archives(segments).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    assert sorted(((r.page_id, r.url) for r in got), key=key) == sorted(((r[0], r[1]) for r in rows), key=key)
    for r in got:
        html = next((h or "").encode() for i, _, h in rows if i == r.page_id)
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha256(html).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", 1) if r.page_id == 2 else ("response", None)) and (r.payload is None or bytes(r.payload) == html)
    assert warc.export_archives(segments, str(tmp_path)) >= 2
    assert warc.read_archives(warc.import_archives(spark, str(tmp_path))).count() == len(rows)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_broken_archives_are_errors():
    good = warc.write_record(1, "u", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None)
    assert len(list(warc.read_stream([good[:7], good[7:] + good]))) == 2
    for bad in (good[:-9], good + b"tail", warc.write_record(1, "u", b"x" * 200, "0" * 64, None)):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read_stream([bad]))


def test_very_long_texts(spark):
    """Texts of a megabyte and more go through every operator over the corpus."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    long = " ".join(rng.choices(words, k=200_000))
    near = long.replace(words[0], "other")
    docs = docs_of(spark, [(1, long), (2, near), (3, "short text"), (4, long[:100_000] + ". " + ITEM + ". " + long[:1000])])
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got[1] == got[2] == 1 and got[3] == 3 and got[4] == 4
    report = {r.doc_id: r.n_removed for r in exactdup.dedup_report(docs).collect()}
    assert report[1] > 0.9 * len(long) and report[3] == 0
    found = decontam.contamination(docs, spark.createDataFrame([(7, ITEM)], "item_id long, text string")).where("contaminated").collect()
    assert [r.doc_id for r in found] == [4]
    assert {r.doc_id: r.n_tokens for r in mixing.mix(docs).collect()}[1] == 200_000
    pages = docs.selectExpr("doc_id AS page_id", "'u' AS url", "text AS html")
    assert {r.page_id: r.payload_bytes for r in warc.read_archives(warc.write_archives(pages)).collect()}[2] == len(near)


def test_exact_duplicates_beside_their_sql_form(spark):
    """Shared passages at every offset, overlapping ones, texts of several bytes a character, copies and odd rows."""
    import duckdb

    rng = random.Random(6)
    say = lambda n: "".join(rng.choices("abcdefgh é新", k=n))
    shared = [say(260) for _ in range(4)]
    texts = [say(rng.randint(0, 90)) + rng.choice(shared)[rng.randint(0, 40) :] + say(rng.randint(0, 300)) + rng.choice(shared)[: rng.randint(150, 260)] for _ in range(40)]
    texts += [texts[0], "ab" * 150, "x" * 199, "x" * 200, "", None]
    docs = docs_of(spark, [*enumerate(texts)])
    duck = duckdb.connect()
    duck.register("documents", docs.toArrow())
    want = sorted(duck.sql(exactdup.ORACLES["op4_exactdup"]).fetchall())
    assert sorted(tuple(r) for r in exactdup.dedup_report(docs).collect()) == want and sum(r[3] for r in want) > 40
