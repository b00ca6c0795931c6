"""Operator 8, benchmark decontamination by template canonicalisation; DataFrame functions only.

Texts become templates: names (capitalised words inside a sentence), numbers and the units behind them become typed
placeholders; the rest is compared lower-cased, without punctuation. Of every benchmark item and every text all windows of
``WINDOW`` template tokens are hashed: an item may have one window alone that identifies it, so none is skipped. A text is contaminated
by an item if it has at least ``COVER`` percent of the item's windows and its slots are consistent: along some diagonal that has
``COVER`` percent by itself, or the one on which most windows lie, equal fillers of the item stand against equal fillers of the text and different
ones against different ones, type by type. A copy is consistent, and so is a question with other names and numbers; a text that merely
shares the template's words with mixed-up slots is not.

Of an item so long that ``COVER`` percent of it are over ``RUN`` tokens, ``RUN`` tokens in a row are enough, with consistent slots
inside them. An item without a window that identifies it (under ``WINDOW`` template tokens, or fewer than ``LITERALS`` words in each
window) is found verbatim: its words and numbers, fillers included, in order and next to each other; it counts as one window. An
item of fewer than ``MIN_WORDS`` words and numbers, a bare answer, stands in texts that have never seen the benchmark: it is left
out, and ``left_out`` tells which are.

Candidates come from an item's rarest windows. Who has COVER percent of n windows has one of any n - COVER percent + 1 of them, and who
has ``RUN`` tokens in a row has a window in any ``WINDOW`` places in a row among them; so windows are counted over all texts first and
the rarest such sets looked up: a phrase that many items and very many texts share joins nobody, and no link is lost. Candidates
alone meet with all of their item's windows.

Defined results: null and empty texts match nothing; items without a letter or digit identify nothing; repeated texts and rows are
judged alike, one row for each (doc_id, item_id), texts without an id together under a null doc_id; repeated item ids are joined by
their smallest text; empty tables give no row; a very long text is one row's work, its windows rows of their own; further columns are ignored.
Tables made of the benchmark or of candidates are broadcast up to ``BROADCAST_ROWS`` counted rows and joined by a shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm._common import materialise, quoted, table, tidy, unused

WINDOW, LITERALS, COVER, RUN, MIN_WORDS = 5, 3, 50, 50, 5
BROADCAST_ROWS = 1_000_000
NUM, NAME, UNIT, END = "\ue000", "\ue001", "\ue002", "\ue003"
UNITS = "kg|kilograms?|grams?|g|mg|tons?|pounds?|lbs?|km|kilometers?|kilometres?|meters?|metres?|m|cm|mm|miles?|inches|inch|feet|foot|ft|hours?|hrs?|h|minutes?|mins?|min|seconds?|secs?|s|days?|weeks?|months?|years?|dollars?|euros?|cents?|usd|eur|percent|liters?|litres?|l|ml|degrees?"
_NAMES = r"([\p{Ll},;] )(\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)*)"
_NUMBERS = rf"(\p{{N}}+(?:[.,]\p{{N}}+)*)(?: ?({UNITS})([^\p{{L}}\p{{N}}]|$))?"
_STRIP = f"([{NUM}{NAME}{UNIT}])[^{END}]*{END}"
_SPLIT = rf"[^\p{{L}}\p{{N}}{NUM}{NAME}{UNIT}]+"
_TOKEN = rf"[{NUM}{NAME}{UNIT}][^{END}]*{END}|[\p{{L}}\p{{N}}]+"
_SLOT = f"[{NUM}{NAME}{UNIT}]"
_PLAIN = r"\p{N}+(?:[.,]\p{N}+)*|\p{L}+"


def _flat(pattern: str) -> str:
    """For the JVM: its ``(...)*`` goes one call deeper with each turn, and a run of many thousand names or digits would end the executor. What
    follows these groups can be empty, so they never give anything back: as possessive ones they match the same, in a loop."""
    return pattern.replace(")*", ")*+")


def tagged(text: Column) -> Column:
    """The text with every name, number and unit marked and ended."""
    own = F.contains(text, F.lit(NUM)) | F.contains(text, F.lit(NAME)) | F.contains(text, F.lit(UNIT)) | F.contains(text, F.lit(END))
    text = F.when(own, F.translate(text, NUM + NAME + UNIT + END, "    ")).otherwise(text)
    text = F.regexp_replace(text, _flat(_NAMES), f"$1{NAME}$2{END}")
    text = F.regexp_replace(text, _flat(_NUMBERS), f" {NUM}$1{END}{UNIT}$2{END}$3")
    return F.lower(F.replace(text, F.lit(UNIT + END), F.lit(" ")))


def template(text: Column) -> Column:
    """Tokens of the template, each placeholder one character."""
    return F.split(F.regexp_replace(tagged(text), _STRIP, "$1 "), _SPLIT)


def tagged_tokens(text: Column) -> Column:
    """The same tokens with the placeholders' fillers behind them."""
    return F.regexp_extract_all(tagged(text), F.lit(_TOKEN), F.lit(0))


def _kinds(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike(_SLOT), F.substring(t, 1, 1)).otherwise(t))


def _windows(tokens: Column, n: int) -> Column:
    """Hash and place of every window."""
    at = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    return F.when(F.size(tokens) >= n, F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(tokens, i, F.lit(n))).alias("w"))))


def _items(benchmark: DataFrame, min_words: int) -> DataFrame:
    one = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))
    one = one.withColumn("words", _words(F.col("text"))).where(F.size("words") >= min_words)
    tokens = one.select("item_id", "text", "words", tagged_tokens(F.col("text")).alias("item_tokens"))
    return tokens.withColumn("kinds", _kinds(F.col("item_tokens")))


def left_out(benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """item_id, n_words of the items that are too short to be looked for; null texts have no words."""
    one = benchmark.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))
    return one.select("item_id", F.coalesce(F.size(_words(F.col("text"))), F.lit(0)).alias("n_words")).where(F.col("n_words") < min_words)


def _key() -> Column:
    """What texts are told apart by: a verdict depends on the text alone, whatever its id, and repeated texts are judged once."""
    return F.md5(F.col("text").cast("binary"))


def _words(text: Column) -> Column:
    """Words and numbers as they stand; unlike the template they do not depend on what is around a passage."""
    return F.regexp_extract_all(F.lower(text), F.lit(_flat(_PLAIN)), F.lit(0))


def _places(tokens: Column, n: int, key: str, df: DataFrame, at: str) -> DataFrame:
    """key, at, w of every window of ``n`` tokens. The tokens are a column of their own first: a lambda would compute them anew each time."""
    return df.select(key, tokens.alias("_tokens")).select(key, F.explode(_windows(F.col("_tokens"), n)).alias("x")).select(key, F.col("x.at").alias(at), F.col("x.w").alias("w"))


def _verbatim(texts: DataFrame, items: DataFrame, n: int) -> DataFrame | None:
    """h, item_id of the texts that hold all words and numbers of an item, in order and next to each other: every window of its words stands
    on one diagonal. Windows are rows, texts are not copied."""
    own = items.select("item_id", F.size(F.filter("item_tokens", lambda t: t.rlike(_SLOT))).cast("long").alias("n_slots"), "words", F.least(F.size("words"), F.lit(n)).alias("k"))
    own = materialise(own.where("k > 0"), "verbatim-items")
    sizes = sorted(r.k for r in own.select("k").distinct().collect())
    found = None
    for k in sizes:
        part = own.where(F.col("k") == k)
        windows = materialise(_places(F.col("words"), k, "item_id", part, "item_at"), "verbatim-windows")
        n_all = windows.count()
        seen = _seen(_places(_words(F.col("text")), k, "t", texts.select(F.xxhash64("text").alias("t"), "text"), "at"), windows, n_all)
        candidates = _candidates(seen, _rarest(windows, seen, 100, n_all), n_all)
        near = _near(texts, candidates, _words(F.col("text")))
        hits = _hits(_places(F.col("tokens"), k, "h", near, "at"), candidates.join(near.select("t", "h"), "t"), windows, n_all)
        whole = hits.groupBy("h", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count("*").alias("c"))
        whole = whole.join(_bounded(part.select("item_id", "n_slots", (F.size("words") - (k - 1)).alias("n_places")), n_all), "item_id").where("c = n_places")
        one = F.lit(1).cast("long")
        rows = whole.select("h", "item_id", one.alias("n_windows"), one.alias("n_matched"), "n_slots", F.lit(True).alias("is_top"), F.lit(True).alias("consistent"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _seen(places: DataFrame, windows: DataFrame, n_all: int) -> DataFrame:
    """(t, w): which of the items' windows a text has, each once."""
    return materialise(places.join(_bounded(windows.select("w").distinct(), n_all), "w", "left_semi").select("t", "w").distinct(), "seen")


def _rarest(windows: DataFrame, seen: DataFrame, cover: int, n_all: int, fences: DataFrame | None = None, n: int = 0, run: int = 0) -> DataFrame:
    """(item_id, w): of every item the rarest windows of which a text with ``cover`` percent must have one; of the items of ``fences``, whose runs
    count too, also ``n`` places in a row, the rarest ones, of every stretch that a run cannot jump."""
    counts = windows.select("item_id", "item_at", "w").join(_bounded(seen.groupBy("w").agg(F.count("*").alias("c")), n_all), "w", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    counts = materialise(counts, "window-counts")
    ranked = counts.select("item_id", "w", "c").distinct()
    item = Window.partitionBy("item_id")  # an item's windows are no more than its own tokens
    ranked = ranked.withColumn("k", F.row_number().over(item.orderBy("c", "w"))).withColumn("n", F.count("*").over(item))
    chosen = ranked.where(F.col("k") <= F.col("n") - F.floor((F.col("n") * cover + 99) / 100) + 1).select("item_id", "w")
    if fences is None:
        return chosen
    size = max(1, (run - n + 1) // 2)  # a run spans one of these stretches whole
    long = counts.join(_bounded(fences, n_all), "item_id", "left_semi").withColumn("stretch", F.floor((F.col("item_at") - 1) / size))
    long = long.withColumn("cost", F.sum("c").over(item.orderBy("item_at").rangeBetween(0, n - 1)))
    inside = F.when((F.col("item_at") - 1) % size + n <= size, F.struct("cost", "item_at"))
    best = long.groupBy("item_id", "stretch").agg(F.min(inside)["item_at"].alias("first"))
    fence = long.join(_bounded(best, n_all), ["item_id", "stretch"]).where("first IS NULL OR item_at BETWEEN first AND first + " + str(n - 1))
    return chosen.unionByName(fence.select("item_id", "w")).distinct()


def _candidates(seen: DataFrame, chosen: DataFrame, n_all: int) -> DataFrame:
    return materialise(seen.join(_bounded(chosen, n_all), "w").select("t", "item_id").distinct(), "candidates")


def _near(texts: DataFrame, candidates: DataFrame, tokens: Column) -> DataFrame:
    """t, h, tokens of the candidates' texts, each distinct text once."""
    few = candidates.select("t").distinct()
    rows = texts.withColumn("t", F.xxhash64("text")).join(_bounded(few, candidates.count()), "t", "left_semi").groupBy("t", _key().alias("h")).agg(F.first("text").alias("text"))
    return materialise(rows.select("t", "h", tokens.alias("tokens")), "candidate-tokens")


def _hits(places: DataFrame, pairs: DataFrame, windows: DataFrame, n_all: int) -> DataFrame:
    """h, item_id, at, item_at, w: all places of a candidate's windows, of its own item alone."""
    asked = pairs.select("h", "item_id").join(_bounded(windows, n_all), "item_id")
    return places.join(asked, ["h", "w"])


def _bounded(df: DataFrame, n: int) -> DataFrame:
    """With a hint to broadcast where its rows have been counted and are few."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _judged(texts: DataFrame, benchmark: DataFrame, n: int, cover: int, literals: int, run: int, min_words: int) -> DataFrame:
    """A row for each distinct text (``h``), item and place that is judged."""
    items = materialise(_items(benchmark, min_words), "items")
    literal = lambda tokens: F.size(F.filter(tokens, lambda t: ~t.rlike(_SLOT))) >= literals
    windows = items.where(F.size("kinds") >= n).select("item_id", "kinds", F.explode(F.sequence(F.lit(1), F.size("kinds") - (n - 1))).alias("item_at"))
    windows = windows.withColumn("window", F.slice("kinds", F.col("item_at"), F.lit(n))).where(literal(F.col("window")))
    windows = materialise(windows.select("item_id", "item_at", F.xxhash64("window").alias("w")), "item-windows")
    n_all = windows.count()
    sizes = windows.groupBy("item_id").agg(F.countDistinct("w").alias("n_windows"))
    verbatim = _verbatim(texts, items.join(windows.select("item_id").distinct(), "item_id", "left_anti"), n)
    seen = _seen(_places(template(F.col("text")), n, "t", texts.select(F.xxhash64("text").alias("t"), "text"), "at"), windows, n_all)
    is_long = F.size("kinds") * cover > 100 * run
    chosen = _rarest(windows, seen, cover, n_all, items.where(is_long).select("item_id"), n, run)
    candidates = _candidates(seen, chosen, n_all)
    near = _near(texts, candidates, tagged_tokens(F.col("text")))
    hits = _hits(_places(_kinds(F.col("tokens")), n, "h", near, "at"), candidates.join(near.select("t", "h"), "t"), windows, n_all)
    # an item may repeat a window, and a text an item: places are counted once, on every diagonal
    diagonals = hits.groupBy("h", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.collect_set("w").alias("ws"), F.sort_array(F.collect_list("item_at")).alias("ats"))
    # windows no more than n apart leave no token between them: where the gaps are wider, a run ends
    starts = F.filter(F.sequence(F.lit(1), F.size("ats")), lambda i: (i == 1) | (F.get("ats", i - 1) - F.get("ats", i - 2) > n))
    diagonals = diagonals.withColumn("c", F.size("ats")).withColumn("starts", starts)
    runs = F.transform("starts", lambda i, j: F.struct(F.get("ats", i - 1).alias("first"), (F.get("ats", F.coalesce(F.get("starts", j + 1), F.col("c") + 1) - 2) + (n - 1)).alias("last")))
    diagonals = diagonals.withColumn("runs", F.filter(runs, lambda r: r["last"] - r["first"] + 1 >= run))
    pairs = diagonals.groupBy("h", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ws")))).alias("n_matched"), F.max_by("shift", F.struct("c", -F.col("shift"))).alias("top"), F.collect_list(F.struct("shift", F.size("ws").alias("own"), "runs")).alias("places")
    )
    lengths = items.select("item_id", F.size("kinds").alias("item_size"))
    n_tokens = items.agg(F.coalesce(F.sum(F.size("item_tokens")), F.lit(0))).first()[0]
    pairs = pairs.join(_bounded(sizes.join(lengths, "item_id"), n_all), "item_id")
    # windows of several places may reach the share together: then the place with most of them is judged as well
    share = F.col("n_matched") * 100 >= cover * F.col("n_windows")
    whole = F.filter("places", lambda p: share & ((p["shift"] == F.col("top")) | (p["own"] * 100 >= cover * F.col("n_windows"))))
    whole = F.transform(whole, lambda p: F.struct(p["shift"].alias("shift"), F.lit(1).alias("first"), F.col("item_size").alias("last"), (p["shift"] == F.col("top")).alias("is_top")))
    # of a long item a run is enough, and only its own slots count
    long = F.col("item_size") * cover > 100 * run
    parts = F.flatten(F.transform("places", lambda p: F.transform(F.filter(p["runs"], lambda r: long), lambda r: F.struct(p["shift"].alias("shift"), r["first"].alias("first"), r["last"].alias("last"), F.lit(False).alias("is_top")))))
    pairs = pairs.select("h", "item_id", F.col("n_windows").cast("long"), F.col("n_matched").cast("long"), F.explode(F.concat(whole, parts)).alias("place")).select("h", "item_id", "n_windows", "n_matched", "place.*")
    pairs = materialise(pairs, "places")
    # slots meet as rows, so a text that holds a template many times is not copied for each place
    slots_of = lambda df, key, tokens, at, name: df.select(key, F.posexplode(tokens).alias("i", name)).where(F.col(name).rlike(_SLOT)).select(key, (F.col("i") + 1).alias(at), name)
    place = ["h", "item_id", "shift", "first", "last", "is_top"]
    asked = pairs.select(*place).join(_bounded(slots_of(items, "item_id", "item_tokens", "item_at", "f"), n_tokens), "item_id").where("item_at BETWEEN first AND last").withColumn("at", F.col("item_at") + F.col("shift"))
    met = asked.join(slots_of(near, "h", "tokens", "at", "g"), ["h", "at"]).where(F.substring("f", 1, 1) == F.substring("g", 1, 1))
    met = met.groupBy(*place).agg(F.collect_set(F.struct("f", "g")).alias("slots"), F.count("*").alias("n_slots"))
    both = pairs.join(met, place, "left").withColumn("n_slots", F.coalesce("n_slots", F.lit(0).cast("long")))
    distinct = lambda name: F.size(F.array_distinct(F.transform("slots", lambda p: p[name]))) == F.size("slots")
    one_to_one = F.coalesce(distinct("f") & distinct("g"), F.lit(True))
    judged = both.select("h", "item_id", "n_windows", "n_matched", "n_slots", "is_top", one_to_one.alias("consistent"))
    return judged.unionByName(verbatim) if verbatim is not None else judged


@tidy
def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, cover: int = COVER, literals: int = LITERALS, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_matched, n_slots, consistent, contaminated: a row for each text and item that
    share ``cover`` percent of the item's windows, or ``run`` tokens in a row of a long item, or all of an item without windows."""
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    judged = materialise(_judged(texts, benchmark, n, cover, literals, run, min_words), "judged")
    ids = texts.withColumn("h", _key()).join(_bounded(judged, judged.count()), "h")
    best = ids.groupBy("doc_id", "item_id").agg(F.max(F.struct("consistent", "n_matched", "is_top", "n_slots", "n_windows")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.n_matched", "b.n_slots", "b.consistent", F.col("b.consistent").alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is contaminated, whatever their id; another text under the same id stays."""
    judged = _judged(docs.where("text IS NOT NULL").select("doc_id", "text"), benchmark, WINDOW, COVER, LITERALS, RUN, MIN_WORDS).where("consistent")
    own = unused(docs, "_h")
    found = materialise(judged.select(F.col("h").alias(own)).distinct(), "contaminated")
    return docs.withColumn(own, _key()).join(_bounded(found, found.count()), own, "left_anti").select(*(quoted(c) for c in docs.columns))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op8_decontamination": op8_decontamination}


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


# the same rules without candidates: every window of every text meets every window of the items
_TAGGED = (
    f"lower(replace(regexp_replace(regexp_replace(translate(text, '{NUM}{NAME}{UNIT}{END}', '    '), '{_sql(_NAMES)}', '\\1{NAME}\\2{END}', 'g'), "
    f"'{_sql(_NUMBERS)}', ' {NUM}\\1{END}{UNIT}\\2{END}\\3', 'g'), '{UNIT}{END}', ' '))"
)
_SQL_KINDS = f"list_transform(toks, lambda t: CASE WHEN regexp_matches(t, '{_SLOT}') THEN t[1] ELSE t END)"
_SQL_WINDOWS = f"SELECT *, unnest(generate_series(1, len(kinds) - {WINDOW - 1})) AS k FROM"
_SQL_WORDS = f"regexp_extract_all(lower(text), '{_PLAIN}')"


def sql_form(run: int = RUN) -> str:
    """The counterpart for DuckDB."""
    return f"""WITH it AS (SELECT item_id, {_SQL_WORDS} AS words, regexp_extract_all({_TAGGED}, '{_TOKEN}') AS toks FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL GROUP BY 1) WHERE len({_SQL_WORDS}) >= {MIN_WORDS}),
i AS (SELECT *, {_SQL_KINDS} AS kinds FROM it),
iw AS (SELECT item_id, k, array_to_string(kinds[k:k + {WINDOW - 1}], chr(31)) AS w FROM ({_SQL_WINDOWS} i WHERE len(kinds) >= {WINDOW}) WHERE len(list_filter(kinds[k:k + {WINDOW - 1}], lambda t: NOT regexp_matches(t, '{_SLOT}'))) >= {LITERALS}),
dt AS (SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all({_TAGGED}, '{_TOKEN}') AS toks FROM documents WHERE text IS NOT NULL),
d AS (SELECT *, {_SQL_KINDS} AS kinds FROM dt WHERE len(toks) >= {WINDOW}),
dw AS (SELECT r, k, array_to_string(kinds[k:k + {WINDOW - 1}], chr(31)) AS w FROM ({_SQL_WINDOWS} d)),
h AS (SELECT r, item_id, dw.k - iw.k AS shift, iw.k AS item_at, w FROM dw JOIN iw USING (w)),
n AS (SELECT item_id, count(DISTINCT w)::BIGINT AS n_windows, any_value(size) AS size FROM iw JOIN (SELECT item_id, len(kinds) AS size FROM i) USING (item_id) GROUP BY 1),
m AS (SELECT r, item_id, n_windows, size, count(DISTINCT w)::BIGINT AS n_matched FROM h JOIN n USING (item_id) GROUP BY ALL),
g AS (SELECT r, item_id, shift, count(*) AS c, count(DISTINCT w) AS own FROM h GROUP BY 1, 2, 3),
b AS (SELECT *, row_number() OVER (PARTITION BY r, item_id ORDER BY c DESC, shift) = 1 AS is_top FROM g),
z AS (SELECT r, item_id, shift, min(item_at) AS a, max(item_at) + {WINDOW - 1} AS z FROM (SELECT *, sum(CASE WHEN item_at - before <= {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY r, item_id, shift ORDER BY item_at) AS island
  FROM (SELECT *, lag(item_at) OVER (PARTITION BY r, item_id, shift ORDER BY item_at) AS before FROM h)) GROUP BY r, item_id, shift, island),
p AS (SELECT r, item_id, n_windows, n_matched, shift, 1 AS a, size AS z, is_top FROM m JOIN b USING (r, item_id) WHERE n_matched * 100 >= {COVER} * n_windows AND (is_top OR own * 100 >= {COVER} * n_windows)
  UNION ALL SELECT r, item_id, n_windows, n_matched, shift, a, z, false FROM m JOIN z USING (r, item_id) WHERE size * {COVER} > 100 * {run} AND z - a + 1 >= {run}),
s AS (SELECT p.*, f, CASE WHEN j + shift >= 1 THEN dt.toks[j + shift] END AS g FROM (SELECT p.*, unnest(it.toks) AS f, unnest(generate_series(1, len(it.toks))) AS j FROM p JOIN it USING (item_id)) p JOIN dt USING (r) WHERE j BETWEEN a AND z),
q AS (SELECT r, item_id, shift, a, z, is_top, count(*)::BIGINT AS n_slots, count(DISTINCT f) = count(DISTINCT f || chr(31) || g) AND count(DISTINCT g) = count(DISTINCT f || chr(31) || g) AS consistent FROM s WHERE regexp_matches(f, '{_SLOT}') AND f[1] = g[1] GROUP BY ALL),
v AS (SELECT r, item_id, 1::BIGINT AS n_windows, 1::BIGINT AS n_matched, len(list_filter(i.toks, lambda t: regexp_matches(t, '{_SLOT}')))::BIGINT AS n_slots, true AS is_top, true AS consistent
  FROM (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line FROM i ANTI JOIN iw USING (item_id)) i JOIN (SELECT r, ' ' || array_to_string({_SQL_WORDS}, ' ') || ' ' AS line FROM dt) t ON contains(t.line, i.line)),
x AS (SELECT r, item_id, n_windows, n_matched, coalesce(n_slots, 0) AS n_slots, is_top, coalesce(consistent, true) AS consistent FROM p LEFT JOIN q USING (r, item_id, shift, a, z, is_top) UNION ALL SELECT r, item_id, n_windows, n_matched, n_slots, is_top, consistent FROM v),
y AS (SELECT doc_id, x.*, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY consistent DESC, n_matched DESC, is_top DESC, n_slots DESC, n_windows DESC) AS best FROM x JOIN dt USING (r))
SELECT doc_id, item_id, n_windows, n_matched, n_slots, consistent, consistent AS contaminated FROM y WHERE best = 1"""


ORACLES = {"op8_decontamination": sql_form()}
