"""Operator 7, mixing sources to target weights by temperature.

A source's share p of all tokens is raised to an exponent a between 0 (every source alike) and 1 (as found) and normalised.
The exponent is found by bisection: the largest that reaches a target entropy of the weights, or the smallest that repeats
no source more often than a limit; entropy falls and repetition falls as a grows, so both have one crossing. A token budget
times its weight is what a source has to give: whole epochs, and of one more epoch the head of a permutation of its blocks.

The permutation is by hash: every text falls in one of the source's blocks, about ``block_tokens`` tokens each; blocks stand in the
order of their hashed number and texts in a block in the order of their hashed id. Where a source's budget ends inside a
block, that block alone is ordered text by text. Only sources' sums come to the driver, and those as aggregates: each
step of the search asks the table of sources for a sum.

Defined results: a null or empty text has no tokens and follows its block's fate; a null source is a source of its own; a
source without tokens gets no weight; equal ids are ordered by their text's hash, and rows equal in both share one decision;
an empty table gives no row; extra columns are kept where asked for by ``keep``, whatever their names; a very long text is one row whose
words are counted, and fills its block alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm._common import materialise, quoted, table, tidy, unused

BLOCK_TOKENS = 20_000
#: Hexadecimal digits of a block's place that make a stretch of the permutation: 4,096 stretches a source.
STRETCH_DIGITS = 3
ROUNDS = 48
#: Budget of the mix, as a multiple of all tokens; the share of the highest possible entropy that is aimed at; most epochs of a source.
BUDGET, ENTROPY_SHARE, MAX_EPOCHS = 1.0, 0.95, 4.0
#: Up to so many sources the search runs on their sums in the driver; beyond, each of its steps is an aggregation in Spark.
DRIVER_SOURCES = 10_000


def counted(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Every text as _id, _src, n_tokens (words between ASCII blanks) and h, its MD5, by which equal ids are ordered; columns to be kept
    are _k0, _k1 .., so that none can clash with what is worked out here."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    return docs.select(*(quoted(k).alias(f"_k{i}") for i, k in enumerate(keep)), F.col("doc_id").alias("_id"), src.alias("_src"), tokens.alias("n_tokens"), F.md5(text.cast("binary")).alias("h"))


def _bisect(holds: Callable[[float], bool], low: float, high: float) -> float:
    """``holds(low)`` is true and ``holds(high)`` is not."""
    for _ in range(ROUNDS):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def exponent(measure: Callable[[float], tuple[float, float]], entropy: float | None, max_epochs: float | None) -> float:
    """``measure(a)``: entropy of the weights and the most epochs of a source. The repetition limit comes before the entropy."""
    seen: dict[float, tuple[float, float]] = {}

    def at(a: float) -> tuple[float, float]:
        if a not in seen:
            seen[a] = measure(a)
        return seen[a]

    spread = lambda a: entropy is None or at(a)[0] >= entropy
    fits = lambda a: max_epochs is None or at(a)[1] <= max_epochs
    a = 1.0 if spread(1.0) else _bisect(spread, 0.0, 1.0) if spread(0.0) else 0.0
    return a if fits(a) or not fits(1.0) else _bisect(fits, 1.0, a)


def measure_list(tokens: list[int], budget: float) -> Callable[[float], tuple[float, float]]:
    total = float(sum(tokens))

    def measure(a: float) -> tuple[float, float]:
        q = [(t / total) ** a for t in tokens]
        z = math.fsum(q)
        return -math.fsum(x / z * math.log(x / z) for x in q), max(x / z * budget / t for x, t in zip(q, tokens, strict=True))

    return measure


def measure_table(sources: DataFrame, total: int, budget: float) -> Callable[[float], tuple[float, float]]:
    def measure(a: float) -> tuple[float, float]:
        q = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))
        r = sources.agg(F.sum(q).alias("z"), F.sum(q * F.log(q)).alias("s"), F.max(q / F.col("tokens")).alias("m")).first()
        return math.log(r.z) - r.s / r.z, r.m / r.z * budget

    return measure


def solve(sources: DataFrame, total: int, budget: float, entropy_share: float | None, max_epochs: float | None) -> float:
    n = sources.count()
    if not n:
        return 1.0
    if n <= DRIVER_SOURCES:
        measure = measure_list(sorted(r.tokens for r in sources.select("tokens").collect()), budget)
    else:
        measure = measure_table(sources, total, budget)
    return exponent(measure, None if entropy_share is None else entropy_share * math.log(n), max_epochs)


def _order(seed: int, *cols: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)).cast("binary"))


@tidy
def mix(docs: DataFrame, budget_share: float = BUDGET, entropy_share: float | None = ENTROPY_SHARE, max_epochs: float | None = MAX_EPOCHS, block_tokens: int = BLOCK_TOKENS, seed: int = 0, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """One row for each text: ``keep``, n_tokens, its source's weight and full_epochs, the text's copies in the mix, and
    block, its block's place in the source's permutation; own names that ``keep`` has too get underscores."""
    rows = materialise(counted(docs, keep), "mix-tokens")
    sources = materialise(rows.groupBy("_src").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = budget_share * total
    a = solve(sources, total, budget, entropy_share, max_epochs)
    q = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))
    z = sources.agg(F.sum(q)).first()[0] or 1.0
    # rounded, so that the order in which a sum was made decides nothing
    plan = sources.withColumn("weight", F.round(q / F.lit(z), 9)).withColumn("want", F.floor(F.col("weight") * F.lit(float(budget))))
    plan = plan.withColumn("full_epochs", F.floor(F.col("want") / F.col("tokens"))).withColumn("rest", F.col("want") - F.col("full_epochs") * F.col("tokens"))
    plan = materialise(plan.withColumn("blocks", F.ceil(F.col("tokens") / F.lit(block_tokens))).drop("tokens", "want"), "mix-plan")
    # the table of sources is small against the texts, and its files' size is known: Spark broadcasts it below its threshold and sorts beyond
    number = F.conv(F.substring(_order(seed, F.col("_id"), F.col("h")), 1, 15), 16, 10).cast("long")
    placed = rows.join(plan, "_src", "left").withColumn("_block", F.pmod(number, F.coalesce("blocks", F.lit(1))))
    sums = placed.groupBy("_src", "_block").agg(F.sum("n_tokens").alias("block_tokens"))
    # a source may have very many blocks: they are summed by stretches of the permutation first, so no task holds more than one stretch
    sums = sums.withColumn("_place", _order(seed + 1, F.col("_src"), F.col("_block"))).withColumn("_stretch", F.substring("_place", 1, STRETCH_DIGITS))
    along = Window.partitionBy("_src").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    heads = sums.groupBy("_src", "_stretch").agg(F.sum("block_tokens").alias("t"), F.count("*").alias("c"))
    heads = heads.select("_src", "_stretch", earlier("t", along).alias("_tokens"), earlier("c", along).alias("_blocks"))
    w = Window.partitionBy("_src", "_stretch").orderBy("_place")
    blocks = sums.join(heads, ["_src", "_stretch"]).withColumn("block", F.col("_blocks") + F.row_number().over(w) - 1)
    blocks = blocks.withColumn("before", F.col("_tokens") + earlier("block_tokens", w.rowsBetween(Window.unboundedPreceding, -1)))
    blocks = materialise(blocks.select("_src", "_block", "block_tokens", "block", "before"), "mix-blocks")
    placed = placed.join(blocks, ["_src", "_block"]).withColumns({"rest": F.coalesce("rest", F.lit(0)), "full_epochs": F.coalesce("full_epochs", F.lit(0))})
    whole = F.col("before") + F.col("block_tokens") <= F.col("rest")
    cut = (F.col("before") < F.col("rest")) & ~whole
    taken = docs.select(*(quoted(k) for k in keep))
    named = lambda c, name: c.cast("long").alias(unused(taken, name))
    out = lambda df, more: df.select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)), named(F.col("n_tokens"), "n_tokens"), F.coalesce("weight", F.lit(0.0)).alias(unused(taken, "weight")), named(F.col("full_epochs"), "full_epochs"), named(F.col("full_epochs") + more.cast("int"), "copies"), named(F.col("block"), "block"))
    settled = out(placed.where(~cut), whole & (F.col("before") < F.col("rest")))
    # at most one block of each source is cut, and only its texts are ordered one by one; rows equal in id and text are one text there
    keys = placed.where(cut).groupBy("_src", "_block", F.col("_id").alias("_d"), F.col("h").alias("_h")).agg(F.sum("n_tokens").alias("t"))
    one_by_one = Window.partitionBy("_src", "_block").orderBy(_order(seed + 2, F.col("_d"), F.col("_h"))).rangeBetween(Window.unboundedPreceding, 0)
    keys = keys.select("_d", "_h", F.col("_src").alias("_s"), F.sum("t").over(one_by_one).alias("_sum"))
    some = placed.where(cut)
    some = some.join(keys, some["_id"].eqNullSafe(F.col("_d")) & (some["h"] == F.col("_h")) & (some["_src"] == F.col("_s")))
    return settled.unionByName(out(some.withColumn("_upto", F.col("before") + F.col("_sum")), F.col("_upto") <= F.col("rest")))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _q(a: str) -> str:
    return f"list_transform(toks, lambda x: pow(x::DOUBLE / total, {a}))"


# with z the sum of q: entropy = ln(z) - sum(q ln q) / z, and the most epochs = max(q / tokens) / z * budget
_ENTROPY = "(ln(list_sum({q})) - list_sum(list_transform({q}, lambda y: y * ln(y))) / list_sum({q}))"
_EPOCHS = "(list_max(list_transform(toks, lambda x: pow(x::DOUBLE / total, {a}) / x)) / list_sum({q}) * {b} * total)"
_SPREAD = lambda a: f"({_ENTROPY.format(q=_q(a))} >= {ENTROPY_SHARE} * ln(len(toks)))"
_FITS = lambda a: f"({_EPOCHS.format(q=_q(a), a=a, b=BUDGET)} <= {MAX_EPOCHS})"
ORACLE = rf"""WITH RECURSIVE d AS (SELECT doc_id, source, 's' || source AS s0, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens, md5(coalesce(text, '')) AS h FROM documents),
r AS (SELECT *, coalesce(s0, '') AS src FROM d),
s AS (SELECT src, sum(n_tokens)::BIGINT AS tokens FROM r GROUP BY 1 HAVING sum(n_tokens) > 0),
l AS (SELECT list(tokens ORDER BY tokens) AS toks, sum(tokens)::DOUBLE AS total FROM s),
e(i, low, high) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT i + 1, CASE WHEN {_SPREAD("(low + high) / 2")} THEN (low + high) / 2 ELSE low END, CASE WHEN {_SPREAD("(low + high) / 2")} THEN high ELSE (low + high) / 2 END FROM e, l WHERE i < {ROUNDS}),
a1 AS (SELECT CASE WHEN {_SPREAD("1.0")} THEN 1.0 WHEN NOT {_SPREAD("0.0")} THEN 0.0 ELSE low END AS a FROM e, l WHERE i = {ROUNDS}),
f(i, low, high) AS (SELECT 0, 1.0::DOUBLE, a::DOUBLE FROM a1 UNION ALL
  SELECT i + 1, CASE WHEN {_FITS("(low + high) / 2")} THEN (low + high) / 2 ELSE low END, CASE WHEN {_FITS("(low + high) / 2")} THEN high ELSE (low + high) / 2 END FROM f, l WHERE i < {ROUNDS}),
a2 AS (SELECT CASE WHEN {_FITS("a1.a")} OR NOT {_FITS("1.0")} THEN a1.a ELSE low END AS a FROM a1, f, l WHERE i = {ROUNDS}),
p AS (SELECT src, tokens, round(pow(tokens::DOUBLE / total, a) / list_sum({_q("a")}), 9) AS weight, floor(round(pow(tokens::DOUBLE / total, a) / list_sum({_q("a")}), 9) * {BUDGET} * total)::BIGINT AS want,
  ceil(tokens / {BLOCK_TOKENS}::DOUBLE)::BIGINT AS blocks FROM s, l, a2),
q AS (SELECT *, want // tokens AS full_epochs, want - (want // tokens) * tokens AS rest FROM p),
x AS (SELECT r.*, weight, coalesce(full_epochs, 0) AS full_epochs, coalesce(rest, 0) AS rest, ('0x' || md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || h)[1:15])::BIGINT % coalesce(blocks, 1) AS b FROM r LEFT JOIN q USING (src)),
g AS (SELECT src, b, sum(n_tokens)::BIGINT AS bt FROM x GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER w - 1 AS block, coalesce(sum(bt) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g WINDOW w AS (PARTITION BY src ORDER BY md5('1|' || src || '|' || b::VARCHAR))),
y AS (SELECT x.*, bt, block, before, before + sum(n_tokens) OVER (PARTITION BY src, b ORDER BY md5('2|' || coalesce(doc_id::VARCHAR, '') || '|' || h)) AS upto FROM x JOIN k USING (src, b))
SELECT doc_id, source, n_tokens, coalesce(weight, 0) AS weight, full_epochs::BIGINT AS full_epochs,
  (full_epochs + CASE WHEN before >= rest THEN 0 WHEN before + bt <= rest OR upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies, block::BIGINT AS block FROM y"""

QUERIES = {"op7_mixing": op7_mixing}
ORACLES = {"op7_mixing": ORACLE}
