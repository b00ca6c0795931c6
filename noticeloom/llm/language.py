"""Operator 3, language identification by compression.

For each language a zstandard raw-content dictionary is cut from a bounded sample of labelled texts. A text is encoded,
whole and in windows, with every dictionary; the language whose dictionary gives the fewest bytes is predicted, and the
prediction is marked as rejected where the runner-up is nearly as good.

Training sample, as documented parameters: the ``max_langs`` most frequent languages, at most ``docs_per_lang`` ids of each (those with
the lowest hash, so the choice is the same in every run), one text for each id, of each at most ``sample_chars`` characters,
``dict_bytes`` in all. What is held by the driver and sent to executors is bounded by these.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; where two languages tie, the
first in alphabetical order is predicted with score 0; without any labelled text every text is ``und``; repeated rows, and rows
without an id, are judged each for itself and alike (the latter never trained on); a very long text is coded window by window; columns
other than id, text and (for training) lang are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm._common import id_bucket, map_rows, table
from noticeloom.llm.zdict import compressor, windows

DOCS_PER_LANG, SAMPLE_CHARS, DICT_BYTES, WINDOW, LEVEL = 96, 2048, 48 << 10, 1024, 6
#: Languages that are learned: the most frequent ones, so that what is collected and sent out is bounded.
MAX_LANGS = 256
#: A lead of less than this share of the runner-up's bytes is narrow.
NARROW = 0.02
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-cased words of letters with a blank between them, a word that follows itself once: case and decoration say
    little of a language."""
    words = _NOT_LETTERS.sub(" ", text.lower()).split(" ")
    return " ".join([w for w, before in zip(words, ["", *words], strict=False) if w != before]).encode()


def train(docs: DataFrame, learn: Column, docs_per_lang: int = DOCS_PER_LANG, sample_chars: int = SAMPLE_CHARS, dict_bytes: int = DICT_BYTES, max_langs: int = MAX_LANGS) -> dict[str, bytes]:
    """language -> dictionary content, from the rows for which ``learn`` holds and lang is not null."""
    h = F.xxhash64(F.col("doc_id"))
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # one row for each id and language, so that repeated rows take no places
    ids = rows.select("lang", "doc_id").distinct()
    langs = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).select("lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(h, "doc_id"))
    # of bounded size: docs_per_lang ids of each of max_langs languages at most
    chosen = ids.join(F.broadcast(langs), "lang").withColumn("r", rank).where(F.col("r") <= docs_per_lang).select("lang", "doc_id")
    at = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.greatest(F.length("text") - sample_chars, F.lit(1))) + 1
    pieces = rows.where(F.length("text") > 0).select("lang", "doc_id", h.alias("h"), F.substring("text", at.cast("int"), F.lit(sample_chars)).alias("t"))
    sample = pieces.join(F.broadcast(chosen), ["lang", "doc_id"]).groupBy("lang", "h", "doc_id").agg(F.min("t").alias("t")).collect()
    share = max(1, dict_bytes // max(1, docs_per_lang))
    out: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r.lang, r.h, r.doc_id)):
        out.setdefault(r.lang, []).append(letters(r.t))
    # every sampled text gives an equal share; what short ones leave over goes to the longer ones
    return {lang: _fill(texts, share, dict_bytes) for lang, texts in out.items()}


def _fill(texts: list[bytes], share: int, total: int) -> bytes:
    got = [t[:share] for t in texts]
    spare = total - sum(map(len, got))
    for i, t in enumerate(texts):
        more = t[len(got[i]) : len(got[i]) + max(0, spare)]
        got[i] += more
        spare -= len(more)
    return b"\n".join(got)[:total]


def has_letter(raw: bytes) -> bool:
    return bool(_ASCII_LETTER.search(raw)) or (not raw.isascii() and any(c.isalpha() for c in raw.decode("utf-8", "replace")))


def predict(raw: bytes | None, models: list[tuple[str, object]], window: int = WINDOW, narrow: float = NARROW) -> tuple[str, float, bool]:
    if not raw or not models or not has_letter(raw):
        return "und", 0.0, True
    size = dict.fromkeys((k for k, _ in models), 0)
    for piece in windows(letters(raw.decode("utf-8", "replace")), window):
        for lang, c in models:
            size[lang] += len(c.compress(piece))
    order = sorted(size, key=lambda k: (size[k], k))
    if len(order) == 1:
        return order[0], 1.0, False
    best, second = size[order[0]], size[order[1]]
    lead = (second - best) / second
    # a lead of a quarter of the bytes is as sure as it gets
    return order[0], min(1.0, 4 * lead), lead < narrow


def identify(docs: DataFrame, dictionaries: dict[str, bytes], window: int = WINDOW, narrow: float = NARROW) -> DataFrame:
    """lang_pred, score and rejected of every text: one pass, no shuffle."""
    return map_rows(docs, "lang_pred string, score double, rejected boolean", lambda raw, models: predict(raw, models, window, narrow), setup=lambda: [(k, compressor(v, LEVEL)) for k, v in sorted(dictionaries.items())])


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    got = identify(docs, train(docs, ~held_out))
    return got.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op3_language": op3_language}
ORACLES: dict[str, str] = {}
