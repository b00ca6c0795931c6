"""Text functions as Column expressions: Spark plans, optimises and compiles them with the query around them.

Blanks: ``(?U)`` lets ``\\s`` cover the ideographic and the no-break space, which notices are full of.
"""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import patterns as P
from noticeloom.functions import vocabulary as V

EDGE = "：:，,；;。 "


def text(c: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def first_of(*cs: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*(nonempty(c) for c in cs), F.lit(""))


#: What ``(?U)\\s`` covers: the characters with Unicode's property White_Space.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column, marks: str = "") -> Column:
    """Without blanks, or without ``marks``, at both ends."""
    if not marks:
        return F.btrim(c.cast("string"), F.lit(BLANKS))
    own = "[" + "".join("\\" + m for m in marks) + "]"
    return F.regexp_replace(c, rf"^{own}+|{own}+$", "")


def squeeze(c: Column) -> Column:
    """Every run of blanks as one, none at the ends."""
    return strip(F.regexp_replace(text(c), r"(?U)\s+", " "))


def plain_blanks(c: Column) -> Column:
    return F.translate(F.replace(text(c), F.lit("&nbsp;"), F.lit(" ")), "\u00a0\u3000", "  ")


def inline(c: Column) -> Column:
    """One line, without punctuation at its ends."""
    return strip(squeeze(plain_blanks(c)), EDGE)


def lines(c: Column) -> Column:
    """The non-empty lines, each stripped and with single blanks."""
    each = F.transform(F.split(plain_blanks(c), r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"), lambda x: strip(F.regexp_replace(x, r"[ \t\r\f\x0B]+", " ")))
    return F.filter(each, lambda x: x != "")


def normalised(c: Column) -> Column:
    return F.array_join(lines(c), "\n")


def until(c: Column, marks: list[str]) -> Column:
    """What stands before each of ``marks`` in turn."""
    return reduce(lambda x, m: F.substring_index(x, m, 1), marks, c)


# Expressions below name their argument once: a plan is a tree, and an argument named twice at each of n levels is in it 2^n times.


def matched(c: Column, pattern: str, i: int = 0) -> Column:
    """A group of the first match; null without one."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(i)), F.lit(0))


def nonempty(c: Column) -> Column:
    return matched(c, r"(?s)^.+$")


_FOOTER = r"(?sU)\s*(?:" + "|".join(V.VALUE_FOOTERS) + ").*$"


def cleaned(c: Column) -> Column:
    """A field on one line without the page's footer; null stays null."""
    one = F.regexp_replace(F.translate(F.replace(c, F.lit("&nbsp;"), F.lit(" ")), "\u00a0\u3000", "  "), r"(?U)\s+", " ")
    return F.regexp_replace(strip(strip(one), EDGE), _FOOTER, "")


def value(c: Column, default: str = V.DEFAULT) -> Column:
    """A cleaned field, ``default`` if nothing is left."""
    return F.coalesce(nonempty(cleaned(text(c))), F.lit(default))


def known(c: Column) -> Column:
    """A cleaned field; null for every spelling of "no value"."""
    return matched(cleaned(c), r"(?s)^(?!(?:" + "|".join(V.MISSING) + r")$).+$")


def is_missing(c: Column) -> Column:
    """Null or any spelling of "no value"."""
    return inline(c).isin(V.MISSING)


def present(c: Column) -> Column:
    """The value, null where it is missing: the form in which the library keeps fields."""
    return F.when(~is_missing(c), c)


def rendered(c: Column, default: str = V.DEFAULT) -> Column:
    """For output: ``default`` for what is missing."""
    return F.coalesce(present(c), F.lit(default))


def unescape_all(c: Column) -> Column:
    # an Arrow function, as those of ``operators.pages.over``: texts of both cross to Python together
    def run(a: pa.Array) -> pa.Array:
        return a if a.null_count == len(a) else pa.array([None if x is None else html.unescape(x) for x in a.to_pylist()], a.type)

    return F.arrow_udf(run, "string")(c)


def unescape_each(c: Column) -> Column:
    """The same for every text of an array."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda xs: [html.unescape(x) for x in xs], na_action="ignore")

    return F.pandas_udf(run, "array<string>")(c)


COMMON_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def unescape_common(c: Column) -> Column:
    """The frequent entities, without leaving the JVM."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), COMMON_ENTITIES.items(), c)


_RARE = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)(?:#\w+|[A-Za-z]\w*);?"


def unescape(c: Column) -> Column:
    """All entities; Python sees only texts with one that the JVM does not know."""
    return F.when(c.rlike(_RARE), unescape_all(F.when(c.rlike(_RARE), c))).otherwise(unescape_common(c))


_BLANK_ENTITY = r"&nbsp;|&ensp;|&emsp;|\u00a0"


def html_line(c: Column) -> Column:
    """A fragment of HTML as one line of text."""
    return squeeze(F.regexp_replace(F.regexp_replace(unescape(text(c)), r"<[^>]+>", ""), _BLANK_ENTITY, " "))


BLOCKS = "p|div|li|tr|h1|h2|h3|h4|h5|h6"


def _block_lines(c: Column) -> Column:
    """What ``html_lines`` does behind the entities."""
    t = F.regexp_replace(c, rf"(?i)<\s*br\s*/?\s*>|</\s*(?:{BLOCKS})\s*>|<\s*(?:{BLOCKS})[^>]*>", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", ""), _BLANK_ENTITY, " ")
    each = F.transform(F.split(t, r"\r\n|[\n\r\u000b\u000c\u0085\u2028\u2029]"), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.array_join(F.filter(each, lambda x: x != ""), "\n")


def html_lines(c: Column) -> Column:
    """A fragment of HTML as lines, one for each block element."""
    return _block_lines(unescape(text(c)))


def html_lines_each(rows: DataFrame, parts: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: an array of fragments, each as ``html_lines`` gives it. The array crosses to Python at most once, and only where one
    of its fragments has an entity that the JVM does not know; empty fragments cost nothing."""
    odd = F.exists(F.col(name), lambda x: x.rlike(_RARE))
    rows = rows.withColumn(name, F.transform(parts, text))
    plain = F.coalesce(unescape_each(F.when(odd, F.col(name))), F.transform(F.col(name), unescape_common))
    return rows.withColumn(name, plain).withColumn(name, F.transform(F.col(name), lambda x: F.when(x != "", _block_lines(x)).otherwise("")))


def page_text(c: Column, max_chars: int | None = 16_000) -> Column:
    """A whole page as lines of text: without scripts, styles and frames, up to its footer."""
    t = F.regexp_replace(text(c), r"(?is)<(script|style|noscript|iframe)\b[^>]*>.*?</\1\s*>|<!--.*?-->", "\n")
    t = unescape(F.regexp_replace(t, r"(?s)<[^>]+>", "\n"))
    each = F.transform(F.split(t, r"[\n\r]"), squeeze)
    t = until(F.array_join(F.filter(each, lambda x: x != ""), "\n"), V.PAGE_FOOTERS)
    return F.substring(t, 1, max_chars) if max_chars else t


def tidy(c: Column) -> Column:
    """Without control characters, single blanks, at most one empty line between others."""
    t = F.regexp_replace(text(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return strip(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def common_clean(c: Column) -> Column:
    """Entities resolved and long gaps narrowed: for every field of a finished record."""
    return strip(F.replace(F.regexp_replace(unescape(text(c)), r"(?U)\s{3,}", "  "), F.lit("\u3000"), F.lit(" ")))


def join_split_codes(c: Column) -> Column:
    """Letters and digits that markup has pulled apart by single blanks are joined, in up to five passes (a pass consumes
    pairs), then blanks inside brackets before or after them."""
    t = reduce(lambda x, _: F.regexp_replace(x, r"([A-Za-z0-9]) ([A-Za-z0-9])", "$1$2"), range(5), c)
    return F.regexp_replace(F.regexp_replace(t, r"(\d) +([）)\]])", "$1$2"), r"([（(\[。，、]) +(\d|[A-Z])", "$1$2")


_PURE = r"(?U)^[\s：:，,、。；;!！?？'\"“”‘’\[\]【】()（）\-—…\.·]+$"


def without_marks(c: Column) -> Column:
    """An extracted value without punctuation at its ends; empty if there is nothing but punctuation."""
    t = F.regexp_replace(F.regexp_replace(strip(text(c)), r"(?U)[：:，,、。\s]+$", ""), r"(?U)^[：:，,、\s]+", "")
    return F.regexp_replace(t, _PURE, "")


def clip(c: Column, n: int = 500) -> Column:
    return F.substring(text(c), 1, n)


def phone(c: Column) -> Column:
    """The telephone numbers at the start of a value, up to what belongs to another field."""
    t = strip(F.regexp_extract(squeeze(c), rf"(?s)^(.+?)(?=(?:{'|'.join(P.PHONE_STOPS)})|\z)", 1))
    head = strip(F.regexp_extract(t, P.PHONE, 0))
    return strip(strip(F.coalesce(nonempty(head), t)), " ：:，,；;")


def location(c: Column) -> Column:
    """A trading place as a region: the province itself, or the first city named."""
    t = strip(F.regexp_replace(text(c), "交易场所[：:]", ""))
    city = F.regexp_extract(t, r"(?U)(\S+市)", 1)
    return F.when(F.contains(t, F.lit("省本级")) | (t == "省"), "山西省本级").when(city != "", city).when(t == "", V.OLD_DEFAULT).otherwise(t)


def preview(pairs: Column, each: int = 60, whole: int = 240) -> Column:
    """``k=v；…`` of an array of (k, v), long values and the whole cut short with dots."""
    cut = lambda x, n: F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)
    kept = F.filter(F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), squeeze(p["v"]).alias("v"))), lambda p: p["v"] != "")
    return cut(F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), cut(p["v"], each))), "；"), whole)


def hits(c: Column, words: list[str], ignore_case: bool = False) -> Column:
    """How many of ``words`` stand in the text, each counted once."""
    t = F.lower(text(c)) if ignore_case else text(c)
    return reduce(lambda a, b: a + b, (F.contains(t, F.lit(w.lower() if ignore_case else w)).cast("int") for w in words))


def has_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text(c), F.lit(w)) for w in words))
