"""Operator 1, quality rules by repetition coverage.

Every text is cut into words, the words are numbered, and hashes of several n-gram lengths roll over the numbers in
numpy. What counts is the share of a text's characters that lie inside duplicated n-grams and duplicated lines.

Defined results: a null or empty text has no words, fails the base rule and is not kept; a text shorter than an n-gram has
no characters in it; ties and repeated rows are judged each for itself; columns other than the id and the text are ignored; an empty table gives no row.
A task holds one text's arrays at a time, so very long texts cost memory in proportion to their own length only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from noticeloom.llm._common import map_rows, table

#: n-gram length in words -> highest share, in percent, of a text's word characters inside n-grams found twice or more,
#: the first occurrence included: twice what would be left out by keeping it.
NGRAM_LIMITS = {5: 30, 7: 26, 10: 20}
#: The same for characters in lines that equal an earlier line.
LINE_LIMIT = 20
MIN_WORDS, MAX_REPEAT_WORDS, BASE_NGRAM = 50, 50, 3
SYMBOLS = b"#*$%&|<>"
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, {}, base_failed boolean, kept boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(ids: np.ndarray, lengths) -> dict[int, np.ndarray]:
    """Hashes of all windows of each length; window i starts at word i. Each length rolls on from the one below."""
    mixed, out = _mix(ids.astype(np.uint64)), {}
    h = mixed
    for n in range(2, max(lengths) + 1):
        if len(ids) < n:
            break
        h = _mix(h[:-1]) + mixed[n - 1 :] * np.uint64(0xD6E8FEB86659FD93)
        if n in lengths:
            out[n] = h
    return out


def covered(h: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in a window whose hash occurs twice or more, the first occurrence included."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return np.zeros(n_words, bool)
    edge = np.zeros(n_words + 1, np.int64)
    dup = np.zeros(len(h), bool)
    dup[order[1:][same]] = True
    dup[order[:-1][same]] = True
    starts = np.flatnonzero(dup)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def measure(raw: bytes | None, limits: dict[int, int] = NGRAM_LIMITS, line_limit: int = LINE_LIMIT) -> tuple:
    raw = raw or b""
    words = raw.split()  # of bytes: at 0x20 and 0x09-0x0D only
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lens = np.fromiter((len(w.decode("utf-8", "replace")) for w in number), np.int64, len(number))[ids] if words else ids
    chars = int(lens.sum())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += len(b"".join(line.split()).decode("utf-8", "replace"))
        elif line.strip():
            seen.add(line)
    hashes = rolled(ids, {BASE_NGRAM, *limits})
    cover = {n: covered(h, n, len(words)) for n, h in hashes.items()}
    repeat = int(cover[BASE_NGRAM].sum()) if BASE_NGRAM in cover else 0
    inside = [int(lens[cover[n]].sum()) if n in cover else 0 for n in limits]
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_WORDS * len(words)
    fine = 100 * dup_line_chars <= line_limit * chars and all(100 * x <= limit * chars for x, limit in zip(inside, limits.values(), strict=True))
    return (len(words), chars, symbols, dup_lines, repeat, dup_line_chars, *inside, failed, fine and not failed)


def repetition_coverage(docs: DataFrame, limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT) -> DataFrame:
    """Repetition measures and verdict of every text: one pass, no shuffle.

    Returns ``doc_id``, the counts, ``dup_chars_N`` for each n-gram length N of ``limits``, ``base_failed`` and ``kept``.
    """
    limits = dict(NGRAM_LIMITS if limits is None else limits)
    return map_rows(docs, SCHEMA.format(", ".join(f"dup_chars_{n} long" for n in limits)), lambda raw: measure(raw, limits, line_limit))


def op1_repetition(spark, sf_dir: str) -> DataFrame:
    return repetition_coverage(table(spark, sf_dir, "documents"))


_GRAM = """
g{n} AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM (
  SELECT doc_id, i AS pos, array_to_string(ws[i:i + {n} - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {n} + 1)) AS i FROM w WHERE len(ws) >= {n}))),
c{n} AS (SELECT doc_id, count(*) AS n_in, sum(length(ws[p]))::BIGINT AS chars FROM (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + {n} - 1)) AS p FROM g{n} WHERE c > 1) JOIN w USING (doc_id) GROUP BY 1)"""

_ORACLE = (
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
b AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM w),
l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line) AS k, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS c
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ld AS (SELECT doc_id, count(*)::BIGINT AS n_dup_lines, sum(c)::BIGINT AS dup_line_chars FROM l WHERE k > 1 GROUP BY 1),"""
    + ",".join(_GRAM.format(n=n) for n in (BASE_NGRAM, *NGRAM_LIMITS))
    + f""",
m AS (SELECT b.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(c3.n_in, 0)::BIGINT AS n_repeat_words,
  {", ".join(f"coalesce(c{n}.chars, 0) AS dup_chars_{n}" for n in NGRAM_LIMITS)}
  FROM b LEFT JOIN ld USING (doc_id) LEFT JOIN c3 USING (doc_id) {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in NGRAM_LIMITS)}),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {LINE_LIMIT} * word_chars
  AND {" AND ".join(f"100 * dup_chars_{n} <= {x} * word_chars" for n, x in NGRAM_LIMITS.items())} AS kept FROM f"""
)

QUERIES = {"op1_repetition": op1_repetition}
ORACLES = {"op1_repetition": _ORACLE}
