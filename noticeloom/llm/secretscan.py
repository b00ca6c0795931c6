"""Operator 12, secret scans by two character Markov models.

Some secrets tell themselves by their form: a value behind a key's name, an access key, a long hexadecimal number (the base
kinds). They are the labelled samples of random strings; all other words of the corpus that are too short to be a key are those of ordinary identifiers. Of
both, the transitions from a character to the next are counted over all documents, added up by Spark, and make two models
P(next | last). A token that no base span touches is a secret of kind ``markov`` where

    sum of log P_random(next | last) - log P_ordinary(next | last)

is at least log(1 / FALSE), so that a word drawn from the ordinary model passes with a probability of at most FALSE, and where
its mean over the token's characters is nearer to that of random samples than to that of ordinary ones. The random model is mixed with
the uniform one, as a key may be written in characters that no sample has. Signs within a token part it as a space does, and a token
must pass in small letters too: names are put together from words in both ways.

Defined results: a null or empty text has no spans; spans are places in code points, ends exclusive; those of one kind never overlap, those
of different base kinds may; a text's matches do not depend on other texts, its ``markov`` spans do through the models; repeated rows are
judged each for itself but counted each for the models; a null id is carried along; columns other than id and text are ignored; without
any sample of random strings the uniform model stands for them; an empty table gives no row. A very long text costs a few times its own
length in memory. The models hold a few thousand numbers whatever the corpus's size.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import map_rows, table, text_column

KINDS = ("assign", "access", "hex", "markov")
#: The base kinds. ``assign`` is searched in small letters, which leaves its spans as they are.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_VALUE = 12

#: Characters of the models, the shortest token that is judged, the highest chance of an ordinary word to be taken for a random one.
ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
MIN_TOKEN, FALSE = 16, 1e-9
#: Share of the uniform model in the random one; count that every transition is given on top.
UNIFORM, SMOOTH = 0.5, 0.5
TOKEN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
LONG = re.compile(rb"[A-Za-z0-9]{%d,}" % MIN_TOKEN)
SIZE = len(ALPHABET) + 1  # state 0 is what stands before a token and behind it
_STATE = np.zeros(256, np.int64)
_STATE[list(ALPHABET)] = np.arange(1, SIZE)
ORDINARY, RANDOM = 0, 1


def base_spans(raw: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in bytes, by start, then kind: leftmost matches that do not overlap, those too short left out.

    Runs that are too short to count hold no longer ones, so asking for their length at once finds the same.
    """
    small = raw.lower()
    out = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(small) if m.end() - m.start(1) >= MIN_VALUE]
    out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(raw)]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(raw)]
    return sorted(out)


def transitions(raw: bytes) -> np.ndarray:
    """How often each state follows each, ``SIZE`` x ``SIZE``, laid out flat."""
    s = _STATE[np.frombuffer(b" %b " % raw, np.uint8)]
    return np.bincount(s[:-1] * SIZE + s[1:], minlength=SIZE * SIZE)


def labelled(raw: bytes) -> tuple[bytes, bytes]:
    """A text's ordinary words and its random strings. Words as long as a token have no label: a hidden key would vouch for itself."""
    spans = base_spans(raw)
    rest = bytearray(raw)
    for start, end in [*((s, e) for s, _, e, _ in spans), *(m.span() for m in LONG.finditer(raw))]:
        rest[start:end] = b" " * (end - start)
    return bytes(rest), b" ".join(raw[value:end] for _, _, end, value in spans)


def _counted(df: DataFrame, of) -> DataFrame:
    """Transitions of ``of(batch)``, pairs of label and bytes, as rows label, pair, n: each task sends at most one row a transition."""
    schema = pa.schema([("label", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            for label, raw in of(batch):
                total[label] += transitions(raw)
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(pair), pa.array(total[label, pair])], schema=schema)

    return df.mapInArrow(run, "label long, pair long, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))


def corpus_transitions(docs: DataFrame) -> DataFrame:
    """Counts from whole texts: values of the base spans are random samples, all other words shorter than a token ordinary ones."""

    def of(batch):
        joined: list[list[bytes]] = [[], []]
        size = 0
        for raw in text_column(batch, 0):
            for part, x in zip(joined, labelled(raw or b""), strict=True):
                if x:
                    part.append(x)
            size += len(raw or b"")
            if size > 1 << 20:
                yield from ((k, b" ".join(part)) for k, part in enumerate(joined))
                joined, size = [[], []], 0
        yield from ((k, b" ".join(part)) for k, part in enumerate(joined))

    return _counted(docs.select("text"), of)


def sample_transitions(samples: DataFrame) -> DataFrame:
    """Counts from a table of labelled samples: ``text``, and ``label`` 1 for random strings, 0 for ordinary ones; other rows are not used."""

    def of(batch):
        for label, raw in zip(batch.column(1).to_pylist(), text_column(batch, 0), strict=True):
            if raw and label in (ORDINARY, RANDOM):
                yield label, raw

    return _counted(samples.select("text", F.col("label").cast("long")), of)


class Model(NamedTuple):
    ratio: np.ndarray  # log P_random - log P_ordinary of each transition, flat
    mean: float  # least mean of a token


def fit(counts: DataFrame) -> Model:
    """The two models' ratio; ``counts`` has at most 2 x ``SIZE``^2 rows."""
    n = np.zeros((2, SIZE, SIZE))
    for r in counts.collect():
        n[r.label].flat[r.pair] += r.n
    n[:, :, 0] = 0  # where a token ends says nothing of what it is
    p = (n + SMOOTH) / (n.sum(2, keepdims=True) + SMOOTH * SIZE)
    seen = n[RANDOM].sum(1, keepdims=True) > 0
    p[RANDOM] = np.where(seen, (1 - UNIFORM) * p[RANDOM] + UNIFORM / (SIZE - 1), 1 / (SIZE - 1))
    ratio = np.log(p[RANDOM]) - np.log(p[ORDINARY])
    ratio[:, 0] = 0
    means = [float((n[k] * ratio).sum() / total) for k in (ORDINARY, RANDOM) if (total := n[k].sum())]
    return Model(ratio.ravel(), max(0.0, sum(means) / 2) if len(means) == 2 else 0.0)


def ratio_of(token: bytes, model: Model) -> float:
    s = _STATE[np.frombuffer(b" " + token, np.uint8)]
    return float(model.ratio[s[:-1] * SIZE + s[1:]].sum())


def is_random(token: bytes, model: Model, false: float = FALSE) -> bool:
    least = max(math.log(1 / false), model.mean * len(token))
    return ratio_of(token, model) >= least and ratio_of(token.lower(), model) >= least


def scan(raw: bytes, model: Model, false: float = FALSE) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points of all spans of a text, base ones and the method's, by start, then kind."""
    base = base_spans(raw)
    found = [(start, kind, end) for start, kind, end, _ in base]
    covered: list[list[int]] = []
    for start, _, end, _ in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(end, covered[-1][1])
        else:
            covered.append([start, end])
    at = 0
    for m in TOKEN.finditer(raw):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at < len(covered) and covered[at][0] < m.end():
            continue
        if is_random(m[0], model, false):
            found.append((m.start(), 3, m.end()))
    if not found:
        return []
    found.sort()
    # bytes to code points: those that start no character are not counted
    places = np.array([(s, e) for s, _, e in found])
    if raw.isascii():
        return found
    starts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    points = np.append(0, starts)[places]
    return [(int(s), kind, int(e)) for (s, e), (_, kind, _) in zip(points, found, strict=True)]


def find_secrets(docs: DataFrame, model: Model, false: float = FALSE) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end) of every text: one pass, no shuffle."""

    def row(raw: bytes | None) -> tuple:
        return ([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(raw or b"", model, false)],)

    return map_rows(docs, "spans array<struct<kind: string, start: long, end: long>>", row)


def op12_secrets(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit(corpus_transitions(docs)))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = line(F.filter("spans", lambda s: s["kind"] != "markov"))
    return found.select("doc_id", *(n(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(base.cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


def sql_form() -> str:
    """The counterpart for DuckDB. It has no places of matches, so matches are marked in the text and places counted up to the marks; the models are
    made from the characters as rows."""
    keys = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    kinds = {  # what comes before the value, the value, its least length
        "assign": (rf"(?:{keys})[\"'']?\x20*[:=]\x20*[\"'']?", "[A-Za-z0-9+/_.=-]+", MIN_VALUE), "access": ("", "AKIA[A-Z0-9]+", 18), "hex": ("", "[0-9a-f]+", 16),
        "token": ("", f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}", 0), "long": ("", f"[A-Za-z0-9]{{{MIN_TOKEN},}}", 0),
    }
    marked = " UNION ALL ".join(f"SELECT r, '{k}' AS kind, {i} AS rank, {least} AS least, regexp_replace(t, '({before})({value})', chr(1) || '\\1' || chr(2) || '\\2' || chr(3), 'g') AS m FROM d" for i, (k, (before, value, least)) in enumerate(kinds.items()))
    state = f"strpos('{ALPHABET.decode()}', c)"
    ratio = lambda rows: f"SELECT k, sum(ratio) AS score FROM ({rows}) JOIN model USING (a, b) GROUP BY 1"
    chars = lambda token: f"SELECT k, coalesce(lag(s) OVER (PARTITION BY k ORDER BY i), 0) AS a, s AS b FROM (SELECT k, i, {state} AS s FROM (SELECT k, unnest(string_split({token}, '')) AS c, unnest(range(len({token}))) AS i FROM c))"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), chr(4) || chr(4) || chr(4)) AS t FROM documents),
m AS ({marked}),
p AS (SELECT r, kind, rank, least, unnest(string_split(m, chr(1))) AS part, unnest(range(len(string_split(m, chr(1))))) AS k FROM m),
q AS (SELECT *, sum(length(translate(part, chr(2) || chr(3), ''))) OVER (PARTITION BY r, kind ORDER BY k) - length(translate(part, chr(2) || chr(3), '')) AS s0,
  length(split_part(part, chr(2), 1)) AS n_before, split_part(split_part(part, chr(2), 2), chr(3), 1) AS value FROM p),
s AS (SELECT r, kind, rank, s0::BIGINT AS s, (s0 + n_before + length(value))::BIGINT AS e, value FROM q WHERE k > 0 AND length(value) >= least),
base AS (SELECT * FROM s WHERE rank < 3),
blank AS (SELECT DISTINCT r, unnest(range(s, e)) AS i FROM s WHERE kind <> 'token'),
ch AS (SELECT r, i, CASE WHEN b.i IS NULL THEN {state} ELSE 0 END AS s FROM (SELECT r, unnest(string_split(t, '')) AS c, unnest(range(length(t))) AS i FROM d WHERE t <> '') LEFT JOIN blank b USING (r, i)),
o AS (SELECT 0 AS label, coalesce(lag(s) OVER (PARTITION BY r ORDER BY i), 0) AS a, s AS b FROM ch),
v AS (SELECT row_number() OVER () AS k, value FROM base), x AS (SELECT 1 AS label, coalesce(lag(s) OVER (PARTITION BY k ORDER BY i), 0) AS a, s AS b FROM (SELECT k, i, {state} AS s FROM (SELECT k, unnest(string_split(value, '')) AS c, unnest(range(length(value))) AS i FROM v))),
n AS (SELECT label, a, b, count(*)::DOUBLE AS n FROM (SELECT * FROM o UNION ALL SELECT * FROM x) WHERE b > 0 GROUP BY 1, 2, 3),
g AS (SELECT l.label, a.a, b.b, coalesce(n.n, 0) AS n, sum(coalesce(n.n, 0)) OVER (PARTITION BY l.label, a.a) AS every FROM (SELECT unnest([0, 1]) AS label) l, (SELECT unnest(range({SIZE})) AS a) a, (SELECT unnest(range({SIZE})) AS b) b LEFT JOIN n ON n.label = l.label AND n.a = a.a AND n.b = b.b),
pr AS (SELECT label, a, b, n, CASE WHEN label = 0 THEN (n + {SMOOTH}) / (every + {SMOOTH} * {SIZE}) WHEN every > 0 THEN {1 - UNIFORM} * (n + {SMOOTH}) / (every + {SMOOTH} * {SIZE}) + {UNIFORM} / ({SIZE} - 1) ELSE 1.0 / ({SIZE} - 1) END AS p FROM g),
model AS (SELECT a, b, CASE WHEN b = 0 THEN 0 ELSE ln(y.p) - ln(z.p) END AS ratio, z.n AS n0, y.n AS n1 FROM pr y JOIN pr z USING (a, b) WHERE y.label = 1 AND z.label = 0),
mean AS (SELECT CASE WHEN sum(n0) > 0 AND sum(n1) > 0 THEN greatest(0, (sum(n0 * ratio) / sum(n0) + sum(n1 * ratio) / sum(n1)) / 2) ELSE 0 END AS mean FROM model),
c AS (SELECT row_number() OVER () AS k, r, s, e, value, lower(value) AS small FROM s t WHERE kind = 'token' AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = t.r AND b.s < t.e AND b.e > t.s)),
f AS (SELECT r, 'markov' AS kind, 3 AS rank, s, e FROM c JOIN ({ratio(chars("value"))}) hi USING (k) JOIN ({ratio(chars("small"))}) low USING (k), mean
  WHERE least(hi.score, low.score) >= greatest({-math.log(FALSE)}, mean * (e - s))),
y AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM (SELECT r, kind, rank, s, e FROM base UNION ALL SELECT * FROM f) GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN y USING (r)"""


QUERIES = {"op12_secrets": op12_secrets}
ORACLES = {"op12_secrets": sql_form()}
