"""Operator 11, periodic runs of words by Crochemore's partition refinement.

The positions of a text are classes: two are together at length l where the l words from there on are equal. From one length
to the next a class is split by the classes of its positions' successors, and only classes that a split has just made, all but
the largest piece of each, are looked at (the smaller half), so a word is touched as often as the logarithm of the text's length.
Members of a class are linked in their order. Neighbours whose distance equals the length are a square whose root is no
repetition itself; squares of one root length that start word by word are one run. Classes stop at the longest root asked for.

All texts of a piece of a batch are refined together, one numpy step a length: each has words of its own, and ends in a word
that no text has. Links are told when they break: a link of distance d that held from length b to length e was a square if
b <= d <= e.

Defined results: a null or empty text has no words, no run and an empty collapsed text; runs may overlap, and every word
that lies in any run behind its first period is left out; ties between runs go to the smallest start, then to the smallest period;
repeated rows are judged each for itself; a null id is carried along; columns other than id and text are ignored; an empty table gives
no row. A task holds a piece of a few MB of text, or one longer text: its memory is in proportion to the longest text, its steps to
a third of that text's words at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import BATCH_BYTES, crc32_sql, table, text_column

MIN_LENGTH, MIN_TIMES = 24, 3
WORD = r"[^\x20\x09-\x0D]+"


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. count[0] of them, then the next."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


class Classes:
    """The positions of numbered words, by the factor that starts there; ``length`` is that of the factors now."""

    def __init__(self, words: np.ndarray, last: np.ndarray):
        n = len(words)
        self.n, self.last, self.length = n, last, 1
        self.cls = np.unique(words, return_inverse=True)[1].astype(np.int64)
        self.members = np.argsort(self.cls, kind="stable")  # class by class
        self.place = np.empty(n, np.int64)
        self.place[self.members] = np.arange(n)
        self.size = np.bincount(self.cls, minlength=n)
        self.first = np.cumsum(self.size) - self.size
        self.used = int(self.cls.max()) + 1 if n else 0
        # neighbours in a class; a position without one is its own
        self.after, self.before, self.born = np.arange(n), np.arange(n), np.ones(n, np.int64)
        one, two = self.members[:-1], self.members[1:]
        same = self.cls[one] == self.cls[two]
        self.after[one[same]], self.before[two[same]] = two[same], one[same]
        self.small = self.members
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def _broken(self, at: np.ndarray) -> None:
        """Links from ``at`` onwards held up to now: those that were squares are kept."""
        d = self.after[at] - at
        square = (self.born[at] <= d) & (d <= self.length)
        if square.any():
            self.found.append((at[square], d[square]))
        self.born[at] = self.length + 1

    def _relink(self, moved: np.ndarray, group: np.ndarray) -> None:
        """Take ``moved`` (in order of group, then position) out of their classes' chains and link each group anew."""
        was = moved[np.argsort(self.cls[moved] * self.n + moved, kind="stable")]
        joined = self.after[was[:-1]] == was[1:]
        head, tail = was[np.append(True, ~joined)], was[np.append(~joined, True)]
        left, right = self.before[head], self.after[tail]
        has_left, has_right = left != head, right != tail
        self._broken(left[has_left])
        both = has_left & has_right
        self.after[left[both]], self.before[right[both]] = right[both], left[both]
        ends = left[has_left & ~has_right]
        self.after[ends] = ends
        begins = right[has_right & ~has_left]
        self.before[begins] = begins
        same = group[1:] == group[:-1]
        after, before = moved.copy(), moved.copy()
        after[:-1][same], before[1:][same] = moved[1:][same], moved[:-1][same]
        changed = after != self.after[moved]
        self._broken(moved[changed])
        self.after[moved], self.before[moved] = after, before

    def _shift(self, moved: np.ndarray, owner: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> None:
        """Bring ``moved``, ``counts`` of each of ``classes``, to the end of their classes' stretches of ``members``."""
        begin = self.first[classes] + self.size[classes] - counts
        tail = _spans(begin, counts)
        marked = np.zeros(len(tail), bool)
        where = self.place[moved]
        inside = where >= np.repeat(begin, counts)  # already in the tail; the owner's tail begins at ``offset`` of all tails
        offset = np.cumsum(counts) - counts
        marked[(where - begin[owner] + offset[owner])[inside]] = True
        stay = self.members[tail[~marked]]  # as many as there are holes before the tail, class by class
        holes = where[~inside]
        self.members[holes], self.place[stay] = stay, holes
        self.members[tail], self.place[moved] = moved, tail

    def refine(self) -> bool:
        """From factors of a length to those of one word more; whether any class was split."""
        at = self.small - 1
        at = at[at >= 0]
        at = at[(self.size[self.cls[at]] > 1) & (self.last[at] > self.length)]
        if not len(at):
            return False
        at.sort()
        key = self.cls[at] * self.n + self.cls[at + 1]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(start, len(at)))
        owner = self.cls[at[start]]  # of each group, the class that it comes from
        lead = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        groups = np.diff(np.append(lead, len(owner)))
        rest = self.size[owner[lead]] - np.add.reduceat(count, lead)
        nth = np.repeat(np.arange(len(lead)), groups)
        most = np.maximum.reduceat(count, lead)
        # the largest group of a class, the first of equal ones
        is_most = count == most[nth]
        is_most &= np.cumsum(is_most) - np.repeat((np.cumsum(is_most) - is_most)[lead], groups) == 1
        stays = is_most & (rest == 0)[nth]  # keeps its class's number, as nothing else is left of it
        moves = ~stays
        if not moves.any():
            self.small = at[:0]
            return False
        of = np.repeat(np.arange(len(start)), count)
        picked = moves[of]
        moved, group = at[picked], of[picked]
        size = np.bincount(nth[moves], weights=count[moves], minlength=len(lead)).astype(np.int64)
        some = size > 0
        classes, counts = owner[lead][some], size[some]
        self._relink(moved, group)
        rank = np.cumsum(some) - 1
        self._shift(moved, rank[nth[group]], classes, counts)
        fresh = np.arange(self.used, self.used + int(moves.sum()))
        self.used += len(fresh)
        self.size[fresh] = count[moves]
        self.size[classes] -= counts
        self.first[fresh] = self.place[moved[np.flatnonzero(np.append(True, group[1:] != group[:-1]))]]
        self.cls[moved] = np.repeat(fresh, count[moves])
        # all pieces but the largest of each class that was split are looked at next
        rest_most = (rest >= most)[nth]
        small = fresh[~is_most[moves] | rest_most[moves]]
        remains = owner[lead][some & (rest < most) & (rest > 0)]
        # where the largest group kept the number nothing remains but it
        pieces = np.concatenate([small, remains])
        self.small = self.members[_spans(self.first[pieces], self.size[pieces])]
        self.length += 1
        return True


def squares(words: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of every square of numbered words whose root is not itself a repetition and at most ``last`` (one for each position) long.

    The last position must hold a word that stands nowhere else.
    """
    c = Classes(words, last)
    while c.refine():
        pass
    at = np.arange(len(words))
    d = c.after - at
    alive = (c.born <= d) & (d <= last)
    found = [*c.found, (at[alive], d[alive])]
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def merged(start: np.ndarray, period: np.ndarray, min_length: int, min_times: int) -> np.ndarray:
    """Rows (start, length, period) of the runs that squares make up, by start, then period."""
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    begins = np.append(True, (period[1:] != period[:-1]) | (start[1:] != start[:-1] + 1)) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(begins)
    n_squares = np.diff(np.append(first, len(start)))
    runs = np.stack([start[first], n_squares - 1 + 2 * period[first], period[first]], 1)
    runs = runs[runs[:, 1] >= np.maximum(min_length, min_times * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def piece_runs(texts: list[bytes], min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Of each text its words, and its runs as rows (start, length, period)."""
    split = [t.split() for t in texts]  # of bytes: at 0x20 and 0x09-0x0D only
    numbered, last, used = [], [], 0
    for words in split:
        number = {w: i for i, w in enumerate(dict.fromkeys(words), used)}
        numbered.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        used += len(number) + 1
        numbered.append(np.array([used - 1]))
        last.append(len(words) // min_times)
    lengths = np.array([len(w) + 1 for w in split], np.int64)
    starts = np.cumsum(lengths) - lengths
    runs = merged(*squares(np.concatenate(numbered), np.repeat(np.array(last, np.int64), lengths)), min_length, min_times) if split else np.empty((0, 3), np.int64)
    cuts = np.searchsorted(runs[:, 0], np.append(starts, lengths.sum()))
    for i, words in enumerate(split):
        yield words, runs[cuts[i] : cuts[i + 1]] - np.array([starts[i], 0, 0])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that lie in no run behind its first period, joined by spaces."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0))


def strongest(runs: np.ndarray) -> dict | None:
    """The run of the greatest length / period, the fraction itself, not its value as a float."""
    if not len(runs):
        return None
    s, n, p = max(runs.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return {"start": s, "length": n, "period": p}


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES, piece_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id``, ``runs`` (array of start, length and period in words, by start, then period), ``strongest`` (one of them, or null) and
    ``collapsed`` (the text without the repetitions) of every text: one pass, no shuffle. ``min_times``: 2 or more."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    run_ddl = "struct<start: long, length: long, period: long>"
    out_type = StructType([docs.schema["doc_id"], *StructType.fromDDL(f"runs array<{run_ddl}>, strongest {run_ddl}, collapsed string").fields])

    def run(batches):
        schema = to_arrow_schema(out_type)

        def found(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
            cols: list[list] = [[], [], []]
            for words, runs in piece_runs(texts, min_length, min_times):
                for col, x in zip(cols, ([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], strongest(runs), collapsed(words, runs)), strict=True):
                    col.append(x)
            arrays = [pa.array(cols[0], pa.list_(_RUN)), pa.array(cols[1], _RUN), pa.array(cols[2], pa.binary())]
            return pa.RecordBatch.from_arrays([ids.cast(schema.field(0).type), *(a.cast(f.type) for a, f in zip(arrays, [schema.field(i) for i in (1, 2, 3)], strict=True))], schema=schema)

        for batch in batches:
            held, size, at = [], 0, 0
            for i, raw in enumerate(text_column(batch, 1)):
                held.append(raw or b"")
                size += len(raw or b"")
                if size > piece_bytes:
                    yield found(batch.column(0).slice(at, i + 1 - at), held)
                    held, size, at = [], 0, i + 1
            if held:
                yield found(batch.column(0).slice(at), held)

    return docs.select("doc_id", "text").mapInArrow(run, out_type)


def looped(text: Column, doc_id: Column) -> Column:
    """The text of the contract: of every document with crc32 of its id divisible by ten, the words from one on repeat a stretch of theirs."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    as_int = lambda c: c.cast("int")
    head = F.slice(words, F.lit(1), as_int(a))
    loop = F.flatten(F.array_repeat(F.slice(words, as_int(a + 1), as_int(p)), as_int(F.ceil((n - a) / p))))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, F.slice(loop, F.lit(1), as_int(n - a))), " ")).otherwise(text)


def op11_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    hex_of = lambda c: F.sha2(c.cast("binary"), 256)
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(best[k].alias(k) for k in ("start", "length", "period")),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        hex_of(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))).alias("runs_sha256"),
        hex_of(F.col("collapsed")).alias("collapsed_sha256"),
    )


# A run has eight words twice at its period's distance, so islands of such pairs are the runs; of equal stretches the smallest period counts.
_ORACLE = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws, {crc32_sql("doc_id")} AS h FROM documents),
l AS (SELECT *, len(ws)::BIGINT AS n, h // 10 AS g FROM d), b AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM l),
q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM b),
t AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(ws[:a], list_transform(range(n - a), lambda i: ws[a + i % p + 1])) ELSE ws END AS ws FROM q),
o AS (SELECT r, n, i, hash(ws[i + 1:i + 8]) AS gram FROM (SELECT r, n, ws, unnest(range(n - 7)) AS i FROM t WHERE n >= {MIN_LENGTH})),
s AS (SELECT r, gram FROM o GROUP BY 1, 2 HAVING count(*) > 1), oo AS (SELECT o.* FROM o JOIN s USING (r, gram)),
e AS (SELECT x.r, x.i, y.i - x.i AS p FROM oo x JOIN oo y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
v AS (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM e),
m AS (SELECT r, min(i) AS start, count(*) + 7 + p AS length, p AS period FROM v GROUP BY r, p, island),
u AS (SELECT r, start, length, min(period) AS period FROM m WHERE length >= greatest({MIN_LENGTH}, 3 * period) GROUP BY 1, 2, 3),
k AS (SELECT r, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, (length / period, -start, -period)) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM u GROUP BY 1),
x AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
w AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS kept FROM (SELECT r, unnest(ws) AS w, unnest(range(n)) AS i FROM t WHERE r IN (SELECT r FROM u)) ANTI JOIN x USING (r, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period, (1000 * best.l // best.p)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(CASE WHEN n_runs > 0 THEN coalesce(kept, '') ELSE array_to_string(ws, ' ') END) AS collapsed_sha256
FROM t LEFT JOIN k USING (r) LEFT JOIN w USING (r)"""

QUERIES = {"op11_runs": op11_runs}
ORACLES = {"op11_runs": _ORACLE}
