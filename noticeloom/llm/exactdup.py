"""Operator 4, suffix-array deduplication: bytes covered by a string of ``length`` bytes that also starts elsewhere.

No machine sorts the suffixes of the whole corpus, so the text is first cut where equal strings are sure to meet:

1. Of every window of ``length`` bytes the seed of ``SEED`` bytes with the least hash is its anchor (the leftmost of equals). Equal
   windows have equal anchors at equal places, so they can only meet within one anchor's group. Consecutive windows with
   one anchor form a span; about one byte in seventy is an anchor.
2. Anchors that occur once are done. Equal spans of the others are one class with a count: all windows of a span that
   occurs twice are repeated, and copies of a passage cost one row in the next step.
3. Groups with several distinct spans go, anchor by anchor, into shards of about ``SHARD`` bytes. A shard's suffixes and common prefixes are
   sorted by external induction (``induced``); a window is repeated if it shares ``length`` bytes with a neighbour.
   A group of more than ``GROUP`` distinct spans (the edges of a passage that very many documents share) is cut by more context first: windows
   are put together by the 185 bytes that those with nearly as many bytes before the anchor share. What is still as large is cut into windows.
4. The verdicts go back to the spans' places and these to the documents.

Defined results: null texts are empty; texts shorter than ``length`` lose nothing; equal rows and equal texts are each other's
copies; rows with a null id are judged like any other; a text that loses all its bytes has the digest of the empty string; a text of one
repeated byte has one span and one merged run; a very long text costs its task memory in proportion to its own length;
columns other than id and text are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import discard, lean, lean_groups, materialise, quoted, table, text_column, tidy
from noticeloom.llm.induced import MEMORY, Scratch, descending_suffixes

LENGTH, SEED = 200, 64
#: Bytes of a shard; spans of a group beyond which it is cut by more context, and by how much the windows of a piece then differ.
SHARD, GROUP, WIDTHS = 1 << 20, 2000, (16, 1)
_CHUNK = 1 << 15
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)])
    return up, down


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Anchors:
    def __init__(self, length: int = LENGTH, seed: int = SEED):
        self.length, self.seed = length, seed
        self.up, self.down = _powers(_CHUNK + length)
        self.byte = _scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

    def _least(self, key: np.ndarray, w: int) -> np.ndarray:
        """The least of every w consecutive keys (two running minima over blocks of w)."""
        n = len(key) - w + 1
        padded = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(key)] = key
        blocks = padded.reshape(-1, w)
        left = np.minimum.accumulate(blocks, axis=1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(right[:n], left[w - 1 : w - 1 + n])

    def spans(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor hash, first window, last window + 1) of every span of a text."""
        n = len(raw) - self.length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        data, w = np.frombuffer(raw, np.uint8), self.length - self.seed + 1
        places, hashes, firsts = [], [], []
        for c in range(0, n, _CHUNK):
            part = self.byte[data[c : c + _CHUNK + self.length - 1]]
            m = len(part)
            sums = np.zeros(m + 1, np.uint64)
            np.cumsum(part * self.up[:m], out=sums[1:])
            h = _scramble((sums[self.seed :] - sums[: m + 1 - self.seed]) * self.down[: m + 1 - self.seed])
            # the hash's high bits, then the place: the leftmost of equals is the least
            low = np.uint64(16)
            best = (self._least((h >> low << low) | np.arange(len(h), dtype=np.uint64), w) & np.uint64(0xFFFF)).astype(np.int64)
            new = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
            places.append(best[new] + c)
            hashes.append(h[best[new]].view(np.int64))
            firsts.append(new + c)
        place, anchor, first = np.concatenate(places), np.concatenate(hashes), np.concatenate(firsts)
        keep = np.append(True, place[1:] != place[:-1])  # one span may lie in two chunks
        anchor, first = anchor[keep], first[keep]
        return anchor, first, np.append(first[1:], n)

    def place(self, raw: bytes) -> int:
        """Where a span's anchor stands."""
        part = self.byte[np.frombuffer(raw, np.uint8)[: self.length]]
        sums = np.append(np.uint64(0), np.cumsum(part * self.up[: self.length]))
        h = _scramble((sums[self.seed :] - sums[: self.length + 1 - self.seed]) * self.down[: self.length + 1 - self.seed])
        low = np.uint64(16)
        return int(np.argmin((h >> low << low) | np.arange(len(h), dtype=np.uint64)))


RUNS_TYPE = "array<struct<a:int,b:int>>"
ROWS = f"doc_id long, k long, anchor long, span long, size int, n int, cover {RUNS_TYPE}"
_RUN = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _lists(offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Lists of runs from their ends."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], ["a", "b"]))


def _anchor_rows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """A row for each distinct span of a text: how often it stands there, and the bytes that its places cover, merged. A span that stands twice in
    one text is repeated whatever the others hold, so its single places are not needed."""
    schema = pa.schema([*((x, pa.int64()) for x in ("doc_id", "k", "anchor", "span")), ("size", pa.int32()), ("n", pa.int32()), ("cover", _RUN)])

    def run(batches: Iterator[pa.RecordBatch]):
        import xxhash

        anchors = Anchors(length, seed)
        held: list[tuple] = []
        n = 0

        def flush():
            ids, null, ks, anchor, span, size, count, runs, a, b = (np.concatenate([h[i] for h in held]) for i in range(10))
            cols = [pa.array(ids, mask=null), pa.array(ks), pa.array(anchor), pa.array(span), pa.array(size.astype(np.int32)), pa.array(count.astype(np.int32)), _lists(np.append(0, np.cumsum(runs)), a, b)]
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        for batch in batches:
            ids, ks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, raw in enumerate(text_column(batch)):
                anchor, first, end = anchors.spans(raw or b"")
                if not len(anchor):
                    continue
                view = memoryview(raw)
                size = end - first + length - 1
                span = np.fromiter((xxhash.xxh64_intdigest(view[a : a + s]) for a, s in zip(first.tolist(), size.tolist(), strict=True)), np.uint64, len(first)).view(np.int64)
                order = np.lexsort((first, span, anchor))
                anchor, span, size, first = anchor[order], span[order], size[order], first[order]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (span[1:] != span[:-1]))
                begins = np.flatnonzero(new | np.append(True, first[1:] > first[:-1] + size[:-1]))
                at = np.flatnonzero(new)
                m = len(at)
                ends = np.append(begins[1:], len(first)) - 1
                runs = np.diff(np.append(np.searchsorted(begins, at), len(begins)))
                held.append((np.full(m, ids[i] or 0, np.int64), np.full(m, ids[i] is None), np.full(m, ks[i], np.int64), anchor[at], span[at], size[at], np.diff(np.append(at, len(first))), runs, first[begins], first[ends] + size[ends]))
                n += m
                if n > 50_000:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return docs.select("doc_id", F.xxhash64("text").alias("k"), "text").mapInArrow(lean(run), ROWS)


def repeated_runs(spans: list[bytes], length: int, memory: int = MEMORY) -> list[list[tuple[int, int]]]:
    """For each span: the runs [from, to) of bytes covered by windows that also start in another place of the spans."""
    with Scratch(memory) as scratch:
        at = np.cumsum([0, *(len(s) + 1 for s in spans)])
        text = scratch.array(int(at[-1]) + 1, np.int16)
        for s, a in zip(spans, at, strict=False):
            text[a : a + len(s)] = np.frombuffer(s, np.uint8).astype(np.int16) + 2
            text[a + len(s)] = 1
        repeated, before = scratch.array(len(text), bool), None
        # a window is repeated if it shares ``length`` bytes with the one above or below it in the order of suffixes
        for pos, lcp in descending_suffixes(text, memory, length, 258):
            near = lcp >= length
            repeated[pos[near]] = True
            above = np.append(before if before is not None else pos[:1], pos[:-1])
            repeated[above[near]] = True
            before = pos[-1:]
        return [runs_of(np.asarray(repeated[a : a + max(0, len(s) - length + 1)]), length) for s, a in zip(spans, at, strict=False)]


def runs_of(repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged byte runs of repeated windows."""
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(p[0]), int(p[-1]) + length) for p in np.split(starts, cut)]


RUNS = f"anchor long, span long, runs {RUNS_TYPE}"


def _sorted_verdicts(texts: DataFrame, shards: int, length: int, memory: int) -> DataFrame:
    """Runs of repeated bytes of each span (anchor, span, bytes), its shard's suffixes sorted."""
    kind = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("runs", _RUN)])

    def judge(t: pa.Table) -> pa.Table:
        runs = repeated_runs([x.as_py() for x in t.column("bytes")], length, memory)
        ends = np.array([e for r in runs for e in r], np.int64).reshape(-1, 2)
        return pa.table([t.column("anchor"), t.column("span"), _lists(np.cumsum([0, *map(len, runs)]), ends[:, 0], ends[:, 1])], schema=kind)

    return texts.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(lean_groups(judge), RUNS)


PIECES = "anchor long, span long, whole_anchor long, whole_span long, at int, c long, bytes binary"


def _pieces(texts: DataFrame, length: int, seed: int, width: int) -> DataFrame:
    """Spans (anchor, span, c, bytes) cut by how many bytes their windows have before the anchor, ``width`` values at a time. The windows of a piece
    share all but ``width`` - 1 of their bytes, and those are its new anchor: equal windows still meet, in groups that are told apart by more context."""
    schema = pa.schema([*((x, pa.int64()) for x in ("anchor", "span", "whole_anchor", "whole_span")), ("at", pa.int32()), ("c", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        import xxhash

        anchors = Anchors(length, seed)
        for b in batches:
            whole_anchor, whole_span, count = (b.column(i).to_pylist() for i in range(3))
            rows, size = [], 0
            for i, x in enumerate(b.column(3)):
                raw = x.as_py()
                view, n, place = memoryview(raw), len(raw) - length + 1, anchors.place(raw)
                first = 0
                while first < n:
                    before = place - first
                    low = before // width * width
                    last = min(n - 1, place - low)
                    # what all windows with ``low`` to ``low + width - 1`` bytes before the anchor have in common
                    key = xxhash.xxh64_intdigest(view[place - low : place - low - width + 1 + length], seed=low)
                    own = bytes(view[first : last + length])
                    rows.append((key, xxhash.xxh64_intdigest(own, seed=low), whole_anchor[i], whole_span[i], first, count[i], own))
                    size += len(own)
                    first = last + 1
                if size > 8 << 20:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    def batch(rows):
        cols = list(zip(*rows, strict=True))
        hashes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in cols[:2]]
        return pa.RecordBatch.from_arrays([*hashes, *(pa.array(c, schema.field(i + 2).type) for i, c in enumerate(cols[2:]))], schema=schema)

    return texts.select("anchor", "span", "c", "bytes").mapInArrow(lean(run), PIECES)


def _judged(texts: DataFrame, length: int, seed: int, shard: int, group: int, memory: int, widths: tuple[int, ...]) -> DataFrame:
    """(anchor, span, runs) of distinct spans (anchor, span, c, m, bytes) of groups with several. A group of more than ``group`` spans, the edges of
    a passage that very many texts share, is cut into pieces by more context, and these are judged the same way: of equal pieces all is
    repeated, different ones are sorted. With ``width`` 1 a piece is one window, and only equal ones are left."""
    total = texts.where(F.col("m") <= group).agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    out = _sorted_verdicts(texts.where(F.col("m") <= group), max(1, -(-total // shard)), length, memory)
    hot = texts.where(F.col("m") > group)
    if not widths or hot.isEmpty():
        return out
    pieces = materialise(_pieces(hot, length, seed, widths[0]), "pieces")
    kinds = materialise(pieces.groupBy("anchor", "span").agg(F.sum("c").alias("c"), F.first("bytes").alias("bytes")), "piece-kinds")
    several = materialise(kinds.groupBy("anchor").agg(F.count("*").alias("m"), F.min("c").alias("least")).where("m > 1 AND least = 1").select("anchor", "m"), "piece-groups")
    whole = kinds.where("c > 1").select("anchor", "span", F.array(F.struct(F.lit(0).alias("a"), F.length("bytes").alias("b"))).alias("runs"))
    part = _judged(kinds.join(several, "anchor"), length, seed, shard, group, memory, widths[1:]).join(kinds.where("c = 1").select("anchor", "span"), ["anchor", "span"], "left_semi")
    found = pieces.join(whole.unionByName(part), ["anchor", "span"])
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b")))
    found = found.select(F.col("whole_anchor").alias("anchor"), F.col("whole_span").alias("span"), moved.alias("runs"))
    return out.unionByName(found.groupBy("anchor", "span").agg(F.flatten(F.collect_list("runs")).alias("runs")))


@tidy
def repeated_intervals(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard: int = SHARD, group: int = GROUP, memory: int = MEMORY) -> DataFrame:
    """doc_id, k (hash of the text) and runs, the byte intervals to remove, unsorted and overlapping, of every text that has any."""
    rows = materialise(_anchor_rows(docs, length, seed), "anchors")
    # tables of their own, so that the joins on them are plain exchanges, of which Spark splits a hot one
    twice = materialise(rows.groupBy("anchor").agg(F.sum("n").alias("c")).where("c > 1").select("anchor"), "repeated-anchors")
    shared = materialise(rows.join(twice, "anchor", "left_semi"), "shared-anchors")
    discard(rows)
    one = F.struct("doc_id", "k", F.col("cover")[0]["a"].alias("at"))
    spans = materialise(shared.groupBy("anchor", "span").agg(F.sum("n").alias("c"), F.min("size").alias("size"), F.min(one).alias("one")), "spans")
    several = materialise(spans.groupBy("anchor").agg(F.count("*").alias("m"), F.min("c").alias("least")).where("m > 1 AND least = 1").select("anchor", "m"), "open-anchors")
    open_ = materialise(spans.join(several, "anchor").select("anchor", "span", "c", "m", "size", "one.*"), "open-spans")
    source = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("t"))
    texts = source.join(open_, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("k")))
    texts = texts.select("anchor", "span", "c", "m", F.expr("substring(t, at + 1, size)").alias("bytes")).dropDuplicates(["anchor", "span"])
    texts = materialise(texts, "span-texts")
    # spans that occur twice are known already; they went into the shards for others to be compared with
    part = _judged(texts, length, seed, shard, group, memory, WIDTHS).join(spans.where("c = 1").select("anchor", "span"), ["anchor", "span"], "left_semi").where(F.size("runs") > 0)
    whole = spans.where("c > 1").select("anchor", "span", F.lit(None).cast(RUNS_TYPE).alias("runs"))
    verdicts = materialise(whole.unionByName(part), "verdicts")
    at = F.col("cover")[0]["a"]
    moved = F.transform("runs", lambda r: F.struct((r["a"] + at).alias("a"), (r["b"] + at).alias("b")))
    found = shared.join(verdicts, ["anchor", "span"]).select("doc_id", "k", F.when(F.col("runs").isNull(), F.col("cover")).otherwise(moved).alias("runs"))
    return found.groupBy("doc_id", "k").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def merged(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    """What is left of ``raw``."""
    ends = [0, *(b for _, b in runs)]
    return b"".join(raw[b:a] for b, a in zip(ends, [*(a for a, _ in runs), len(raw)], strict=True))


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, narrowed so that no character is cut in two."""
    out = []
    for a, b in runs:
        while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def apply_runs(docs: DataFrame, intervals: DataFrame, schema: str, row, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and what ``row(bytes or None, merged runs)`` returns, for every row of ``docs``."""
    from pyspark.sql.types import StructType

    own = StructType.fromDDL(schema)
    out_type = StructType([docs.schema[k] for k in keep] + own.fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_type)
        for b in batches:
            kept = [b.column(i) for i in range(len(keep))]
            runs = b.column(len(keep) + 1)
            at, held, size = 0, [], 0

            def flush(end):
                cols = list(zip(*held, strict=True))
                return pa.RecordBatch.from_arrays([c.slice(at, end - at).cast(arrow.field(i).type) for i, c in enumerate(kept)] + [pa.array(c, arrow.field(len(keep) + i).type) for i, c in enumerate(cols)], schema=arrow)

            for i, raw in enumerate(text_column(b, len(keep))):
                held.append(row(raw, merged((r["a"], r["b"]) for r in runs[i].as_py() or ())))
                size += len(raw or b"")
                if size > 8 << 20:
                    yield flush(i + 1)
                    at, held, size = i + 1, [], 0
            if held:
                yield flush(b.num_rows)

    found = intervals.select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.col("runs").alias("_runs"))
    rows = docs.select(*(quoted(k).alias(f"_{i}") for i, k in enumerate(keep)), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), F.col("text").alias("_text"))
    rows = rows.join(found, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_k")), "left")
    return rows.select(*(f"_{i}" for i in range(len(keep))), "_text", "_runs").mapInArrow(lean(run), out_type)


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every text."""

    def row(raw, runs):
        raw = raw or b""
        return len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut(raw, runs)).hexdigest()

    return apply_runs(docs, repeated_intervals(docs, **options), "n_bytes long, n_removed long, n_spans long, kept_sha256 string", row)


def op4_exactdup(spark, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


QUERIES = {"op4_exactdup": op4_exactdup}
# every window of every text by its digest: those that two windows have are repeated, and what they cover is cut
ORACLES = {
    "op4_exactdup": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(b[i + 1:i + {LENGTH}]) AS g FROM (SELECT r, b, unnest(range(octet_length(b) - {LENGTH - 1})) AS i FROM d WHERE octet_length(b) >= {LENGTH})),
s AS (SELECT r, i FROM w JOIN (SELECT g FROM w GROUP BY 1 HAVING count(*) > 1) USING (g)),
n AS (SELECT r, min(i) AS a, max(i) + {LENGTH} AS z FROM (SELECT r, i, sum(CASE WHEN i - before <= {LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS island
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM s)) GROUP BY r, island),
k AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM n GROUP BY 1)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE list_reduce(list_transform(range(len(starts) + 1), lambda j: substr(h, CASE WHEN j = 0 THEN 1 ELSE 2 * ends[j] + 1 END,
    CASE WHEN j = len(starts) THEN len(h) ELSE 2 * starts[j + 1] - CASE WHEN j = 0 THEN 0 ELSE 2 * ends[j] END END)), lambda x, y: x || y) END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""
}
