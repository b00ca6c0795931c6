"""Operator 2, language-model scores by stupid backoff.

Counts are of the whole corpus, and a text is scored by the counts of all other texts (its own are taken off), so that no
text vouches for itself. With c the counts of other texts and v the up to ``ORDER`` - 1 words before w:

    S(w | v) = c(v w) / c(v)                  where another text has v w
             = BACKOFF * S(w | v without its first word)   otherwise
    S(w)     = c(w) / n                       with c(w) at least UNSEEN

Everything is joined by the hash of the n-gram. Each task cuts its texts into words once and writes them down as blocks of some MB, numbers
for words. A block explodes its texts into n-grams and sends each distinct one once, with its count, to the n-gram's partition, packed as one sorted row for each partition (at worst
one row for each n-gram, so the number of rows never outgrows the n-grams'). A partition sums the counts of its n-grams over all blocks: that is
the count table. Each block gets the sums of its n-grams back, joins them to its texts' n-grams and sums per document. An n-gram that
every text has is one entry from each block, whatever its count.

Words and pairs are counted first. A longer n-gram can only stand in another text if both its shorter ones do, so of each further order
only those n-grams are counted whose parts another text has: the rest back off anyway. Nothing is lost by it, and most never travel.

Defined results: null and empty texts have no words and score null; a text shorter than ``ORDER`` is scored by what it has; repeated rows
count each as a text of its own; rows with a null id are counted and scored like others; a very long text is one block's work; columns other than id and text
are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from noticeloom.llm._common import input_bytes, materialise, shuffle_partitions, table, text_column, tidy

BACKOFF, UNSEEN, ORDER = 0.4, 0.5, 3
#: Bytes of text of a block, and input bytes (as stored) of a partition of n-grams.
BLOCK_BYTES, PART_BYTES = 10 << 20, 4 << 20
#: Bits of an n-gram's hash. Sixty travel in half a byte less each than sixty-four; of n distinct n-grams a share of n / 2^60 meets another one.
HASH_BITS = 60
_CUT = np.uint64(64 - HASH_BITS)
_TOTAL = np.uint64(0xA5A5A5A5A5A5A5A5) >> _CUT


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(x: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed: planes of zeros or of few values cost next to nothing."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1).T).view("<u8").ravel()


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def numbered(batches, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``BLOCKS`` from batches of doc_id and text: texts are cut into words here and nowhere else."""
    from pyspark import TaskContext

    import zstandard

    pid, seq = TaskContext.get().partitionId(), 0
    ids, parts, lengths, number, size = [], [], [], _Numbers(), 0

    def block() -> pa.RecordBatch:
        flat = np.concatenate([np.empty(0, np.int64), *parts])
        # frequent words get small numbers, whose upper bytes are zeros
        rank = np.argsort(-np.bincount(flat, minlength=len(number)), kind="stable")
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        words = list(number)
        vocabulary = zstandard.ZstdCompressor(level=3).compress(b" ".join(words[i] for i in rank.tolist()))
        cells = [[(pid << 32) + seq], [ids], [pack(np.array(lengths, np.uint64))], [vocabulary], [pack(place[flat])]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, BLOCKS, strict=True)], schema=BLOCKS)

    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), text_column(batch, 1), strict=True):
            words = (raw or b"").lower().split()
            ids.append(doc_id)
            lengths.append(len(words))
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            size += len(raw or b"")
            if size >= block_bytes:
                yield block()
                ids, parts, lengths, number, size, seq = [], [], [], _Numbers(), 0, seq + 1
    if ids:
        yield block()


#: A block: its texts' ids, their numbers of words, its distinct words, and which of them stands where.
BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("vocabulary", pa.binary()), ("words", pa.binary())])
BLOCKS_DDL = "block long, ids array<long>, lengths binary, vocabulary binary, words binary"


class Block:
    """The n-grams of some texts, by order. An n-gram is told by the hash of its words; it stands at its last word's place."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray, order: int = ORDER):
        self.lengths = lengths
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.nth = (np.arange(len(flat)) - starts[self.doc]).astype(np.int32)  # a word's place in its text
        self.hash = [_mix(flat ^ np.uint64(0x5851F42D4C957F2D)) >> _CUT]
        rolled = flat
        for n in range(2, order + 1):
            rolled = np.append(np.zeros(1, np.uint64), rolled[:-1]) * np.uint64(0x9E3779B97F4A7C15) + flat * np.uint64(2 * n - 3)
            self.hash.append(_mix(rolled ^ np.uint64(n)) >> _CUT)

    @classmethod
    def of(cls, row: dict, order: int = ORDER) -> Block:
        """From a row of ``BLOCKS``."""
        import xxhash
        import zstandard

        words = zstandard.ZstdDecompressor().decompress(row["vocabulary"]).split(b" ") if row["vocabulary"] else []
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        return cls(unpack(row["lengths"]).astype(np.int64), hashes[unpack(row["words"])], order)

    def places(self, n: int) -> np.ndarray:
        """Where n-grams of ``n`` words end."""
        return np.flatnonzero(self.nth >= n - 1)

    def counted(self, orders: list[int], at: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The distinct n-grams of some orders, at some places, with their counts, and for each order which of them stands at each place; with
        the words' also the number of all words."""
        found = [np.unique(self.hash[n - 1][at[n]], return_inverse=True) for n in orders]
        sums = [np.bincount(back, minlength=len(g)) for g, back in found]
        if 1 in orders:
            found.append((np.array([_TOTAL], np.uint64), None))
            sums.append(np.array([len(self.doc)]))
        every = np.concatenate([g for g, _ in found])
        order = np.argsort(every, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        starts = np.cumsum([0, *(len(g) for g, _ in found)])
        return every[order], np.concatenate(sums)[order], [place[a : a + len(g)][back] for a, (g, back) in zip(starts.tolist(), found, strict=False) if back is not None]

    def others(self, at: np.ndarray, which: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Of the n-grams at ``at``, ``which`` of the distinct ones they are: their count in other texts."""
        times = np.ones(len(at), np.int64)
        more = np.flatnonzero(np.bincount(which, minlength=len(totals))[which] > 1)  # the others stand in the block once
        own = self.doc[at[more]].astype(np.int64) * max(1, len(totals)) + which[more]
        order = np.argsort(own)
        own = own[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.empty(0, np.int64)
        counts = np.diff(np.append(first, len(own)))
        times[more[order]] = np.repeat(counts, counts)
        return totals[which].astype(np.int64) - times

    def seen(self, n: int, below: np.ndarray) -> np.ndarray:
        """Where an n-gram can stand in another text, ``below`` telling for each word's place whether the shorter one that ends there does."""
        at = self.places(n)
        return at[below[at] & below[at - 1]]

    def levels(self, sums: Callable[[int], np.ndarray], upto: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, places, counts in other texts there, 1 for each place that another text has) for n = 1 .. ``upto``. A block's n-grams are the same
        each time they are made, so only their sums have to come back."""
        at = {1: self.places(1), 2: self.places(2)}
        grams, _, which = self.counted([1, 2], at)
        totals = sums(2)
        self.total = int(totals[np.searchsorted(grams, _TOTAL)]) if len(totals) else 0
        for n in range(1, upto + 1):
            if n > 2:
                _, _, (own,) = self.counted([n], at)
                totals = sums(n)
            else:
                own = which[n - 1]
            count = self.others(at[n], own, totals)
            hit = np.zeros(len(self.doc), bool)
            hit[at[n][count > 0]] = True
            yield n, at[n], count, hit
            if n > 1:
                at = {n + 1: self.seen(n + 1, hit)}

    def scores(self, sums: Callable[[int], np.ndarray], backoff: float, unseen: float):
        """(words, words backed off to themselves, unseen words, mean log10 score or None) of each text."""
        size, n_docs = len(self.doc), len(self.lengths)
        found = self.levels(sums, len(self.hash))
        _, _, one, _ = next(found)
        total = self.total - self.lengths
        score = np.log10(np.maximum(one, unseen)) - np.log10(np.maximum(total[self.doc], 1))
        lower, single = one, np.ones(size, bool)
        for n, at, there, hit in found:
            count = np.zeros(size, np.int64)
            count[at] = there
            # a text's first words have no longer n-gram to back off from
            score[(self.nth >= n - 1) & ~hit] += math.log10(backoff)
            score[hit] = np.log10(count[hit]) - np.log10(lower[np.flatnonzero(hit) - 1])
            single &= ~hit
            lower = count
        alone = single & (self.nth >= 1)
        sums = np.bincount(self.doc, weights=score, minlength=n_docs)
        off = np.bincount(self.doc, weights=alone, minlength=n_docs).astype(np.int64)
        new = np.bincount(self.doc, weights=one <= 0, minlength=n_docs).astype(np.int64)
        for k, o, u, x in zip(self.lengths.tolist(), off.tolist(), new.tolist(), sums.tolist(), strict=True):
            yield k, o, u, round(x / k, 6) if k else None


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_backoff", pa.int64()), ("n_unseen", pa.int64()), ("score", pa.float64())])


def _sums(s: pa.Table, level: int) -> np.ndarray:
    """What came back for the n-grams that a block sent at a level, in the order of their hashes."""
    own = s.filter(pc.equal(s.column("level"), level)).sort_by("part")
    return np.concatenate([np.empty(0, np.uint64), *(unpack(x.as_py()) for x in own.column("sums"))])


@tidy
def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, unseen: float = UNSEEN, block_bytes: int = BLOCK_BYTES, parts: int | None = None, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_backoff, n_unseen, score (mean log10 of S over the text's words) of every text; ``order``: 2 or more."""
    size = input_bytes(docs)
    parts = parts or (max(1, -(-size // PART_BYTES)) if size else shuffle_partitions(docs.sparkSession))
    bits = (parts - 1).bit_length()
    # written down, so that every later step sees the same blocks, whatever is lost; both joins have one plan, so Spark shuffles it once
    blocks = materialise(docs.select("doc_id", "text").mapInArrow(lambda batches: numbered(batches, block_bytes), BLOCKS_DDL), "blocks")
    sent = pa.schema([("block", pa.int64()), ("level", pa.int64()), ("part", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
    sent_ddl, back_ddl = "block long, level long, part long, grams binary, counts binary", "block long, level long, part long, sums binary"

    def packed(block: int, level: int, grams: np.ndarray, counts: np.ndarray) -> pa.Table:
        """A row for each partition that gets any; partitions are ranges of hashes."""
        part = (grams >> np.uint64(HASH_BITS - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
        cut = (np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()
        rows = [(block, level, int(part[a]), pack(np.diff(grams[a:b], prepend=np.uint64(0))), pack(counts[a:b])) for a, b in zip([0, *cut], [*cut, len(part)], strict=True) if b > a]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), sent, strict=True)], schema=sent) if rows else sent.empty_table()

    def shorter(row: dict) -> pa.Table:
        b = Block.of(row, 2)
        return packed(row["block"], 2, *b.counted([1, 2], {1: b.places(1), 2: b.places(2)})[:2])

    def explode(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one block in memory at a time
                yield from shorter(batch.slice(i, 1).to_pylist()[0]).to_batches()

    def explode_longer(level: int):
        def run(t: pa.Table, s: pa.Table) -> pa.Table:
            if not t.num_rows:
                return sent.empty_table()
            (row,) = t.to_pylist()
            b = Block.of(row, level)
            *_, (_, _, _, hit) = b.levels(lambda n: _sums(s, n), level - 1)
            at = b.seen(level, hit)
            return packed(row["block"], level, *b.counted([level], {level: at})[:2])

        return run

    def count(t: pa.Table) -> pa.Table:
        grams = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) for x in t.column("grams")]
        counts = np.concatenate([unpack(x.as_py()) for x in t.column("counts")])
        _, at = np.unique(np.concatenate(grams), return_inverse=True)
        sums = np.bincount(at, weights=counts).astype(np.uint64)[at]
        ends = np.cumsum([len(g) for g in grams])[:-1]
        return pa.table([*(t.column(c) for c in ("block", "level", "part")), pa.array([pack(x) for x in np.split(sums, ends)], pa.binary())], names=["block", "level", "part", "sums"])

    def join(t: pa.Table, s: pa.Table) -> pa.Table:
        if not t.num_rows:
            return OUT.empty_table()
        (row,) = t.to_pylist()
        cols = list(zip(*Block.of(row, order).scores(lambda n: _sums(s, n), backoff, unseen), strict=True))
        return pa.table([pa.array(c, f.type) for c, f in zip([row["ids"], *cols], OUT, strict=True)], schema=OUT)

    counted = blocks.mapInArrow(explode, sent_ddl).groupBy("part").applyInArrow(count, back_ddl)
    for level in range(3, order + 1):
        longer = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(explode_longer(level), sent_ddl)
        counted = counted.unionByName(longer.groupBy("part").applyInArrow(count, back_ddl))
    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(join, "doc_id long, n_words long, n_backoff long, n_unseen long, score double")


def op2_lm(spark, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op2_lm": op2_lm}
_DOCUMENTS = r"""d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT r, len(ws) AS k, i, ws[i] AS a, CASE WHEN i > 1 THEN ws[i - 1:i] END AS b, CASE WHEN i > 2 THEN ws[i - 2:i] END AS c FROM (SELECT r, ws, unnest(generate_series(1, len(ws))) AS i FROM d))"""
# of each order: the count of every text, and of all of them; n-grams of a text that another text does not have count 0
_COUNTS = lambda c: f"{c}o AS (SELECT r, {c}, count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY 1, 2), {c}n AS (SELECT r, {c}, sum(n) OVER (PARTITION BY {c}) - n AS n FROM {c}o)"
ORACLES = {
    "op2_lm": f"""WITH {_DOCUMENTS}, n AS (SELECT count(*) AS n FROM t), {_COUNTS("a")}, {_COUNTS("b")}, {_COUNTS("c")},
x AS (SELECT t.r, t.i, n.n - k AS total, an.n AS one, coalesce(bn.n, 0) AS two, coalesce(cn.n, 0) AS three, av.n AS before, coalesce(bv.n, 0) AS pair FROM t CROSS JOIN n
  JOIN an ON an.r = t.r AND an.a = t.a LEFT JOIN bn ON bn.r = t.r AND bn.b = t.b LEFT JOIN cn ON cn.r = t.r AND cn.c = t.c LEFT JOIN an av ON av.r = t.r AND av.a = t.b[1] LEFT JOIN bn bv ON bv.r = t.r AND bv.b = t.c[1:2]),
s AS (SELECT r, count(*) AS k, count(*) FILTER (i > 1 AND two = 0) AS n_backoff, count(*) FILTER (one = 0) AS n_unseen,
  sum(CASE WHEN three > 0 THEN log10(three) - log10(pair) ELSE CASE WHEN i > 2 THEN log10({BACKOFF}) ELSE 0 END +
    CASE WHEN two > 0 THEN log10(two) - log10(before) ELSE CASE WHEN i > 1 THEN log10({BACKOFF}) ELSE 0 END + log10(greatest(one, {UNSEEN})) - log10(greatest(total, 1)) END END) AS s FROM x GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff, coalesce(n_unseen, 0)::BIGINT AS n_unseen, round(s / k, 6) AS score FROM d LEFT JOIN s USING (r)"""
}
