"""Operator 13, the prefix trie of conversations.

Conversations are sequences of turns; every distinct sequence of first turns is a node, and two conversations share a node as long
as they share their beginning.

1. ``running``: rows are sorted by conversation and turn over the whole cluster, numpy scans every partition, and what a
   conversation had before a partition's first row is carried over. So a conversation of any length is spread over tasks.
2. A turn's value times a power of its depth, modulo 2^61 - 1, summed over the first d turns, is a polynomial fingerprint of
   that prefix. Rows of equal depth and fingerprint are a candidate group; its representative is the smallest conversation.
3. Every group is verified: each member's turn (its SHA-256) and the fingerprint before it must be its representative's. As this holds
   at every depth, whole prefixes are compared turn by turn. Groups with a member that differs are collisions: their turns get
   values of their own by a fresh hash, which splits them, and the scan is run again until none is left.
4. A node is named by its smallest conversation and its depth, so nodes of one name are a path downwards, and a path hangs on the node
   above its top. Sums over subtrees are rolled up from path to parent path, one hop a round, each path's sum as one row, and
   then along paths by ``running`` from the bottom.

Defined results: turns are ordered by number, null first, ties by the digest of role and text; null role or text is empty; rows with a
null conv_id belong to no conversation; repeated rows are turns of their own; an empty table has no node, not even the root; columns
other than the four are ignored; very long texts are reduced to a digest and a number of words where they are read. Rounds of the rollup
are as many as paths hang on each other, at most the longest conversation's turns. Nothing is gathered by conversation or node but sums; the ids
that end at a node are packed in order and hashed as a stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm._common import crc32_sql, discard, materialise, shuffle_partitions, table, tidy

PRIME = (1 << 61) - 1
BASE = 0x1A2B3C4D5E6F7081 % PRIME
#: Ids that end at a node travel in packs of about so many bytes.
PACK_BYTES = 1 << 16
_LOW = np.uint64((1 << 32) - 1)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, for values below it, in 64-bit halves."""
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    ah, al, bh, bl = a >> np.uint64(32), a & _LOW, b >> np.uint64(32), b & _LOW
    high, middle, low = ah * bh, ah * bl + al * bh, al * bl  # below 2^58, 2^62, 2^64
    # 2^64 is 8 and 2^32 * m is (m >> 29) + (m & (2^29 - 1)) * 2^32 modulo the prime
    p = np.uint64(PRIME)
    out = (low & p) + (low >> np.uint64(61)) + (high << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << np.uint64(32))
    out = (out & p) + (out >> np.uint64(61))
    return np.where(out >= p, out - p, out)


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^61 - 1."""
    out, square, e = np.ones(len(exponents), np.uint64), np.full(1, base, np.uint64), exponents.astype(np.int64)
    while e.any():
        out = np.where(e & 1, times(out, square), out)
        square, e = times(square, square), e >> 1
    return out


def running(df: DataFrame, key: str, order: list[Column], values: list[str], name: str) -> DataFrame:
    """``df`` with ``run_<value>`` for each of ``values`` (longs): the sum over the rows of ``key`` up to and with this one, in ``order``.

    One range exchange whatever the sizes of the keys: a partition scans its rows in numpy, and sums carried into a partition
    are at most one row each, as only its first key can have begun before. The scanned rows are a written table.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    out_type = StructType([*df.schema.fields, *(StructField(f"run_{v}", LongType()) for v in values), StructField("pid", LongType())])

    def scan(batches):
        from pyspark import TaskContext

        schema = to_arrow_schema(out_type)
        pid, last, held = TaskContext.get().partitionId(), None, [0] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            new = np.append(True, keys[1:] != keys[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
            sums = []
            for i, v in enumerate(values):
                x = batch.column(batch.schema.get_field_index(v)).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(x)
                s = total - (total - x)[first]
                if keys[0] == last:
                    s[first == 0] += held[i]
                held[i] = int(s[-1])
                sums.append(s)
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(s, pa.int64()) for s in sums), pa.array(np.full(len(keys), pid), pa.int64())], schema=schema)

    n = shuffle_partitions(df.sparkSession)
    rows = materialise(df.repartitionByRange(n, F.col(key), *order).sortWithinPartitions(F.col(key), *order).mapInArrow(scan, out_type), name)
    before = Window.partitionBy(key).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(key, "pid").agg(*(F.sum(v).alias(v) for v in values))
    carried = parts.select(F.col(key).alias("_key"), F.col("pid").alias("_pid"), *(F.sum(v).over(before).alias(f"_{v}") for v in values)).where(f"_{values[0]} IS NOT NULL")
    carried = F.broadcast(carried)  # at most a row for each partition
    joined = rows.join(carried, (F.col(key) == F.col("_key")) & (F.col("pid") == F.col("_pid")), "left")
    out = joined.select(*df.columns, *((F.col(f"run_{v}") + F.coalesce(f"_{v}", F.lit(0))).alias(f"run_{v}") for v in values))
    out._noticeloom_path = rows._noticeloom_path
    return out


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (of role and text), words (of the text) of every turn that has a conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("digest"), words.alias("words"))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), digest, words: turns in the order of their numbers."""
    rows = running(turns.withColumn("one", F.lit(1).cast("long")), "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], ["one"], "turns")
    out = rows.select("conv_id", F.col("run_one").alias("depth"), "digest", "words")
    out._noticeloom_path = rows._noticeloom_path
    return out


def fingerprints(turns: DataFrame, base: int = BASE, modulus: int = PRIME) -> DataFrame:
    """``turns`` (conv_id, depth, digest, words, salt) with the fingerprints up to each turn and before it, in two halves that are summed apart.

    ``modulus``: that of a turn's value; a small one makes collisions, for tests.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    value = F.pmod(F.xxhash64("digest", "salt"), F.lit(min(modulus, PRIME)))
    valued = turns.withColumn("value", value)
    out_type = StructType([*turns.schema.fields, *StructType.fromDDL("low long, high long").fields])

    def terms(batches):
        schema = to_arrow_schema(out_type)
        for b in batches:
            t = times(b.column(b.num_columns - 1).to_numpy().astype(np.uint64), powers(base, b.column(b.schema.get_field_index("depth")).to_numpy()))
            if modulus < PRIME:
                t %= np.uint64(modulus)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array((t & _LOW).astype(np.int64)), pa.array((t >> np.uint64(32)).astype(np.int64))], schema=schema)

    rows = running(valued.mapInArrow(terms, out_type), "conv_id", [F.col("depth")], ["low", "high"], "prefixes")
    # sums of the halves of residues; congruent sums that are not equal are another fingerprint, which parts nothing that is equal
    out = rows.select(*turns.columns, F.col("run_low").alias("f_low"), F.col("run_high").alias("f_high"), (F.col("run_low") - F.col("low")).alias("p_low"), (F.col("run_high") - F.col("high")).alias("p_high"))
    out._noticeloom_path = rows._noticeloom_path
    return out


_GROUP = ["depth", "f_low", "f_high"]
_SAME = ["digest", "p_low", "p_high"]


def verified(turns: DataFrame, base: int = BASE, modulus: int = PRIME) -> tuple[DataFrame, DataFrame]:
    """(prefixes, groups): fingerprints under which no two different prefixes meet, and one row for each of them.

    A member that is not like its group's representative marks a collision; all turns of such groups are valued anew.
    """
    turns = turns.withColumn("salt", F.lit(0).cast("long"))
    written = None
    salt = 0
    while True:
        prefixes = fingerprints(turns, base, modulus)
        if written is not None:
            discard(written)
        # equal members of a group are one row here; a group of any size is summed in the map tasks
        kinds = materialise(prefixes.groupBy(*_GROUP, *_SAME).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words")), "kinds")
        heads = kinds.groupBy(*_GROUP).agg(F.min_by(F.struct(*_SAME), F.struct("conv_id", *_SAME)).alias("head"))
        clash = kinds.join(heads, _GROUP).where(F.struct(*_SAME) != F.col("head")).select(*_GROUP).distinct()
        clash = materialise(clash, "clashes")
        if clash.isEmpty():
            discard(clash)
            return prefixes, kinds
        salt += 1
        written = materialise(prefixes.join(clash.withColumn("_hit", F.lit(True)), _GROUP, "left").select("conv_id", "depth", "digest", "words", F.when(F.col("_hit"), F.lit(salt)).otherwise(F.col("salt")).cast("long").alias("salt")), "salted")
        for t in (prefixes, kinds, clash):
            discard(t)
        turns = written


def ends_digest(ends: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``ends_sha256``, the SHA-256 of each key's ids (``conv_id``) in order, joined by commas.

    Ids are sorted by key over the whole cluster and packed; a key's packs are hashed one after the other, none held.
    """
    n = shuffle_partitions(ends.sparkSession)
    key_ddl = ", ".join(f"{k} long" for k in keys)

    def pack(batches):
        from pyspark import TaskContext

        pid, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new = np.zeros(batch.num_rows, bool)
            for c in cols[: len(keys)]:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            rows = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                for at in range(a, b, PACK_BYTES // 8):
                    seq += 1
                    ids = cols[-1][at : min(b, at + PACK_BYTES // 8)]
                    rows.append((*(int(c[a]) for c in cols[:-1]), pid, seq, ",".join(map(str, ids.tolist()))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * (len(keys) + 2) + [pa.string()], strict=True)], names=[*keys, "pid", "seq", "ids"]) if rows else pa.RecordBatch.from_pylist([], pa.schema([(k, pa.int64()) for k in [*keys, "pid", "seq"]] + [("ids", pa.string())]))

    def digest(batches):
        last, h, rows = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(len(keys))), batch.column(len(keys)).to_pylist(), strict=True):
                if key != last:
                    if h:
                        rows.append((*last, h.hexdigest()))
                    last, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if len(rows) > 10_000:
                yield table_of(rows)
                rows = []
        if h:
            rows.append((*last, h.hexdigest()))
        if rows:
            yield table_of(rows)

    def table_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * len(keys) + [pa.string()], strict=True)], names=[*keys, "ends_sha256"])

    packs = ends.select(*keys, "conv_id").repartitionByRange(n, *keys, "conv_id").sortWithinPartitions(*keys, "conv_id").mapInArrow(pack, f"{key_ddl}, pid long, seq long, ids string")
    return packs.repartition(n, *keys).sortWithinPartitions(*keys, "pid", "seq").select(*keys, "ids").mapInArrow(digest, f"{key_ddl}, ends_sha256 string")


def rolled_up(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` (conv_id, depth, parent_conv_id, ``values``) with ``sub_<value>`` for each of ``values``: its sum over the node's subtree."""
    total = [F.sum(v).alias(v) for v in values]
    # a path's top is its node whose parent has another name
    tops = materialise(nodes.where("parent_conv_id IS NULL OR parent_conv_id <> conv_id").select("conv_id", F.col("parent_conv_id").alias("above"), (F.col("depth") - 1).alias("above_depth")), "tops")
    now = materialise(nodes.groupBy("conv_id").agg(*total), "sums")
    hung: list[DataFrame] = []
    while True:
        # what hangs on a node: sums of the paths whose tops are its children
        up = materialise(now.join(tops, "conv_id").where("above IS NOT NULL").groupBy(F.col("above").alias("conv_id"), F.col("above_depth").alias("depth")).agg(*total), "hung")
        discard(now)
        if up.isEmpty():
            discard(up)
            break
        hung.append(up)
        now = materialise(up.groupBy("conv_id").agg(*total), "sums")
    own = nodes.select("conv_id", "depth", *values)
    for h in hung:
        own = own.unionByName(h)
    sums = running(own.groupBy("conv_id", "depth").agg(*total), "conv_id", [F.col("depth").desc()], values, "paths")
    sums = materialise(sums.select("conv_id", "depth", *(F.col(f"run_{v}").alias(f"sub_{v}") for v in values)), "subtrees")
    for t in (tops, *hung):
        discard(t)
    return nodes.join(sums, ["conv_id", "depth"])


def prefix_trie(turns: DataFrame, members: DataFrame, base: int = BASE, modulus: int = PRIME) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth from 1 without gaps, digest, words); ``members``: conv_id, n_turns of every conversation, turnless ones too.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    prefixes, kinds = verified(turns, base, modulus)
    own = kinds.select("conv_id", "depth", "f_low", "f_high", "p_low", "p_high", "n_convs", "words")
    above = kinds.select((F.col("depth") + 1).alias("depth"), F.col("f_low").alias("p_low"), F.col("f_high").alias("p_high"), F.col("conv_id").alias("parent_conv_id"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = materialise(root.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("f_low", "f_high")), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(0).cast("long").alias("words")), "root")
    first = own.where("depth = 1").drop("p_low", "p_high").crossJoin(F.broadcast(root.select(F.col("conv_id").alias("parent_conv_id"))))  # the root is one row
    deeper = own.where("depth > 1").join(above, ["depth", "p_low", "p_high"]).drop("p_low", "p_high")
    linked = root.unionByName(first).unionByName(deeper)
    linked = materialise(linked.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    children = linked.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = linked.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = materialise(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "nodes")
    discard(linked)
    # a conversation ends at the fingerprint of its last turn; a turnless one at the root
    ends = prefixes.join(members.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select(*_GROUP, "conv_id")
    ends = ends.unionByName(members.where("n_turns = 0").select(*(F.lit(0).cast("long").alias(c) for c in _GROUP), "conv_id"))
    digests = ends_digest(ends, _GROUP)
    out = rolled_up(nodes, ["leaf", "saved"]).join(digests, _GROUP, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sub_leaf").alias("n_leaves"), F.col("sub_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


@tidy
def conversation_trie(conversations: DataFrame, base: int = BASE, modulus: int = PRIME) -> DataFrame:
    """The trie of a table conv_id, turn, role, text as it stands."""
    turns = materialise(numbered(turns_of(conversations)), "numbered")
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.max("depth").alias("n_turns")), base, modulus)


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of the contract: conversation c begins with the first h turns of c - c % ``every``, h = crc32(c) % ``most``, then has its own turns after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    from_id = F.col("conv_id") - F.col("conv_id") % every
    starts = turns.where((F.col("conv_id") % every == 0) & (F.col("depth") < most)).groupBy(F.col("conv_id").alias("from_id")).agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "words"))).alias("start"))  # fewer than ``most`` turns each
    members = turns.groupBy("conv_id").agg(F.max("depth").alias("n_own")).withColumn("h", h).withColumn("from_id", from_id).join(starts, "from_id", "left")
    members = members.withColumn("start", F.slice(F.coalesce("start", F.array()), F.lit(1), F.col("h").cast("int"))).withColumn("n_start", F.size("start").cast("long"))
    members = materialise(members.withColumn("n_turns", F.col("n_start") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).drop("n_own", "from_id"), "members")
    given = members.select("conv_id", F.explode("start").alias("t")).select("conv_id", "t.depth", "t.digest", "t.words")
    own = turns.join(members.select("conv_id", "h", "n_start"), "conv_id").where("depth > h").select("conv_id", (F.col("depth") - F.col("h") + F.col("n_start")).alias("depth"), "digest", "words")
    return given.unionByName(own), members.select("conv_id", "n_turns")


@tidy
def op13_convtrie(spark, sf_dir: str) -> DataFrame:
    turns = materialise(numbered(turns_of(table(spark, sf_dir, "conversations"))), "numbered")
    return prefix_trie(*rebuilt(turns))


_ORACLE = rf"""WITH s AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS seq FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (SELECT *, {crc32_sql("conv_id")} % 4 AS h FROM s),
r AS (SELECT h.conv_id, list_concat(coalesce(b.seq[:h], []), h.seq[h + 1:]) AS seq FROM h LEFT JOIN s b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(seq) = d AS ends, d, seq[:d] AS path FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM r)),
n AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends)), sha256('')) AS ends_sha256 FROM p GROUP BY 1, 2),
v AS (SELECT n.*, CASE WHEN n.d > 0 THEN (n.n_convs - 1) * len(regexp_extract_all(n.path[n.d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS own, m.parent, coalesce(c.n_children, 0) AS n_children
  FROM n LEFT JOIN (SELECT d + 1 AS d, path AS up, conv_id AS parent FROM n) m ON m.d = n.d AND m.up = n.path[:n.d - 1] LEFT JOIN (SELECT d - 1 AS d, path[:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2) c ON c.d = n.d AND c.path = n.path),
u AS (SELECT up, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM (SELECT own, n_children, path[:k] AS up FROM (SELECT *, unnest(range(d + 1)) AS k FROM v)) GROUP BY 1)
SELECT conv_id, d::BIGINT AS depth, CASE WHEN d > 0 THEN parent END AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM v JOIN u ON u.up = v.path"""

QUERIES = {"op13_convtrie": op13_convtrie}
ORACLES = {"op13_convtrie": _ORACLE}
