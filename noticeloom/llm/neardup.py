"""Operator 6, MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes the set of its word shingles; equal sets are one class, represented by its smallest doc_id.
2. MinHash signatures of the representatives are cut into bands; texts that share a band are candidates. Each bucket's texts
   are first compared with the bucket's smallest (a star), so a bucket of m texts gives m - 1 pairs.
3. A candidate pair is compared batch by batch of its signature. After n values with m equal, the posterior probability that
   the similarity reaches the threshold (uniform prior) is a binomial sum; below ``miss`` the pair is dropped.
4. Survivors are verified on their full sets of words. Links give components (alternating stars, each round a table).
5. In buckets whose texts are still in several components, texts outside the largest component are compared with all others,
   in tiles of bounded size, pruned as in 3 on signatures alone; texts go only to tiles in which they have a candidate, and are verified
   there. After that no two texts that share a band are left uncompared unless they are in one component already, so no component is missed.

A pair at the threshold shares no band with probability (1 - t^rows)^bands: 1.3e-7 for t = 0.8 with 40 bands of 5 values.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle; rows with equal id and equal text are judged alike; different texts under one id are judged
each for itself, and a component is named by the smallest id in it; rows with a null id have no component, are linked with
nothing and are kept; a very long text costs its task memory in proportion to its own length; columns other than id and text
are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import discard, lean, lean_groups, map_rows, materialise, table, text_key, tidy
from noticeloom.llm.graph import components

BANDS, ROWS = 40, 5
#: Values of a signature compared at a time; the probability at which a pair is given up.
BATCH, MISS = 20, 1e-9
#: Texts of a tile's side, 400 bytes of signature each.
TILE = 2048
#: Ids and keys of up to this many texts are broadcast (some 15 MB); more are joined by a shuffle.
BROADCAST_IDS = 250_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(raw: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, sorted."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, n + 1, dtype=np.uint64)
    return _mix(i * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), _mix(i * np.uint64(0xD6E8FEB86659FD93))


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 64):
        x = shingles[i : i + 64, None] * a + b
        np.minimum(low, x.min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = _mix(np.arange(1, bands + 1, dtype=np.uint64))
    for column in sig.reshape(bands, rows).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def least_matches(n_values: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n values, fewer than m equal ones leave the threshold a posterior probability below ``miss``.

    With a uniform prior, P(J > t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in [*range(batch, n_values, batch), n_values]:
        below, m = 0.0, -1
        for i in range(n + 2):
            below += math.exp(math.lgamma(n + 2) - math.lgamma(i + 1) - math.lgamma(n + 2 - i) + i * math.log(threshold) + (n + 1 - i) * math.log1p(-threshold)) if threshold < 1 else float(i == n + 1)
            if below >= miss:
                break
            m = i
        out.append((n, m + 1))
    return out


def surviving(a: np.ndarray, b: np.ndarray, least: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two matrices of signatures stay after the sequential comparison."""
    alive, got, at = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, m in least:
        got[alive] += (a[alive, at:n] == b[alive, at:n]).sum(1)
        alive, at = alive[got[alive] >= m], n
        if not len(alive):
            break
    return alive


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in col), np.uint16).reshape(len(col), width)


PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _few(ids: DataFrame) -> DataFrame:
    """With a hint to broadcast where its rows have been counted and are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _texts(docs: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """rid and text of the representatives in ``wanted`` (rid). Written once, so that the joins on it are plain exchanges, of
    which Spark splits a hot one."""
    ids = materialise(reps.select("rid", "doc_id", "text_key").join(_few(wanted), "rid", "left_semi"), "wanted-ids")
    own = docs.select("doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    return materialise(own.join(_few(ids), ["doc_id", "text_key"]).groupBy("rid").agg(F.first("text").alias("text")), "wanted-texts")


def _prune(pairs: DataFrame, sigs: DataFrame, least: list[tuple[int, int]]) -> DataFrame:
    """The pairs (u, v) whose signatures survive."""
    width = least[-1][0]

    def run(batches):
        for x in batches:
            if x.num_rows:
                keep = pa.array(surviving(_matrix(x.column(2), width), _matrix(x.column(3), width), least))
                yield pa.RecordBatch.from_arrays([x.column(0).take(keep), x.column(1).take(keep)], schema=PAIR)

    u, v = (sigs.select(F.col("rid").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "uv")
    return pairs.join(u, "u").join(v, "v").select("u", "v", "sig_u", "sig_v").mapInArrow(lean(run), "u long, v long")


def _verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, part: int, whole: int) -> DataFrame:
    """The pairs whose full sets have ``whole * intersection >= part * union``."""

    def shingles(raw: bytes) -> set:
        words = raw.lower().split()
        return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)}

    def run(batches):
        last, own = None, set()
        for x in batches:
            keep = []
            texts = [x.column(i).cast(pa.binary()) for i in (2, 3)]
            for i, u in enumerate(x.column(0).to_pylist()):
                if u != last:
                    last, own = u, shingles(texts[0][i].as_py())
                other = shingles(texts[1][i].as_py())
                both = len(own & other)
                if whole * both >= part * (len(own) + len(other) - both):
                    keep.append(i)
            if keep:
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([x.column(0).take(at), x.column(1).take(at)], schema=PAIR)

    pairs = materialise(pairs, "survivors")
    texts = _texts(docs, reps, pairs.select(F.col("u").alias("rid")).unionByName(pairs.select(F.col("v").alias("rid"))).distinct())
    u, v = (texts.select(F.col("rid").alias(k), F.col("text").alias(f"text_{k}")) for k in "uv")
    return pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v").mapInArrow(lean(run), "u long, v long")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _sides(t: pa.Table, width: int, least: list[tuple[int, int]]):
    """For each stray of a tile: its place and the places of the texts that survive beside it."""
    role, ids, label, stray = (t.column(c).to_numpy() for c in ("role", "rid", "label", "stray"))
    sig = _matrix(t.column("sig").combine_chunks(), width) if t.num_rows else np.empty((0, width), np.uint16)
    a = np.flatnonzero(role == 0)
    for i in np.flatnonzero(role == 1).tolist():
        # two strays meet twice, in either role; once is enough
        other = a[(label[a] != label[i]) & (~stray[a].astype(bool) | (ids[a] > ids[i]))]
        if len(other) and len(found := other[surviving(np.broadcast_to(sig[i], (len(other), width)), sig[other], least)]):
            yield i, found.tolist()


def _tiles(members: DataFrame, reps: DataFrame, docs: DataFrame, least: list[tuple[int, int]], tile: int, k: int, part: int, whole: int) -> DataFrame:
    """Links between different components in buckets (key, rid, label) that hold several.

    Tiles are first compared by signatures alone; texts then travel only to the tiles in which they have a candidate. There a tile verifies
    its candidates on their full sets and gives at most one link fewer than it has texts, as two texts of one component need no second."""
    width = least[-1][0]
    by_label = members.groupBy("key", "label").agg(F.count("*").alias("c"))
    open_ = by_label.groupBy("key").agg(F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("k")).where("k > 1 AND n > 2")
    open_ = open_.select("key", F.col("top.label").alias("top"), F.ceil(F.col("n") / tile).cast("int").alias("t"), F.ceil((F.col("n") - F.col("top.c")) / tile).cast("int").alias("s"))
    left = materialise(members.join(open_, "key").withColumn("stray", F.col("label") != F.col("top")), "open-buckets")
    side = lambda df, role, tiles, strays: df.select("key", F.lit(role).alias("role"), "rid", "label", "stray", tiles.alias("tile"), strays.alias("part"))
    every = side(left, 0, F.pmod(F.xxhash64("rid"), F.col("t")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    strays = side(left.where("stray"), 1, F.explode(F.sequence(F.lit(0), F.col("t") - 1)), F.pmod(F.xxhash64("rid", F.lit(1)), F.col("s")).cast("int"))
    rows = every.unionByName(strays).join(reps.select("rid", "sig"), "rid")
    place = ["key", "tile", "part"]
    named = pa.schema([("key", pa.int64()), ("tile", pa.int32()), ("part", pa.int32()), ("role", pa.int32()), ("rid", pa.int64()), ("label", pa.int64()), ("stray", pa.bool_()), ("sig", pa.binary())])

    def candidates(t: pa.Table) -> pa.Table:
        at = {j for i, found in _sides(t, width, least) for j in (i, *found)}
        return t.select(named.names).take(pa.array(sorted(at), pa.int64())).cast(named)

    def compare(t: pa.Table) -> pa.Table:
        ids, label, text = t.column("rid").to_numpy(), t.column("label").to_numpy(), t.column("text")
        hashes, sets, root = WordHashes(), {}, {}

        def own(i: int) -> np.ndarray:
            if ids[i] not in sets:
                sets[ids[i]] = shingle_hashes(text[i].as_py().encode(), k, hashes)
            return sets[ids[i]]

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        links = []
        for i, found in _sides(t, width, least):
            for j in found:
                x, y = find(int(label[i])), find(int(label[j]))
                if x != y:
                    n, m, both = len(own(i)), len(own(j)), common(own(i), own(j))
                    if whole * both >= part * (n + m - both):
                        root[x] = y
                        links.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())}, schema=PAIR)

    near = rows.groupBy(*place).applyInArrow(lean_groups(candidates), "key long, tile int, part int, role int, rid long, label long, stray boolean, sig binary")
    near = materialise(near, "tile-candidates")
    texts = _texts(docs, reps, near.select("rid").distinct())
    return near.join(texts, "rid").groupBy(*place).applyInArrow(lean_groups(compare), "u long, v long").distinct()


@tidy
def near_duplicates(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, tile: int = TILE) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every text; texts are linked when ``whole * both >= part * union``."""
    n_values = bands * rows
    least = least_matches(n_values, BATCH, part / whole, miss)

    def row(raw, state):
        import xxhash

        hashes, a, b = state
        own = shingle_hashes(raw, k, hashes)
        if not len(own):
            return 0, None, None, None
        sig = minhash(own, a, b)
        return len(own), xxhash.xxh3_128_digest(own.tobytes()), sig.astype(np.uint16).tobytes(), band_keys(sig, bands, rows)

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    base = materialise(map_rows(keyed, "n_shingles long, set_id binary, sig binary, bands array<long>", row, keep=("doc_id", "text_key"), setup=lambda: (WordHashes(), *coefficients(n_values))), "signatures")
    some = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = some.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    classes = materialise(first.select("set_id", "one.*").withColumn("rid", F.col("doc_id")), "classes")
    if not classes.groupBy("doc_id").count().where("count > 1").isEmpty():
        # one id with several texts that are first of their class: numbers take the ids' place, written down so that they stay
        classes = materialise(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    reps = some.join(classes.select("set_id", "doc_id", "text_key", "rid"), ["set_id", "doc_id", "text_key"]).groupBy("rid", "doc_id", "text_key").agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    reps = materialise(reps, "representatives")
    members = reps.select("rid", F.explode("bands").alias("key"))
    pivots = members.groupBy("key").agg(F.min("rid").alias("u"), F.count("*").alias("n")).where("n > 1").select("key", "u")
    shared = materialise(members.join(pivots, "key"), "buckets")
    stars = materialise(shared.where("rid <> u").select("u", F.col("rid").alias("v")).distinct(), "stars")
    links = materialise(_verify(_prune(stars, reps.select("rid", "sig"), least), docs, reps, k, part, whole), "star-links")
    label = materialise(components(links.select("u", "v")), "labels")
    marked = shared.join(label.withColumnRenamed("node", "rid"), "rid", "left").select("key", "rid", F.coalesce("component", "rid").alias("label"))
    more = materialise(_tiles(marked, reps, docs, least, tile, k, part, whole), "tile-links")
    if not more.isEmpty():
        label = materialise(components(more.unionByName(label.select(F.col("component").alias("u"), F.col("node").alias("v")))), "labels")
    for done in (shared, reps):
        discard(done)
    named = label.join(classes.select(F.col("rid").alias("node"), "doc_id"), "node")
    least_id = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = named.join(least_id, "component").select(F.col("node").alias("rid"), "component_id")
    own = classes.join(found, "rid", "left").select("set_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = base.select("doc_id", "text_key", "n_shingles", "set_id").join(own, "set_id", "left")
    # of a row without an id there is nothing to link
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op6_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2).drop("text_key")


QUERIES = {"op6_neardup": op6_neardup}
ORACLES = {
    "op6_neardup": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 80 * (nx.n + ny.n - common)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS doc_id, min(y)::BIGINT AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""
}
