"""Upserts whose rows see each other: the n-th new row is matched with the table as the rows before it have left it.

A new row takes the table's row of the equal name, else the first one, in table order, of which one name contains the other (both of
five characters or more), else it is appended. What a row finds depends on earlier ones, but only on those whose names match its own or
those of its candidates. So matching names are links, and in rounds every row is decided whose candidates are: rows that nothing
undecided stands before, all over the table at once. Names that hang together and have few rows are decided before that, one after the other
in one pass over the rows dealt by such groups; the rounds are for the others. Rounds are as many as the longest chain of rows that wait for each other, not as rows; each
round's tables are written down, and hold undecided rows' links only.

With ``rename`` a matched row takes the new name over, as a replaced row does, and the old name matches nobody any more; without it the table's name
stays. Repeats of a name between which no matching name comes are one visit and are decided together, however many they are.

Names are compared with blanks normalised; null names match nothing and found a row each; equal names of the snapshot count once, under
the smallest ordinal; ``order`` is a long, zero or more, that no two new rows share; empty tables are fine.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import inline, is_missing, present, text
from noticeloom.functions.values import ordered_set
from noticeloom.operators.projects import MIN_NAME, containing
from noticeloom.sources.writers import dropped, landed

log = logging.getLogger(__name__)

#: Rows that one task looks through for a name; names with more are looked through by ranges, over all tasks.
MOST = 1_000_000
#: Rows of the names that hang together which one pass in order decides; more of them are decided in rounds.
FEW = 500
#: The time of a link to nothing; the snapshot's is -1.
MARK = -2


def last_before(rows: DataFrame, key: list[str], order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the greatest ``value`` among the rows of ``key`` that stand before it in ``order`` (nulls are none).

    A key may have any share of the rows: they are dealt by range, looked through range by range, and what came before a range is added.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = landed(rows.repartitionByRange(n, *key, order).withColumn("_pid", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*key, "_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(*key, "_pid").agg(F.max(value).alias("_v")).withColumn("_before", F.max("_v").over(above)).drop("_v")
    got = dealt.withColumn("_inside", F.max(value).over(inside)).join(ranges, [*key, "_pid"])
    return got.withColumn(name, F.greatest("_inside", "_before")).drop("_inside", "_before", "_pid")


def matching_names(names: DataFrame) -> DataFrame:
    """(a, b): distinct names (column ``n``) that match each other, in both directions, and every name with itself."""
    pairs = containing(names.select(F.col("n").alias("a")), names.select(F.col("n").alias("b")), "a", "b", MIN_NAME).where("a <> b")
    return landed(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(names.select(F.col("n").alias("a"), F.col("n").alias("b"))), "matching")


def _hot(items: DataFrame, pairs: DataFrame) -> DataFrame | None:
    """(b): names with more than ``MOST`` rows of their own and of names that match them; they are as few as all rows allow. None if no name can be one."""
    counts, degrees = items.groupBy("n").agg(F.count("*").alias("c")), pairs.groupBy("b").agg(F.count("*").alias("d"))
    c, d = counts.agg(F.max("c")).first()[0], degrees.agg(F.max("d")).first()[0]
    if not c or 2 * c * d <= MOST:
        return None
    sums = pairs.join(counts.select(F.col("n").alias("a"), F.col("c").alias("ca")), "a", "left").groupBy("b").agg(F.sum("ca").alias("s"), F.count("*").alias("d"))
    hot = landed(sums.join(counts.select(F.col("n").alias("b"), "c"), "b").where(F.coalesce("s", F.lit(0)) + F.col("d") * F.col("c") > MOST).select("b"), "hot")
    return None if hot.isEmpty() else hot


def _seen_by_ranges(rows: DataFrame) -> DataFrame:
    """What ``_visits`` finds out for a name in one task, for names of any share of the rows."""
    seen = landed(last_before(rows, ["a", "b"], "t", "v", "last").where("own").select("a", "b", "t", "last"), "seen")
    foreign = seen.groupBy("b", "t").agg(F.max(F.when(F.col("a") != F.col("b"), F.col("last"))).alias("p"))
    foreign = foreign.withColumn("p", F.coalesce("p", F.lit(-1)))
    visit = foreign.join(foreign.groupBy("b", "p").agg(F.min("t").alias("node")), ["b", "p"])
    return seen.join(visit.select("b", "t", "node"), ["b", "t"])


def _visits(items: DataFrame, pairs: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(item's row -> node, nodes, links), for names that are taken over. A link leads to the last visit of a matching name before the node,
    or to the snapshot's row of that name if there was none."""
    # for a pair (a, b): when a was last there before each row of b
    own = pairs.join(items.select(F.col("n").alias("b"), "t"), "b").select("a", "b", "t", F.when(F.col("a") == F.col("b"), F.col("t")).alias("v"), F.lit(True).alias("own"))
    others = pairs.where("a <> b").join(items.select(F.col("n").alias("a"), "t"), "a").select("a", "b", "t", F.col("t").alias("v"), F.lit(False).alias("own"))
    rows, hot = own.unionByName(others), _hot(items, pairs)
    # a name's rows are brought together once; all windows hold within them
    dealt = (rows.join(F.broadcast(hot), "b", "left_anti") if hot is not None else rows).repartition("b")
    before = Window.partitionBy("b", "a").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    seen = dealt.withColumn("last", F.max("v").over(before)).where("own")
    foreign = F.max(F.when(F.col("a") != F.col("b"), F.col("last"))).over(Window.partitionBy("b", "t"))
    seen = seen.withColumn("p", F.coalesce(foreign, F.lit(-1))).withColumn("node", F.min("t").over(Window.partitionBy("b", "p"))).select("a", "b", "t", "last", "node")
    if hot is not None:
        seen = seen.unionByName(_seen_by_ranges(rows.join(F.broadcast(hot), "b", "left_semi")).select(*seen.columns))
    seen = landed(seen, "seen")
    visit = landed(seen.where("a = b").select(F.col("b").alias("n"), "t", "node"), "visits")
    nodes = visit.where("t = node").select("n", "t")
    at_nodes = seen.where("t = node").drop("node")
    to_visit = visit.select(F.col("n").alias("a"), F.col("t").alias("last"), F.col("node").alias("jt"))
    later = at_nodes.where("last IS NOT NULL").join(to_visit, ["a", "last"]).select(F.col("a").alias("jn"), "jt", F.col("b").alias("kn"), F.col("t").alias("kt"), F.lit(None).cast(known.schema["slot"].dataType).alias("slot"))
    start = at_nodes.where("last IS NULL").join(known, at_nodes["a"] == known["n"]).select(F.col("a").alias("jn"), F.lit(-1).cast("long").alias("jt"), F.col("b").alias("kn"), F.col("t").alias("kt"), "slot")
    return visit, nodes, later.unionByName(start)


def _names(items: DataFrame, pairs: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same for names that stay: all rows of a name go the way of its first."""
    first = items.groupBy("n").agg(F.min("t").alias("node"))
    visit = landed(items.join(first, "n").select("n", "t", "node"), "visits")
    nodes = landed(visit.select("n", F.col("node").alias("t")).distinct(), "nodes")
    own = nodes.select(F.col("n").alias("b"), F.col("t").alias("kt"))
    ends = pairs.join(own, "b").join(known.select(F.col("n").alias("a"), "slot"), "a", "left").join(nodes.select(F.col("n").alias("a"), F.col("t").alias("jt")), "a", "left")
    ends = ends.where("slot IS NOT NULL OR jt < kt")
    return visit, nodes, ends.select(F.col("a").alias("jn"), F.when(F.col("slot").isNull(), F.col("jt")).otherwise(F.lit(-1)).cast("long").alias("jt"), F.col("b").alias("kn"), "kt", "slot")


def _groups(pairs: DataFrame) -> DataFrame:
    """(n, l, closed): a label of every name, and whether all names that match it have the same one. Names of a label whose names are all closed match
    nothing outside of it: labels are smallest hashes, so names that have nothing to do with each other may share one, which does no harm."""
    label = pairs.groupBy("b").agg(F.min(F.xxhash64("a")).alias("l"))
    for _ in range(2):
        near = pairs.join(label.select(F.col("b").alias("a"), "l"), "a")
        label = near.groupBy("b").agg(F.min("l").alias("l"), (F.min("l") == F.max("l")).alias("closed"), F.max(F.when(F.col("a") == F.col("b"), F.col("l"))).alias("own"))
    return label.select(F.col("b").alias("n"), F.col("own").alias("l"), "closed")


def _in_turn(schema: StructType, rename: bool) -> Callable:
    """For mapInArrow over (l, n, t, o) in the order of l, t, o: (t, o, f) of every new row, the snapshot's ordinal or the founder that it takes."""

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        label, table = None, {}  # name -> what it stands for, by place in the table
        for batch in batches:
            got = []
            for l, n, t, o in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if l != label:
                    label, table = l, {}
                if t < 0:
                    table[n] = (len(table), o, None)
                    continue
                hit = n if n in table else None
                if hit is None and len(n) >= MIN_NAME:
                    hit = min((k for k in table if len(k) >= MIN_NAME and (k in n or n in k)), key=lambda k: table[k][0], default=None)
                if hit is None:
                    hit = n
                    table[n] = (len(table), None, t)
                slot = table[hit]
                if rename and hit != n:
                    del table[hit]
                    table[n] = slot
                got.append((t, *slot[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*got, strict=True) if got else [[]] * 3, out, strict=True)], schema=out)

    return run


def _in_rounds(named: DataFrame, pairs: DataFrame, known: DataFrame, slot: Callable, rename: bool) -> tuple[DataFrame, int]:
    """(t, slot) of every row of ``named``, whatever hangs together, and the number of rounds."""
    visit, nodes, links = (_visits if rename else _names)(named, pairs, known)
    # beside its links an open node has a mark, a link to nothing, so the links alone tell what is open
    marks = nodes.select(F.col("n").alias("jn"), F.lit(MARK).cast("long").alias("jt"), F.col("n").alias("kn"), F.col("t").alias("kt"), F.lit(None).cast(known.schema["slot"].dataType).alias("slot"))
    links = landed(links.unionByName(marks), "links")
    done: list[DataFrame] = []
    while not links.isEmpty():
        # a link is sure when its candidate has a row and no undecided row that could take it over comes first
        exact, real = F.col("jn") == F.col("kn"), F.col("jt") != MARK
        if rename:
            first = links.where(real).groupBy("jn", "jt").agg(F.min("kt").alias("u"))
            sure = links.join(first, ["jn", "jt"], "left").withColumn("sure", F.when(real, F.col("slot").isNotNull() & (F.col("u") == F.col("kt"))))
        else:
            sure = links.withColumn("sure", F.when(real, F.col("slot").isNotNull()))
        best = F.min(F.when(F.col("sure"), F.struct((~exact).alias("near"), "slot", "jn", "jt"))).alias("best")
        votes = sure.groupBy(F.col("kn").alias("n"), F.col("kt").alias("t")).agg(best, F.min("sure").alias("all_sure"), F.max(F.col("sure") & exact).alias("equal"))
        ready = votes.where("all_sure IS NULL OR all_sure OR equal")
        now = landed(ready.select("n", "t", F.coalesce(F.col("best.slot"), slot(1, F.lit(None), F.col("t"))).alias("slot"), F.col("best.jn").alias("took_n"), F.col("best.jt").alias("took_t")), "decided")
        done.append(now)
        kept = links.join(now.select(F.col("n").alias("kn"), F.col("t").alias("kt")), ["kn", "kt"], "left_anti")
        # candidates get their rows; names that are nobody's any more are no candidates (what is taken was decided before, so it is not in both parts)
        fate = now.select(F.col("n").alias("jn"), F.col("t").alias("jt"), F.col("slot").alias("got"), (F.lit(rename) | F.col("took_n").isNull()).alias("stays"))
        if rename:
            fate = fate.unionByName(now.where("took_n IS NOT NULL").select(F.col("took_n").alias("jn"), F.col("took_t").alias("jt"), F.lit(None).cast(known.schema["slot"].dataType).alias("got"), F.lit(False).alias("stays")))
        kept = kept.join(fate, ["jn", "jt"], "left").where("stays IS NULL OR stays")
        kept = landed(kept.select("jn", "jt", "kn", "kt", F.coalesce("slot", "got").alias("slot")), "links")
        dropped(links)
        links = kept
    decided = reduce(DataFrame.unionByName, (d.select("n", F.col("t").alias("node"), "slot") for d in done))
    out = landed(visit.join(decided, ["n", "node"]).select("t", "slot"), "in_rounds")
    for t in (visit, links, *done):
        dropped(t)
    return out, len(done)


def resolved(new: DataFrame, snapshot: DataFrame, order: str, ordinal: str, key: str = "项目名称", rename: bool = True) -> DataFrame:
    """(order, slot) of every new row: slot.known is the ordinal of the snapshot's row that it takes, slot.founder the order of the new row
    that was appended and that it takes, itself included."""
    kind = snapshot.schema[ordinal].dataType.simpleString()
    slot = lambda is_new, o, t: F.struct(F.lit(is_new).alias("appended"), o.cast(kind).alias("known"), t.cast("long").alias("founder"))
    items = landed(new.select(F.when(F.col(key).isNotNull(), inline(F.col(key))).alias("n"), F.col(order).cast("long").alias("t")), "items")
    known = snapshot.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("n")).agg(F.min(ordinal).alias("o"))
    known = landed(known.select("n", slot(0, F.col("o"), F.lit(None)).alias("slot")), "known")
    named = items.where("n IS NOT NULL")
    every = named.select("n").union(known.select("n")).distinct()
    pairs = matching_names(every)
    # names that hang together and have few rows are decided in one pass over them, the others in rounds
    groups = landed(_groups(pairs), "groups")
    every = named.select("n", "t", F.lit(None).cast(kind).alias("o")).unionByName(known.select("n", F.lit(-1).cast("long").alias("t"), F.col("slot.known").alias("o")))
    members = landed(every.join(groups, "n"), "members")
    small = landed(members.groupBy("l").agg(F.count("*").alias("c"), F.min("closed").alias("closed")).where((F.col("c") <= FEW) & F.col("closed")).select("l"), "small")
    turns = members.join(small, "l", "left_semi").select("l", "n", "t", "o").repartition("l").sortWithinPartitions("l", "t", "o")
    schema = StructType().add("t", "long").add("o", snapshot.schema[ordinal].dataType).add("f", "long")
    at_once = landed(turns.mapInArrow(_in_turn(schema, rename), schema), "at_once")
    tables = [items, known, pairs, groups, members, small, at_once]
    out = at_once.select("t", F.struct(F.when(F.col("f").isNull(), 0).otherwise(1).alias("appended"), F.col("o").alias("known"), F.col("f").alias("founder")).alias("slot"))
    out = out.unionByName(items.where("n IS NULL").select("t", slot(1, F.lit(None), F.col("t")).alias("slot")))
    rest, rounds = landed(members.join(small, "l", "left_anti").select("n", "t"), "rest"), 0
    tables.append(rest)
    if not rest.where("t >= 0").isEmpty():
        names = rest.select("n").distinct()
        left = pairs.join(names.select(F.col("n").alias("b")), "b", "left_semi").select("a", "b")
        late, rounds = _in_rounds(rest.where("t >= 0"), left, known.join(names, "n", "left_semi"), slot, rename)
        out = out.unionByName(late)
        tables.append(late)
    log.info("rows resolved in %d rounds", rounds)
    out = landed(out.select(F.col("t").alias(order), "slot"), "resolved")
    for t in tables:
        dropped(t)
    out._rounds = rounds
    return out


def upsert_in_order(snapshot: DataFrame, new: DataFrame, order: str, ordinal: str, new_ordinal: Column, mode: str = "replace", key: str = "项目名称") -> DataFrame:
    """The table after all rows of ``new`` have been put in one after the other. ``replace``: the last row of a slot is its row, name included;
    ``fill``: the table's name stays, blanks are filled by the first row that has a value, the collected cells grow; ``merge``: the same with
    the last value, except in columns that keep their first. ``new_ordinal``: of an appended row, from the columns of ``new``."""
    columns = [c for c in snapshot.columns if c != ordinal]
    slots = resolved(new, snapshot, order, ordinal, key, rename=mode == "replace")
    kind = snapshot.schema[ordinal].dataType
    rows = new.withColumn("_own", new_ordinal.cast(kind)).join(slots, order)
    rows = rows.select(*columns, F.lit(1).alias("_new"), F.col(order).cast("long").alias("_t"), "_own", "slot")
    own_slot = F.struct(F.lit(0).alias("appended"), F.col(ordinal).alias("known"), F.lit(None).cast("long").alias("founder"))
    known = snapshot.select(*columns, F.lit(0).alias("_new"), F.lit(-1).cast("long").alias("_t"), F.col(ordinal).alias("_own"), own_slot.alias("slot"))
    every = known.unionByName(rows)
    o = F.col("_t")

    def cell(c: str) -> Column:
        if mode == "replace":
            return F.max_by(c, o).alias(c)
        if c == key:
            return F.min_by(c, o).alias(c)
        if c in V.AGGREGATED or c in V.OLD_APPENDED:
            parts = F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), F.split(text(F.col(c)), "；").alias("v")))), lambda x: x["v"])
            return ordered_set(F.flatten(parts)).alias(c)
        pick = F.min_by if mode == "fill" or c in V.KEEP_FIRST else F.max_by
        return F.coalesce(pick(present(F.col(c)), F.when(~is_missing(F.col(c)), o)), F.lit(V.DEFAULT)).alias(c)

    return every.groupBy("slot").agg(*(cell(c) for c in columns), F.min_by("_own", o).alias(ordinal)).select(*snapshot.columns)
