"""Versioned tables: writers that meet, batches that touch few buckets."""

import threading

from pyspark.sql import functions as F

from noticeloom.sources import buckets, writers


def newest_wins(old, batch):
    return batch.unionByName(old.join(batch.select("k"), "k", "left_anti"))


def at_once(*jobs):
    errors = []

    def run(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors


def test_two_writers_both_leave_a_version(spark):
    root = writers.scratch(spark, "race")
    writers.write_snapshot(spark.range(1), root)
    seen, commit = threading.Barrier(2, timeout=60), writers._commits

    def together(*a):
        numbers = commit(*a)
        if numbers == [1]:
            seen.wait()  # both have read the same last number
        return numbers

    writers._commits = together
    try:
        at_once(lambda: writers.write_snapshot(spark.range(10, 20), root), lambda: writers.write_snapshot(spark.range(30, 50), root))
    finally:
        writers._commits = commit
    assert writers._commits(spark, root) == [1, 2, 3]
    assert sorted(writers.read_snapshot(spark, root, v).count() for v in (2, 3)) == [10, 20]
    assert writers.read_snapshot(spark, root).count() == writers.read_snapshot(spark, root, 3).count()


def test_a_number_is_committed_once(spark):
    root = writers.scratch(spark, "once")
    writers._commit(spark, root, 1, ["a", "b"])
    try:
        writers._commit(spark, root, 1, ["c"])
        raise AssertionError("the second commit was let through")
    except writers.Conflict:
        pass
    winners = []

    def commit(name):
        try:
            writers._commit(spark, root, 2, [name])
            winners.append(name)
        except writers.Conflict:
            pass

    at_once(*(lambda n=n: commit(f"w{n}") for n in range(16)))
    assert len(winners) == 1 and writers._manifest(spark, root, 2) == winners
    assert writers._manifest(spark, root, 1) == ["a", "b"] and writers.read_snapshot(spark, writers.scratch(spark, "none")) is None


def rows(spark, *kv):
    return spark.createDataFrame(list(kv), "k string, v int")


def table(spark, root, version=None):
    return {r.k: r.v for r in buckets.read_buckets(spark, root, version).collect()}


def test_batches_rewrite_what_they_touch(spark):
    root = writers.scratch(spark, "buckets")
    first = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    assert buckets.merge_batch(first, root, "k", newest_wins, n=64)["rewritten"] == 64
    size = lambda d: sum(f.stat().st_size for f in d.rglob("*.parquet"))
    from pathlib import Path

    here = Path(root.removeprefix("file:"))
    (whole,) = here.glob("p-*")
    got = buckets.merge_batch(rows(spark, ("7", 2), ("new", 3), (None, 4)), root, "k", newest_wins)
    assert got["version"] == 2 and got["rewritten"] <= 3 and got["tries"] == 1
    (part,) = set(here.glob("p-*")) - {whole}
    assert size(part) < 0.1 * size(whole)
    now = table(spark, root)
    assert len(now) == 5002 and (now["7"], now["new"], now[None], now["8"]) == (2, 3, 4, 1) and len(table(spark, root, 1)) == 5000
    assert buckets.vacuum(spark, root) == 0 and len(table(spark, root)) == 5002


def test_writers_of_the_same_and_of_other_buckets(spark):
    root = writers.scratch(spark, "buckets")
    add = lambda old, batch: old.unionByName(batch).groupBy("k").agg(F.sum("v").cast("int").alias("v"))
    buckets.merge_batch(rows(spark, ("a", 1), ("b", 1)), root, "k", add, n=512)
    ready = threading.Barrier(3, timeout=60)

    def writer(*kv):
        first = [True]

        def merge(old, batch):
            if first and first.pop():
                ready.wait()  # all have read version 1
            return add(old, batch)

        return lambda: buckets.merge_batch(rows(spark, *kv), root, "k", merge)

    at_once(writer(("a", 10)), writer(("a", 100)), writer(("b", 5), ("c", 5)))
    assert table(spark, root) == {"a": 111, "b": 6, "c": 5}


def test_a_bucket_can_become_empty_and_moved_rows_are_refused(spark):
    root = writers.scratch(spark, "buckets")
    buckets.merge_batch(rows(spark, ("a", 1), ("b", 1)), root, "k", newest_wins, n=512)
    buckets.merge_batch(rows(spark, ("a", 0)), root, "k", lambda old, batch: old.where("false"))
    assert table(spark, root) == {"b": 1} and buckets.vacuum(spark, root) == 1 and table(spark, root) == {"b": 1}
    try:
        buckets.merge_batch(rows(spark, ("a", 0)), root, "k", lambda old, batch: batch.withColumn("k", F.lit("zzz")))
        raise AssertionError("a moved row was let through")
    except ValueError:
        pass
    assert buckets.merge_batch(rows(spark).limit(0), root, "k", newest_wins)["rewritten"] == 0 and table(spark, root) == {"b": 1}
