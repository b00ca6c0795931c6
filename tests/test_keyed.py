"""Inserts that happen once, by files' Bloom filters."""

import threading

from pyspark.sql import functions as F

from noticeloom.sources import keyed, writers


def urls(spark, a, b, note="x"):
    return spark.range(a, b).select(F.concat(F.lit("http://h/"), "id").alias("url"), F.col("id").alias("n"), F.lit(note).alias("note"))


def test_only_files_that_may_hold_a_key_are_opened(spark):
    root = writers.scratch(spark, "keyed")
    for k in range(4):
        told = keyed.insert_once(urls(spark, 1000 * k, 1000 * k + 1000, str(k)), root, ["n"])
        assert told["inserted"] == 1000 and told["version"] == k + 1
    got = keyed.insert_once(urls(spark, 2500, 2503, "again").unionByName(urls(spark, 9000, 9002, "new")).unionByName(urls(spark, 9000, 9001, "twice").withColumn("n", F.lit(99999))), root, ["n"])
    assert got["inserted"] == 2 and got["files"] == 64 and 3 >= got["opened"] - got["false"] >= 1 and got["opened"] <= 8
    rows = {r.url: r.note for r in keyed.read_keyed(spark, root).collect()}
    assert len(rows) == 4002 and rows["http://h/2501"] == "2" and rows["http://h/9000"] == "new"
    again = keyed.insert_once(urls(spark, 0, 4000, "again"), root, ["n"])
    assert again["inserted"] == 0 and again["version"] == 5 and again["lookups"] - again["false"] == 4000
    # what the filters promise: about one lookup of a hundred in vain for each file of a bucket
    assert again["false"] <= 0.02 * 4000 * 5


def test_a_batch_that_is_run_again_and_odd_keys(spark):
    root = writers.scratch(spark, "keyed")
    batch = spark.createDataFrame([(None, 1), ("", 2), ("a", 4), ("a", 3), ("é" * 5000, 5)], "url string, n int")
    assert keyed.insert_once(batch, root, ["n"])["inserted"] == 3 and keyed.insert_once(batch, root, ["n"])["inserted"] == 0
    assert sorted(r.n for r in keyed.read_keyed(spark, root).collect()) == [2, 3, 5]
    assert keyed.insert_once(batch.limit(0), root, ["n"])["inserted"] == 0
    empty = writers.scratch(spark, "keyed")
    assert keyed.insert_once(batch.limit(0), empty, ["n"])["version"] == 0 and keyed.read_keyed(spark, empty) is None


def test_two_writers_store_a_key_once(spark):
    root = writers.scratch(spark, "keyed")
    keyed.insert_once(urls(spark, 0, 10), root, ["n"])
    errors = []

    def writer(a, b, note):
        try:
            keyed.insert_once(urls(spark, a, b, note), root, ["n"])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    jobs = [threading.Thread(target=writer, args=x) for x in ((5, 40, "p"), (20, 60, "q"))]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    rows = keyed.read_keyed(spark, root)
    assert not errors and rows.count() == 60 == rows.select("url").distinct().count()
