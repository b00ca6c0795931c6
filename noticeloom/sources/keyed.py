"""An append-only table that knows without being read which of its files may hold a key.

Every batch is a folder: data files, each of one bucket of keys by hash, and beside them a Bloom filter for each file, as rows (file, bucket,
word, bits) of 64 bits. Looking a batch's keys up is a join of their bits with the filters of their buckets; a key whose bits are all set in a file's
filter may be there, and only such files are opened, for such keys. So the result is exact, and what is read follows the batch, not the
table: filters are some ten bits a key, and no other file is touched.

Versions are manifests of folders, committed by number; a writer that finds its number taken looks the keys up again, so two writers never store one key twice,
and a batch that is run again finds its rows there. Null keys are not stored; of equal keys in a batch the first in order is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.relations import first_k
from noticeloom.sources.writers import Conflict, _commit, _commits, _manifest

#: Buckets of keys, bits of a filter for each key, hashes for each key, most rows of a data file.
BUCKETS, BITS, HASHES, FILE_ROWS = 16, 10, 7, 1_000_000


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(n)).cast("int")


def _bits(df: DataFrame, key: str, size: Column, keep: list[str]) -> DataFrame:
    """A row for each hash of a key: word, and the bit in it. ``size``: words of the filter."""
    places = df.select(*keep, size.alias("_size"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.xxhash64(F.col(key), i))).alias("_h"))
    placed = places.withColumn("_place", F.pmod(F.col("_h"), F.col("_size") * 64))
    return placed.select(*keep, F.floor(F.col("_place") / 64).alias("word"), F.expr("shiftleft(1L, CAST(_place % 64 AS INT))").alias("bit"))


def _filters(data: DataFrame, key: str) -> DataFrame:
    """file, bucket, size, word, bits of the files of ``data``; words without a bit have no row. Bits are put together in the map tasks."""
    rows = data.select(F.col(key), F.col("_bucket").alias("bucket"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
    sizes = rows.groupBy("file", "bucket").agg(F.ceil(F.count("*") * BITS / 64).alias("size"))
    bits = _bits(rows.join(sizes, ["file", "bucket"]), key, F.col("size"), ["file", "bucket", "size"])
    return bits.groupBy("file", "bucket", "size", "word").agg(F.expr("bit_or(bit)").alias("bits"))


def read_keyed(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of the newest version; none before the first."""
    numbers = _commits(spark, root)
    return spark.read.parquet(*(f"{root}/{part}/data/_bucket=*" for part in _manifest(spark, root, numbers[-1]))) if numbers else None


def may_hold(keys: DataFrame, root: str, parts: list[str], key: str) -> DataFrame:
    """key, path: the files that may hold each of ``keys`` (distinct, column ``key``)."""
    spark = keys.sparkSession
    filters = None
    for part in parts:
        own = spark.read.parquet(f"{root}/{part}/filters").withColumn("path", F.concat(F.lit(f"{root}/{part}/data/_bucket="), F.col("bucket"), F.lit("/"), F.col("file")))
        filters = own if filters is None else filters.unionByName(own)
    files = filters.select("bucket", "path", "size").distinct()
    # filters differ in size: a key has its bits for each size that its bucket knows
    sizes = files.select("bucket", "size").distinct()
    asked = _bits(keys.withColumn("bucket", _bucket(F.col(key), BUCKETS)).join(sizes, "bucket"), key, F.col("size"), [key, "bucket", "size"]).distinct()
    need = asked.groupBy(key, "bucket", "size").agg(F.count("*").alias("need"))
    hit = asked.join(filters, ["bucket", "size", "word"]).where(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy(key, "bucket", "size", "path").agg(F.count("*").alias("got"))
    return hit.join(need, [key, "bucket", "size"]).where("got = need").select(key, "path")


def insert_once(batch: DataFrame, root: str, order: list[str], key: str = "url", tries: int = 20) -> dict:
    """Store the rows whose key the table does not have. Returns the version, rows inserted, files that there were and files that were opened,
    and the lookups that found nothing in a file (``false``) among those that there were (``lookups``)."""
    spark = batch.sparkSession
    fresh = first_k(batch.where(F.col(key).isNotNull()), [key], order, 1)
    for _ in range(tries):
        numbers = _commits(spark, root)
        number = numbers[-1] if numbers else 0
        parts = _manifest(spark, root, number) if number else []
        told = {"version": number, "inserted": 0, "files": 0, "opened": 0, "lookups": 0, "false": 0}
        new = fresh
        if parts:
            pairs = may_hold(fresh.select(key), root, parts, key).persist()
            paths = [r.path for r in pairs.select("path").distinct().collect()]  # names of files that are opened anyway
            told["files"] = len(spark.read.parquet(*(f"{root}/{p}/data/_bucket=*" for p in parts)).inputFiles())
            told["opened"] = len(paths)
            if paths:
                there = spark.read.parquet(*paths).select(key, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("_file"))
                known = there.join(pairs.select(key, F.element_at(F.split("path", "/"), -1).alias("_file")), [key, "_file"]).select(key).distinct().persist()
                told["lookups"] = pairs.count()
                told["false"] = told["lookups"] - known.count()
                new = fresh.join(known, key, "left_anti")
        folder = f"b-{uuid.uuid4().hex}"
        rows = new.withColumn("_bucket", _bucket(F.col(key), BUCKETS))
        rows.repartition("_bucket").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("_bucket").parquet(f"{root}/{folder}/data")
        if parts:
            pairs.unpersist()
        data = spark.read.schema(rows.schema).parquet(f"{root}/{folder}/data")
        told["inserted"] = data.count()
        if not told["inserted"]:
            return told
        _filters(data, key).write.parquet(f"{root}/{folder}/filters")
        try:
            _commit(spark, root, number + 1, [*parts, folder])
        except Conflict:
            continue
        return told | {"version": number + 1}
    raise Conflict(f"{root}: {tries} tries")
