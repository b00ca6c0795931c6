"""Keyword search that opens what it needs: an index of pairs of characters over announcements' titles.

Every insert adds a folder: its rows in files of bounded size, and for each pair of neighbouring characters of a title (small letters) the files that
have it, in buckets by the pair. A search takes the pairs of the keyword's literal parts (``%`` and ``_`` are wildcards), reads the buckets of these pairs
alone, keeps the files that have all of them, opens these, and lets the LIKE rule decide.
Pairs and not triples: a keyword of two characters is the usual one in Chinese. A keyword without a pair of its own is looked for in all rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions.text import text
from noticeloom.operators.relations import find_announcements
from noticeloom.sources.writers import Conflict, _commit, _commits, _manifest

GRAM, BUCKETS, FILE_ROWS = 2, 64, 100_000


def grams(title: Column) -> Column:
    """The distinct pairs of characters of a title in small letters."""
    t = F.lower(text(title))
    return F.when(F.length(t) >= GRAM, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - (GRAM - 1)), lambda i: F.substring(t, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def keyword_grams(keyword: str) -> list[str]:
    """The pairs that every title with the keyword has; a backslash takes the sign behind it literally."""
    parts, part = [], ""
    for m in re.finditer(r"\\(.)|([%_])|(.)", keyword.lower(), re.S):
        if m[2]:
            parts.append(part)
            part = ""
        else:
            part += m[1] or m[3]
    return sorted({p[i : i + GRAM] for p in [*parts, part] for i in range(len(p) - GRAM + 1)})


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def insert_indexed(rows: DataFrame, root: str, title: str = "title", tries: int = 20) -> int:
    """Add announcements to the table and its index; the version."""
    spark = rows.sparkSession
    folder = f"i-{uuid.uuid4().hex}"
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{root}/{folder}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{root}/{folder}/rows")
    own = written.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.explode(grams(F.col(title))).alias("gram"))
    # a file's rows with a pair are one number: what is looked up are files, the rule decides on rows
    postings = own.groupBy("gram", "file").agg(F.count("*").alias("n")).withColumn("_bucket", _bucket(F.col("gram")))
    postings.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}/grams")
    for _ in range(tries):
        numbers = _commits(spark, root)
        try:
            _commit(spark, root, (numbers[-1] if numbers else 0) + 1, [*(_manifest(spark, root, numbers[-1]) if numbers else []), folder])
        except Conflict:
            continue
        return len(numbers) + 1
    raise Conflict(f"{root}: {tries} tries")


def candidate_files(spark: SparkSession, root: str, keyword: str) -> list[str] | None:
    """Paths of the files in which every pair of the keyword occurs; None where it has no pair."""
    wanted = keyword_grams(keyword)
    numbers = _commits(spark, root)
    if not wanted or not numbers:
        return None
    buckets = [r.b for r in spark.createDataFrame([(g,) for g in wanted], "g string").select(_bucket(F.col("g")).alias("b")).distinct().collect()]
    out: list[str] = []
    for folder in _manifest(spark, root, numbers[-1]):
        base = f"{root}/{folder}"
        there = spark.read.option("basePath", f"{base}/grams").schema("gram string, file string, n long, _bucket int").parquet(f"{base}/grams").where(F.col("_bucket").isin(buckets) & F.col("gram").isin(wanted))
        full = there.groupBy("file").agg(F.count("*").alias("k")).where(F.col("k") == len(wanted))
        out += [f"{base}/rows/{r.file}" for r in full.select("file").collect()]  # names of the files that are opened
    return out


def search(spark: SparkSession, root: str, keyword: str = "", category: str = "", ann_type: str = "", limit: int = 20) -> DataFrame:
    """What ``relations.find_announcements`` finds over the whole table, from the files that can hold it."""
    numbers = _commits(spark, root)
    folders = [f"{root}/{f}/rows" for f in _manifest(spark, root, numbers[-1])]
    files = candidate_files(spark, root, keyword)
    schema = spark.read.parquet(folders[0]).schema
    paths = folders if files is None else files
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return find_announcements(rows, keyword, category, ann_type, limit)
