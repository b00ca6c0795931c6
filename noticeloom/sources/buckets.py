"""A versioned table in buckets by the hash of its key: a batch rewrites the buckets that it touches, and no others.

Every version is a manifest: the table's number of buckets, its schema, and the folder that holds each bucket's rows. A batch reads the
buckets of its keys, merges, writes these buckets anew into one folder, and commits a manifest that names it for them and leaves the other lines
as they are. The commit is a file named by the version's number, put there if it is absent. A writer that finds its number taken looks what
the others have changed since: where they wrote none of its buckets only the manifest is made anew, else the merge is.

Old versions stay readable until ``vacuum`` deletes the folders that none of the newest versions names. Null keys are a bucket's rows like others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeloom.sources.writers import Conflict, _commit, _commits, _fs, _manifest

BUCKETS = 256


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(n)).cast("int")


def _version(spark: SparkSession, root: str, number: int) -> tuple[dict, dict[int, str]]:
    head, *lines = _manifest(spark, root, number)
    return json.loads(head), {int(k): v for k, v in (x.split(" ", 1) for x in lines if x)}


def _lines(head: dict, parts: dict[int, str]) -> list[str]:
    return [json.dumps(head), *(f"{k} {parts[k]}" for k in sorted(parts))]


def _rows(spark: SparkSession, root: str, head: dict, parts: dict[int, str], wanted: list[int] | None = None) -> DataFrame:
    """The rows of some buckets; a folder holds each of its buckets as a folder of its own, so no other file is opened."""
    schema = StructType.fromJson(head["schema"])
    paths = [f"{root}/{folder}/_bucket={k}" for k, folder in parts.items() if wanted is None or k in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The newest version, or the one asked for; none before the first."""
    numbers = _commits(spark, root)
    return _rows(spark, root, *_version(spark, root, version or numbers[-1])) if numbers else None


def merge_batch(batch: DataFrame, root: str, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], n: int = BUCKETS, tries: int = 20) -> dict:
    """Merge a batch into the table: ``merge(old, batch)`` gets the rows of the touched buckets and the batch, and returns these buckets' new rows.

    ``merge`` must not move a row to another key's bucket. Returns the version, the buckets rewritten and the tries that it took. The first batch makes
    the table, with ``n`` buckets and its schema; later ones keep to both.
    """
    spark = batch.sparkSession
    for attempt in range(1, tries + 1):
        numbers = _commits(spark, root)
        base = numbers[-1] if numbers else 0
        head, parts = _version(spark, root, base) if base else ({"buckets": n, "schema": batch.schema.jsonValue()}, {})
        count = head["buckets"]
        # at most as many numbers as the table has buckets
        touched = sorted(r.b for r in batch.select(bucket_of(key, count).alias("b")).distinct().collect())
        new = merge(_rows(spark, root, head, parts, touched), batch)
        new = new.select(*(f"`{c}`" for c in StructType.fromJson(head["schema"]).fieldNames()))
        folder = f"p-{uuid.uuid4().hex}"
        new.withColumn("_bucket", bucket_of(key, count)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}")
        path, fs = _fs(spark, f"{root}/{folder}")
        written = {int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path) if f.getPath().getName().startswith("_bucket=")}
        if not written <= set(touched):
            raise ValueError(f"rows of buckets {sorted(written - set(touched))[:5]} came out of a merge of others")
        at = base
        while True:
            mine = {k: v for k, v in parts.items() if k not in touched} | {k: folder for k in written}
            try:
                _commit(spark, root, at + 1, _lines(head, mine))
                return {"version": at + 1, "rewritten": len(touched), "tries": attempt}
            except Conflict:
                at = _commits(spark, root)[-1]
                other_head, other = _version(spark, root, at)
                if other_head["buckets"] != count or any(parts.get(k) != other.get(k) for k in touched):
                    break  # somebody has written what was read here: merge again
                head, parts = other_head, other
    raise Conflict(f"{root}: {tries} tries")


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the folders that none of the ``keep`` newest versions names, and the older manifests; how many folders. Not while a writer is at work."""
    numbers = _commits(spark, root)
    used = {v for n in numbers[-keep:] for v in _version(spark, root, n)[1].values()}
    path, fs = _fs(spark, root)
    gone = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("p-") and f.getPath().getName() not in used]
    for p in gone:
        fs.delete(p, True)
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{root}/_commits/{n:012d}")[0], False)
    return len(gone)
