"""Results out: CSV, JSON and text, snapshots that change in one step, and append-only tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import rendered, text


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``); a temporary one only in local mode."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them can read")
        conf = tempfile.mkdtemp(prefix="noticeloom-")
    return f"{conf.rstrip('/')}/noticeloom/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder that all executors share, read back: what is computed from it survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a landed table that nothing reads any more."""
    path, fs = _fs(df.sparkSession, df._landed)
    fs.delete(path, True)


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, default: str = "") -> None:
    """The columns in order, extra ones left out, missing values as ``default``; a byte order mark before the first header."""
    columns = columns or rows.columns
    cell = lambda c: (rendered(F.col(f"`{c}`"), default) if default else text(F.col(f"`{c}`"))) if c in rows.columns else F.lit(default)
    out = rows.select(*(cell(c).alias(("﻿" if i == 0 else "") + c) for i, c in enumerate(columns)))
    out.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_json(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    (rows.select(*columns) if columns else rows).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_counted(rows: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Write ``rows`` by ``write`` and count on the way: each of ``counts`` is an aggregate over what is written, seen as it passes; no second job."""
    seen = Observation(f"counts-{uuid.uuid4().hex}")
    write(rows.observe(seen, *(c.alias(k) for k, c in counts.items())))
    return seen.get


def write_envelope(rows: DataFrame, path: str, section: str, now: Column, days: int, fields: list[str]) -> dict[str, int]:
    """A section's records, one JSON object a line and as CSV with the section's columns (none without records), and beside them the
    metadata of the envelope: at scale the records stay distributed. Returns the records written and how many have each field; both are counted
    while they are written, and the metadata takes them from there."""
    spark = rows.sparkSession
    own = [f for f in fields if f in rows.columns]
    filled = {f"filled_{i}": F.count_if(F.coalesce(text(F.col(f"`{f}`")) != "", F.lit(False))) for i, f in enumerate(own)}
    told = write_counted(rows, lambda r: r.write.mode("overwrite").json(f"{path}/data", ignoreNullFields=False), total=F.count("*"), **filled)
    if told["total"]:
        written = spark.read.schema(rows.schema).json(f"{path}/data")
        write_csv(written, f"{path}/csv", [*fields, *(c for c in V.SECTION_EXTRA if c not in fields and c in rows.columns)])
    meta = spark.range(1).select(F.lit("全国公共资源交易平台（山西省）").alias("source"), F.lit(section).alias("section"), F.lit(told["total"]).cast("long").alias("total_count"), F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("crawl_time"), F.lit(days).alias("days_lookback"), F.array(*map(F.lit, fields)).alias("fields"))
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return {"total": told["total"]} | {f: told[f"filled_{i}"] for i, f in enumerate(own)}


def write_by_kind(rows: DataFrame, path: str, fields: dict[str, list[str]], kind: str = "_subtype_") -> None:
    """JSON and CSV of each kind with its own fields; kinds without rows are written too. The input is computed once, into one folder for
    each kind, and a kind's files are made from its folder alone."""
    every = list(dict.fromkeys(c for columns in fields.values() for c in columns))
    own = rows.where(F.col(kind).isin(list(fields))).select(F.col(kind).alias("_kind"), *((text(F.col(f"`{c}`")) if c in rows.columns else F.lit("")).alias(c) for c in every))
    own.write.mode("overwrite").partitionBy("_kind").parquet(f"{path}/_rows")
    landed = rows.sparkSession.read.schema(own.schema).parquet(f"{path}/_rows")
    for k, columns in fields.items():
        part = landed.where(F.col("_kind") == k).select(*(f"`{c}`" for c in columns))
        write_json(part, f"{path}/{k}/json")
        write_csv(part, f"{path}/{k}/csv")


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Conflict(Exception):
    """Another writer has committed the version that was to be written."""


def _commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    folder, fs = _fs(spark, f"{root}/_commits")
    if not fs.exists(folder):
        return []
    return sorted(int(n) for n in (f.getPath().getName() for f in fs.listStatus(folder)) if n.isdigit())


def _manifest(spark: SparkSession, root: str, number: int) -> list[str]:
    """What a version consists of, one line each."""
    path, fs = _fs(spark, f"{root}/_commits/{number:012d}")
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, number: int, lines: list[str]) -> None:
    """Make version ``number`` of ``lines``, or raise ``Conflict`` if there is one. The manifest is written aside and then given the number's
    name in one step that never overwrites, so readers see no half of it: a rename, on a local disk a link, as its renames look first and move then."""
    mark, fs = _fs(spark, f"{root}/_commits/{number:012d}")
    aside, _ = _fs(spark, f"{root}/_aside/{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    fs.mkdirs(mark.getParent())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(mark), local(aside))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(aside, mark, none)
    except Exception as e:  # noqa: BLE001
        if "FileAlreadyExistsException" not in str(e):
            raise
        raise Conflict(f"version {number} of {root}") from None
    finally:
        fs.delete(aside, False)


def write_snapshot(rows: DataFrame, root: str, tries: int = 20) -> int:
    """A new version beside the others: readers see the old table or the new one, nothing is deleted or overwritten on the way, and a
    write that breaks off before the commit leaves the old table. Of two writers one commits a number and the other the next, so every
    table that was written is a version of its own."""
    spark = rows.sparkSession
    part = f"v-{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/{part}")
    for _ in range(tries):
        number = max(_commits(spark, root), default=0) + 1
        try:
            _commit(spark, root, number, [part])
        except Conflict:
            continue
        return number
    raise Conflict(f"{root}: {tries} tries")


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The newest committed version, or the one asked for; none before the first."""
    numbers = _commits(spark, root)
    if not numbers:
        return None
    return spark.read.parquet(*(f"{root}/{part}" for part in _manifest(spark, root, version or numbers[-1])))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An append-only table whose files may lack columns that were added later."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.select(*((F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in columns))
