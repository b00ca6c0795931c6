"""Landed data: CSV and JSON tables, PDFs with their extracted text, and the schemas of page tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from noticeloom.functions import vocabulary as V
from noticeloom.functions.text import has_any, is_missing, present
from noticeloom.functions.values import cache_key, is_pdf, publish_cell
from noticeloom.sources.pdf import pdf_text

LIST_PAGES = "url string, channel string, page int, html string, fetched_at timestamp"
DETAIL_PAGES = "url string, html string, fetched_at timestamp"


def strings(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_projects(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A project table from CSV: all text, columns by their header's names, missing ones added, missing values as null, the cell of dates cleaned,
    the older table's qualification purged of page footers."""
    columns = columns or V.PROJECT_COLUMNS
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    cell = lambda c: present(F.col(f"`{c}`")) if c in raw.columns else F.lit(None).cast("string")
    fixed = {"发布网站": lambda c: F.coalesce(c, F.lit(V.SITE_NAME)), "发布日期": lambda c: present(publish_cell(c)), "投标人资格要求": lambda c: F.when(~has_any(c, V.BAD_QUALIFICATION), c)}
    return raw.select(*(fixed.get(c, lambda x: x)(cell(c)).alias(c) for c in columns))


def read_projects_or_set_aside(spark: SparkSession, path: str, today: str, columns: list[str] | None = None) -> DataFrame:
    """A project table; one that cannot be read, or does not exist, is an empty table. A broken one is renamed to ``path.bad_today`` first,
    so that nothing writes over it."""
    columns = columns or V.PROJECT_COLUMNS
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        # a table of projects names them; a file whose header does not is none
        if "项目名称" in {c.lstrip("\ufeff") for c in spark.read.csv(path, header=True, multiLine=True, escape='"').columns}:
            return read_projects(spark, path, columns)
        fs.rename(p, jvm.org.apache.hadoop.fs.Path(f"{path}.bad_{today}"))
    return spark.createDataFrame([], strings(columns))


def read_section_json(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """The records of a section's JSON file, whose envelope holds them under ``data``."""
    columns = fields or [*V.SECTION_FIELDS, *V.SECTION_EXTRA]
    schema = StructType([StructField("metadata", strings(["source", "section", "crawl_time", "total_count"]))]).add("data", ArrayType(strings(columns)))
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("data").alias("r")).select("r.*")


def read_json_list(spark: SparkSession, path: str, fields: list[str], lines: bool = False) -> DataFrame:
    """Files that hold a JSON array each; with ``lines``, one object a line, as this library writes them."""
    return spark.read.schema(strings(fields)).json(path, multiLine=not lines)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the PDFs among the files of a folder, told by their first bytes."""
    return spark.read.format("binaryFile").load(path).where(is_pdf(F.col("content"))).select("path", "content")


def file_texts(files: DataFrame, *extractors: Callable[[bytes], str]) -> DataFrame:
    """``text`` of each file: the first extractor that gives one; one that fails counts as giving none."""

    def run(batches):
        for b in batches:
            texts = []
            for content in b["content"]:
                got = ""
                for f in extractors:
                    try:
                        got = f(bytes(content)) or ""
                    except Exception:  # noqa: BLE001  broken files are what the chain is for
                        got = ""
                    if got.strip():
                        break
                texts.append(got)
            yield pd.DataFrame({"path": b["path"], "text": texts})

    return files.mapInPandas(run, "path string, text string")


def pdf_texts(spark: SparkSession, path: str, *others: Callable[[bytes], str]) -> DataFrame:
    """(path, text) of the PDFs of a folder: what the library's own reader finds, else what ``others`` do (recognition of pictures, say)."""
    return file_texts(read_files(spark, path), pdf_text, *others)


def cached_texts(pages: DataFrame, cache: DataFrame, url: str = "file_url") -> DataFrame:
    """Pages with what the cache (key, text) holds for their file."""
    return pages.withColumn("key", cache_key(F.col(url))).join(cache, "key", "left")


def usable(projects: DataFrame) -> DataFrame:
    return projects.where(~is_missing(F.col("项目名称")))
