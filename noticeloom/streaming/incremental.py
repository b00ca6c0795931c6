"""Incremental loads with Structured Streaming. The batch operators do the work; a stream only says which landed files are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.projects import aligned, project_rows, upsert
from noticeloom.operators.relations import insert_if_absent
from noticeloom.sources.readers import LIST_PAGES
from noticeloom.sources.writers import append, read_snapshot, write_snapshot


def landed(spark: SparkSession, path: str, schema: str = LIST_PAGES, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).load(path)


def once_by_url(rows: DataFrame, watermark: str = "7 days", at: str = "fetched_at") -> DataFrame:
    """Each address once within the watermark; the state forgets older ones."""
    return rows.withWatermark(at, watermark).dropDuplicatesWithinWatermark(["url"])


def store_announcements(rows: DataFrame, table: str, checkpoint: str, order: list[str]):
    """Every batch inserts what the table does not have yet. A batch that is run again finds its rows there, so nothing is stored twice."""

    def one(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(table).select("url")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            known = batch.select("url").limit(0)
        append(insert_if_absent(known, batch, order), table)

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain_projects(history: DataFrame, root: str, checkpoint: str, mode: str = "replace"):
    """Every batch of notices becomes project rows, aligned with the snapshot's names and merged into its next version. ``_ordinal``, the
    batch in which a project came and its name, is stored with it: the order in which names are tried does not change afterwards."""

    def one(batch: DataFrame, number: int) -> None:
        new, old = project_rows(batch), read_snapshot(batch.sparkSession, root)
        ordinal = F.concat_ws("|", F.lit(f"{number:012d}"), "项目名称")
        if old is None:
            write_snapshot(new.withColumn("_ordinal", ordinal), root)
            return
        known = old.select(F.col("项目名称").alias("_name"), "_ordinal")
        merged = upsert(old.drop("_ordinal"), aligned(new, old, "_ordinal"), mode)
        write_snapshot(merged.join(known, merged["项目名称"] == known["_name"], "left").select(*merged.columns, F.coalesce("_ordinal", ordinal).alias("_ordinal")), root)

    return history.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
