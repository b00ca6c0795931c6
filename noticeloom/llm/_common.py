"""What the operators share: tables in the shared folder, sizes, and Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a Python worker is handed at once are cut into pieces of about this many bytes of text.
BATCH_BYTES = 8 << 20


#: Tables whose rows cost far more to work on than to deal out.
COSTLY = ("documents",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. One of long texts that comes in fewer pieces than there are cores (a file of one row group is one) is dealt to all
    of them; with enough pieces, as at any size that matters, it is read as it is."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in COSTLY and df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only in local mode where it is unset (tests)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        sc = spark.sparkContext
        conf = sc.getCheckpointDir()
        if not conf:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them can read")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="noticeloom-"))
            conf = sc.getCheckpointDir()
    return conf.rstrip("/")


#: Tables that operators now running have written, by the run's number; a thread's own run is a local property of its Spark context.
_WRITTEN: dict[str, list[str]] = {}
_RUN = "noticeloom.run"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/noticeloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.get(df.sparkSession.sparkContext.getLocalProperty(_RUN) or "", []).append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._noticeloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialised table that nothing lazy reads any more."""
    _delete(df.sparkSession, df._noticeloom_path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that leaves one table behind, its result: that is written down, and all other tables it has written are deleted,
    those of operators that it calls too. ``discard`` deletes the result when it has been used."""

    @functools.wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        spark = SparkSession.active()
        outer, own = spark.sparkContext.getLocalProperty(_RUN), uuid.uuid4().hex
        _WRITTEN[own] = []
        spark.sparkContext.setLocalProperty(_RUN, own)
        try:
            kept = materialise(operator(*args, **kwargs), operator.__name__)
            _WRITTEN[own].remove(kept._noticeloom_path)
        finally:
            spark.sparkContext.setLocalProperty(_RUN, outer)
            for path in _WRITTEN.pop(own):
                _delete(spark, path)
        _WRITTEN.get(outer or "", []).append(kept._noticeloom_path)
        return kept

    return run


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the plan's size, from file sizes; no job runs."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 60 else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of the contracts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(batch: pa.RecordBatch, at: str | int = "text") -> Iterator[bytes | None]:
    """The UTF-8 bytes of each row's text, one at a time; ``at``: the column's name, or its place."""
    col = batch.column(at if isinstance(at, int) else batch.schema.get_field_index(at))
    col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return (x.as_py() for x in col)


_given_back = 0.0


def give_back() -> None:
    """Memory that Arrow and the allocator hold without using it, back to the system: a Python worker is kept for the tasks of later stages, and its
    executor is charged for what it holds until then."""
    global _given_back
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than glibc
    _given_back = time.monotonic()


def _behind(size: int) -> None:
    # a function of the module, not of the closure that is sent: the time is the worker's own
    if size > 256 << 10 or time.monotonic() - _given_back > 1:
        give_back()


def lean(f: Callable) -> Callable:
    """``f``, for mapInArrow, giving memory back when its task ends."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def lean_groups(f: Callable) -> Callable:
    """``f``, for applyInArrow, giving memory back behind a large group, and once a second."""

    @functools.wraps(f)
    def run(t: pa.Table) -> pa.Table:
        out = f(t)
        _behind(t.nbytes)
        return out

    return run


def map_rows(df: DataFrame, schema: str, row: Callable, keep: tuple[str, ...] = ("doc_id",), text: str = "text", setup: Callable | None = None) -> DataFrame:
    """One row out for each row in: ``keep`` columns as they are, then what ``row(bytes or None)`` returns.

    ``setup()`` runs once in a task and its result is passed to ``row`` as second argument. Text goes to Python as
    Arrow batches and rows come back in batches of bounded size, so a task holds one batch, not its partition.
    """
    from pyspark.sql.types import StructType

    own = StructType.fromDDL(schema)
    names = [f.name for f in own.fields]
    out_type = StructType([df.schema[k] for k in keep] + own.fields)
    n_keep = len(keep)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_type)
        state = (setup(),) if setup else ()
        for batch in batches:
            kept = [batch.column(i) for i in range(n_keep)]
            at, held, size = 0, [], 0

            def flush(end):
                cols = list(zip(*held, strict=True)) if held else [[] for _ in names]
                return pa.RecordBatch.from_arrays([k.slice(at, end - at).cast(arrow.field(i).type) for i, k in enumerate(kept)] + [pa.array(c, type=arrow.field(n_keep + i).type) for i, c in enumerate(cols)], schema=arrow)

            for i, raw in enumerate(text_column(batch, n_keep)):
                held.append(row(raw, *state))
                size += len(raw or b"")
                if size > BATCH_BYTES:
                    yield flush(i + 1)
                    at, held, size = i + 1, [], 0
            if held:
                yield flush(batch.num_rows)

    # columns go by place, so none of the kept ones can clash with the text
    return df.select(*(quoted(k).alias(f"_{i}") for i, k in enumerate(keep)), quoted(text).alias("_text")).mapInArrow(lean(run), out_type)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column) -> Column:
    """What texts are told apart by: 128 bits of a digest; null texts have one of their own."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit(b"t"), text.cast("binary")), F.lit(b""))))


def without(docs: DataFrame, rows: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose doc_id and text are those of ``rows`` (doc_id, text_key): broadcast where they have been
    counted and are few, else shuffled. Another text under the same id stays."""
    gone = materialise(rows.select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_key")).distinct(), "gone")
    own = unused(docs, "_key")
    keyed = docs.withColumn(own, text_key(F.col("text")))
    same = keyed["doc_id"].eqNullSafe(F.col("_gone")) & (keyed[own] == F.col("_gone_key"))
    return keyed.join(F.broadcast(gone) if gone.count() <= broadcast_rows else gone, same, "left_anti").select(*(quoted(c) for c in docs.columns))


def crc32_sql(column: str) -> str:
    """DuckDB SQL for crc32 of a column's value as text, unsigned, bit by bit: the polynomial is the standard's, reversed."""
    bit = "CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END"
    byte = f"list_reduce(list_concat([xor(c, b)], range(8)), lambda y, i: {bit})"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({column}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {byte}), 4294967295)"
