"""Sections' JSON files, read by many tasks a file.

A file is one object that holds its records, flat objects, in the array ``data``. Spark's text reader cuts it behind every closing brace and deals
the fragments by ranges of the file's bytes. A fragment alone does not tell whether it lies inside a text, where braces are no braces. So a first pass says for
every range how a reader that comes in outside or inside a text leaves it, and how depth changes; put together from left to right (a
row for each range) that is every range's state, with which a second pass cuts its records out. A record that crosses a border is put
together from its pieces, one or two for each range.

Texts may hold braces, quotes and escapes anywhere. A file that breaks off gives the records before; other keys of the envelope are passed
over, as are elements that are no objects; null fields and fields that a record lacks are null, other values than texts are as JSON
writes them; an empty file and an empty array give nothing. Any path that Spark reads will do; ranges are as large as ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.sources.writers import landed

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]|"', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_ROWS = 5_000


class Reader:
    """What is known behind a fragment: inside a text or not, depth, and whether the array ``data`` of the envelope is open. Without a known
    depth (``depth`` counts from the entry then) ``arrays`` has the depth at which every array named data opened, and the lowest depth since."""

    def __init__(self, inside: bool = False, depth: int = 0, in_data: bool = False):
        self.inside, self.depth, self.in_data, self.low = inside, depth, in_data, depth
        self.arrays: list[list[int]] = []

    def step(self, fragment: str) -> int:
        """The place where a record begins in the fragment, or -1: an object at depth three, in the array data."""
        at, begin, last = 0, -1, ""
        if self.inside:
            m = _REST.match(fragment)
            if m is None:
                return begin
            at, self.inside = m.end(), False
        for m in _TOKEN.finditer(fragment, at):
            c = m[0]
            if c == '"':
                self.inside = True
                break
            if c in "{[":
                if c == "[" and last == '"data"':
                    self.arrays.append([self.depth, self.depth + 1])
                    self.in_data |= self.depth == 1
                self.depth += 1
                if self.depth == 3 and c == "{" and self.in_data:
                    begin = m.start()
            elif c in "}]":
                self.depth -= 1
                self.low = min(self.low, self.depth)
                self.in_data &= self.depth >= 2
                for x in self.arrays:
                    x[1] = min(x[1], self.depth)
            last = c
        return begin


def _ranges(fragments: DataFrame) -> DataFrame:
    """file, start, size, n (bytes), and for a reader that comes in outside and one that comes in inside a text how it leaves."""
    ddl = "file string, start long, size long, n long, " + ", ".join(f"inside_{s} long, depth_{s} long, low_{s} long, arrays_{s} string" for s in (0, 1))
    names = [x.split()[0] for x in ddl.split(", ")]

    def row(key, n, readers):
        return [*key, n, *(v for r in readers for v in (int(r.inside), r.depth, r.low, json.dumps(r.arrays)))]

    def run(batches):
        key, n, readers, done = None, 0, [], []
        for batch in batches:
            for value, *own in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if own != key:
                    if key:
                        done.append(row(key, n, readers))
                    key, n, readers = own, 0, [Reader(), Reader(inside=True)]
                n += len(value.encode()) + 1
                for r in readers:
                    r.step(value + "}")
        if key:
            done.append(row(key, n, readers))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "file" or k.startswith("arrays") else pa.int64()) for k, c in zip(names, zip(*done, strict=True), strict=True)], names=names)

    return fragments.mapInArrow(run, ddl)


def _entered(g: pd.DataFrame) -> pd.DataFrame:
    """Of one file's ranges from left to right: the state at the entry, where an element that is open there began, whether the file breaks off in it."""
    g = g.sort_values("start")
    inside, depth, in_data, opened, out = 0, 0, False, -1, []
    unfinished = g["n"].sum() > g["size"].iloc[0]  # the reader's last fragment has no brace behind it
    for k, r in enumerate(g.itertuples()):
        out.append((r.file, r.start, inside, depth, in_data, opened, bool(unfinished and k == len(g) - 1)))
        low = depth + getattr(r, f"low_{inside}")
        here = [depth + since >= 2 for at, since in json.loads(getattr(r, f"arrays_{inside}")) if depth + at == 1]
        in_data = here[-1] if here else in_data and low >= 2
        inside, depth = getattr(r, f"inside_{inside}"), depth + getattr(r, f"depth_{inside}")
        opened = -1 if depth < 3 else opened if opened >= 0 and low >= 3 else r.start
    return pd.DataFrame(out, columns=["file", "start", "inside", "depth", "in_data", "opened", "cut"])


def _by_range(batches):
    """(key, values) of each range as its rows come; a value with whether it is the range's last."""
    rows = ((value, tuple(key)) for batch in batches for value, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    ahead = next(rows, None)

    def values(key):
        nonlocal ahead
        while ahead is not None and ahead[1] == key:
            value = ahead[0]
            ahead = next(rows, None)
            yield value, ahead is None or ahead[1] != key

    while ahead is not None:
        key = ahead[1]
        yield key, values(key)


def _cells(raw: str, fields: list[str]) -> list[str | None] | None:
    try:
        row = json.loads(raw, strict=False)
    except ValueError:
        return None
    if not isinstance(row, dict):
        return None
    return [v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in map(row.get, fields)]


def read_envelopes(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """The records under ``data`` of envelopes' files, each field as text."""
    text = spark.read.option("lineSep", "}").text(path)
    fragments = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    states = landed(_ranges(fragments).groupBy("file").applyInPandas(_entered, "file string, start long, inside long, depth long, in_data boolean, opened long, cut boolean"), "ranges")
    cells = ", ".join(f"c{i} string" for i in range(len(fields)))
    schema = pa.schema([("file", pa.string()), ("opened", pa.int64()), ("start", pa.int64()), ("piece", pa.string()), *((f"c{i}", pa.string()) for i in range(len(fields)))])

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def cut(batches):
        out: list[list] = []
        r = None
        for (file, start, *entry), values in _by_range(batches):
            *state, opened, breaks_off = entry
            r, held, whole = Reader(*state), [], False
            held_open = r.depth >= 3
            for value, is_last in values:
                raw = value if is_last and breaks_off else value + "}"
                before, begin = r.depth, r.step(raw)
                if before < 3:
                    held_open = whole = begin >= 0
                    held = [raw[begin:]] if whole else []
                elif held_open:
                    held.append(raw)
                if r.depth < 3 and held_open:
                    if not whole:
                        out.append([file, opened, start, "".join(held), *[None] * len(fields)])
                    elif (cells_ := _cells("".join(held), fields)) is not None:
                        out.append([None, None, None, None, *cells_])
                    held, held_open, whole = [], False, False
                if len(out) >= _ROWS:
                    yield batch_of(out)
                    out.clear()
            if held_open and held:
                out.append([file, start if whole else opened, start, "".join(held), *[None] * len(fields)])
        if out:
            yield batch_of(out)

    def joined(batches):
        for batch in batches:
            rows = [r for raw in batch.column(0).to_pylist() if (r := _cells(raw, fields)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(fields))], names=[f"c{i}" for i in range(len(fields))])

    # a row for each range: Spark broadcasts them below its threshold; rows of a range keep their order in the scan, which a shuffle would not
    entered = F.broadcast(states)
    known = fragments.join(entered, ["file", "start"]).select("value", "file", "start", "inside", "depth", "in_data", "opened", "cut")
    got = landed(known.mapInArrow(cut, f"file string, opened long, start long, piece string, {cells}"), "records")
    pieces = got.where("piece IS NOT NULL").groupBy("file", "opened").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda x: x["piece"]), "").alias("raw"))
    across = pieces.select("raw").mapInArrow(joined, cells)
    every = got.where("piece IS NULL").select(*(f"c{i}" for i in range(len(fields)))).unionByName(across)
    return every.toDF(*fields) if fields else every
