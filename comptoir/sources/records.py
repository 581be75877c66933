"""Records of delimited text whose quoted fields hold line breaks, cut from byte ranges in parallel.

Spark splits a file at line ends, so a range may begin inside a quoted field. Whether it does follows from
the ranges before it. Each range first tells what it would make of both cases (a function from the state at
its beginning to the state at its end); composing these along each file, one row per range, gives every
range its true beginning. Then each range cuts its own records, and only what crosses a range end, at most
two pieces per range, is put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import ensure_checkpoint_dir
from comptoir.sources.errors import CorruptInputError

_STATES = "path string, start long, after_out boolean, after_in boolean, cleared boolean"
_BEGINS = "path string, start long, inside boolean, owner long, open boolean"
_PIECES = "path string, start long, owner long, number long, whole boolean, value binary"


class Quotes:
    """Whether a line ends inside a quoted field. A quote opens a field only at the field's beginning; two stand for one."""

    def __init__(self, delimiter: str, encoding: str):
        sep = re.escape(delimiter.encode(encoding))
        inside, rest = rb'[^"]*+(?:""[^"]*+)*+', rb"(?:(?!" + sep + rb").)*+"
        field = rb'(?:"' + inside + rb'"' + rest + rb'|(?!")' + rest + rb")"
        opened = rb'"' + inside + rb"\Z"
        self._out = re.compile(rb"(?s)(?:" + field + sep + rb")*+" + opened).match
        self._in = re.compile(rb"(?s)" + inside + rb'(?:\Z|"' + rest + sep + rb"(?:" + field + sep + rb")*+" + opened + rb")").match

    def after(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        return (self._in if inside else self._out)(line) is not None


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """The lines of each byte range that a task reads, one range after the other."""
    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    source = rows()
    row = next(source, None)
    while row is not None:
        path, start = row[:2]

        def own(path=path, start=start):
            nonlocal row
            while row is not None and row[:2] == (path, start):
                yield row[2]
                row = next(source, None)

        lines = own()
        yield path, start, lines
        for _ in lines:  # whatever the caller has not taken
            pass


def _states(lines: DataFrame, quotes: Quotes) -> DataFrame:
    """The two possible end states of each range, and whether a range that begins inside a field gets out of it at a line end."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for path, start, own in _ranges(batches):
            out, into, cleared = False, True, False
            for line in own:
                if b'"' in line:
                    out, into = quotes.after(line, out), quotes.after(line, into)
                cleared = cleared or not into
            found.append((path, start, out, into, cleared))
        yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=["path", "start", "after_out", "after_in", "cleared"]).astype({"start": "int64"}), preserve_index=False) \
            if found else pa.RecordBatch.from_pylist([], pa.schema([("path", pa.string()), ("start", pa.int64()), *((c, pa.bool_()) for c in ("after_out", "after_in", "cleared"))]))

    return lines.mapInArrow(work, _STATES)


def _begins(states: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file in order: does each begin inside a field, of a record begun in which range, and does it end inside."""
    states = states.sort_values("start")
    rows, inside, owner = [], False, 0
    for path, start, after_out, after_in, cleared in states.itertuples(index=False):
        begun = owner if inside else start
        end = bool(after_in if inside else after_out)
        rows.append((path, start, inside, begun, end))
        owner = begun if inside and not cleared else start
        inside = end
    return pd.DataFrame(rows, columns=["path", "start", "inside", "owner", "open"])


def _cut(lines: DataFrame, begins: dict[tuple[str, int], tuple[bool, int]], quotes: Quotes) -> DataFrame:
    """Pieces: whole records, and what a range has of records that cross its ends. ``number`` counts the records begun in a range."""
    shared = lines.sparkSession.sparkContext.broadcast(begins)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "start", "owner", "number", "whole", "value"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        rows, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, size
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            rows, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for path, start, own in _ranges(batches):
            inside, owner = shared.value[path, start]
            piece, number, carried = [], 0, inside
            for line in own:
                if not piece and not inside and not line.strip():
                    continue  # blank lines between records are no records
                piece.append(line)
                inside = quotes.after(line, inside)
                if not inside:
                    value = b"\n".join(piece)
                    rows.append((path, start, owner, -1, False, value) if carried else (path, start, start, number, True, value))
                    number += not carried
                    piece, carried, size = [], False, size + len(value)
                    if size > 4 << 20 or len(rows) >= 10_000:
                        yield flush()
            if piece:
                value = b"\n".join(piece)
                rows.append((path, start, owner, -1, False, value) if carried else (path, start, start, number, False, value))
        if rows:
            yield flush()

    return lines.mapInArrow(work, _PIECES)


def quoted_records(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str) -> DataFrame:
    """One row ``(first, value)`` per record, as bytes; ``first`` marks the first record of each file.

    Line breaks inside quoted fields are kept as ``\\n``; blank lines between records are left out. The encoding must write
    ASCII as single bytes. The ranges' states (one small row for each range of a file) reach the driver and all
    tasks. The records are cut when this is called and kept as a checkpoint. A file that ends inside a quoted field is refused.
    """
    ensure_checkpoint_dir(spark)
    quotes, lines = Quotes(delimiter, encoding), _lines(spark, paths)
    begins = _states(lines, quotes).groupBy("path").applyInPandas(_begins, _BEGINS).collect()
    last = {}
    for r in begins:
        last[r["path"]] = max(last.get(r["path"], (-1, False)), (r["start"], r["open"]))
    unclosed = sorted(path for path, (_, is_open) in last.items() if is_open)
    if unclosed:
        raise CorruptInputError(f"a quoted field is never closed: {', '.join(unclosed[:5])}", paths=unclosed)
    pieces = _cut(lines, {(r["path"], r["start"]): (r["inside"], r["owner"]) for r in begins}, quotes).checkpoint()
    whole = pieces.where("whole").select(((F.col("start") == 0) & (F.col("number") == 0)).alias("first"), "value")
    crossing = pieces.where("NOT whole").groupBy("path", "owner").agg(
        (F.max("owner").eqNullSafe(F.lit(0)) & (F.max("number") == 0)).alias("first"),
        F.array_sort(F.collect_list(F.struct("start", F.decode("value", "ISO-8859-1").alias("text")))).alias("parts"))
    joined = F.encode(F.array_join("parts.text", "\n"), "ISO-8859-1")
    return whole.unionByName(crossing.select("first", joined.alias("value")))
