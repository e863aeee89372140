"""CSV records with line breaks inside quotes, read by many tasks per file.

Whether a line break ends a record depends on all quotes before it. The state at the end of a block of a file is a
function of the state at its begin (outside or inside of quotes), and these functions compose:
1. Each block is scanned once from both states; the result is one row per block.
2. The states at the begin of the blocks follow from first to last; their number is that of the file splits, which the
   driver lists anyway.
3. Each block cuts its records from its true begin. What a block ends, or begins, in the middle of a record are
   fragments, at most two a block; only they are shuffled and joined.

A quote opens at the begin of a field only and is written twice inside; a quoted value may go on behind its closing
quote up to the separator. Records end with a line feed; a carriage return before a line feed is dropped. Lines without
any character are no records. The functions that tasks run carry no reference to this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = "file string, block long"
PARTS = f"{BLOCK}, row long, kind string, record string"
WHOLE, BEGIN = "whole", "begin"  # the third kind is "middle"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _ends(separator: str):
    """Function (line, inside) -> inside of quotes at the end of the line."""
    def ends(line: str, inside: bool) -> bool:
        if '"' not in line:
            return inside
        parts = line.split('"')
        closed = False  # the last quote closed a value; one that follows at once opens it again
        for i, text in enumerate(parts[:-1]):
            if inside:
                inside, closed = False, True
            elif closed and not text:
                inside, closed = True, False
            else:
                inside, closed = (text[-1:] == separator) if text else i == 0, False
        return inside
    return ends


def _states(separator: str):
    ends = _ends(separator)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer():
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([states[0]]), pa.array([states[1]])],
                names=["file", "block", "outside", "inside"])

        now, states = None, [False, True]
        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != now:
                    if now is not None:
                        yield answer()
                    now, states = (file, block), [False, True]
                if '"' in line:
                    states = [ends(line, s) for s in states]
        if now is not None:
            yield answer()
    return rows


def _cut(separator: str, begun_inside: set):
    """Records and fragments of each block. A fragment's row says its place; it has the line breaks that belong to it."""
    ends, size = _ends(separator), 10_000

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def answer():
            columns = list(zip(*found))
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                               names=["file", "block", "row", "kind", "record"])
            found.clear()
            return batch

        now, row, inside, kind, open_lines = None, 0, False, "whole", []
        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != now:
                    if open_lines:  # the block before ends within a record
                        found.append((*now, row, "middle" if kind == "middle" else "begin", "\n".join(open_lines) + "\n"))
                    now, row, open_lines = (file, block), 0, []
                    inside = now in begun_inside
                    kind = "middle" if inside else "whole"
                inside = ends(line, inside)
                open_lines.append(line)
                if inside:
                    continue
                found.append((*now, row, kind, "\n".join(open_lines)))
                row, kind, open_lines = row + 1, "whole", []
                if len(found) >= size:
                    yield answer()
        if open_lines:
            found.append((*now, row, "middle" if kind == "middle" else "begin", "\n".join(open_lines) + "\n"))
        if found:
            yield answer()
    return rows


def begun_inside(spark: SparkSession, path: str, separator: str = ",") -> set[tuple[str, int]]:
    """(file, block) of the blocks that begin inside of quotes."""
    states = _lines(spark, path).mapInArrow(_states(separator), f"{BLOCK}, outside boolean, inside boolean").collect()
    found, file, inside = set(), None, False
    for s in sorted(states, key=lambda s: (s["file"], s["block"])):
        if s["file"] != file:
            file, inside = s["file"], False
        if inside:
            found.add((s["file"], s["block"]))
        inside = s["inside"] if inside else s["outside"]
    return found


def records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """file, block, row, record: the text of every record, without its line end; (file, block, row) is its place."""
    inside = begun_inside(spark, path, separator)
    parts = _lines(spark, path).mapInArrow(_cut(separator, inside), PARTS)
    # A fragment that begins a record starts a new one; those after it go on.
    order = Window.partitionBy("file").orderBy("block", "row")
    number = F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(order)
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "record")))
    joined = parts.where(F.col("kind") != WHOLE).withColumn("number", number).groupBy("file", "number").agg(
        pieces.alias("pieces")).select(
        "file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["row"].alias("row"),
        F.array_join(F.transform("pieces", lambda p: p["record"]), "").alias("record"))
    whole = parts.where(F.col("kind") == WHOLE)
    unix = F.regexp_replace("record", "\r\n", "\n")
    columns = ["file", "block", "row", F.regexp_replace(unix, r"\r?\n?\z", "").alias("record")]
    return whole.select(*columns).unionByName(joined.select(*columns)).where("record <> ''")
