"""Splittable reading of CSV sheets whose quoted cells hold line breaks.

Spark's ``multiLine`` reader takes a file in one task, because whether a
line break ends a record depends on the quotes before it.  Here the lines are
read in splits.  A first pass runs each split from both possible states,
outside and inside a quoted cell, and reports the two end states; folding
these along each file (one row for each split) fixes the true state at every
split's start.  A second pass cuts the splits into records (once for the files' headers, once
for the rows).  A record
that crosses a split's end is put together from its pieces, of which a split
has two at most, and every record is parsed by the built-in ``from_csv``.

The rows equal those of the ``multiLine`` reader (comma, ``"`` as quote and
as its own escape, UTF-8, records ended by ``\\n`` or ``\\r\\n``): a quote opens a
cell only as its first character, empty lines are no records, each file's
first record is its header, a byte order mark is dropped, and a quoted cell
that is still open at the end of its file ends there.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: From inside a quoted cell to the quote that ends it (two quotes are one character of the cell).
_CLOSE = re.compile(r'(?:[^"]|"")*?"(?!")')
_STATES = "file string, block long, from_outside boolean, from_inside boolean"
_PIECES = "file string, block long, place long, kind string, record string"
_BOM = "﻿"


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after ``line``, which starts ``inside`` one or not."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            closed = _CLOSE.match(line, at if inside else at + 1)
            if closed is None:
                return True
            at, inside = closed.end(), False
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # lines end at \n alone, so a \r inside a cell is kept
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches):
    """(file, block, lines) of each split, in order; a split's lines may come in several batches."""
    key, held = None, []
    for batch in batches:
        for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != key:
                if key:
                    yield *key, held, True
                key, held = (file, block), []
            held.append(line)
        if key:
            yield *key, held, False
            held = []
    if key:
        yield *key, held, True


def _states(lines: DataFrame) -> DataFrame:
    """One row for each split: the end states of both start states."""
    def scan(batches):
        outside, inside, out = False, True, []
        for file, block, some, last in _runs(batches):
            for line in some:
                if '"' in line:
                    outside, inside = inside_after(line, outside), inside_after(line, inside)
            if last:
                out.append((file, block, outside, inside))
                outside, inside = False, True
        yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
                              ["file", "block", "from_outside", "from_inside"])

    return lines.mapInArrow(scan, _STATES)


def _starts_inside(states: DataFrame) -> DataFrame:
    """(file, block) of the splits that start inside a quoted cell; a file has one row for each split here."""
    def fold(frame):
        frame, inside, found = frame.sort_values("block"), False, []
        for block, from_outside, from_inside in zip(frame["block"], frame["from_outside"], frame["from_inside"]):
            if inside:
                found.append(block)
            inside = bool(from_inside if inside else from_outside)
        return frame[frame["block"].isin(found)][["file", "block"]]

    return states.groupBy("file").applyInPandas(fold, "file string, block long")


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, place, record): every record of the files, header included;
    (block, place) is its order within the file."""
    lines = _lines(spark, path)
    # one entry for each split that is cut inside a cell: those sheets have few, and never more than splits
    cut = {(r["file"], r["block"]) for r in _starts_inside(_states(lines)).toLocalIterator()}
    given = spark.sparkContext.broadcast(cut)

    def gather(batches):
        known, parts, place, inside, kind, at = given.value, [], 0, False, None, None
        for file, block, some, last in _runs(batches):
            if at != (file, block):
                at, place, parts = (file, block), 0, []
                inside = at in known
                kind = "head" if inside else "whole"
            out = []
            for line in some:
                parts.append(line)
                inside = inside_after(line, inside) if inside or '"' in line else False
                if not inside:
                    out.append((file, block, place, kind, "\n".join(parts)))
                    parts, kind, place = [], "whole", place + 1
            if last and parts:
                # still open: the next split goes on, also with what was open before this one
                out.append((file, block, place, "tail" if kind == "whole" else "head", "\n".join(parts)))
                parts = []
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                      ["file", "block", "place", "kind", "record"])

    pieces = lines.mapInArrow(gather, _PIECES)
    whole = pieces.where("kind = 'whole'").drop("kind")
    # a tail and the heads of the splits after it are one record (a split has two pieces at most)
    split = pieces.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == "head", 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") == "tail", F.struct("block", "place")), ignorenulls=True).over(order)
    joined = split.withColumn("owner", owner).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", F.when(F.col("kind") == "head", 0).otherwise(1).alias("k"), "record"))).alias("parts"))
    joined = joined.select("file", "owner.block", "owner.place", F.array_join(F.col("parts.record"), "\n").alias("record"))
    return whole.unionByName(joined)


def _fields(spark: SparkSession, header: str) -> list[str]:
    """The header's names as the CSV reader makes them (repeated and empty names included)."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(
        spark.sparkContext.parallelize([header], 1)).columns


def read_sheet(spark: SparkSession, path: str | list[str], corrupt: str | None = None) -> DataFrame:
    """All cells as strings under the header's names, like ``multiLine`` CSV.

    With ``corrupt`` a column of that name holds the text of records whose
    number of cells differs from the header's, null for the others.
    """
    every = records(spark, path)
    first = F.regexp_replace("record", "^" + _BOM, "")
    every = every.withColumn("record", F.when((F.col("block") == 0) & (F.col("place") == 0), first).otherwise(F.col("record")))
    # a file whose first line ends with \r\n has \r\n for \n, in cells as well (for the multiLine reader, too)
    ends = F.substring_index("record", "\n", 1).endswith("\r")
    top_of = every.where("block = 0").select("file", "place", "record", ends.alias("ends"))
    blank = F.col("record").isin("", "\r")
    # one row for each file, as in the file listing that the driver holds anyway; so small that it is broadcast
    files = top_of.groupBy("file").agg(F.min(F.when(~blank, F.col("place"))).alias("head"), F.min_by("ends", "place").alias("crlf"),
                                       F.min_by(F.when(~blank, F.col("record")), F.when(~blank, F.col("place"))).alias("top")).collect()
    tops = sorted((r["file"], r["top"]) for r in files if r["top"] is not None)
    if not tops:
        return spark.createDataFrame([], StructType([]))
    names = _fields(spark, tops[0][1].removesuffix("\r"))
    known = F.broadcast(spark.createDataFrame([(r["file"], r["head"], r["crlf"]) for r in files], "file string, head long, crlf boolean"))
    every = every.join(known, "file", "left").withColumn("record", F.when(
        F.col("crlf"), F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")).otherwise(F.col("record")))
    mark = "_corrupt_record" if corrupt is None else corrupt
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField(mark, StringType())])
    # a file's header is its first record that is not empty
    rows = every.where((F.col("record") != "") & ((F.col("block") != 0) | (F.col("place") != F.col("head"))))
    cells = F.from_csv("record", _ddl(schema), {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": mark, "maxCharsPerColumn": "-1"})
    out = rows.select(cells.alias("_c")).select("_c.*")
    return out if corrupt else out.drop(mark)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)

