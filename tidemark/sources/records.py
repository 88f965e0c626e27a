"""Records of text files that may go over several lines.

Whether a line ends a record depends on all lines of its file before it: on brackets that
are open (JSON), on quotes that are (CSV). Both are running sums of what a line adds. Sums are
taken within a block of a file, and the sums of blocks before it are added, so no file is
read by one task. Lines stay where they are: the task that reads a block joins those of a
record, and only records that go over the end of a block are shuffled. A file of which every
line is whole by itself needs none of this.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.scale import BROADCAST_BYTES, lookup_join, lookup_side, measured_bytes
from tidemark.session import settle

# A JSON string, read without going back: a backslash takes the next letter along.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
# A bracket that closes, and one that opens with nothing between but blanks: of all JSON,
# only the end of one document and the start of the next look like this.
_SEAM = r"\G((?:[^\"}\]]|" + _STRING + r"|[}\]](?![ \t]*[{\[]))*+)([}\]])[ \t]*(?=[{\[])"


def file_lines(spark: SparkSession, paths: Sequence[str], only: str | None = None) -> DataFrame:
    """(file, block, at, value): lines that are not blank, in the order of ``at`` within a
    block. Folders are read with all below them; ``only`` is a pattern of file names."""
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", only) if only else reader
    lines = reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    return lines.filter(F.trim("value") != "")


def json_lines(spark: SparkSession, paths: Sequence[str], only: str | None = None) -> DataFrame:
    """``file_lines`` with a line for each document where several stand on one."""
    lines = file_lines(spark, paths, only)
    joint = F.col("value").rlike(r"[}\]][ \t]*[{\[]")
    apart = F.when(joint, F.split(F.regexp_replace("value", _SEAM, "$1$2\n"), "\n")).otherwise(F.array("value"))
    split = lines.select("file", "block", "at", F.posexplode(apart).alias("part", "value"))
    return split.withColumn("at", F.struct("at", "part")).drop("part")


def open_brackets(line: Column) -> Column:
    """How many more brackets a line of JSON opens than it closes; strings don't count."""
    brackets = F.regexp_replace(line, _STRING + r"|[^\[\]{}\"]++", "")
    opened = F.length(F.translate(brackets, "}]", ""))
    return (2 * opened - F.length(brackets)).cast("long")


def quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).cast("long")


def look_at(lines: DataFrame, adds: Column, closed: Callable[[Column], Column], *told: Column) -> DataFrame:
    """(file, block, adds, odd), settled: what a block's lines add together, and whether one
    of them isn't a record by itself; ``told`` are further aggregates of a block. Those that
    are numbers leave the lines unsorted."""
    odd = F.bool_or(~closed(adds)).alias("odd")
    return settle(lines.groupBy("file", "block").agg(F.sum(adds).alias("adds"), odd, *told))


def _cut_at(blocks: DataFrame, closed: Callable[[Column], Column]) -> DataFrame:
    """(file, block, split, before, cut) of files with odd lines: a number for each block,
    the sum of the blocks before it, and whether a record goes over one of its ends."""
    odd = blocks.join(blocks.filter("odd").select("file").distinct(), "file", "left_semi")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = odd.withColumn("before", F.coalesce(F.sum("adds").over(earlier), F.lit(0)))
    cut = ~closed(F.col("before")) | ~closed(F.col("before") + F.col("adds"))
    return settle(summed.select("file", "block", F.monotonically_increasing_id().alias("split"), "before", cut.alias("cut")))


def _joined(batches: Iterator[pa.RecordBatch], closed: Callable, whole: bool) -> Iterator[pa.RecordBatch]:
    """(split, follows, value) of lines that come in order: the records that lie in one split,
    or, without ``whole``, the pieces of those that go over its ends. A piece ``follows`` if
    its record began in a split before. Of a record, only its lines are held."""
    split, total, follows, held = None, 0, False, []

    def rest() -> list[pa.RecordBatch]:
        if not held or whole:
            return []
        return [pa.record_batch({"split": [split], "follows": [follows], "value": ["\n".join(held)]})]

    for batch in batches:
        splits = batch.column("split").to_numpy()
        starts = np.flatnonzero(np.diff(splits, prepend=splits[:1] - 1)) if len(splits) else []
        for start, stop in zip(starts, [*starts[1:], len(splits)]):
            if splits[start] != split:
                yield from rest()
                split, total, held = int(splits[start]), batch.column("before")[int(start)].as_py(), []
                follows = not closed(total)
            lines = batch.column("value").slice(start, stop - start)
            sums = total + np.cumsum(batch.column("adds").slice(start, stop - start).to_numpy())
            total = int(sums[-1])
            ends = np.flatnonzero(closed(sums)) + 1
            if len(ends) and (held or follows):
                # The record that was open, here or in a split before.
                first = "\n".join([*held, *lines.slice(0, ends[0]).to_pylist()])
                if follows != whole:
                    yield pa.record_batch({"split": [split], "follows": [follows], "value": [first]})
                held, follows = [], False
                lines, ends = lines.slice(ends[0]), ends[1:] - ends[0]
            last = int(ends[-1]) if len(ends) else 0
            if whole and last:
                places = pa.array(np.concatenate([[0], ends]), pa.int32())
                joined = pc.binary_join(pa.ListArray.from_arrays(places, pa.concat_arrays([lines.slice(0, last)])), "\n")
                n = len(joined)
                yield pa.record_batch({"split": np.full(n, split), "follows": np.zeros(n, bool), "value": joined})
            held += lines.slice(last).to_pylist()
    yield from rest()


def _in_order(lines: DataFrame, splits: DataFrame, adds: Column) -> DataFrame:
    """(split, before, adds, value): the lines of ``splits``, those of one in order and in one
    task. A scan has them so, unless there are too many splits to send to its tasks."""
    small = measured_bytes(splits) <= BROADCAST_BYTES
    found = lines.join(F.broadcast(splits) if small else splits, ["file", "block"])
    found = found if small else found.repartition("split").sortWithinPartitions("split", "at")
    return found.select("split", "before", adds.alias("adds"), "value")


def joined_lines(lines: DataFrame, blocks: DataFrame, adds: Column, closed: Callable) -> DataFrame:
    """(file, value): records made of the lines of files that have odd ones. A line adds
    ``adds`` to what is open; ``closed`` of the sum, a column or an array, tells that a record
    ends. What a file leaves open at its end is a record, too: its reader finds it broken.

    Lines are joined where they are read. Only pieces of records that go over the end of a
    block, at most two of a block, are shuffled."""
    splits = _cut_at(blocks, closed)

    def run(where: DataFrame, whole: bool) -> DataFrame:
        ordered = _in_order(lines, where.select("file", "block", "split", "before"), adds)
        joined = ordered.mapInArrow(lambda batches: _joined(batches, closed, whole), "split long, follows boolean, value string")
        return lookup_join(joined, where.select("split", "file", "block"), "split")

    inside = run(splits, True).select("file", "value")
    cut = splits.filter("cut")
    if cut.isEmpty():
        return inside
    pieces = settle(run(cut, False))
    begun = Window.partitionBy("file").orderBy("block", F.desc("follows")).rowsBetween(Window.unboundedPreceding, 0)
    record = F.count_if(~F.col("follows")).over(begun)
    parts = pieces.select("file", record.alias("record"), F.struct("block", (~F.col("follows")).alias("begins"), "value").alias("line"))
    across = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    text = F.array_join(F.transform("lines", lambda part: part["value"]), "\n")
    return inside.unionByName(across.select("file", text.alias("value")))


def whole_records(lines: DataFrame, blocks: DataFrame, adds: Column, closed: Callable) -> DataFrame:
    """(file, value): records of all files; ``blocks`` is what ``look_at`` found."""
    kinds = {r.odd for r in blocks.groupBy("file").agg(F.bool_or("odd").alias("odd")).select("odd").distinct().collect()}
    if kinds <= {False}:
        return lines.select("file", "value")
    spread = joined_lines(lines, blocks, adds, closed)
    if kinds == {True}:
        return spread
    files = blocks.filter("odd").select("file").distinct()
    return lines.join(lookup_side(files), "file", "left_anti").select("file", "value").unionByName(spread)
