"""Lookups whose size decides how they travel, and numbering without one big task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than one task should get is kept out of a shuffled join; of such
# keys there are at most HEAVY_KEYS, the ones with most rows.
HEAVY_ROWS = 1_000_000
HEAVY_KEYS = 100_000


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the values in ``df``: text by its length, nested values by the length of
    their JSON text with a width for each element, other columns by width."""
    per_row = F.lit(0).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(column))
            # A number of one digit takes eight bytes, so a comma counts for sixteen.
            commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
            per_row = per_row + F.octet_length(text) + 16 * commas + 16
        else:
            per_row = per_row + 16
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def lookup_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when measuring proves it small, else as it came."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def heavy_keys(rows: DataFrame, key: str, most: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``most`` rows, or more than one in HEAVY_KEYS of all rows where
    that is more; so there are fewer than HEAVY_KEYS of them."""
    counts = settle(rows.groupBy(key).agg(F.count("*").alias("_rows")))
    total = counts.agg(F.sum("_rows")).scalar()
    limit = F.greatest(F.lit(most), total / HEAVY_KEYS)
    return counts.filter(F.col(key).isNotNull() & (F.col("_rows") > limit)).select(key)


def lookup_join(
    rows: DataFrame, side: DataFrame, key: str, limit: int = BROADCAST_BYTES, most: int = HEAVY_ROWS
) -> DataFrame:
    """Left join of ``rows`` with ``side``, which has one row per key.

    A side that measures small is broadcast, and the rows stay where they are. A larger
    one is joined by a shuffle, from which the heavy keys are kept out: the side's rows
    for them are few by definition and are broadcast if they measure small, too. Rows
    without a key match nothing and stay out as well. No task then holds all rows of a
    heavy key, whatever the session's settings for skewed joins.
    """
    if measured_bytes(side) <= limit:
        return rows.join(F.broadcast(side), key, "left")
    found = settle(heavy_keys(rows, key, most))
    few = settle(side.join(F.broadcast(found), key, "left_semi"))
    if measured_bytes(few) > BROADCAST_BYTES:
        # Rows of the side this wide can't be broadcast: adaptive execution has to split.
        return rows.join(side, key, "left")
    heavy = F.broadcast(found.withColumn("_heavy", F.lit(True)))
    marked = rows.join(heavy, key, "left")
    aside = F.col("_heavy").isNotNull() | F.col(key).isNull()
    in_place = marked.filter(aside).join(F.broadcast(few), key, "left")
    shuffled = marked.filter(~aside).join(side, key, "left")
    return in_place.unionByName(shuffled).drop("_heavy")


def with_ordinal(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add the zero-based position of each row in ``order``.

    A global ``row_number`` would sort everything in one task. Here the rows are
    range partitioned and sorted, each takes its position within its partition, and
    the counts of the preceding partitions are added. The positions are settled
    before the counts are taken, because a second run of the range partitioning
    may sample other bounds.
    """
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id holds the partition above 33 bits of row position.
    placed = placed.withColumn("_slot", F.shiftright("_id", 33))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the sort, however many rows it holds.
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slot")
        .agg(F.count("*").alias("_rows"))
        .select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_slot")
        .withColumn(name, F.col("_before") + within)
        .drop("_slot", "_id", "_before")
    )
