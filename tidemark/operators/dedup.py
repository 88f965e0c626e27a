"""Exact duplicates, duplicates by key, and the newest rows of each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scale import lookup_join
from tidemark.session import settle

# Ways in which one series is split before its rows meet in a single group.
SERIES_SPLITS = 64


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def one_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (), keep: str = "last"
) -> DataFrame:
    """One row per key: the one that sorts last (or first) by ``prefer``, then by the
    other columns in name order.

    The survivor is the same under any partitioning, since rows that tie are equal.
    As an aggregate it is combined before the shuffle, so a key that holds a large
    share of the rows sends one row per map task.
    """
    others = sorted(c for c in df.columns if c not in keys and c not in prefer)
    ranked = [*prefer, *others]
    if not ranked:
        return df.select(*keys).distinct()
    pick = {"last": F.max, "first": F.min}[keep]
    if len(ranked) == 1:  # no struct, so that the aggregate is one by hash
        return df.groupBy(*keys).agg(pick(F.col(ranked[0])).alias(ranked[0])).select(*df.columns)
    best = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_best"))
    return best.select(
        *(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns)
    )


# Up to this many rows per series Spark keeps only so many per group before a shuffle.
RANKED = 1000


def last_n_per_key(
    df: DataFrame, key: str, newest_first: Sequence[str], n: int, splits: int = SERIES_SPLITS
) -> DataFrame:
    """The ``n`` newest rows of every series under a total order (all columns
    descending).

    Rows are ranked twice: within a slice of the series, then among the rows that
    survive, at most ``n * splits`` per series; of those Spark keeps only ``n`` rows per
    group of a map task before each shuffle. Beyond ``RANKED`` rows it would not, so there
    the day is found first up to which a series has too few: newer rows are all taken, and
    only those of that day are ranked.
    """
    if n <= RANKED:
        return _ranked(df, key, newest_first, F.lit(n), splits)
    first = newest_first[0]
    dated = isinstance(df.schema[first].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    day = F.col(first).cast("date") if dated else F.col(first)
    rows = df.withColumn("_day", day)
    # Each map task sends one row per series and day.
    counts = rows.groupBy(F.col(key).alias("_series"), "_day").agg(F.count("*").alias("_rows"))
    newer = Window.partitionBy("_series").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
    # The day on which a series is full; before it, nothing is taken.
    full = (F.col("_newer") < n) & (F.col("_newer") + F.col("_rows") >= n)
    cuts = settle(counts.filter(full).select("_series", F.col("_day").alias("_cut"), (n - F.col("_newer")).alias("_left")))
    cut = lookup_join(rows.withColumn("_series", F.col(key)), cuts, "_series").filter(
        F.col("_left").isNull() | F.col("_day").isNull() & F.col("_cut").isNull() | (F.col("_day") >= F.col("_cut")) | F.col("_cut").isNull()
    )
    on_cut = F.col("_left").isNotNull() & F.col("_day").eqNullSafe(F.col("_cut"))
    whole = cut.filter(~on_cut).select(*df.columns)
    last = _ranked(cut.filter(on_cut), key, newest_first, F.col("_left"), splits)
    return whole.unionByName(last.select(*df.columns))


def _ranked(df: DataFrame, key: str, newest_first: Sequence[str], n: Column, splits: int) -> DataFrame:
    order = [F.col(c).desc() for c in newest_first]
    sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(splits)))
    in_slice = Window.partitionBy(key, "_slice").orderBy(*order)
    in_series = Window.partitionBy(key).orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(in_slice))
        .filter(F.col("_rank") <= n)
        .drop("_rank", "_slice")
        .withColumn("_rank", F.row_number().over(in_series))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )
