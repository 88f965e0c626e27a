"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import unit

#: Values that are told apart at most; more are an error, as none is left out.
MOST_STRATA = 1024


def strata(df: DataFrame, stratum: str) -> dict:
    """How many rows each value of `stratum` has. Rows without a value don't count."""
    counts = df.filter(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count("*").alias("rows"))
    found = counts.limit(MOST_STRATA + 1).collect()
    if len(found) > MOST_STRATA:
        raise ValueError(f"more than {MOST_STRATA} values of {stratum} to learn")
    return {r[0]: r[1] for r in found}


def stratified(
    df: DataFrame, stratum: str, each: int, place: Column, most: int
) -> tuple[DataFrame, dict]:
    """About `each` rows of every value of `stratum` (all, if it has no more; fewer of each,
    if there would be over `most` in all), chosen by the hash `place`; and how many rows
    each value has. Rows without a value are left out.

    What comes back is bounded by `most` rows (and one a value), up to the scatter of
    hashing, and is spread over the tasks as the rows were: nothing is sorted or moved.
    """
    sizes = strata(df, stratum)
    if not sizes:
        return df.filter(F.lit(False)), sizes
    each = max(1, min(each, most // len(sizes)))
    shares = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, each / n))])
    return df.filter(unit(place) < F.coalesce(shares[F.col(stratum)], F.lit(0.0))), sizes


def least_of_each(df: DataFrame, stratum: str, each: int, place: Column, most: int) -> tuple[DataFrame, dict]:
    """`stratified`, with exactly the rows of the least hashes of every value, so that also
    where few are taken each value has some. A task sends `each` rows of a value at most."""
    sizes = strata(df, stratum)
    if not sizes:
        return df.filter(F.lit(False)), sizes
    each = max(1, min(each, most // len(sizes)))
    by_hash = Window.partitionBy(stratum).orderBy(place)
    known = df.filter(F.col(stratum).isNotNull())
    return known.withColumn("_turn", F.row_number().over(by_hash)).filter(F.col("_turn") <= each).drop("_turn"), sizes
