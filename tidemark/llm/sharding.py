"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt into blocks by a hash. How many rows each block sends to each shard is a
random matrix with the blocks' counts as row sums and the shards' sizes as column sums;
under a uniform shuffle its law is multivariate hypergeometric. The matrix is drawn
exactly, not row by row: a tree over the blocks splits the shards' sizes among up to
`FAN_OUT` children at a time, so its depth is logarithmic and each level is one job over
few rows. Rows then take a random order in their block (which tells the shard), travel,
and take a random order in their shard (which tells the slot).

Everything random is a hash of the row and the seed, so a task that runs again gives the
same rows. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, let, row_hash, table, unit, with_columns

FAN_OUT = 32
#: Rows that a block, and a slot range of a shard, hold on average.
BLOCK_ROWS = 50_000
#: Fewer blocks than this would not keep a cluster busy.
LEAST_BLOCKS = 64
#: Standard deviations of a draw that are summed; what lies outside is below 2**-53.
REACH = 12


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` of `total` items are among the `marked`: the quantile at `u`.

    The probabilities follow from their ratios, from the least number upwards. Arguments
    are doubles that hold whole numbers; so is the result.
    """
    number = lambda x: F.lit(float(x))

    def bounds(p: Column) -> Column:
        n, k, d = p["n"], p["k"], p["d"]
        mode = F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")
        var = d * k / F.greatest(n, number(1)) * (n - k) / F.greatest(n, number(1))
        var = var * (n - d) / F.greatest(n - 1, number(1))
        reach = F.ceil(number(REACH) * F.sqrt(F.greatest(var, number(0)))).cast("double") + REACH
        low = F.greatest(number(0), d - (n - k), mode - reach)
        high = F.least(d, k, mode + reach)
        return F.struct(n.alias("n"), k.alias("k"), d.alias("d"), p["u"].alias("u"),
                        low.alias("low"), high.alias("high"))

    def ratio(p: Column, x: Column) -> Column:
        """Weight of x over the weight of x - 1."""
        return (p["k"] - x + 1) * (p["d"] - x + 1) / (x * (p["n"] - p["k"] - p["d"] + x))

    def steps(p: Column) -> Column:
        many = F.sequence((p["low"] + 1).cast("long"), p["high"].cast("long"))
        return F.when(p["high"] > p["low"], many).otherwise(F.array().cast("array<long>"))

    def quantile(p: Column) -> Column:
        first = F.struct(number(1).alias("w"), number(1).alias("sum"))

        def add(acc: Column, x: Column) -> Column:
            weight = acc["w"] * ratio(p, x.cast("double"))
            return let(weight, lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum")))

        def walk(target: Column) -> Column:
            start = F.struct(number(1).alias("w"), number(1).alias("sum"), number(0).alias("x"))

            def step(acc: Column, x: Column) -> Column:
                weight = acc["w"] * ratio(p, x.cast("double"))
                passed = F.when(acc["sum"] <= target, number(1)).otherwise(number(0))
                return let(
                    weight,
                    lambda w: F.struct(
                        w.alias("w"), (acc["sum"] + w).alias("sum"), (acc["x"] + passed).alias("x")
                    ),
                )

            return F.aggregate(steps(p), start, step, lambda acc: acc["x"])

        whole = F.aggregate(steps(p), first, add, lambda acc: acc["sum"])
        return p["low"] + let(whole * p["u"], walk)

    given = F.struct(total.alias("n"), marked.alias("k"), drawn.alias("d"), u.alias("u"))
    return let(let(given, bounds), quantile)


def _split(capacities: Column, counts: Column, seed: int, level: int, parent: Column) -> Column:
    """Shares of the children in a node's capacities, one array of doubles for each child.

    `counts` has the children's rows in order. Child by child and shard by shard, a
    hypergeometric number of the shard's remaining rows falls to the child.
    """
    none = F.array().cast("array<double>")

    def child(acc: Column, c: Column) -> Column:
        def shard(part: Column, k: Column) -> Column:
            u = unit(F.xxhash64(F.lit(seed), F.lit(level), parent, c["child"], F.size(part["got"])))
            draw = hypergeometric(part["total"], k, part["left"], u)
            return let(
                draw,
                lambda x: F.struct(
                    (part["total"] - k).alias("total"),
                    (part["left"] - x).alias("left"),
                    F.concat(part["got"], F.array(x)).alias("got"),
                ),
            )

        whole = F.aggregate(acc["open"], F.lit(0.0), lambda a, x: a + x)
        begin = F.struct(
            whole.alias("total"), c["rows"].cast("double").alias("left"), none.alias("got")
        )
        return let(
            F.aggregate(acc["open"], begin, shard, lambda part: part["got"]),
            lambda got: F.struct(
                F.zip_with(acc["open"], got, lambda a, b: a - b).alias("open"),
                F.concat(
                    acc["out"], F.array(F.struct(c["child"].alias("node"), got.alias("caps")))
                ).alias("out"),
            ),
        )

    begin = F.struct(
        capacities.alias("open"), F.array().cast("array<struct<node:long,caps:array<double>>>").alias("out")
    )
    return F.aggregate(counts, begin, child, lambda acc: acc["out"])


def communication_matrix(counts: DataFrame, blocks: int, shards: int, seed: int) -> DataFrame:
    """`block`, `caps`: how many of the block's rows go to each shard.

    `counts` has `block` (from 0) and `rows`. Shard sizes differ by one at most; the
    first shards have the larger size.
    """
    depth = max(1, math.ceil(round(math.log(max(blocks, 2), FAN_OUT), 9)))
    totals = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    size = lambda s: F.floor((F.col("rows") + shards - 1 - s) / shards).cast("double")
    nodes = totals.select(
        F.lit(0).cast("long").alias("node"), F.array(*[size(s) for s in range(shards)]).alias("caps")
    )
    for level in range(1, depth + 1):
        width = FAN_OUT ** (depth - level)
        here = counts.groupBy(F.floor(F.col("block") / width).cast("long").alias("child"))
        here = here.agg(F.sum("rows").alias("rows"))
        here = here.groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node"))
        # At most FAN_OUT entries each.
        here = here.agg(F.array_sort(F.collect_list(F.struct("child", "rows"))).alias("counts"))
        shares = _split(F.col("caps"), F.col("counts"), seed, level, F.col("node"))
        nodes = nodes.join(here, "node").select(F.explode(shares).alias("part")).select("part.*")
    return nodes.select(
        F.col("node").alias("block"), F.transform("caps", lambda x: x.cast("long")).alias("caps")
    )


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`df` with `shard` (from 0) and `slot` (from 0 without gaps in each shard).

    Every assignment of rows to places is equally likely, as far as 64-bit hashes of rows
    are random; shards' counts differ by one at most. Rows are hashed with all their
    columns, nulls included, so a column with few values makes no hot block; rows that
    are equal in all columns are interchangeable and get a place each. An empty table
    gives no rows. Columns named `shard` or `slot` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = df.count()
    blocks = max(LEAST_BLOCKS, math.ceil(rows / block_rows))
    ranges = max(4, math.ceil(rows / shards / block_rows))
    body = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        row_hash(df, seed, 0).alias("place"),
        row_hash(df, seed, 1).alias("order"),
        row_hash(df, seed, 2).alias("spread"),
    ).withColumn("block", F.pmod("place", F.lit(blocks)))
    counts = kept(body.groupBy("block").agg(F.count("*").alias("rows")))
    matrix = kept(communication_matrix(counts, blocks, shards, seed))

    local = Window.partitionBy("block").orderBy("order", "place", "spread")
    ends = F.aggregate(
        "caps",
        F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("ends")),
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["ends"], F.array(acc["sum"] + x)).alias("ends")
        ),
        lambda acc: acc["ends"],
    )
    sent = (
        body.withColumn("turn", F.row_number().over(local) - 1)
        .join(matrix.select("block", ends.alias("ends")), "block")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("turn"))))
        .withColumn("part", F.shiftrightunsigned("spread", 32) % ranges)
    )
    lengths = sent.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept(
        lengths.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    inner = Window.partitionBy("shard", "part").orderBy("spread", "order", "place")
    placed = sent.withColumn("turn", F.row_number().over(inner) - 1).join(starts, ["shard", "part"])
    out = placed.select("row.*", F.col("shard").alias("_shard"), (F.col("start") + F.col("turn")).alias("_slot"))
    named = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]
    return out.select(*named, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def op3_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23. Sizes and checksums are taken before the shuffle,
    so texts do not travel."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return with_columns(
        shuffle_into_shards(docs, 24),
        law=F.lit("rows"),
        grown_shard=F.lit(None).cast("int"),
    )
