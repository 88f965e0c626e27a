"""Benchmark passages in documents, by a hash set of test n-grams.

The windows of the test items (10 words; a shorter item is one window) are few; documents
are many. A window that occurs in a document covers a whole aligned block of it: a run of
half as many words whose position is a multiple of its length. So documents are scanned
block by block, one in five positions for ten words, against the set of all runs of that
length inside windows. Only around blocks that hit are windows formed, looked up by hash
and compared word by word. The set is broadcast if its counted size is small, else joined
by a shuffle. Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, kept, let, table

WINDOW = 10
#: Most bytes of a table that is broadcast, with 32 for each row besides its words.
BROADCAST_BYTES = 32 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words where letters have not been lowered.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_in(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _block(length: int) -> int:
    """Words of the blocks of which every window of `length` words holds an aligned one."""
    return (length + 1) // 2


def _up_to(last: Column) -> Column:
    """Whole numbers from 0 to `last`, none if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _name(words: Column, start: Column, length: Column | int) -> Column:
    """Hash of some words, from `start` (0 the first), and of how many they are."""
    size = length if isinstance(length, Column) else F.lit(length)
    return F.xxhash64(size, F.slice(words, start + 1, size))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """`item`, `length`, `gram` (its words), `key` of all windows of the items, written."""
    found = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words_in(F.col(f"`{text}`")).alias("words"))
    found = found.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    starts = F.explode(_up_to(F.size("words") - F.col("length"))).alias("s")
    found = found.select("item", "length", "words", starts)
    gram = F.slice("words", F.col("s") + 1, F.col("length"))
    return kept(found.select("item", "length", gram.alias("gram"), _name(F.col("words"), F.col("s"), F.col("length")).alias("key")).distinct())


def _side(df: DataFrame) -> DataFrame:
    """For broadcast if its bytes, counted over all rows, are few; else as it is."""
    words = F.octet_length(F.array_join("gram", " ")) if "gram" in df.columns else F.lit(0)
    size = df.agg(F.coalesce(F.sum((words + 32).cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def occurrences(docs: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sizes (`_node`, `n_words`) of all documents, and where windows occur in them:
    `_node`, `s` (the first word), `length`, `item`."""
    lengths = sorted(r.length for r in grams.select("length").distinct().collect())  # ten at most
    by_block = {b: [n for n in lengths if _block(n) == b] for b in {_block(n) for n in lengths}}
    words = words_in(F.col("text"))

    def runs_of(block: int) -> DataFrame:
        names = F.transform(_up_to(F.col("length") - block), lambda o: _name(F.col("gram"), o, block))
        return grams.filter(F.col("length").isin(by_block[block])).select(F.explode(names).alias("h"))

    def entry(block: int, at: Column, h: Column) -> Column:
        return F.struct(F.lit(block).alias("block"), at.alias("at"), h.alias("h"))

    def aligned(w: Column, block: int) -> Column:
        last = F.floor(F.size(w) / block).cast("int") - 1
        return F.transform(_up_to(last), lambda j: entry(block, j * block, _name(w, j * block, block)))

    def scanned(w: Column) -> Column:
        # One entry for the document itself; its hash is of no block.
        whole = F.array(entry(0, F.size(w), F.xxhash64(F.lit("size"), F.col("_node"))))
        return F.concat(whole, *[aligned(w, block) for block in by_block])

    entries = docs.select("_node", F.explode(let(words, scanned)).alias("e")).select("_node", "e.*")
    if by_block:
        runs, *others = map(runs_of, by_block)
        for other in others:
            runs = runs.union(other)
        runs = kept(runs.distinct().withColumn("hit", F.lit(True)))
        entries = entries.join(_side(runs), "h", "left")
        entries = entries.filter(F.col("hit") | (F.col("block") == 0))
    entries = kept(entries.select("_node", "block", "at"))
    sizes = entries.filter("block = 0").select("_node", F.col("at").alias("n_words")).distinct()
    if not by_block:
        none = docs.sparkSession.createDataFrame([], "_node long, s int, length int, item string")
        return sizes, none

    spots = entries.filter("block > 0").groupBy("_node").agg(F.collect_set(F.struct("block", "at")).alias("spots"))
    near = docs.select("_node", "text").join(spots, "_node")

    def tried(w: Column) -> Column:
        def of_length(spot: Column, n: int) -> Column:
            first = F.greatest(spot["at"] - (n - _block(n)), F.lit(0))
            last = F.least(spot["at"], F.size(w) - n)
            here = F.when((spot["block"] == _block(n)) & (first <= last), F.sequence(first, last))
            here = here.otherwise(F.array().cast("array<int>"))
            return F.transform(here, lambda s: F.struct(s.alias("s"), F.lit(n).alias("length")))

        def around(spot: Column) -> Column:
            return F.concat(*[of_length(spot, n) for n in lengths])

        starts = F.array_distinct(F.flatten(F.transform("spots", around)))
        return F.transform(
            starts,
            lambda x: F.struct(
                x["s"].alias("s"),
                x["length"].alias("length"),
                F.slice(w, x["s"] + 1, x["length"]).alias("gram"),
                _name(w, x["s"], x["length"]).alias("key"),
            ),
        )

    windows = near.select("_node", F.explode(let(words_in(F.col("text")), tried)).alias("t")).select("_node", "t.*")
    found = windows.join(_side(grams), ["key", "length", "gram"])
    return sizes, found.select("_node", "s", "length", "item")


def contamination(
    df: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`df` with `n_words`, `n_hit` (words in any occurrence of a window), `hits` (their
    positions from 0, ascending) and `items` (ids whose windows occur, sorted as text).

    Words are runs of lower-cased letters, digits and characters beyond ASCII. A null text
    has none; neither has an item without words a window. Null item ids count for the
    words but name no item. Rows with equal id and text are one document. Empty tables
    give no rows and no hits. Columns named like the results are replaced, others pass
    unchanged. `doc_id` must be of an integer type.
    """
    new = ("n_words", "n_hit", "hits", "items")
    rest = [c for c in df.columns if c.lower() not in new]
    plain = df.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.col(f"`{text}`").alias("text"),
    )
    docs = keyed(plain, "_id", "text")
    sizes, found = occurrences(docs, item_windows(items, item_id, item_text, window))
    places = F.transform(
        F.collect_set(F.struct("s", "length")), lambda x: F.sequence(x["s"], x["s"] + x["length"] - 1)
    )
    hit = found.groupBy("_node").agg(
        F.array_sort(F.array_distinct(F.flatten(places))).alias("hits"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    facts = sizes.join(hit, "_node", "left")
    out = docs.select("row", "_node").join(facts, "_node")
    none = lambda kind: F.array().cast(f"array<{kind}>")
    hits = F.coalesce("hits", none("int"))
    return out.select(
        *[F.col(f"row.`{c}`") for c in rest],
        F.col("n_words").cast("long").alias("n_words"),
        F.size(hits).cast("long").alias("n_hit"),
        hits.alias("hits"),
        F.coalesce("items", none("string")).alias("items"),
    )


def decontaminated(df: DataFrame, items: DataFrame, remove: str = "documents", **names: str) -> DataFrame:
    """`df` without the documents in which test windows occur, or, with `remove="spans"`,
    with all documents and without the words of the windows and what separates each from
    the next word. Columns and their order are those of `df`."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be documents or spans")
    text = names.get("text", "text")
    # What is found gets names that no column of `df` has.
    order = df.columns
    aside = [f"_c{i}" for i in range(len(order))]
    renamed = df.toDF(*aside)
    inner = {"doc_id": aside[order.index(names.get("doc_id", "doc_id"))], "text": aside[order.index(text)]}
    found = contamination(renamed, items, **{**names, **inner})
    if remove == "documents":
        return found.filter("n_hit = 0").select(*aside).toDF(*order)
    words = F.regexp_extract_all(F.col(inner["text"]), F.lit(RAW_WORD), F.lit(0))
    gaps = F.split(F.col(inner["text"]), RAW_WORD, -1)

    def cut(p: Column) -> Column:
        stays = F.filter(_up_to(F.size(p["words"]) - 1), lambda i: ~F.array_contains(F.col("hits"), i))
        kept_words = F.transform(stays, lambda i: F.concat(p["words"][i], p["gaps"][i + 1]))
        return F.concat(p["gaps"][0], F.array_join(kept_words, ""))

    shorter = let(F.struct(words.alias("words"), gaps.alias("gaps")), cut)
    value = F.when(F.col("n_hit") > 0, shorter).otherwise(F.col(inner["text"]))
    return found.withColumn(inner["text"], value).select(*aside).toDF(*order)


def op4_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that are in a window of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
    unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS s
  FROM b WHERE len(w) > 0
), p AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
  FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n
), h AS (
  SELECT doc_id, i, n, item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM p) JOIN g USING (n, s)
), c AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
