"""Raw documents and bars written to the landing folders, one folder per symbol and
period, and the list of what has landed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import safe_symbol
from tidemark.session import settle
from tidemark.sources.files import path_exists


# What stands for the key of documents without a code: those of gold.
GOLD_KEY = "XAU"
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "key string, period string, folder string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(key, period, folder): what has landed under ``path``. It is a table that each landing
    adds to; where there is none, the files that lie there tell."""
    written = f"{path.rstrip('/')}/{MANIFEST}"
    if path_exists(spark, written):
        return spark.read.schema(MANIFEST_SCHEMA).parquet(written).distinct()
    return _lying(spark, path)


def _lying(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as the names of folders tell it; the files are listed, not opened."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)

    def value(name: str) -> Column:
        found = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        return F.when(found != "", F.try_url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))

    key = F.coalesce(value("code"), value("folder"), F.lit(GOLD_KEY))
    named = files.select(key.alias("key"), value("period").alias("period"), folder.alias("folder"))
    return named.filter("period IS NOT NULL").distinct()


def _land_new(rows: DataFrame, path: str, key: Column, period: str, folders: Sequence[str], write) -> None:
    """Write the rows whose key has nothing of the period yet, then note them down. A landing
    that was cut off before its note is done again: it replaces what it had written."""
    spark = rows.sparkSession
    root = path.rstrip("/")
    if not path_exists(spark, f"{root}/{MANIFEST}"):
        _lying(spark, path).write.mode("append").parquet(f"{root}/{MANIFEST}")
    done = manifest(spark, path).filter(F.col("period") == period).select(F.col("key").alias("_key"))
    fresh = settle(rows.withColumn("_key", key).join(done.distinct(), "_key", "left_anti"))
    placed = fresh.withColumn("period", F.lit(period))
    write(placed.drop("_key").hint("rebalance", *folders[:1]).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy(*folders))
    _note(placed, path, F.col("_key"), folders)


def _note(placed: DataFrame, path: str, key: Column, folders: Sequence[str]) -> None:
    root = path.rstrip("/")
    names = [F.concat(F.lit(f"/{c}="), F.col(f"`{c}`").cast("string")) for c in folders]
    notes = placed.select(key.alias("key"), "period", F.concat(F.lit(root), *names).alias("folder"))
    notes.distinct().write.mode("append").parquet(f"{root}/{MANIFEST}")


def land_documents(documents: DataFrame, path: str, period: str) -> None:
    """Append documents as JSON lines under ``code=…/period=…``, or under ``period=…`` where
    they have no code. The rows of a folder are gathered first, so it gets few files; a large
    folder is split."""
    folders = ["code", "period"] if "code" in documents.columns else ["period"]
    placed = documents.withColumn("period", F.lit(period))
    placed.hint("rebalance", folders[0]).write.mode("append").partitionBy(*folders).json(path)
    if path_exists(documents.sparkSession, f"{path.rstrip('/')}/{MANIFEST}"):
        _note(placed, path, F.col("code") if "code" in folders else F.lit(GOLD_KEY), folders)


def land_new_documents(documents: DataFrame, path: str, period: str) -> None:
    """``land_documents`` for the codes that have nothing of the period yet; a second run
    adds nothing. Documents without a code, those of gold, are one key together."""
    coded = "code" in documents.columns
    key, folders = (F.col("code"), ["code", "period"]) if coded else (F.lit(GOLD_KEY), ["period"])
    _land_new(documents, path, key, period, folders, lambda writer: writer.json(path))


def land_bars(rows: DataFrame, path: str, ticker: str = "ticker") -> None:
    """Append bars as CSV with a header under one safely named folder per ticker."""
    placed = rows.withColumn("folder", safe_symbol(F.col(ticker))).hint("rebalance", "folder")
    placed.write.mode("append").partitionBy("folder").option("header", True).csv(path)


def land_new_bars(rows: DataFrame, path: str, period: str, ticker: str = "ticker") -> None:
    """Bars of the tickers that have nothing of the period, the name of a run, yet, as CSV
    with a header under ``folder=…/period=…``; a second run adds nothing."""
    placed = rows.withColumn("folder", safe_symbol(F.col(ticker)))
    _land_new(placed, path, F.col("folder"), period, ["folder", "period"], lambda w: w.option("header", True).csv(path))


def landed(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The partition values present under ``path``, from the names of its files, which are
    listed but not opened."""
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    found = {k: F.regexp_extract("path", f"/{k}=([^/]*)/", 1) for k in keys}
    values = [F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))).alias(k) for k, c in found.items()]
    return files.filter(reduce(and_, (c != "" for c in found.values()))).select(*values).distinct()


def not_landed(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(present, list(keys), "left_anti")
