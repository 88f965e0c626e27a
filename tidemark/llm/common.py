"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir, scratch_path
from tidemark.sources.files import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Rows, and bytes, of an Arrow batch: texts can be long, and a batch is held several times.
BATCH = {"maxRecordsPerBatch": 1000, "maxBytesPerBatch": 8 << 20}


def in_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` with batches that are small enough for long texts; where the session
    asks for smaller ones, these stay."""
    conf = df.sparkSession.conf
    for name, most in BATCH.items():
        now = conf.get(f"spark.sql.execution.arrow.{name}", None)
        digits = (now or "").rstrip("b")
        if not digits.isdigit() or not 0 < int(digits) <= most:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Return to the system what a task took: its worker lives on, idle, beside those of
    later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def row_hash(df: DataFrame, *salts: int | str) -> Column:
    """64 bits of all columns of a row; columns that hold maps have no hash and are left out."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return F.xxhash64(*[F.lit(s) for s in salts], *plain)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def unit(bits: Column) -> Column:
    """A hash as a number of [0, 1), from its upper 53 bits."""
    return F.shiftrightunsigned(bits, 11).cast("double") * F.lit(2.0**-53)


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed once into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Has Spark remove the shuffle files of a query when it ends, not when the driver happens to
#: collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is made and computed inside leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that `stored` made; it can't be read any more."""
    for path in df.inputFiles()[:1]:
        remove(df.sparkSession, path.rpartition("/")[0])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once into a table below the checkpoint folder that `dropped` can
    delete as soon as nothing reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The fourth of the rows that nothing is learned from; a row without id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with these columns at the end; they replace columns of the same name, in any case."""
    taken = {name.lower() for name in columns}
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*rest, *[c.alias(name) for name, c in columns.items()])


def keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`df` with `_node`, a number that tells its documents apart in joins.

    It is the id where no id is null or names two texts; otherwise a hash of id and text.
    Rows with equal id and text are one document, however often they are repeated.
    """
    label, both = F.col(f"`{doc_id}`"), _document(doc_id, text)
    return df.withColumn("_node", label.cast("long") if ids_tell(df, doc_id, text) else both)


def _document(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.lit("node"), F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def ids_tell(df: DataFrame, doc_id: str, text: str) -> bool:
    """Whether no id is null or names two texts."""
    both = _document(doc_id, text)
    each = df.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.min(both).alias("low"), F.max(both).alias("high"))
    return not each.filter(F.col("id").isNull() | (F.col("low") != F.col("high"))).limit(1).count()
