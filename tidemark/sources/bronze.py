"""Landed rate documents, gold quotes and bar files as rows.

Schemas are explicit, so a number keeps its type whatever else is in the scan and no
extra pass infers anything. JSON is read in FAILFAST mode: a malformed document is an
error, not a document without rates. So is a pattern that no file matches, and a bar file
whose header is not one of bars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scale import lookup_join, lookup_side
from tidemark.schemas import (
    API_BARS,
    GOLD_DOCUMENT,
    RATE_DOCUMENT,
    SPREAD_DOCUMENT,
    TABLE_SNAPSHOT,
    BarLayout,
)
from tidemark.session import settle
from tidemark.sources.files import matching
from tidemark.sources.records import file_lines, json_lines, look_at, open_brackets, quotes, whole_records

Paths = str | Sequence[str]

def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def json_options(reader, schema: T.StructType, only: str | None, multiline: bool):
    """The settings shared by batch and stream readers of documents."""
    reader = reader.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST")
    return reader.option("pathGlobFilter", only) if only else reader


def _code_of(file: Column) -> Column:
    """The code that a file's folder names, as the landing writes it."""
    named = F.regexp_extract(file, r"/code=([^/]+)/", 1)
    # The path is part of a URL, and a folder's name is escaped once more.
    return F.when(named != "", F.try_url_decode(F.try_url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))))


def read_documents(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    only: str | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """Documents of files that hold one a line, some over several lines, or both. With
    ``multiline=False`` all files hold one a line: that saves a look at their brackets.

    A document ends where all its brackets are closed, outside strings; brackets are summed
    per file and per block of it, and the names of files stay with the data. The code of a
    folder is the code of documents without one.
    """
    if multiline is False:
        return json_options(spark.read, schema, only, False).json(_paths(paths))
    lines = json_lines(spark, _paths(paths), only)
    depth, closed = open_brackets(F.col("value")), lambda depth: depth == 0
    texts = whole_records(lines, look_at(lines, depth, closed), depth, closed)
    coded = "code" in schema.fieldNames()
    extra = [_code_of(F.col("file")).alias("_code")] if coded else []
    # The generator keeps the parse in one place. A document by itself is an array of one.
    parsed = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})
    rows = texts.select(*extra, F.inline(parsed))
    columns = {"code": F.coalesce("code", "_code").alias("code")} if coded else {}
    return rows.select(*[columns.get(n, F.col(f"`{n}`")) for n in schema.fieldNames()])


def batch_paths(spark: SparkSession, paths: Paths, prefix: str, batch: str) -> list[str]:
    """Patterns of where the documents of one batch lie: files named by prefix and batch,
    and folders of the period as the landing writes them. None at all is an error."""
    wanted = []
    for path in _paths(paths):
        root = path.rstrip("/")
        for pattern in (f"{root}/{prefix}{batch}.json", f"{root}/code=*/period={batch}", f"{root}/period={batch}"):
            wanted += [pattern] if matching(spark, pattern) else []
    if not wanted:
        raise FileNotFoundError(f"nothing has landed for {prefix}{batch} in {paths}")
    return wanted


def read_batch(
    spark: SparkSession, paths: Paths, schema: T.StructType, prefix: str, batch: str
) -> DataFrame:
    """All documents of one batch, of whichever form, in one scan of what its patterns name;
    the code of a folder is the code of its documents."""
    return read_documents(spark, batch_paths(spark, paths, prefix, batch), schema)


def read_rates(
    spark: SparkSession, paths: Paths, only: str | None = None, multiline: bool | None = None
) -> DataFrame:
    """Mid-rate documents of one or more folders; ``only`` is a file name pattern such
    as ``rate_*_2025-01-03.json``. Files may hold documents over several lines, or one a
    line; ``multiline=False`` says that all are of the second form."""
    return read_documents(spark, paths, RATE_DOCUMENT, only, multiline)


def read_spreads(
    spark: SparkSession, paths: Paths, only: str | None = None, multiline: bool | None = None
) -> DataFrame:
    return read_documents(spark, paths, SPREAD_DOCUMENT, only, multiline)


def read_gold(
    spark: SparkSession, paths: Paths, only: str | None = None, multiline: bool | None = None
) -> DataFrame:
    return read_documents(spark, paths, GOLD_DOCUMENT, only, multiline)


def read_snapshot(spark: SparkSession, paths: Paths, multiline: bool | None = None) -> DataFrame:
    """Snapshots of a whole table, of which only the effective date is read."""
    return read_documents(spark, paths, TABLE_SNAPSHOT, None, multiline)


def parse_documents(texts: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Documents that arrive as a text column.

    The generator keeps the parse in one place. As a plain projection the optimizer
    would repeat it for every field read and for the test that drops empty arrays.
    """
    parsed = F.from_json(column, schema, {"mode": "FAILFAST"})
    return texts.select(F.inline(F.array(parsed)))


def read_bars(spark: SparkSession, paths: Paths, layout: BarLayout) -> DataFrame:
    """Bar files that all have the header of ``layout``; another header is an error,
    where matching by position would shift every value."""
    return (
        spark.read.schema(layout.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .csv(_paths(paths))
        .select(*layout.needed)
    )


# The names a column of bars may have. The date has three: "price" stands over the dates
# of history files.
BAR_NAMES = {
    "symbol": ("ticker", "symbol"),
    "date": ("date", "price"),
    "open": ("open",),
    "high": ("high",),
    "low": ("low",),
    "close": ("close",),
    "volume": ("volume",),
}


# A CSV record of which no cell has a comma between quotes: before each comma quotes are paired.
_NO_QUOTED_COMMA = '^(?:[^",]|"[^",]*+")*+(?:,(?:[^",]|"[^",]*+")*+)*+$'


def _raw_cells(line: Column) -> Column:
    """The cells of a CSV record as they stand, with blanks and quotes."""
    cells = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit('("(?:[^"]|"")*+"|[^,]*),'), F.lit(1))
    plain = ~line.contains('"') | line.rlike(_NO_QUOTED_COMMA)
    return F.when(plain, F.split(line, ",", -1)).otherwise(cells)


def _bare(cell: Column) -> Column:
    """A cell without the blanks and the quotes around it."""
    bare = F.trim(cell)
    inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
    return F.when(bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1), inner).otherwise(bare)


def read_mixed_bars(spark: SparkSession, paths: Paths) -> DataFrame:
    """Bar files whose headers differ in order, in quotes or in extra columns, as text
    columns of the vendor layout. Every record is read by the header of its own file: the
    first line that is not blank. A quoted cell may hold line breaks. A file whose header
    names no date or no close is an error.
    """
    lines = file_lines(spark, _paths(paths))
    marks, closed = quotes(F.col("value")), lambda n: n % 2 == 0
    # The least place is a number, so that the look sorts no lines; the headers take a second one.
    blocks = look_at(lines, marks, closed, F.min("at").alias("top"))
    tops = blocks.groupBy("file").agg(F.min_by("top", "block").alias("at"))
    told = lines.join(lookup_side(tops.select("at")), "at").select("file", F.col("value").alias("header"))
    names = F.transform(_raw_cells(F.col("header")), lambda n: F.lower(F.trim(_bare(n))))
    told = settle(told.select("file", "header", names.alias("names")))
    lacking = [~F.arrays_overlap("names", F.array(*map(F.lit, BAR_NAMES[k]))) for k in ("date", "close")]
    wrong = [r.file for r in told.filter(lacking[0] | lacking[1]).select("file").limit(20).collect()]
    if wrong:
        raise ValueError(f"no header of bars in {', '.join(wrong)}")

    def place(aliases: Sequence[str]) -> Column:
        found = [F.array_position("names", a).cast("int") for a in aliases]
        return F.coalesce(*[F.when(p > 0, p - 1) for p in found])

    # Places are looked up once a file: in the rows they would make code too long to compile.
    wanted = API_BARS.needed
    places = settle(told.select("file", "header", *(place(BAR_NAMES[n]).alias(n) for n in wanted)))
    records = whole_records(lines, blocks, marks, closed)
    rows = lookup_join(records, places, "file").filter(F.col("value") != F.col("header"))
    # The generators keep the parse in one place, as each of the columns looks into the cells.
    cells = rows.select(*wanted, F.explode(F.array(_raw_cells(F.col("value")))).alias("cells"))
    values = F.struct(*(_bare(F.get("cells", F.col(n))).alias(n) for n in wanted))
    texts = cells.select(F.inline(F.array(values)))
    return texts.select(*(F.when(F.col(n) != "", F.col(n)).alias(n) for n in wanted))
