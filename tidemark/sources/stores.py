"""Where the fact tables live: Parquet folders, or tables behind JDBC.

Both stores have the same methods, so a load runs against either.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, replace
from datetime import date
from functools import reduce
from typing import Protocol

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import one_per_key
from tidemark.operators.incremental import RATES_START, watermark, watermark_per_key
from tidemark.schemas import FactTable
from tidemark.session import settle
from tidemark.sources.files import matching, move, path_exists, remove


@dataclass(frozen=True)
class LoadResult:
    """What one load did to one table. ``n_no_key`` rows came without a key and were not
    stored; in ``n_misfit`` rows a value did not fit its type and was stored as NULL."""

    dataset: str
    status: str
    n_rows: int = 0
    min_date: date | None = None
    max_date: date | None = None
    error: str | None = None
    n_no_key: int = 0
    n_misfit: int = 0


AUDIT_SCHEMA = (
    "dataset string, status string, n_rows bigint, min_date date, max_date date, error string, "
    "n_no_key bigint, n_misfit bigint"
)


def audit_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return spark.createDataFrame([asdict(r) for r in results], AUDIT_SCHEMA)


class FactStore(Protocol):
    spark: SparkSession

    def exists(self, fact: FactTable) -> bool: ...

    def read(
        self, fact: FactTable, since: date | None = None, until: date | None = None
    ) -> DataFrame: ...

    def watermark(self, fact: FactTable, default: date = RATES_START) -> DataFrame: ...

    def watermark_per_key(self, fact: FactTable) -> DataFrame: ...

    def proxy_watermark(self, fact: FactTable, value: str, default: date) -> DataFrame: ...

    def overwrite(self, rows: DataFrame, fact: FactTable) -> LoadResult: ...

    def append(
        self, rows: DataFrame, fact: FactTable, seen: DataFrame | None = None
    ) -> LoadResult: ...


def conform(rows: DataFrame, fact: FactTable) -> DataFrame:
    """The columns of the table in its order and types, whichever scale came in."""
    return rows.select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fact.schema.fields)
    )


def _dated(rows: DataFrame, column: str, since: date | None, until: date | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(F.col(column) >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col(column) <= F.lit(until))
    return rows


class _Watched:
    """Row count and date range taken by the write itself, so nothing is read twice."""

    def __init__(self, rows: DataFrame, fact: FactTable):
        self.fact = fact
        self.seen = Observation()
        self.rows = rows.observe(
            self.seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.min(fact.date_column).alias("min_date"),
            F.max(fact.date_column).alias("max_date"),
        )

    def result(self) -> LoadResult:
        seen = self.seen.get
        status = "LOADED" if seen["n_rows"] else "EMPTY"
        return LoadResult(self.fact.name, status, **seen)


@dataclass
class ParquetStore:
    """Facts as Parquet folders partitioned by the year of their date.

    Beside each table lies its newest date per series, which appends keep up to date. A
    table is replaced by one that is written aside first: what fails then leaves it as it
    was, and a replacement that is cut off between its two moves is taken back.
    """

    spark: SparkSession
    root: str

    def _below(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def path(self, fact: FactTable) -> str:
        return self._below(fact.name)

    def _replaced(self, fact: FactTable) -> str:
        return self._below("_replaced", fact.name)

    def exists(self, fact: FactTable) -> bool:
        if path_exists(self.spark, self.path(fact)):
            return True
        if path_exists(self.spark, self._replaced(fact)):
            move(self.spark, self._replaced(fact), self.path(fact))
            return True
        return False

    def _partitioned(self, fact: FactTable) -> DataFrame:
        year = T.StructField(fact.partition_column, T.IntegerType())
        schema = T.StructType([*fact.schema.fields, year])
        if self.exists(fact):
            return self.spark.read.schema(schema).parquet(self.path(fact))
        return self.spark.createDataFrame([], schema)

    def read(
        self, fact: FactTable, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """The table, empty if it was never written. A date range also prunes the year
        partitions."""
        rows = self._partitioned(fact)
        if since is not None:
            rows = rows.filter(F.col(fact.partition_column) >= since.year)
        if until is not None:
            rows = rows.filter(F.col(fact.partition_column) <= until.year)
        rows = _dated(rows, fact.date_column, since, until)
        return rows.select(*fact.schema.fieldNames())

    def watermark(self, fact: FactTable, default: date = RATES_START) -> DataFrame:
        """The newest date lies in the newest year: of the other partitions only their
        names are looked at, not their columns."""
        rows = self._partitioned(fact)
        newest = rows.agg(F.max(fact.partition_column)).scalar()
        return watermark(
            rows.filter(F.col(fact.partition_column) == newest), fact.date_column, default
        )

    def watermark_per_key(self, fact: FactTable) -> DataFrame:
        """The marks that are kept; without any, those of the whole table."""
        written = self._marks(fact)
        if written is None:
            return watermark_per_key(self.read(fact), fact.series, fact.date_column)
        key = T.StructField(fact.series, fact.schema[fact.series].dataType)
        schema = T.StructType([key, T.StructField("watermark", T.DateType())])
        return self.spark.read.schema(schema).parquet(written[-1])

    def proxy_watermark(self, fact: FactTable, value: str, default: date) -> DataFrame:
        chosen = self.watermark_per_key(fact).filter(F.col(fact.series) == value)
        return watermark(chosen, "watermark", default)

    def _marks(self, fact: FactTable) -> list[str] | None:
        """Versions of the marks, oldest first; one without its last file isn't whole."""
        whole = matching(self.spark, self._below("_marks", fact.name, "v*", "_SUCCESS"))
        return sorted(path.rpartition("/")[0] for path in whole) or None

    def rebuild_marks(self, fact: FactTable) -> None:
        """The marks of the whole table, of which two columns are read."""
        self._put_marks(watermark_per_key(self.read(fact), fact.series, fact.date_column), fact)

    def _put_marks(self, marks: DataFrame, fact: FactTable) -> None:
        # A reader of the version before may still be at work, so that one stays.
        old = self._marks(fact) or []
        number = int(old[-1].rpartition("/v")[2]) + 1 if old else 1
        marks.hint("rebalance").write.mode("overwrite").parquet(self._below("_marks", fact.name, f"v{number:012d}"))
        for version in old[:-1]:
            remove(self.spark, version)

    def overwrite(self, rows: DataFrame, fact: FactTable) -> LoadResult:
        """Written aside, then put in place of the table; the marks are made anew."""
        aside = self._below("_next", f"{fact.name}-{uuid.uuid4().hex}")
        try:
            result = self._write(rows, fact, aside, "errorifexists")
        except Exception:
            remove(self.spark, aside)
            raise
        remove(self.spark, self._below("_marks", fact.name))
        if self.exists(fact):
            remove(self.spark, self._replaced(fact))
            move(self.spark, self.path(fact), self._replaced(fact))
        move(self.spark, aside, self.path(fact))
        remove(self.spark, self._replaced(fact))
        self.rebuild_marks(fact)
        return result

    def append(
        self, rows: DataFrame, fact: FactTable, seen: DataFrame | None = None
    ) -> LoadResult:
        """Rows are added, and the marks raised by ``seen``: rows whose keys are all stored
        now. Without these, or without marks, the marks are made anew. Marks that an append
        didn't get to raise are too low, which only asks for rows again."""
        result = self._write(rows, fact, self.path(fact), "append")
        if seen is None or self._marks(fact) is None:
            self.rebuild_marks(fact)
        else:
            raised = watermark_per_key(seen, fact.series, fact.date_column)
            both = self.watermark_per_key(fact).unionByName(raised)
            self._put_marks(watermark_per_key(both, fact.series, "watermark"), fact)
        return result

    def replace_years(self, rows: DataFrame, fact: FactTable, seen: DataFrame) -> LoadResult:
        """``rows`` in place of all stored rows of their years; other years stay. ``seen``
        raises the marks as it does in ``append``."""
        years = {"partitionOverwriteMode": "dynamic"}
        result = self._write(rows, fact, self.path(fact), "overwrite", **years)
        both = self.watermark_per_key(fact).unionByName(
            watermark_per_key(seen, fact.series, fact.date_column)
        )
        self._put_marks(watermark_per_key(both, fact.series, "watermark"), fact)
        return result

    def put_rejected(self, rows: DataFrame, fact: FactTable) -> None:
        rows.write.mode("append").parquet(self._below("_rejected", fact.name))

    def rejected(self, fact: FactTable) -> DataFrame:
        """What loads with ``keep_rejected`` did not store as it came: see ``append_new``."""
        path = self._below("_rejected", fact.name)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], REJECTED_SCHEMA)
        return self.spark.read.schema(REJECTED_SCHEMA).parquet(path)

    def _write(
        self, rows: DataFrame, fact: FactTable, path: str, mode: str, **options: str
    ) -> LoadResult:
        # The rebalance gathers the rows of a year into few files and still splits a
        # large year. Sorting by key keeps the ranges of row groups narrow, so a filter
        # on one instrument skips most of them. The metrics are taken after the shuffle:
        # only the tasks of a result stage are sure to be counted once.
        placed = (
            conform(rows, fact)
            .withColumn(fact.partition_column, F.year(fact.date_column))
            .hint("rebalance", fact.partition_column)
            .sortWithinPartitions(fact.partition_column, *fact.keys)
        )
        watched = _Watched(placed, fact)
        writer = watched.rows.write.mode(mode).options(**options).partitionBy(fact.partition_column)
        writer.parquet(path)
        return watched.result()


# SQL states of a table that does not exist (PostgreSQL; the standard class).
MISSING_TABLE_STATES = {"42P01", "42S02"}


def table_missing(spark: SparkSession, error: Exception) -> bool:
    """Whether a SQL error among the causes says that the table does not exist."""
    gateway = spark.sparkContext._gateway
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if is_instance_of(gateway, cause, "java.sql.SQLException"):
            if cause.getSQLState() in MISSING_TABLE_STATES:
                return True
        cause = cause.getCause()
    return False


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def max_date_query(
    table: str, date_column: str, key: str | None = None, value: str | None = None
) -> str:
    """A derived table that lets the database compute a watermark: of the table, of one
    key (``value``), or of every key."""
    maximum = f"MAX({date_column}) AS watermark"
    if key is None:
        return f"(SELECT {maximum} FROM {table}) sub"
    if value is None:
        return f"(SELECT {key}, {maximum} FROM {table} GROUP BY {key}) sub"
    return f"(SELECT {maximum} FROM {table} WHERE {key} = {quoted(value)}) sub"


def bounds_query(table: str, date_column: str) -> str:
    """A derived table of one row: the first and the last date of the table."""
    return f"(SELECT MIN({date_column}) AS low, MAX({date_column}) AS high FROM {table}) sub"


@dataclass
class JdbcStore:
    """Facts as database tables. ``options`` holds url, user, password and driver.

    Reads are split over ``partitions`` connections by date; a bound that is not given is
    asked from the database. Writes use at most that many connections.
    """

    spark: SparkSession
    options: Mapping[str, str]
    partitions: int = 8
    batch_size: int = 10_000
    column_types: Mapping[str, str] = field(default_factory=dict)

    def read_options(
        self, fact: FactTable, since: date | None = None, until: date | None = None
    ) -> dict[str, str]:
        options = {**self.options, "dbtable": fact.name}
        if since is not None and until is not None and since < until:
            options |= {
                "partitionColumn": fact.date_column,
                "lowerBound": since.isoformat(),
                "upperBound": until.isoformat(),
                "numPartitions": str(self.partitions),
            }
        return options

    def write_options(self, fact: FactTable) -> dict[str, str]:
        options = {
            **self.options,
            "dbtable": fact.name,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.partitions),
        }
        if fact.name in self.column_types:
            options["createTableColumnTypes"] = self.column_types[fact.name]
        return options

    def _stored(self, options: Mapping[str, str]) -> DataFrame | None:
        try:
            return self.spark.read.format("jdbc").options(**options).load()
        except (Py4JJavaError, PySparkException) as error:
            if not table_missing(self.spark, error):
                raise
            return None

    def _load(self, options: Mapping[str, str], missing: T.StructType | str) -> DataFrame:
        stored = self._stored(options)
        return self.spark.createDataFrame([], missing) if stored is None else stored

    def exists(self, fact: FactTable) -> bool:
        return self._stored(self.read_options(fact)) is not None

    def read(
        self, fact: FactTable, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        low, high = since, until
        if low is None or high is None:
            query = bounds_query(fact.name, fact.date_column)
            bounds = self._load({**self.options, "dbtable": query}, "low date, high date").first()
            if bounds is not None:
                low, high = low or bounds["low"], high or bounds["high"]
        rows = self._load(self.read_options(fact, low, high), fact.schema)
        return _dated(rows, fact.date_column, since, until)

    def watermark(self, fact: FactTable, default: date = RATES_START) -> DataFrame:
        query = max_date_query(fact.name, fact.date_column)
        return self._marks(query, default)

    def proxy_watermark(self, fact: FactTable, value: str, default: date) -> DataFrame:
        query = max_date_query(fact.name, fact.date_column, fact.series, value)
        return self._marks(query, default)

    def _marks(self, query: str, default: date) -> DataFrame:
        marks = self._load({**self.options, "dbtable": query}, "watermark date")
        return watermark(marks, "watermark", default)

    def watermark_per_key(self, fact: FactTable) -> DataFrame:
        query = max_date_query(fact.name, fact.date_column, fact.series)
        return self._load(
            {**self.options, "dbtable": query}, f"{fact.series} string, watermark date"
        )

    def overwrite(self, rows: DataFrame, fact: FactTable) -> LoadResult:
        return self._write(rows, fact, "overwrite")

    def append(
        self, rows: DataFrame, fact: FactTable, seen: DataFrame | None = None
    ) -> LoadResult:
        return self._write(rows, fact, "append")

    def _write(self, rows: DataFrame, fact: FactTable, mode: str) -> LoadResult:
        watched = _Watched(conform(rows, fact), fact)
        options = self.write_options(fact)
        watched.rows.write.format("jdbc").options(**options).mode(mode).save()
        return watched.result()


def _faults(fact: FactTable) -> tuple[Column, Column]:
    """Whether a row lacks a key, and whether another of its values doesn't fit its type."""
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fact.schema.fields}

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    no_key = any_of([typed[k].isNull() for k in fact.keys])
    misfit = any_of([F.col(n).isNotNull() & c.isNull() for n, c in typed.items() if n not in fact.keys])
    return no_key, misfit


class _Counted:
    """A batch, and counts of the rows that a load rejects in whole or in part, taken when
    it is computed."""

    def __init__(self, batch: DataFrame, fact: FactTable):
        no_key, misfit = _faults(fact)
        self.counts = (F.count_if(no_key).alias("n_no_key"), F.count_if(~no_key & misfit).alias("n_misfit"))
        self.batch, self.seen = batch, Observation()
        self.rows = batch.observe(self.seen, *self.counts)

    def of(self, result: LoadResult, some: bool) -> LoadResult:
        """The result with the counts. Unless the load had ``some`` rows to go on with,
        adaptive execution may have dropped the part of the plan that counts; then the batch
        is counted by itself."""
        seen = self.seen.get if some else self.batch.agg(*self.counts).first().asDict()
        return replace(result, **seen)


def _range(rows: DataFrame, fact: FactTable) -> tuple[date | None, date | None]:
    return tuple(rows.agg(F.min(fact.date_column), F.max(fact.date_column)).first())


def append_new(
    store: FactStore, batch: DataFrame, fact: FactTable, keep_rejected: bool = False
) -> LoadResult:
    """Append the rows whose key the table lacks; a second run adds nothing.

    The batch is computed once. Of the table only the key columns and the dates the
    batch spans are read; the first load has nothing to compare with and goes straight
    through. Two loads of one table must not run at the same time: the test and the
    append are separate steps. With ``keep_rejected`` each row of the batch is either
    stored or among the store's ``rejected`` rows.
    """
    if keep_rejected:
        return _append_or_reject(store, batch, fact)
    counted = _Counted(batch, fact)
    single = one_per_key(conform(counted.rows, fact).dropna(subset=list(fact.keys)), fact.keys)
    if not store.exists(fact):
        result = store.append(single, fact)
        return counted.of(result, result.n_rows > 0)
    single = settle(single)
    first, last = _range(single, fact)
    if first is None:
        return counted.of(LoadResult(fact.name, "EMPTY"), first is not None)
    held = store.read(fact, first, last).select(*fact.keys).distinct()
    fresh = single.join(held, list(fact.keys), "left_anti")
    return counted.of(store.append(fresh, fact, single), True)


REJECTED_SCHEMA = "load string, reason string, stored boolean, row string"


def _append_or_reject(store: ParquetStore, batch: DataFrame, fact: FactTable) -> LoadResult:
    """``append_new`` that keeps what it doesn't store, as JSON with the reason: `no key`;
    `held`, the table has the key; `repeated`, the batch has a row of the key that sorts
    later. A row that is stored without a value that didn't fit is kept, too, as `misfit`.
    """
    names, keys = fact.schema.fieldNames(), list(fact.keys)
    no_key, misfit = _faults(fact)
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]), {"ignoreNullFields": "false"})
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fact.schema.fields]
    marks = [raw.alias("row"), no_key.alias("_no_key"), misfit.alias("_misfit"), F.monotonically_increasing_id().alias("_row")]
    judged = settle(batch.select(*typed, *marks))
    values = sorted(set(names) - set(keys))
    single = settle(one_per_key(judged.filter("NOT _no_key").select(*names, "_row"), keys, prefer=values))
    first, last = _range(single, fact)
    known = store.exists(fact)
    fresh = single
    if known and first is not None:
        held = store.read(fact, first, last).select(*keys).distinct()
        fresh = settle(single.join(held, keys, "left_anti"))
    stored = store.append(fresh.select(*names), fact, single if known else None)

    # Which key of the batch was stored, and by which of its rows.
    taken = fresh.select(*keys, F.col("_row").alias("_taken"))
    told = judged.join(taken, keys, "left").withColumn("stored", F.coalesce(F.col("_taken") == F.col("_row"), F.lit(False)))
    held_back = F.when(F.col("_taken").isNull(), "held").otherwise("repeated")
    reason = F.when(F.col("_no_key"), "no key").when(~F.col("stored"), held_back).when(F.col("_misfit"), "misfit")
    rejected = told.withColumn("reason", reason).filter("reason IS NOT NULL")
    load = F.lit(uuid.uuid4().hex).alias("load")
    store.put_rejected(rejected.select(load, "reason", "stored", "row"), fact)
    counts = judged.agg(F.count_if("_no_key").alias("n_no_key"), F.count_if(F.expr("NOT _no_key AND _misfit")).alias("n_misfit"))
    return replace(stored, **counts.first().asDict())


def upsert_greatest(store: ParquetStore, batch: DataFrame, fact: FactTable) -> LoadResult:
    """Store of every key the row that sorts last, be it a stored one or one of the batch.

    So the table is the same however rows were cut into batches. Only the years in which
    a row is new or greater are written again.
    """
    counted = _Counted(batch, fact)
    keys, names = list(fact.keys), fact.schema.fieldNames()
    single = settle(one_per_key(conform(counted.rows, fact).dropna(subset=keys), keys))
    first, last = _range(single, fact)
    if first is None:
        return counted.of(LoadResult(fact.name, "EMPTY"), first is not None)
    if not store.exists(fact):
        result = store.append(single, fact)
        return counted.of(result, result.n_rows > 0)
    rank = F.struct(*sorted(set(names) - set(keys)))
    held = one_per_key(store.read(fact, first, last), keys).select(*keys, rank.alias("_held"))
    greater = F.col("_held").isNull() | (rank > F.col("_held"))
    fresh = settle(single.join(held, keys, "left").filter(greater).select(*names))
    n_rows, low, high = fresh.agg(F.count("*"), F.min(fact.date_column), F.max(fact.date_column)).first()
    if not n_rows:
        return counted.of(LoadResult(fact.name, "EMPTY"), first is not None)
    years = fresh.select(F.year(fact.date_column).alias("_year")).distinct()
    stored = store.read(fact, date(low.year, 1, 1), date(high.year, 12, 31))
    touched = stored.withColumn("_year", F.year(fact.date_column)).join(years, "_year", "left_semi")
    left = touched.select(*names).join(fresh.select(*keys), keys, "left_anti")
    # Settled, as the years that are read are those that are replaced.
    store.replace_years(settle(left.unionByName(fresh)), fact, fresh)
    return counted.of(LoadResult(fact.name, "LOADED", n_rows, low, high), True)
