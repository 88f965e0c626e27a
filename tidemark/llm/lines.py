"""Lines that many documents share, kept once.

Lines are exploded with their positions and hashed by their keys: the line without white
space at its ends, A to Z in lower case. Of each hash the documents that hold it are
counted. Where there are enough, all its lines go but those of the largest id. What goes
comes back to a document as positions, and the text is put together again without them.

Keys are told apart by 256 bits of SHA-2, so no two lines are taken as equal that differ.
Documents are counted from one row per (hash, id), which spreads a line that a third of all
documents hold over all tasks; each task then sends one row per hash it saw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table
from tidemark.operators.scale import lookup_join

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: White space at the ends of a line: blank, and tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _places(docs: DataFrame, least_chars: int) -> DataFrame:
    """`_id`, `_text` (a hash), `hash`, `pos` of every line whose key is long enough."""
    lines = docs.select("_id", "_text", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    # The generator keeps the key in one place: it is tested and hashed.
    keys = lines.select("_id", "_text", "pos", F.explode(F.array(line_key(F.col("line")))).alias("key"))
    long = keys.filter(F.char_length("key") >= least_chars)
    return long.select("_id", "_text", F.unhex(F.sha2("key", 256)).alias("hash"), "pos")


def shared_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """`df` with `n_lines`, `n_dropped` and `kept`, the lines that stay, joined by \\n.

    A key of at least `least_chars` code points that occurs in at least `least_documents`
    documents loses all its lines except in the largest `doc_id` that holds it, which keeps
    them all. Documents are told apart by their ids, which must be of an integer type: rows
    of one id count as one document, whatever their texts, and a null id comes before all
    others. A null or empty text is one empty line. An empty table gives no rows. Columns
    named like the three results are replaced, others pass unchanged.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    label = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63)))
    value = F.col(f"`{text}`")
    docs = df.select(row, label.alias("_id"), F.xxhash64(value).alias("_text"), value.alias("text"))
    places = _places(docs, least_chars)
    held = places.select("hash", "_id").distinct()
    counts = held.groupBy("hash").agg(F.count("*").alias("documents"), F.max("_id").alias("last"))
    shared = kept(counts.filter(F.col("documents") >= least_documents).select("hash", "last"))
    # Rows repeated with equal id and text give each position again.
    lost = lookup_join(places, shared, "hash").filter(F.col("_id") < F.col("last"))
    gone = lost.groupBy("_id", "_text").agg(F.collect_set("pos").alias("gone"))
    joined = docs.join(gone, ["_id", "_text"], "left").withColumn("lines", split_lines(F.col("text")))
    places_left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.transform(places_left, lambda p: F.get("lines", p))
    made = {
        "n_lines": F.size("lines").cast("long"),
        "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        "kept": F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(left, "\n")),
    }
    others = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in made]
    done = joined.select("row", *[c.alias(name) for name, c in made.items()])
    return done.select(*others, *made)


def op13_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that go from all documents, and a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
), k AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.*, c.last IS NOT NULL AND doc_id <> c.last AS gone FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
