"""Removal of passages that occur before, by difference-cover anchors.

A window is `window` consecutive words of a document; it is a repeat if the same words also
start at a smaller (document, position). To find repeats, runs of fewer words are hashed at
some positions only: those whose remainder modulo a period is in a difference cover. For
any two positions there is a shift below the period that takes both into the cover. So two
equal windows share a run that is hashed at both places, as long as a run and a shift fit
in the window together. Runs that occur once are then out; around each of the others the
windows that hold it are hashed whole, and the first place of each hash is found.

Of a few hundred thousand places a task hands on one for each hash; the others are known to
be repeats at once. So a passage that a third of all documents share sends few rows.
Of texts that are equal as a whole only the first is looked at: all windows of the others
start earlier in it, and so does whatever else they could be compared with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ids_tell, in_arrow, keyed, kept, table
from tidemark.llm.words import Hasher, gathered, mix, new_key, signed, words_of

WINDOW = 20
#: Perfect difference sets. Every remainder is a difference of two members.
COVERS = {1: [0], 3: [0, 1], 7: [0, 1, 3], 13: [0, 1, 3, 9]}
#: Anchor runs shorter than this would match by chance too often.
LEAST_RUN = 4


def cover_for(window: int) -> tuple[int, np.ndarray, int]:
    """Period, which remainders are in its cover, and the words of an anchor run."""
    period = max((p for p in COVERS if window - p + 1 >= min(LEAST_RUN, window)), default=1)
    marks = np.zeros(period, bool)
    marks[COVERS[period]] = True
    return period, marks, window - period + 1


def _in_turn(hashes: np.ndarray, *place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries to hand on, each place of a hash once, and whether no smaller place has
    their hash; later columns of a place decide last. A place is there twice if its row is."""
    turn = np.lexsort((*reversed(place), hashes))
    first = np.ones(len(turn), bool)
    first[1:] = hashes[turn[1:]] != hashes[turn[:-1]]
    new = first.copy()
    for p in place:
        new[1:] |= p[turn[1:]] != p[turn[:-1]]
    return turn[new], first[new]


def _own_key(hashes: np.ndarray, known: np.ndarray, *place: np.ndarray) -> np.ndarray:
    """Hashes to group by: what is known already gets a key of its own, so it is spread."""
    other = np.full(len(hashes), 0x51ED270B, np.uint64)
    for p in place:
        other = mix(other ^ p.astype(np.int64).view(np.uint64))
    return np.where(known, other, hashes)


def anchors(docs: DataFrame, window: int, secret: bytes) -> DataFrame:
    """Anchor runs of all documents: `key`, `_node`, `spot`: its word times two, plus 1 if
    the task has just seen the run more than once."""
    period, marks, length = cover_for(window)

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        by_key = Hasher(secret)
        for batch in batches:
            nodes = np.asarray(batch.column(2)).astype(np.int64)
            for w in words_of(batch.column(3), by_key):
                hashes, starts = w.runs(length)
                owner = w.owner()[starts]
                at = starts - w.first[owner]
                chosen = marks[at % period] & (w.counts[owner] >= window)
                yield hashes[chosen], nodes[w.row + owner[chosen]], at[chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, node, at in gathered(found_in(batches)):
            chosen, first = _in_turn(hashes, node, at)
            hashes, node, at = hashes[chosen], node[chosen], at[chosen]
            _, back, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            several = counts[back] > 1
            key = _own_key(hashes, several & ~first, node, at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(node), pa.array(at * 2 + several)], ["key", "_node", "spot"]
            )

    return in_arrow(docs.select("row", "_id", "_node", "text"), run, "key long, _node long, spot long")


def windows(near: DataFrame, window: int, order: list[str], secret: bytes) -> DataFrame:
    """Windows that hold an anchor of `spots`: `key`, the columns of `order` (`_id` and
    `_node`, or `_node` alone where that is the id) and `spot`: the first word times two,
    plus 1 if the task has just seen an earlier one."""
    period, _, _ = cover_for(window)
    names = ["key", *order, "spot"]

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        by_key = Hasher(secret)
        for batch in batches:
            ids, nodes = (np.asarray(batch.column(i)).astype(np.int64) for i in (1, 2))
            spots = batch.column(4)
            for w in words_of(batch.column(3), by_key):
                hashes, starts = w.runs(window)
                wanted = np.zeros(len(w.hashes) + 1, np.int32)
                rows = len(w.first) - 1
                part = spots.slice(w.row, rows)
                owner = np.repeat(np.arange(rows), np.asarray(part.value_lengths()))
                at = np.asarray(part.flatten()).astype(np.int64)
                # A window from `at - period + 1` to `at` can hold the anchor, in its text.
                np.add.at(wanted, w.first[owner] + np.maximum(at - period + 1, 0), 1)
                np.add.at(wanted, w.first[owner] + at + 1, -1)
                near_one = np.cumsum(wanted)[starts] > 0
                starts = starts[near_one]
                owner = w.owner()[starts]
                yield hashes[near_one], ids[w.row + owner], nodes[w.row + owner], starts - w.first[owner]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, label, node, start in gathered(found_in(batches)):
            # A repeated row gives its places twice, of which none is earlier.
            chosen, first = _in_turn(hashes, label, node, start)
            hashes, label, node, start = hashes[chosen], label[chosen], node[chosen], start[chosen]
            known = ~first
            key = _own_key(hashes, known, label, node, start)
            out = {"key": signed(key), "_id": label, "_node": node, "spot": start * 2 + known}
            yield pa.RecordBatch.from_arrays([pa.array(out[c]) for c in names], names)

    return in_arrow(
        near.select("row", "_id", "_node", "text", "spots"), run, ", ".join(f"{c} long" for c in names)
    )


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).cast(pa.binary()).to_pylist()
            repeats = batch.column(names.index("repeats")).to_pylist()
            copies = batch.column(names.index("copy")).to_pylist()
            counts, removed, left = [], [], []
            for text, starts, copy in zip(texts, repeats, copies, strict=True):
                words = (text or b"").split()
                counts.append(len(words))
                if copy and len(words) >= window:
                    words = []
                elif starts:
                    gone = np.zeros(len(words) + 1, np.int32)
                    # A row repeated over tasks gives its starts twice, which covers the same words.
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, np.asarray(starts) + window, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    words = [x for x, out in zip(words, gone.tolist(), strict=True) if not out]
                removed.append(counts[-1] - len(words))
                left.append(b" ".join(words))
            rest = [i for i, n in enumerate(names) if n not in ("repeats", "copy")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in rest], pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())],
                [*[names[i] for i in rest], "n_words", "n_removed", "kept"],
            )

    return run


def repeated_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`df` with `n_words`, `n_removed` and `kept`, the words that stay, joined by one blank.

    A word goes if a window that covers it repeats. Windows are judged on the texts as
    given. `doc_id` must be of an integer type; a null id comes before all others. Rows
    with equal id and text are one document and all get its result; texts of one id are
    ordered by a hash. Null texts have no words; texts shorter than a window lose none. An
    empty table gives no rows. Columns named like the three results are replaced, others
    pass unchanged.
    """
    new = ("n_words", "n_removed", "kept")
    others = [c for c in df.columns if c.lower() not in (*new, text.lower())]
    plain = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                      F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63))).alias("_id"),
                      F.col(f"`{text}`").alias("text"))
    # Whoever reads texts reads all four columns, so that one shuffle of them serves all.
    order = ["_node"] if ids_tell(plain, "_id", "text") else ["_id", "_node"]
    docs = keyed(plain, "_id", "text").select("row", "_id", "_node", "text")
    whole = F.unhex(F.sha2("text", 256))
    firsts = docs.groupBy(whole).agg(F.min(F.struct("_id", "_node")).alias("f")).select("f._node")
    copies = kept(docs.select("_node").distinct().join(firsts, "_node", "left_anti"))
    # An outer join, as an anti join would be moved below the shuffle that others read.
    again = docs.join(copies.withColumn("copy", F.lit(True)), "_node", "left").filter("copy IS NULL")
    secret = new_key()
    found = anchors(again, window, secret)
    times = F.count("*").over(Window.partitionBy("key"))
    live = found.withColumn("times", times).filter((F.col("spot") % 2 == 1) | (F.col("times") > 1))
    spots = live.groupBy("_node").agg(F.collect_list(F.shiftright("spot", 1)).alias("spots"))
    near = docs.join(spots, "_node")
    known = F.col("spot") % 2 == 1
    # Dealt out here, as the window would have its structs made first and send them along.
    places = windows(near, window, order, secret).repartition("key").withColumn("place", F.struct(*order, "spot"))
    first = F.min(F.when(~known, F.col("place"))).over(Window.partitionBy("key"))
    repeats = places.withColumn("first", first).filter(known | (F.col("place") > F.col("first")))
    repeats = repeats.groupBy("_node").agg(F.collect_list(F.shiftright("spot", 1)).alias("repeats"))
    marks = repeats.withColumn("copy", F.lit(False)).unionByName(
        copies.select("_node", F.lit(None).cast("array<bigint>").alias("repeats"), F.lit(True).alias("copy"))
    )
    joined = docs.join(marks, "_node", "left")
    schema = joined.select("row", "_id", "_node", "text").withColumns(
        {"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}
    ).schema
    done = in_arrow(joined.select("row", "_id", "_node", "text", "repeats", "copy"), _cut(window), schema)
    columns = [c for c in df.columns if c.lower() not in new]
    back = [F.col("text").alias(c) if c.lower() == text.lower() else F.col(f"row.`{c}`") for c in columns]
    return done.select(*back, *new)


def op7_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that go from all documents, and a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = repeated_words(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20
), h AS (
  SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS s FROM p
), r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM h
  ) WHERE n > 1
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r
), x AS (
  SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id
), k AS (
  SELECT d.doc_id, w, coalesce(gone, []) AS gone,
    [w[j] FOR j IN range(1, len(w) + 1) IF gone IS NULL OR NOT list_contains(gone, j)] AS kept
  FROM d LEFT JOIN x ON x.doc_id = d.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""
