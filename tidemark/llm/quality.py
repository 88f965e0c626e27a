"""Quality scores by compression.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts
labelled bad. A text that resembles the good ones compresses better with the good
dictionary. The difference of the two compressed sizes, over the size of the text, becomes
a probability by a logistic curve fitted on labelled texts that trained no dictionary. A
short text gives little evidence: the size it is divided by is never under `SMOOTH`, and
the curve has a second term for shortness.

A dictionary helps most at the start of a frame, before the text itself has filled the
window, so a text is compressed in blocks of `BLOCK` bytes and the sizes are added up: the
whole text counts, evenly. Memory is one block, whatever the length.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, in_arrow, table
from tidemark.llm.sampling import stratified

BLOCK = 2048
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
#: Labelled documents of each label that are learned from at most, and the blocks, spread
#: evenly over a document, that it gives to the fit at most.
FIT_DOCUMENTS, FIT_BLOCKS = 2000, 8
ACCEPT = 0.7
#: Bytes added to the size of a text.
SMOOTH = 256


def blocks_of(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    return (data[i : i + size] for i in range(0, len(data), size))


@dataclass(frozen=True)
class QualityModel:
    """Without both dictionaries every text gets `prior`; so does an empty one."""

    prior: float
    good: bytes | None = None
    bad: bytes | None = None
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def compressors(self) -> tuple:
        made = []
        for raw in (self.good, self.bad):
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    dict_data=words, level=LEVEL, write_content_size=False,
                    write_checksum=False, write_dict_id=False,
                )
            )
        return tuple(made)

    def score(self, found: tuple[float, float] | None) -> float:
        if found is None or self.good is None:
            return self.prior
        x = self.curve[0] * found[0] + self.curve[1] * found[1] + self.curve[2]
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def difference(blocks: Iterable[bytes], good, bad) -> tuple[float, float] | None:
    """Bytes that the bad dictionary needs more than the good one, for each byte of text;
    and the shortness of the text, from 1 down to 0. None if there is no text."""
    more = size = 0
    for block in blocks:
        more += len(bad.compress(block)) - len(good.compress(block))
        size += len(block)
    return (more / (size + SMOOTH), SMOOTH / (size + SMOOTH)) if size else None


def _fit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels, turns = (batch.column(i).to_pylist() for i in range(3))
        chosen = []
        for text in texts:
            data = (text or "").encode()
            starts = range(0, len(data), BLOCK)
            step = max(1, math.ceil(len(starts) / FIT_BLOCKS))
            chosen.append([data[i : i + BLOCK] for i in starts[::step]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(turns, pa.int64()), pa.array(chosen, pa.list_(pa.binary()))],
            ["label", "turn", "blocks"],
        )


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Factors of the two columns and offset, by Newton's method; a small ridge keeps
    separable labels finite."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    rows = np.column_stack([x / scale, np.ones(len(x))])
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-3, 1e-6]) * weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -60, 60)))
        gradient = rows.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve(rows.T @ (rows * (weight * p * (1 - p))[:, None]) + ridge, gradient)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale[0]), float(beta[1] / scale[1]), float(beta[2])


def fit_quality(documents: DataFrame, labels: DataFrame, each: int = FIT_DOCUMENTS) -> QualityModel:
    """Model from documents (`doc_id`, `text`) and labels (`doc_id`, `quality` 0 or 1).

    Rows that `held_out` names are not learned from, nor are ids whose labels disagree,
    other label values, or nulls. At most about `each` documents of each label are read,
    of each at most `FIT_BLOCKS` blocks; that much comes to the driver (64 MB with the
    defaults). Half of them, by a hash of the id, train the dictionaries, the others the
    curve, weighted to the labels' shares in the whole table. Of an id with several rows one
    text is read, that of the least hash. If a label has too few texts
    for a dictionary, every score is the prior, (good + 1) / (labelled + 1).
    """
    sure = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("most"))
        .filter(F.col("label") == F.col("most"))
        .select("doc_id", "label")
    )
    chosen, sizes = stratified(sure, "label", each, F.xxhash64(F.lit("quality"), "doc_id"), 2 * each)
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 1)
    if not (sizes.get(0) and sizes.get(1)):
        return QualityModel(prior)
    # The ids of a bounded sample: about 2 * each rows of two numbers.
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    turn = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("turn")
    found = in_arrow(
        rows.select("text", "label", turn), _fit_blocks, "label int, turn long, blocks array<binary>"
    ).collect()
    found.sort(key=lambda r: (r.label, r.turn, r.blocks))
    words = {}
    for label in (0, 1):
        samples = [bytes(b) for r in found if r.label == label and r.turn == 0 for b in r.blocks]
        try:
            words[label] = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            # Too few or too short samples: their bytes themselves serve as dictionary.
            words[label] = b"".join(samples)[-DICTIONARY_BYTES:]
        if len(words[label]) < 8:
            return QualityModel(prior)
    rough = QualityModel(prior, words[1], words[0])
    good, bad = rough.compressors()
    fitted = [(difference(map(bytes, r.blocks), good, bad), r.label) for r in found if r.turn == 1 and r.blocks]
    y = np.array([label for _, label in fitted], dtype=float)
    if len(set(y)) < 2:
        return QualityModel(prior)
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    curve = _logistic(np.array([found for found, _ in fitted]), y, weight / weight.mean())
    return QualityModel(prior, words[1], words[0], curve)


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """`df` with the column `score`, which replaces one of that name.

    A null or empty text gets the prior. Rows stay in their tasks, one Arrow batch at a
    time; all other columns pass unchanged.
    """
    at = df.columns.index(text)
    rest = [i for i, c in enumerate(df.columns) if c.lower() != score.lower()]
    schema = df.select(*[f"`{df.columns[i]}`" for i in rest]).withColumn(score, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = model.compressors() if model.good is not None else (None, None)
        for batch in batches:
            found = []
            for value in batch.column(at):
                data = value.as_py() if value.is_valid else None
                if data and good is not None:
                    found.append(model.score(difference(blocks_of(data.encode()), good, bad)))
                else:
                    found.append(model.prior)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in rest], pa.array(found, pa.float64())],
                [*[batch.schema.names[i] for i in rest], score],
            )

    return in_arrow(df, run, schema)


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels of the fourth that is held out are never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
