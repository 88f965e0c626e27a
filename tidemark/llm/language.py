"""Language identification with a string kernel.

The kernel of two texts is that of their presence vectors: one entry for every distinct
run of `1` to `N_MAX` characters (a blended spectrum), 1 if the run occurs, the vector
scaled to length 1. Runs are hashed into `FEATURES` entries, so a text's vector has a
bounded size.

Kernel ridge regression of one language against the rest is done in the Nystroem space of
`LANDMARKS` sample texts: with C the kernel of all sample texts and landmarks and M that of
the landmarks, the dual weights A solve (C'C + ridge M) A = C'Y. A text x with presence row
p scores p L' A, where L holds the landmarks' rows. Since matrix products associate,
L' A (`FEATURES` x languages) is computed once and a batch of texts takes one product of
its presence rows with it, whatever the number of landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, in_arrow, row_hash, table
from tidemark.llm.sampling import least_of_each

N_MAX = 4
FEATURES = 1 << 16
#: Sample texts of a language, and of all languages, at most; and landmarks among them.
FIT_TEXTS, FIT_MOST, LANDMARKS = 300, 1500, 256
#: Weights that are summed at a time, over all languages.
PICKED = 1 << 20
RIDGE = 1e-2
UNDETERMINED = "und"
#: Characters that are hashed at a time.
SLICE = 1 << 16
# A multiplier for each place of a run and for its length; any odd numbers do.
_PLACE = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(text: str, flags: np.ndarray) -> np.ndarray:
    """Features of a text, in ascending order. `flags` are FEATURES zeros, and are again.

    Case is folded to lower. A long text is hashed in slices that overlap by N_MAX - 1.
    """
    folded = text.lower()
    for start in range(0, max(1, len(folded) - N_MAX + 1), SLICE):
        codes = np.frombuffer(folded[start : start + SLICE + N_MAX - 1].encode("utf-32-le"), np.uint32)
        run = np.zeros(len(codes), np.uint32)
        for n in range(1, N_MAX + 1):
            if len(codes) < n:
                break
            run = run[: len(codes) - n + 1] + codes[n - 1 :] * _PLACE[n - 1]
            mixed = run * np.uint32(0x2C1B3C6D + 2 * n)
            mixed ^= mixed >> np.uint32(15)
            flags[(mixed * np.uint32(0x297A2D39)) >> np.uint32(16)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


@dataclass(frozen=True)
class LanguageModel:
    """Weights of all features for each language; empty if nothing was learned."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def predict(self, texts: list[str | None], flags: np.ndarray) -> tuple[list[str], list[float]]:
        rows = [presence(t, flags) if has_letter(t) and self.languages else None for t in texts]
        sizes = np.array([0 if r is None else len(r) for r in rows])
        named, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not sizes.any():
            return named, scores
        # The product of the sparse 0/1 rows with the weights: sums of the weights' rows, of
        # which some thousands are taken at a time.
        full = np.flatnonzero(sizes)
        features = np.concatenate([r for r in rows if r is not None])
        owner = np.repeat(np.arange(len(full)), sizes[full])
        margins = np.zeros((len(full), len(self.languages)), np.float64)
        step = max(1, PICKED // len(self.languages))
        for start in range(0, len(features), step):
            part = owner[start : start + step]
            begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            margins[part[begins]] += np.add.reduceat(self.weights[features[start : start + step]], begins, axis=0)
        margins /= np.sqrt(sizes[full])[:, None]
        best = margins.argmax(axis=1)
        for at, k, margin in zip(full, best, margins[np.arange(len(full)), best], strict=True):
            named[at] = self.languages[k]
            # Targets were 1 for the language and -1 for the rest.
            scores[at] = float(min(1.0, max(0.0, (1 + margin) / 2)))
        return named, scores


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(FEATURES, bool)
    for batch in batches:
        found = [presence(t, flags).astype(np.uint16).tobytes() for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["found", "lang", "place"]
        )


def fit_language(df: DataFrame, text: str = "text", lang: str = "lang", each: int = FIT_TEXTS) -> LanguageModel:
    """Model from the labelled rows of `df`: up to `each` texts of every language and about
    `FIT_MOST` in all, of the least hashes; one of every language at least. More than 1024
    languages are an error. Equal texts of a language
    count as one, however many there are. What comes to the driver is, for each of them,
    its features, 128 KB at most. Null languages and texts without letters are not learned
    from. Without any labelled text the model knows no language.
    """
    labelled = df.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Counted and chosen by their hashes; of equal texts, which share one, one row is read.
    place = row_hash(labelled, "language")
    hashes = labelled.select("lang", place.alias("place")).distinct()
    few, sizes = least_of_each(hashes, "lang", each, F.col("place"), FIT_MOST)
    if not sizes:
        return LanguageModel((), np.zeros((FEATURES, 0), np.float32))
    # The hashes of a bounded sample; `first` keeps one text for each in every task.
    few = few.withColumnRenamed("place", "wanted").withColumnRenamed("lang", "of")
    chosen = labelled.withColumn("place", place).join(
        F.broadcast(few), (F.col("place") == F.col("wanted")) & (F.col("lang") == F.col("of")), "left_semi"
    )
    chosen = chosen.groupBy("lang", "place").agg(F.first("text").alias("text")).select("text", "lang", "place")
    rows = in_arrow(chosen, _sample_rows, "found binary, lang string, place long").collect()
    rows.sort(key=lambda r: (r.place, r.lang))
    languages = tuple(sorted({r.lang for r in rows}))
    matrix = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        features = np.frombuffer(bytes(r.found), np.uint16)
        matrix[i, features] = 1 / np.sqrt(max(1, len(features)))
    targets = np.array([[1.0 if r.lang == k else -1.0 for k in languages] for r in rows])
    share = max(1, LANDMARKS // len(languages))
    taken: dict[str, int] = {}
    marks = []
    for i, r in enumerate(rows):
        taken[r.lang] = taken.get(r.lang, 0) + 1
        if taken[r.lang] <= share:
            marks.append(i)
    landmarks = matrix[marks]
    cross = (matrix @ landmarks.T).astype(np.float64)
    inner = (landmarks @ landmarks.T).astype(np.float64)
    # Every language weighs the same, however few texts it has.
    counts = {k: sum(r.lang == k for r in rows) for k in languages}
    weight = np.array([len(rows) / len(languages) / counts[r.lang] for r in rows])[:, None]
    jitter = 1e-8 * np.eye(len(marks))
    dual = np.linalg.solve(cross.T @ (weight * cross) + RIDGE * inner + jitter, cross.T @ (weight * targets))
    return LanguageModel(languages, (landmarks.T.astype(np.float64) @ dual).astype(np.float32))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`df` with `lang_pred` and `score`, which replace columns of these names.

    `und` with score 0 if the text is null or empty or has no letter, or nothing was
    learned. Nothing but the text is read. Whole texts, batch by batch: for each text the
    features are bounded, and so is the slice of it that is hashed at a time.
    """
    at = df.columns.index(text)
    rest = [i for i, c in enumerate(df.columns) if c.lower() not in ("lang_pred", "score")]
    schema = (
        df.select(*[f"`{df.columns[i]}`" for i in rest])
        .withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)})
        .schema
    )
    step = 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(FEATURES, bool)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                named, scores = model.predict(batch.column(at).to_pylist(), flags)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in rest], pa.array(named, pa.string()), pa.array(scores, pa.float64())],
                    [*[batch.schema.names[i] for i in rest], "lang_pred", "score"],
                )

    return in_arrow(df, run, schema)


def op1_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three fourths of them."""
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs.filter(~held_out(F.col("doc_id"))))
    named = identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
