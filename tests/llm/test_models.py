"""Language and quality: accuracy on what was held out, and odd rows."""

import zlib

from pyspark.sql import functions as F

from tidemark.llm import language, quality
from tidemark.llm.common import held_out

SF = "/root/testdata/sf0.01"


def out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_is_crc_of_the_id(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == out(r.id) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(held_out(F.col("id"))).first()[0] is False


def test_language_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language.op1_string_kernel_language(spark, SF).collect()
    assert len(rows) == len(docs) and all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in tested) / len(tested) > 0.97


def test_language_of_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_language(docs)
    rows = [(1, None, "a", 1.0), (2, "", "a", 1.0), (3, "12 ?! ²", "a", 1.0), (4, "the " * 100000, "a", 1.0), (4, "the", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, LANG_PRED string, score double")
    found = language.identify(df, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    named = [(r.doc_id, r.lang_pred) for r in found.orderBy("doc_id").collect()]
    assert named == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert language.identify(df.limit(0), model).collect() == []


def test_language_sample_takes_equal_texts_once(spark, monkeypatch):
    """Whichever of the texts a third of all rows hold, the sample keeps its bound."""
    read, whole = [], language.in_arrow
    monkeypatch.setattr(language, "in_arrow", lambda df, *rest: (read.append(df.select("text").collect()), whole(df, *rest))[1])
    rows = [(f"hot text {k}", "en") for k in range(30) for _ in range(40)]
    model = language.fit_language(spark.createDataFrame(rows, "text string, lang string"), each=400)
    assert model.languages == ("en",)
    assert sorted(r.text for r in read[0]) == sorted({t for t, _ in rows})


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "..", "en")], "doc_id long, text string, lang string")
    model = language.fit_language(df)
    assert model.languages == ()
    assert {r.lang_pred for r in language.identify(df, model).collect()} == {"und"}


def test_presence_in_slices_is_presence_of_the_whole(monkeypatch):
    import numpy as np

    text = "The quick brown fox, über alles! " * 50
    flags = np.zeros(language.FEATURES, bool)
    whole = language.presence(text, flags).tolist()
    monkeypatch.setattr(language, "SLICE", 7)
    assert language.presence(text, flags).tolist() == whole
    assert not flags.any()


def test_quality_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = quality.op10_compression_quality(spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in labels]
    good = [r.predicted for r in tested if labels[r.doc_id] == 1]
    bad = [r.predicted for r in tested if labels[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.96 and sum(bad) / len(bad) < 0.15


def test_quality_of_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit_quality(docs, labels.union(labels))
    assert model.good and 0.5 < model.prior < 1
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (3, "word " * 200000, 5), (3, "word", None)], "doc_id long, text string, Score int")
    found = quality.score_quality(df, model)
    assert found.columns == ["doc_id", "text", "score"]
    scores = [r.score for r in found.orderBy("doc_id", "text").collect()]
    assert len(scores) == 4 and scores[0] == scores[1] == model.prior
    assert quality.score_quality(df.limit(0), model).collect() == []


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (4, "other text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_quality(docs, none).prior == 1.0
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (4, 7)], "doc_id long, quality int")
    assert quality.fit_quality(docs, odd) == quality.QualityModel(1.0)
    both = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    scored = quality.score_quality(docs, quality.fit_quality(docs, both)).collect()
    assert all(0 <= r.score <= 1 for r in scored)


def test_whole_text_counts():
    good, bad = quality.QualityModel(0.5, b"good words here " * 50, b"bad # % junk ###" * 50).compressors()
    data = b"good words here " * 400 + b"bad # % junk ###" * 4000
    head = quality.difference(quality.blocks_of(data[:6400]), good, bad)[0]
    assert head > 0 > quality.difference(quality.blocks_of(data), good, bad)[0]


def test_no_language_is_left_out(spark):
    rows = [(f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 3} " * 20, f"l{i}") for i in range(300)] * 2
    model = language.fit_language(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 300


def test_too_many_languages_are_an_error(spark):
    import pytest

    rows = [(f"some text {i}", f"l{i}") for i in range(1100)]
    with pytest.raises(ValueError, match="1024"):
        language.fit_language(spark.createDataFrame(rows, "text string, lang string"))


def test_a_small_language_is_learned_beside_large_ones(spark):
    rows = [(f"the quick brown fox {i} jumps", "en") for i in range(3000)] + [("ein kleiner brauner hund", "de")]
    model = language.fit_language(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ("de", "en")


def test_sums_of_weights_do_not_depend_on_their_parts(monkeypatch):
    import numpy as np

    source = np.random.default_rng(1)
    model = language.LanguageModel(("a", "b", "c"), source.normal(size=(language.FEATURES, 3)).astype(np.float32))
    texts = ["some words of a text", None, "", "x", "longer words " * 50]
    flags = np.zeros(language.FEATURES, bool)
    whole = model.predict(texts, flags)
    monkeypatch.setattr(language, "PICKED", 12)
    names, scores = model.predict(texts, flags)
    assert names == whole[0] and np.allclose(scores, whole[1])


def test_a_row_that_repeats_is_fitted_once(spark):
    docs = [(i, f"good words number {i} and more of them. " * 30) for i in range(0, 40)]
    docs += [(i, f"BAD!!! {i} buy $$$ " * 30) for i in range(40, 80)]
    labels = [(i, int(i < 40)) for i in range(80)]
    repeated = docs + [docs[1]] * 500 + [(1, "another text")]
    models = [
        quality.fit_quality(spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
        for d in (docs, docs + [docs[1]] * 500)
    ]
    assert models[0] == models[1]
    many = quality.fit_quality(spark.createDataFrame(repeated, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert many.curve is not None
