"""The stages of the pipeline, each against brute force on what the one before kept."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_duplicates import classes_by_hand, repeats_by_hand, windows_by_hand
from tidemark.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{i}")
        found.append(spark.read.parquet(f"{folder}/{i}"))
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_return_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near copies", "repeated passages", "benchmark", "tokens"]
    assert all(df.schema.names == stages[0].schema.names for df in stages[1:5])
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:5])


def test_quality_keeps_what_scores_well(spark, stages):
    model = quality.fit_quality(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scored = quality.score_quality(stages[0], model).collect()
    assert dict(rows(stages[1])) == {r.doc_id: r.text for r in scored if r.score >= 0.7}


def test_one_of_each_class_stays(stages):
    wanted = {i for i, (_, least) in classes_by_hand(rows(stages[1])).items() if i == least}
    assert dict(rows(stages[2])) == {i: t for i, t in rows(stages[1]) if i in wanted}


def test_repeats_are_cut(stages):
    wanted = repeats_by_hand(rows(stages[2]), 20)
    before = dict(rows(stages[2]))
    assert dict(rows(stages[3])) == {i: kept if gone else before[i] for i, (_, gone, kept) in wanted.items()}
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_documents_with_test_windows_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = windows_by_hand(rows(stages[3]), items)
    assert dict(rows(stages[4])) == {i: t for i, t in rows(stages[3]) if not found[i][1]}


def test_tokens_are_the_library_s(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(rows(stages[4]))
    found = stages[5].collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_run_is_all_stages_in_turn(spark, stages):
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert found == {r.doc_id: r.ids for r in stages[5].collect()}


def test_odd_and_empty_tables(spark, stages):
    schema = stages[0].schema
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "One word", "en", "s", 8), (2, "One word", "en", "s", 8)]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(odd, schema)):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            assert made.count() <= docs.count()
