import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.bpe import Bpe, decode, encode, fingerprints, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as file:
    BPE = Bpe(file.read())


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert list(BPE.encode(text)) == ids
    assert BPE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    chunks = list(BPE.chunks(text))
    assert sum(c[0] for c in chunks) == len(ids)
    assert " ".join(c[1] for c in chunks) == " ".join(map(str, ids))
    assert " ".join(c[2] for c in chunks) == BPE.decode(ids)


@pytest.mark.parametrize(
    "text",
    ["", "  ", "a", "it's they'Ll 12.5 .. !!", "Wörld ΑΣ ß İ é é", "<|endoftext|>x<|startoftext|> <|endoftext",
     "\x1ca\x1fb\x85c　d e", "日本語 한국어 👩‍👩‍👧 ½Ⅷ٣²", "힣가"],
)
def test_like_the_library(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    same(text)


def test_windows_of_long_runs():
    source = random.Random(3)
    for alphabet, size in (("aehinotrs", 7000), ("th", 5000), ("!?.=", 4000), ("é", 3000), ("a", 6000)):
        same("".join(source.choice(alphabet) for _ in range(size)))
    assert BPE.lookahead * 4 <= BPE.window < 7000


def test_slices_of_long_texts():
    source = random.Random(4)
    words = ["the", "Thing.", "ofthesernt", "écoute,", "12", "<|endoftext|>"]
    same(" ".join(source.choice(words) for _ in range(40000)))


def test_many_texts_a_few_words_ahead(monkeypatch):
    import tidemark.llm.bpe as module

    monkeypatch.setattr(module, "AHEAD", 300)
    monkeypatch.setattr(module, "REMEMBERED", 40)
    source = random.Random(5)
    alphabet = "aehinorst" * 4 + "é日'.,7"
    words = ["".join(source.choice(alphabet) for _ in range(n)) for n in range(1, 90) for _ in range(3)]
    words += ["é" * n for n in (31, 32, 33, 40, 64, 65)] + ["日" * 22, "<|endoftext|>", "\t\n"]
    texts = [None, "", " ", *(" ".join(source.choices(words, k=n)) for n in (1, 2, 40, 400, 3, 0, 90)), "a"]
    found = [[] for _ in texts]
    BPE.forget()
    for row, ids in BPE.ids_of(texts):
        assert len(ids)
        found[row] += ids.tolist()
    assert found == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]
    data = [w.encode() for w in words if len(w.encode()) <= module.LONGEST]
    alone = [[*(BPE.inner[b] for b in w[:-1]), BPE.final[w[-1]]] for w in data]
    many = [np.frombuffer(ids, np.int32).tolist() for ids in BPE.merge_many(data)]
    assert many == [BPE.merge(ids) for ids in alone] and BPE.merge_many([]) == []


def test_readable_text_comes_back():
    text = "the thing's über 12 日本 end"
    pieces = re.sub(r"\s+", " ", "".join(BPE.text(BPE.encode(text)))).strip()
    assert pieces.replace(" ", "") == text.replace(" ", "")
    # A character whose bytes are spread over tokens comes out whole, a broken one marked.
    assert "".join(BPE.text([BPE.inner[0xC3], BPE.inner[0xA9]])) == "é"
    assert "".join(BPE.text([BPE.inner[0xC3]])) == "�"


def test_columns(spark):
    rows = [(1, "Hello there", "x", 7), (1, "Hello there", "x", 7), (2, None, None, None), (None, "", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Ids string, n_tokens int")
    words = vocabulary(spark, PATH)
    done = decode(encode(df, words), words)
    assert done.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    found = sorted((r.text or "", r.ids, r.decoded) for r in done.collect())
    ids = LIBRARY.encode("Hello there", add_special_tokens=False).ids
    assert found == [("", [], "")] * 2 + [("Hello there", ids, "hello</w> there</w>")] * 2
    assert fingerprints(df, words).columns == ["doc_id", "text", "Ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert fingerprints(df.limit(0), words).collect() == []


def test_query_like_the_library(spark):
    from hashlib import sha256

    from tidemark.llm.bpe import op6_streaming_bpe

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op6_streaming_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == sha256(text.encode()).hexdigest()


def test_every_mark_as_the_library_orders_it():
    import sys
    import unicodedata

    marks = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M"]
    assert len(marks) > 2000 and "࢘" in BPE.odd_marks and "́" not in BPE.odd_marks
    for c in marks:
        for text in (f"a{c}̣", f"á{c}", f"é{c}ͅ x{c}̴", unicodedata.normalize("NFD", f"b{c}া")):
            ids = LIBRARY.encode(text, add_special_tokens=False).ids
            assert list(BPE.encode(text)) == ids, ascii(text)


def test_every_letter_as_the_library_has_it():
    import sys
    import unicodedata

    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if unicodedata.category(c) not in ("Cn", "Cs") and (c.lower() != c or unicodedata.decomposition(c)):
            text = f"x{c}1 {unicodedata.normalize('NFD', c)}"
            assert list(BPE.encode(text)) == LIBRARY.encode(text, add_special_tokens=False).ids, hex(i)
