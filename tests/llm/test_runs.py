"""Periodic runs against a search of all periods, and what the automaton tells of one text."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.runs import LastSeen, _stretches, periodic_runs, runs_of, with_planted_runs


def every_run(words, least, times):
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q))
            if length >= max(least, times * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, letters = rng.randint(0, 50), rng.choice([1, 2, 2, 3, 5])
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (5, 3)])
def test_runs_are_those_of_all_periods(least, times):
    rng = random.Random(least * 10 + times)
    for _ in range(1500):
        words = some_words(rng)
        assert runs_of(words, least, times) == every_run(words, least, times), words


def test_earlier_ends_are_longest_common_suffixes():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.randrange(3) for _ in range(30)]
        automaton = LastSeen()
        for i, word in enumerate(words, 1):
            told = dict(automaton.append(word))
            common = {}
            for j in range(1, i):
                n = 0
                while n < j and words[j - 1 - n] == words[i - 1 - n]:
                    n += 1
                common[j] = n
            # An end is told of if no later one has as long a suffix in common.
            wanted = {j: n for j, n in common.items() if n and all(common[k] < n for k in range(j + 1, i))}
            assert told == wanted


def test_stretches_are_apart_and_few():
    rng = random.Random(5)
    words = [b"%d" % rng.randrange(200) for _ in range(3000)]
    words[1000:1400] = (words[1000:1050] * 8)[:400]
    ids = [int(w) for w in words]
    import numpy as np

    parts = _stretches(np.array(ids), 6, 4)
    assert sum(b - a for a, b in parts) < 600
    assert all(x[1] <= y[0] for x, y in zip(parts, parts[1:]))
    assert runs_of(words) == every_run(words, 6, 4) != []


def test_long_text_of_one_word_and_of_one_period():
    assert runs_of([b"a"] * 30_000) == [(0, 30_000, 1)]
    words = [b"%d" % i for i in range(5_000)] * 6
    assert runs_of(words) == [(0, 30_000, 5_000)]


def test_edge_rows(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \t\n ", "x"),
        (4, "a a a a a a", "x"),
        (4, "a a a a a a", "x"),
        (None, "b b b b b b b b b b b b z", None),
        (5, "a b a b a b a b c d c d c d c d", "x"),
        (6, "a a a a a", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, Runs string")
    out = periodic_runs(df)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "strongest", "collapsed"]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
                 for r in out.collect())
    assert got == [
        (0, 7, [(0, 6, 1)], (0, 6, 1), "b b z"),
        (1, 0, [], None, ""),
        (2, 0, [], None, ""),
        (3, 0, [], None, ""),
        (4, 6, [(0, 6, 1)], (0, 6, 1), "a"),
        (4, 6, [(0, 6, 1)], (0, 6, 1), "a"),
        (5, 16, [(0, 8, 2), (8, 8, 2)], (0, 8, 2), "a b c d"),
        (6, 5, [], None, "a a a a a"),
    ]
    assert periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, times=1)


def test_clashing_columns_and_other_text_name(spark):
    df = spark.createDataFrame([(1, "q q q q q q", 5, 6, 7)], "_text long, body string, row int, n_words int, _ int")
    row = periodic_runs(df, text="body").first().asDict()
    assert row["_text"] == 1 and row["row"] == 5 and row["_"] == 7 and row["n_words"] == 6 and row["collapsed"] == "q"


def test_planted_runs_follow_the_ids(spark):
    import zlib

    rows = [(i, " ".join(str(j) for j in range(i % 90))) for i in range(400)] + [(None, "a b"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r, (doc_id, text) in zip(with_planted_runs(df).orderBy(F.monotonically_increasing_id()).collect(), rows):
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        words, g = (text or "").split(), h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        assert (r.text or "").split() == words
