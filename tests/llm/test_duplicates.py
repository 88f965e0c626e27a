"""Repeated passages, similar documents, benchmark windows, near vectors, components:
against brute force on small tables."""

import random
import re
import threading
import time
from contextlib import suppress
from pathlib import Path

import numpy as np
import pytest

from tidemark.llm import decontaminate, graph, ngrams, substrings, vectors

DOCS = "doc_id long, text string, Kept string, key int"


def corpus(seed, many=60, vocabulary=9, longest=60):
    """Texts of few words, with copies, near copies and shared passages."""
    source = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(27)]
    for _ in range(many):
        kind = source.random()
        if kind < 0.25 and texts:
            words = list(source.choice(texts))
            for _ in range(source.randint(0, 3)):
                if words:
                    words[source.randrange(len(words))] = source.choice(["x", "y"])
        else:
            words = [f"w{source.randrange(vocabulary ** 3)}" for _ in range(source.randint(0, longest))]
            if kind > 0.6:
                words[source.randint(0, len(words)) : 0] = passage[: source.randint(15, 27)]
        texts.append(words)
    return texts


def rows_of(texts):
    rows = [(i, " ".join(w), "k", i) for i, w in enumerate(texts)]
    odd = [(1000, None, None, None), (1001, "", "k", 1), (1002, " \t\n", "k", 1), (1003, "One two\x0bthree", "k", 1)]
    return rows + odd


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeats_by_hand(rows, window):
    seen, gone = set(), {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        found = words(text)
        out = set()
        for i in range(len(found) - window + 1):
            run = tuple(found[i : i + window])
            if run in seen:
                out |= set(range(i, i + window))
            seen.add(run)
        gone[doc_id] = (len(found), len(out), " ".join(w for i, w in enumerate(found) if i not in out))
    return gone


@pytest.mark.parametrize(("seed", "window"), [(1, 20), (2, 20), (3, 5), (4, 12)])
def test_repeats(spark, seed, window):
    rows = rows_of(corpus(seed))
    source = random.Random(seed)
    rows += [(2000, " ".join(source.choice("ab") for _ in range(80)), "k", 1)]  # repeats within one text
    found = substrings.repeated_words(spark.createDataFrame(rows, DOCS).repartition(5), window=window)
    assert found.columns == ["doc_id", "text", "key", "n_words", "n_removed", "kept"]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found.collect()} == repeats_by_hand(rows, window)


def test_covers_hold_all_shifts():
    for period, marks in substrings.COVERS.items():
        shifts = {(a - b) % period for a in marks for b in marks}
        assert shifts == set(range(period))
    for window in (1, 2, 3, 5, 12, 20, 50):
        period, _, length = substrings.cover_for(window)
        assert length >= 1 and length + period - 1 == window


def test_repeats_with_shared_and_null_ids(spark):
    long = " ".join(f"a{i}" for i in range(25))
    rows = [(5, long, "k", 1)] * 3 + [(None, "b " + long, "k", 1), (5, "c", "k", 1), (None, None, "k", 1)]
    found = substrings.repeated_words(spark.createDataFrame(rows, DOCS)).collect()
    # The null id comes first, so the text of 5 repeats it; its three rows are one document.
    assert sorted((r.n_words, r.n_removed) for r in found) == [(0, 0), (1, 0), (25, 25), (25, 25), (25, 25), (26, 0)]
    assert substrings.repeated_words(spark.createDataFrame([], DOCS)).collect() == []


def test_repeated_rows_of_unique_words_lose_nothing(spark):
    first, later = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, first, "k", 1)] * 2 + [(6, later, "k", 1)] * 2 + [(7, "c " + later, "k", 1)] * 2
    for more in ([], [(6, "d", "k", 1)]):  # an id that names two texts as well
        df = spark.createDataFrame(rows + more, DOCS)
        for parts in (1, 5):
            found = substrings.repeated_words(df.repartition(parts)).collect()
            wanted = [(5, 0)] * 2 + [(6, 0)] * (2 + len(more)) + [(7, 30)] * 2
            assert sorted((r.doc_id, r.n_removed) for r in found) == wanted


def shingles(text, n=5):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))} if found else set()


def classes_by_hand(rows, p=80, q=100):
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    least = {i: i for i in ids}
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return {i: (len(sets[i]), least[i]) for i in ids}


@pytest.mark.parametrize(("seed", "longest"), [(1, 60), (2, 12), (3, 7), (4, 200)])
def test_similar_classes(spark, monkeypatch, seed, longest):
    monkeypatch.setattr(ngrams, "BLOCK_SETS", 4)
    monkeypatch.setattr(ngrams, "LARGE", 4)
    rows = rows_of(corpus(seed, 80, longest=longest))
    found = ngrams.similar_classes(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    wanted = classes_by_hand(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    kept = ngrams.one_of_each(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "Kept", "key"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in wanted.items() if i == c)


@pytest.mark.parametrize("level", [2, 3])
def test_sets_that_fill_few_segments(spark, monkeypatch, level):
    """With hardly any segments most sets are weak, and what is sent instead finds all."""
    monkeypatch.setattr(ngrams, "SPARE", 0.6 if level == 2 else 0.1)
    monkeypatch.setattr(ngrams, "MORE", 0)
    rows = rows_of(corpus(7, 70, longest=40))
    found = ngrams.similar_classes(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == classes_by_hand(rows)


def test_similar_with_shared_and_null_ids(spark):
    rows = [(3, "a b c d e f", "k", 1)] * 2 + [(3, "other words", "k", 1), (7, "A B c d e f", "k", 1), (None, "a b c d e F", "k", 1)]
    df = spark.createDataFrame(rows, DOCS)
    found = sorted((r.text, r.component_id) for r in ngrams.similar_classes(df).collect())
    assert found == sorted([("a b c d e f", None)] * 2 + [("other words", 3), ("A B c d e f", None), ("a b c d e F", None)])
    assert sorted(r.text for r in ngrams.one_of_each(df).collect()) == ["a b c d e F", "other words"]
    assert ngrams.similar_classes(df.limit(0)).collect() == []


def windows_by_hand(rows, items):
    def cut(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    grams = [(str(i), cut(t)) for i, t in items]
    out = {}
    for doc_id, text, *_ in rows:
        found, hit, by = cut(text), set(), set()
        for item, w in grams:
            n = min(10, len(w))
            runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(found) - n + 1) if n else ():
                if tuple(found[i : i + n]) in runs:
                    hit |= set(range(i, i + n))
                    by.add(item)
        out[doc_id] = (len(found), sorted(hit), sorted(by))
    return out


@pytest.mark.parametrize("broadcast", [0, 1 << 25])
def test_benchmark_windows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    texts = corpus(11, 50)
    rows = rows_of(texts) + [(3000, "It's W5, été; P1 p2. a-b", "k", 1)]
    items = [(1, "P0 p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11"), (2, "p3, p4"), (3, "été"), (4, None), (5, " ?! "), (6, " ".join(texts[3])),
             (7, "p5 p6 p7"), (8, "p10 p11 p12 p13 p14 p15 p16 p17 p18"), (9, "w5 w6"), (10, "p3 p4"), (10, "p3 p4")]
    df, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(df, bench)
    assert found.columns == ["doc_id", "text", "Kept", "key", "n_words", "n_hit", "hits", "items"]
    wanted = windows_by_hand(rows, items)
    assert {r.doc_id: (r.n_words, r.hits, r.items) for r in found.collect()} == wanted
    clean = decontaminate.decontaminated(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, w in wanted.items() if not w[1])
    spans = {r.doc_id: r.text for r in decontaminate.decontaminated(df, bench, remove="spans").collect()}
    again = windows_by_hand([(i, t) for i, t in spans.items()], [])
    assert all(again[i][0] == wanted[i][0] - len(wanted[i][1]) for i in spans)
    assert all(spans[r[0]] == r[1] for r in rows if not wanted[r[0]][1])


def test_benchmark_without_items_or_rows(spark):
    df = spark.createDataFrame([(1, "a b", "k", 1), (1, "a b", "k", 1), (None, None, "k", 1)], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted((r.n_words, r.n_hit) for r in decontaminate.contamination(df, none).collect()) == [(0, 0), (2, 0), (2, 0)]
    item = spark.createDataFrame([(None, "b")], "item_id long, text string")
    found = decontaminate.contamination(df, item).collect()
    assert sorted((r.n_words, r.n_hit, r.items) for r in found) == [(0, 0, []), (2, 1, []), (2, 1, [])]
    assert decontaminate.contamination(df.limit(0), item).collect() == []


def near_by_hand(rows, threshold):
    ok = {}
    for i, (_, v, label) in enumerate(rows):
        x = np.array([np.nan if n is None else n for n in v or ()], float)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            ok[i] = x / np.sqrt(x @ x)
    links = {i: {j for j in ok if j != i and rows[j][2] == rows[i][2] and len(ok[j]) == len(ok[i]) and ok[i] @ ok[j] >= threshold} for i in ok}
    least = [r[0] for r in rows]
    for _ in rows:
        for i, some in links.items():
            for j in some:
                least[i] = least[j] = min(least[i], least[j])
    return sorted((r[0], len(links.get(i, ())), least[i], least[i] == r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [3, 1024])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "CELL_ROWS", 4)
    source = np.random.default_rng(2)
    rows = []
    for i in range(150):
        if rows and source.random() < 0.5:
            base = rows[source.integers(len(rows))]
            v = np.array(base[1]) + source.normal(size=16) * source.choice([0, 0.02, 0.08]) * np.linalg.norm(base[1]) / 4
            rows.append((i, v.tolist(), base[2]))
        else:
            rows.append((i, source.normal(size=16).tolist(), int(source.integers(2))))
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, rows[0][1][:8], rows[0][1][:8], rows[0][1]]
    rows += [(500 + i, v, rows[0][2]) for i, v in enumerate(odd)] + [(600, rows[0][1], None)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    found = vectors.near_copies(df)
    assert found.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()) == near_by_hand(rows, 0.98)


def test_repeated_vectors_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int, KEPT string"
    rows = [(4, [1.0, 0.0], 1, "a")] * 3 + [(None, [2.0, 0.0], 1, "b"), (5, [0.0, 1.0], 1, "c")]
    found = vectors.near_copies(spark.createDataFrame(rows, schema))
    assert found.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in found.collect())
    assert got == [(0, 3, 0, True)] + [(4, 3, 0, False)] * 3 + [(5, 0, 5, True)]
    assert vectors.near_copies(spark.createDataFrame([], schema)).collect() == []


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    found = sorted((r.vec_id, r.n_links) for r in vectors.near_copies(df).collect())
    wanted = [(i, n) for i, n, *_ in near_by_hand(rows, 0.98)]
    assert sum(n for _, n in found) >= 0.99 * sum(n for _, n in wanted)
    assert all(n <= m for (_, n), (_, m) in zip(found, wanted, strict=True))


@pytest.mark.parametrize("shape", [(1, 1), (1, 7), (9, 1), (12, 17), (40, 40)])
@pytest.mark.parametrize("kinds", [2, 5, 10**6])
def test_cells_come_from_the_nearest_on(shape, kinds):
    """All cells once, in the order of their distances, ties and all."""
    source = np.random.default_rng(shape[1] + kinds)
    x, y = (source.integers(0, kinds, n) / kinds for n in shape)
    found = list(vectors.nearest_cells(x, y))
    far = [f for f, _, _ in found]
    assert far == sorted(far) and sorted((a, b) for _, a, b in found) == [(a, b) for a in range(shape[0]) for b in range(shape[1])]
    assert all(f == x[a] + y[b] for f, a, b in found)


def test_recall_over_hundreds_of_cells(spark, monkeypatch):
    """Vectors that differ along one direction, that in which the codewords lie."""
    monkeypatch.setattr(vectors, "CELL_ROWS", 4)
    source = np.random.default_rng(3)
    angles, others = source.random(1600) * 2 * np.pi, source.normal(size=(20, 32))
    others /= np.sqrt((others**2).sum(1))[:, None]
    x = np.zeros((1600, 64))
    x[:, 0], x[:, 1], x[:, 32:] = np.cos(angles), np.sin(angles), others[np.arange(1600) % 20]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.sqrt((x**2).sum(1))[:, None]
    wanted = ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()
    assert sum(wanted) > 5000
    assert [r.n_links for r in vectors.near_copies(df.repartition(4)).orderBy("vec_id").collect()] == wanted


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    source = random.Random(seed)
    shapes = [[(i, i + 1) for i in range(40)], [(100, i) for i in range(101, 130)], [(200, 200)], [(7, 300), (300, 7)]]
    links = [x for s in shapes for x in s] + [(source.randrange(400, 460), source.randrange(400, 460)) for _ in range(40)]
    names = list(range(500))
    source.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    least = {n: n for x in links for n in x}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = graph.components(spark.createDataFrame(links, "a long, b long"))
    own = {a for a, b in links if a == b}
    wanted = {n: c for n, c in least.items() if n not in own or any(n in x and x[0] != x[1] for x in links)}
    assert {r.node: r.component for r in found.collect()} == wanted
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def alternating(first, second, size=1024):
    """Two words whose letters differ at every place, by the parity of its binary digits."""
    odd = [bin(i).count("1") % 2 for i in range(size)]
    return "".join(first if o else second for o in odd), "".join(second if o else first for o in odd)


def test_words_that_cancel_in_a_polynomial_differ(spark):
    one, other = alternating("a", "b")
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{one} {tail}", "k", 1), (2, f"{other} {tail}", "k", 1)]
    done = substrings.repeated_words(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.n_removed for r in done} == {1: 0, 2: 0}
    rows = [(1, " ".join([one] * 3 + ["x"] * 9), "k", 1), (2, " ".join([other] * 3 + ["y"] * 9), "k", 1)]
    done = ngrams.similar_classes(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in done} == {1: 1, 2: 2}


def test_hashes_of_words_and_runs():
    import pyarrow as pa

    from tidemark.llm.words import CHUNK, Hasher, words_of

    source, hasher = random.Random(1), Hasher(b"k" * 16)
    one, other = alternating("a", "b")
    texts = [" ".join(source.choice("ab") for _ in range(100)) for _ in range(20)]
    texts += [f"{one} {other}", None, "", " ", "x" * 63, "x" * 64, "x" * 65, "é" * CHUNK, "ab " * CHUNK, "\t\r" * CHUNK, "z"]
    column, by_hash = pa.array(texts), {}
    for length in (1, 2, 3, 5, 8, 13, 20):
        for found in words_of(column, hasher):
            hashes, starts = found.runs(length)
            for h, s, o in zip(hashes.tolist(), starts.tolist(), found.owner()[starts].tolist()):
                if len(texts[found.row + o]) > 10_000 and s > found.first[o] + 40:
                    continue
                at = s - found.first[o]
                run = tuple(words(texts[found.row + o])[at : at + length])
                assert len(run) == length and by_hash.setdefault(h, run) == run
    assert len(set(by_hash.values())) == len(by_hash)
    counts = [c for found in words_of(column, hasher) for c in found.counts.tolist()]
    assert counts == [len(words(t)) for t in texts]
    # Runs of words alternate as letters do: no window of them cancels, however long.
    for a, b in [alternating("a", "b", 64)]:
        pair = [next(iter(words_of(pa.array([" ".join(t)]), hasher))).runs(64)[0][0] for t in (a, b)]
        assert pair[0] != pair[1]


def test_folded_words_take_only_latin_letters():
    import pyarrow as pa

    from tidemark.llm.words import Hasher, words_of

    hasher = Hasher(b"k" * 16)
    low, high, other = (next(iter(words_of(pa.array([t]), hasher, fold=True))).hashes[0] for t in ("azé", "AZé", "AZÉ"))
    assert low == high != other


def test_large_clusters_are_compared_by_segment_where_that_is_less(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngrams, "LARGE", 2)
    # A chain of groups that share one key each: few pairs by key, many in the cluster.
    mixed = spark.createDataFrame([(k, n) for k in range(30) for n in (k, k + 1)], "key long, _node long")
    dealt = ngrams._dealt(mixed).collect()
    groups = {}
    for r in dealt:
        groups.setdefault(r.cluster, set()).add(r._node)
    assert sorted(map(sorted, groups.values())) == [[k, k + 1] for k in range(30)]
    star = spark.createDataFrame([(k, n) for k in range(40) for n in range(6)], "key long, _node long")
    assert {r.cluster for r in ngrams._dealt(star).collect()} == {0}


def test_huge_and_tiny_vectors_link(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1.001e200], 1), (3, [1e-200, 1e-200], 1), (4, [3.0, 3.0], 1), (5, [5e-324, -1e-310], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


def shuffled_files(spark):
    """Bytes of shuffle files that lie on disk now."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    total = 0
    for path in (p for f in folders for p in Path(f).rglob("shuffle_*")):
        with suppress(OSError):  # it may go meanwhile
            total += path.stat().st_size
    return total


def left_behind(spark, make, most):
    """Bytes of shuffle files that `make` leaves, waiting for those that are being removed."""
    before, made = shuffled_files(spark), make()
    for _ in range(50):
        if (left := shuffled_files(spark) - before) <= most:
            break
        time.sleep(0.2)
    return left, made


def near_copies_of(many, length, copies):
    source = random.Random(5)
    texts = [" ".join(f"w{source.randrange(10**6)}" for _ in range(length)) for _ in range(many)]
    return [(i + k * many, f"{t} copy{k}", "k", 1) for i, t in enumerate(texts) for k in range(copies)]


def test_near_copies_leave_no_shuffle_files_before_the_last_join(spark):
    """What slices and rounds shuffle goes when they end, not when the driver collects garbage."""
    rows = near_copies_of(60, 300, 6)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    left, found = left_behind(spark, lambda: ngrams.similar_classes(df), 400_000)
    assert left <= 400_000
    assert {r.doc_id: r.component_id for r in found.collect()} == {r[0]: r[0] % 60 for r in rows}


@pytest.mark.parametrize(("seed", "slices"), [(1, 2), (4, 3)])
def test_similar_classes_in_slices_and_rounds(spark, monkeypatch, seed, slices):
    for name, value in {"SLICES": slices, "SLICE_GRAMS": 1, "ROUND": 0, "ROUND_GRAMS": 800, "BLOCK_SETS": 4, "LARGE": 4}.items():
        monkeypatch.setattr(ngrams, name, value)
    rows = rows_of(corpus(seed, 80, longest=120))
    found = ngrams.similar_classes(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == classes_by_hand(rows)


def test_parts_of_slices_add_up():
    """Each slice has a part of the differences that its filled segments allow; all add up."""
    source = np.random.default_rng(3)
    for parts in (1, 2, 3, 7):
        filled = source.integers(0, 60, 40)
        owner = np.repeat(np.arange(40), filled)
        number = np.concatenate([source.choice(200, n, replace=False) for n in filled])
        found = ngrams.Segments(owner, owner, filled, owner, owner, number)
        differ = source.integers(0, 50, 40)
        most, seen = np.zeros(40, int), np.zeros(len(owner), int)
        for part in range(parts):
            inside, share = found.shares(differ, part, parts)
            here = np.bincount(owner[inside], minlength=40)
            strong = filled > differ
            assert (share[~strong] == 0).all() and (share[strong] >= 1).all() and (share[strong] <= here[strong] + 1).all()
            most += here - share + 1
            seen += inside
        assert (most[strong] == differ[strong] + 1).all() and (seen == 1).all()


def test_vectors_are_sent_by_block_not_by_cell(spark, monkeypatch):
    """A grid of many cells that most vectors have to search costs no copy for each cell."""
    monkeypatch.setattr(vectors, "CELL_ROWS", 16)
    source = np.random.default_rng(4)
    x = source.normal(size=(4000, 64)).astype(np.float32)
    x[2000:] = x[:2000] * 2
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    df, made, peak = df.repartition(4), [], 0
    work = threading.Thread(target=lambda: made.append(vectors.near_copies(df)))
    before = shuffled_files(spark)
    work.start()
    while work.is_alive():
        peak = max(peak, shuffled_files(spark) - before)
        time.sleep(0.02)
    (found,) = made
    assert peak <= 6 * x.nbytes
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found.collect()) == [(i, 1, i % 2000) for i in range(4000)]


@pytest.mark.parametrize("block", [7, 40])
def test_vectors_of_one_label_in_rounds_of_blocks(spark, monkeypatch, block):
    """Numbers that need four bytes and such that need eight, with a label of many blocks."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "CELL_ROWS", 8)
    source = np.random.default_rng(6)
    base = source.normal(size=(30, 8))
    rows = [(i, (base[i % 30] + source.normal(size=8) * 0.1).tolist(), 1) for i in range(120)]
    rows += [(200 + i, [float(v) for v in base[i].astype(np.float32)], 1) for i in range(30)]
    found = vectors.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()) == near_by_hand(rows, 0.98)
