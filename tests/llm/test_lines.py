"""Lines shared by documents, against a plain count."""

import random

from tidemark.llm.lines import shared_lines

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least_chars=20, least_documents=3):
    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(-(2**63) if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        label = -(2**63) if doc_id is None else doc_id
        left = [
            x for x in lines
            if len(key(x)) < least_chars or len(holders[key(x)]) < least_documents or label == max(holders[key(x)])
        ]
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def got(df, **options):
    out = shared_lines(df, **options)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()), key=str)


def test_random_texts(spark):
    rng = random.Random(1)
    pool = ["x" * 20, "X" * 20, "\t" + "x" * 20 + " \r", "é" * 19, "É" * 20, "é" * 20, "", " ", "short",
            "a line of more than twenty letters", "A Line of more than twenty letters ", " " + "x" * 20,
            "only one document holds this line twice"]
    rows = [(i, "\n".join(rng.choice(pool[:-1]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n"), (63, "\n".join([pool[-1]] * 3)), (None, "x" * 20 + "\n" + pool[9])]
    rows += [(5, rows[5][1]), (7, "another text of a known id\n" + "x" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == plain(rows)
    assert got(df, least_chars=1, least_documents=2) == plain(rows, 1, 2)


def test_largest_id_keeps_all_of_its_lines(spark):
    line = "this very line is in all of them"
    rows = [(i, f"{line}\nown {i}\n{line.upper()}") for i in range(4)]
    out = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out[-1] == (3, 3, 0, rows[3][1]) and out[0] == (0, 3, 2, "own 0")


def test_two_documents_are_too_few(spark):
    rows = [(1, "this very line is in two of them"), (2, "this very line is in two of them"), (2, "this very line is in two of them")]
    assert [r[2] for r in got(spark.createDataFrame(rows, "doc_id long, text string"))] == [0, 0, 0]


def test_clashing_columns_and_empty_table(spark):
    names = "doc_id int, text string, kept int, row int, hash int, pos int, gone int, `lines` int, _id int, N_lines int"
    df = spark.createDataFrame([(i, "a line of more than twenty letters", 1, 2, 3, 4, 5, 6, 7, 8) for i in range(3)], names)
    out = shared_lines(df)
    assert out.columns == ["doc_id", "text", "row", "hash", "pos", "gone", "lines", "_id", "n_lines", "n_dropped", "kept"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].kept == "" and rows[0].n_dropped == 1 and rows[2].kept == rows[2].text and rows[1]["_id"] == 7
    assert shared_lines(df.limit(0)).count() == 0
