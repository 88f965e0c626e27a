"""Runs of a period in the words of a text, by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton. Its suffix links are a tree; the path
from the state of the whole prefix to the root holds all suffixes, longest first. A link-cut
tree over it keeps each path of states that were last seen at one place together, so that an
append recolours a path segment by segment, in a logarithmic number of them on average. A
segment that was last seen to end at word j, with states of up to L words, is the longest
common suffix of the prefixes that end at j and at the new word i. If the distance d = i - j
is at most L, the last 2 d words are a square, and the words from j - L on have period d: a
run as far as it has been read. No smaller period is possible, as the segment would have been
seen later than j. The next words extend the run, which keeps its start and its period.

Only stretches of a text that may hold a run are appended. Within a run of period q every
three words in a row occur again q words later, so all of its triples after the first period
follow their last occurrence by q at most. Stretches without enough such triples in a row,
for periods of each power of two, can't hold a run and are left out; the others are merged.
A run of the text lies in one stretch, with all it extends to, so nothing else is found.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, let, table

LEAST_LENGTH = 6
LEAST_TIMES = 4
#: Words of the groups whose repeats tell which stretches may hold a run.
MOST_GROUP = 3

RUN = "struct<start: long, length: long, period: long>"


class LastSeen:
    """Suffix automaton of the words appended so far, and where its states were last seen.

    State 1 is the root, 0 is none. `left`, `right` and `up` are splay trees of the
    link-cut tree, one for each path of states last seen at one place, in order of length;
    `up` of such a tree's root is the state that the path hangs on, and `seen` of it is the
    place.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}, {}]
        self.length, self.link = [0, 0], [0, 0]
        self.left, self.right, self.up, self.seen = [0, 0], [0, 0], [0, 0], [0, 0]
        self.last = 1
        self.size = 0

    def _state(self, length: int, link: int, following: dict[int, int], seen: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.left.append(0)
        self.right.append(0)
        self.up.append(link)
        self.seen.append(seen)
        return len(self.length) - 1

    def append(self, word: int) -> list[tuple[int, int]]:
        """(j, L) for each earlier end j of a suffix, latest first: L words up to j are
        the longest common suffix with the words so far."""
        following, link, length = self.next, self.link, self.length
        self.size += 1
        new = self._state(self.size, 1, {}, self.size)
        state = self.last
        while state and word not in following[state]:
            following[state][word] = new
            state = link[state]
        if state:
            target = following[state][word]
            if length[target] != length[state] + 1:
                target = self._split(state, word, target)
            link[new] = self.up[new] = target
        self.last = new
        return self._recolour(new)

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the shorter suffixes of `target`, between it and its link."""
        following, link = self.next, self.link
        self._splay(target)
        short = self._state(self.length[state] + 1, link[target], dict(following[target]), self.seen[target])
        while state and following[state].get(word) == target:
            following[state][word] = short
            state = link[state]
        link[target] = short
        # It was seen with `target`: it comes before it on the same path.
        above = self.left[target]
        self.left[short] = above
        if above:
            self.up[above] = short
        self.left[target] = short
        self.up[short] = target
        return short

    def _splay(self, x: int) -> None:
        """Make `x` the root of its splay tree."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        top = y
        while (z := up[top]) and (left[z] == top or right[z] == top):
            top = z
        self.seen[x] = self.seen[top]
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = right[x]
            left[y], right[x] = inner, y
        else:
            inner = left[x]
            right[y], left[x] = inner, y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _recolour(self, state: int) -> list[tuple[int, int]]:
        """Link-cut access from `state` to the root, which becomes one path, seen now."""
        left, right, up, seen, length = self.left, self.right, self.up, self.seen, self.length
        found = []
        below, x = 0, state
        while x:
            self._splay(x)
            if x != state and length[x]:
                found.append((seen[x], length[x]))
            rest = right[x]
            if rest:  # longer suffixes, which did not occur now
                seen[rest] = seen[x]
            right[x] = below
            if below:
                up[below] = x
            below, x = x, up[x]
        seen[below] = self.size
        return found


def _runs_within(words: Sequence[int], least: int, times: int) -> dict[tuple[int, int], int]:
    """End of the run by its start and period."""
    automaton, ends = LastSeen(), {}
    append = automaton.append
    for end, word in enumerate(words, 1):
        for earlier, common in append(word):
            period = end - earlier
            if common + period >= max(least, times * period):
                ends[earlier - common, period] = end
    return ends


def _stretches(words: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Parts of a text, apart from one another, outside which no run can lie."""
    n = len(words)
    if n < least:
        return []

    def needed(low: int, high: int, group: int) -> int:
        """Groups in a row that a run of a period from low to high has at least."""
        return min(max(least, times * q) - q for q in range(low, min(high, low + least) + 1)) - group + 1

    group = max(1, min(MOST_GROUP, needed(1, least, 1)))
    size = n - group + 1
    key = np.zeros(size, np.int64)
    for i in range(group):  # different groups with one key add stretches, none go
        key = key * np.int64(0x1000003) + words[i : i + size]
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(again):
        return []
    place = order[again + 1]
    gaps = place - order[again]
    turn = np.argsort(place)
    place, gaps = place[turn], gaps[turn]
    found = []
    high = 1
    while (low := high // 2 + 1) * times <= n or low == 1:
        near = place[gaps <= high]
        if len(near):
            cuts = np.flatnonzero(np.diff(near) != 1)
            first, last = near[np.r_[0, cuts + 1]], near[np.r_[cuts, len(near) - 1]]
            enough = last - first + 1 >= max(1, needed(low, high, group))
            found += zip((first[enough] - high).tolist(), (last[enough] + group).tolist(), strict=True)
        high *= 2
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(found):
        start = max(start, 0)
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def runs_of(words: Sequence[bytes], least: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period: longest stretches with a
    smallest period, of at least `least` words and `times` periods (2 or more)."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    if len(numbers) < len(words):
        for start, stop in _stretches(ids, least, times):
            for (first, period), end in _runs_within(ids[start:stop].tolist(), least, times).items():
                found.append((start + first, end - first, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return [w for w, out in zip(words, gone.tolist(), strict=True) if not out]


def _find(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        for batch in batches:
            names = batch.schema.names
            at = names.index("_text")
            counts, runs, left, strongest = [], [], [], []
            for text in batch.column(at).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                found = runs_of(words, least, times)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                strongest.append(best and {"start": best[0], "length": best[1], "period": best[2]})
                left.append(b" ".join(_collapsed(words, found)))
            rest = [i for i in range(len(names)) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in rest], pa.array(counts, pa.int64()), pa.array(runs, pa.list_(kind)),
                 pa.array(strongest, kind), pa.array(left, pa.binary()).cast(pa.string())],
                [*[names[i] for i in rest], "n_words", "runs", "strongest", "collapsed"],
            )

    return run


MADE = ("n_words", "runs", "strongest", "collapsed")


def periodic_runs(
    df: DataFrame, text: str = "text", least: int = LEAST_LENGTH, times: int = LEAST_TIMES
) -> DataFrame:
    """`df` with `n_words`; `runs` (start, length, period), by start, then period; the
    `strongest` of them, with the greatest length / period, ties to the smallest start, then
    period, null if there is none; and `collapsed`, the words that no run holds after its
    first period, joined by one blank.

    A run is a stretch of words in which words one period apart are equal, which no neighbour
    extends, of at least `least` words and `times` periods (2 or more); its period is the
    smallest. Null and empty texts have no words. Each text is judged by itself, so ties,
    repeated rows and ids play no part; a text is held by one task, and what its stretches
    that may hold a run take grows with their words (about 1 KB a word). An empty table
    gives no rows. Columns named like the results are replaced, others pass unchanged.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has two periods at least")
    columns = [c for c in df.columns if c.lower() not in MADE]
    filler = "_" * (1 + max(map(len, df.columns)))  # a struct needs a field
    rows = df.select(F.struct(F.lit(0).alias(filler), *[F.col(f"`{c}`") for c in columns]).alias("row"),
                     F.col(f"`{text}`").cast("string").alias("_text"))
    schema = rows.select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast(f"array<{RUN}>").alias("runs"),
        F.lit(None).cast(RUN).alias("strongest"),
        F.lit("").alias("collapsed"),
    ).schema
    found = in_arrow(rows, _find(least, times), schema)
    return found.select(*[F.col(f"row.`{c}`") for c in columns], *MADE)


def with_planted_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with the ends of a tenth of its texts made periodic, by a hash of their ids:
    what the query looks for. A text without id stays as it is."""
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        joined = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
        return F.when(n > 0, joined)

    made = F.when(h % 10 == 0, F.coalesce(let(words, planted), F.col(f"`{text}`"))).otherwise(F.col(f"`{text}`"))
    return df.withColumn(text, made)


def op11_last_seen_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents after some ends were made periodic, with digests."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs)
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("strongest.length * 1000 DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE = r"""
WITH z AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS z
), d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda c, b: xor(c // 256, z[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS h
  FROM documents, z
), a AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g
  FROM d
), p AS (
  SELECT doc_id, n, CASE WHEN NOT planted THEN w ELSE list_transform(range(n), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
  FROM a
), t AS (
  SELECT doc_id, n, unnest(range(n - 2)) AS i, unnest(list_transform(range(1, n - 1),
    lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) AS three
  FROM p WHERE n >= 6
), e AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y
    ON x.doc_id = y.doc_id AND x.three = y.three AND x.i < y.i AND (y.i - x.i) * 4 <= x.n
), s AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM e
), f AS (
  SELECT doc_id, min(i) AS start, count(*) + 2 + q AS length, q FROM s GROUP BY doc_id, q, part
  HAVING count(*) + 2 + q >= greatest(6, 4 * q)
), r AS (
  SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length
), o AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM r GROUP BY doc_id
), b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM r
), g AS (
  SELECT doc_id, list(DISTINCT i) AS gone
  FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY doc_id
), u AS (
  SELECT p.doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM p
), v AS (
  SELECT doc_id, unnest(gone) AS i FROM g
), k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS left_over FROM u ANTI JOIN v USING (doc_id, i) GROUP BY doc_id
)
SELECT p.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
  period::BIGINT AS period, (length * 1000 // period)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM p LEFT JOIN o ON o.doc_id = p.doc_id LEFT JOIN b ON b.doc_id = p.doc_id AND place = 1
  LEFT JOIN k ON k.doc_id = p.doc_id
"""
