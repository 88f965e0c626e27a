"""Near copies among vectors with an inverted multi-index.

Vectors are scaled to length 1 and cut in halves; each half has its own codebook, fitted by
k-means on a bounded sample. A vector's cell is the pair of its nearest codewords, so two
small codebooks make a large grid. A search visits cells in the order of how far the vector
is from them, which for each half is its distance to the plane between its own codeword's
region and the other's, until the next cell is farther than two vectors that link can be
apart. A vector is never nearer to a region than to its plane, so the target recall is 1,
whichever way vectors differ. All that is found is verified by cosine.

Every vector is a member of its cell and a visitor of the cells it searches. Vectors of a
label are dealt into blocks of bounded size, and each pair of blocks goes to one task, which
holds the grid of the block in memory: vectors of one cell visit together what any of them
has to search, as products of matrices. So a vector is sent once for each block of its label,
not for each cell; pairs of blocks are dealt into rounds that send about all vectors once, and
what a round has shuffled is removed when it ends. Equal vectors are one member with a weight.
What comes out are counts and a spanning forest of links, never pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, kept, table, tidy, unit
from tidemark.llm.graph import components

THRESHOLD = 0.98
#: Squared distances of vectors of length 1 are taken to be wrong by less than this.
ROUNDING = 1e-12
#: Vectors that codebooks are fitted on, about, at most; codewords of a half at most;
#: vectors in a cell on average, as long as the codebooks can still grow.
FIT_ROWS, MOST_WORDS, CELL_ROWS = 20_000, 256, 1024
#: Vectors of a block at most, and numbers in them.
BLOCK, BLOCK_NUMBERS = 1 << 16, 1 << 22
#: Pairs of vectors that a task compares at a time, about.
PRODUCT = 1 << 22


@dataclass(frozen=True)
class Codebooks:
    """Codewords of both halves, for vectors of `size` numbers."""

    size: int
    halves: tuple[np.ndarray, np.ndarray]

    def gaps(self, rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each half, the codewords of the rows, and squared distances of the rows to
        the regions of all codewords (0 for their own)."""
        own, gaps = [], []
        for words, half in zip(self.halves, (rows[:, : self.size // 2], rows[:, self.size // 2 :]), strict=True):
            square = (half**2).sum(1)[:, None] - 2 * half @ words.T + (words**2).sum(1)[None, :]
            best = square.argmin(1)
            apart = np.sqrt(((words[:, None, :] - words[None, :, :]) ** 2).sum(2))[best]
            far = square - square[np.arange(len(rows)), best][:, None] - ROUNDING
            own.append(best)
            gaps.append((np.maximum(far, 0) / np.where(apart > 0, 2 * apart, np.inf)) ** 2)
        return own, gaps


def _kmeans(rows: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    """Codewords by Lloyd's rounds from evenly spaced rows; empty ones keep their place."""
    centres = rows[np.linspace(0, len(rows) - 1, words).astype(int)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, rows)
        count = np.bincount(near, minlength=words)
        centres[count > 0] = total[count > 0] / count[count > 0][:, None]
    return centres


def _bytes_of(x: np.ndarray) -> bytes:
    """The numbers in four bytes each where none loses a digit by it, otherwise in eight."""
    small = x.astype(np.float32)
    return small.tobytes() if np.array_equal(small, x) else x.tobytes()


def _unit_rows(packed: list[bytes], size: int) -> np.ndarray:
    """Vectors of `size` numbers as rows of length 1."""
    rows = np.empty((len(packed), size))
    narrow = np.array([len(p) == 4 * size for p in packed], bool)
    for some, kind in ((narrow, np.float32), (~narrow, np.float64)):
        at = np.flatnonzero(some)
        rows[at] = np.frombuffer(b"".join([packed[i] for i in at]), kind).reshape(len(at), size)
    return rows / np.sqrt((rows**2).sum(1))[:, None]


def packed(df: DataFrame, vec_id: str, vector: str, label: str, rest: list[str]) -> DataFrame:
    """`row` (the columns `rest`), `_id`, `label`, `vec` (the numbers, packed), `size`, and two hashes
    of label and vector, `same` and `also`. `vec` is null if the row can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            sizes = []
            for v, told in zip(batch.column(3).to_pylist(), batch.column(2).is_valid().to_pylist(), strict=True):
                x = np.array(v, np.float64) if told and v and None not in v else np.zeros(0)
                top = np.abs(x).max(initial=0.0)
                if np.isfinite(top) and top and not 1e-100 < top < 1e100:
                    # Squares would leave the range of doubles; a power of two changes no digit.
                    x = np.ldexp(x, -int(np.frexp(top)[1]))
                square = float(x @ x) if np.isfinite(top) else np.inf
                out.append(_bytes_of(x + 0.0) if np.isfinite(square) and square > 0 else None)
                sizes.append(0 if out[-1] is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(out, pa.binary()), pa.array(sizes, pa.int32())],
                ["row", "_id", "label", "vec", "size"],
            )

    plain = df.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(-(2**63))).alias("_id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").alias("v"),
    )
    schema = plain.drop("v").withColumns({"vec": F.lit(None).cast("binary"), "size": F.lit(0)}).schema
    hashes = {name: F.xxhash64(F.lit(name), "label", "vec") for name in ("same", "also")}
    return in_arrow(plain, run, schema).withColumns(hashes)


def fit_codebooks(vectors: DataFrame, rows: int = FIT_ROWS) -> Codebooks | None:
    """Codebooks from about `rows` vectors at most, of the size that most have; the number
    of codewords grows with the fourth root of the squared number of vectors per cell."""
    sizes = vectors.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes or sizes[0].size < 2:
        return None
    size, many = sizes[0].size, sizes[0].n
    place = unit(F.xxhash64(F.lit("fit"), "same", "also"))
    sample = vectors.filter((F.col("size") == size) & (place < min(1.0, rows / many))).select("vec").distinct()
    packed = sorted(bytes(r.vec) for r in sample.limit(2 * rows).collect())
    if not packed:
        return None
    found = _unit_rows(packed, size)
    words = int(min(MOST_WORDS, len(found), max(1, round((many / CELL_ROWS) ** 0.5))))
    order = np.random.default_rng(1).permutation(len(found))
    halves = found[order, : size // 2], found[order, size // 2 :]
    return Codebooks(size, tuple(_kmeans(h, words) for h in halves))


def nearest_cells(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells of the grid from the nearest on, with their distances: the sums of one number
    of each half. Multi-sequence traversal: a cell enters the queue once the cells before
    it, in the order of either half, have left it, so the queue holds a staircase."""
    order_x, order_y = np.argsort(x, kind="stable"), np.argsort(y, kind="stable")
    far_x, far_y = x[order_x].tolist(), y[order_y].tolist()
    order_x, order_y = order_x.tolist(), order_y.tolist()
    queue = [(far_x[0] + far_y[0], 0, 0)]
    left = [0] * len(far_x)  # of each row of the grid, how many cells have left the queue
    while queue:
        far, i, j = heapq.heappop(queue)
        left[i] = j + 1
        yield far, order_x[i], order_y[j]
        if i + 1 < len(far_x) and left[i + 1] == j:
            heapq.heappush(queue, (far_x[i + 1] + far_y[j], i + 1, j))
        if j + 1 < len(far_y) and (i == 0 or left[i - 1] > j + 1):
            heapq.heappush(queue, (far_x[i] + far_y[j + 1], i, j + 1))


def _visits(books: Codebooks | None, reach: float, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of rows of `x` (of one cell each) with the rows of `y` in all cells that any of
    the group has to visit."""
    if not books or x.shape[1] != books.size:
        yield np.arange(len(x)), np.arange(len(y))
        return
    wide = len(books.halves[1])

    def in_cells(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows in the order of their cells, which cells there are, and where each begins."""
        cells = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), 8192):
            (a, b), _ = books.gaps(rows[start : start + 8192])
            cells[start : start + 8192] = a * wide + b
        order = np.argsort(cells, kind="stable")
        found, first = np.unique(cells[order], return_index=True)
        return order, found, np.append(first, len(rows))

    mine, _, mine_first = in_cells(x)
    theirs, there, their_first = in_cells(y) if y is not x else (mine, _, mine_first)
    place = {int(c): i for i, c in enumerate(there)}
    for start, stop in zip(mine_first[:-1], mine_first[1:], strict=True):
        group = mine[start:stop]
        # What is nearest to any of the group. Behind the first cell that is too far no link
        # can be missed.
        far = [np.full(len(words), np.inf) for words in books.halves]
        for k in range(0, len(group), 8192):
            far = [np.minimum(f, gap.min(0)) for f, gap in zip(far, books.gaps(x[group[k : k + 8192]])[1], strict=True)]
        near = takewhile(lambda cell: cell[0] <= reach, nearest_cells(*far))
        at = [place[c] for _, a, b in near if (c := a * wide + b) in place]
        if at:
            yield group, np.concatenate([theirs[their_first[i] : their_first[i + 1]] for i in at])


def _links(books: Codebooks | None, reach: float, threshold: float):
    """Links between the vectors of a pair of blocks, from rows of label, size, both blocks,
    a vector's own block, its number, weight and numbers: `u`, `v`, `n`. With u = v it is a
    number of links, otherwise a link."""

    def found_in(size: int, visitors: list[tuple], members: list[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
        x = _unit_rows([r[2] for r in visitors], size)
        y = x if members is visitors else _unit_rows([r[2] for r in members], size)
        id_x, id_y = (np.array([r[0] for r in some], np.int64) for some in (visitors, members))
        weight = np.array([r[1] for r in members], np.int64)
        # Products of short numbers, wrong by less than the margin, tell which are worth exact ones.
        short_x, short_y, least = x.astype(np.float32), y.astype(np.float32), threshold - 2.5e-7 * (size + 4)
        for group, others in _visits(books, reach, x, y):
            right = short_y[others].T
            step = max(1, PRODUCT // len(others))
            for start in range(0, len(group), step):
                some = group[start : start + step]
                close = others[(short_x[some] @ right).max(0) >= least]
                links = (x[some] @ y[close].T >= threshold) & (id_x[some][:, None] != id_y[close][None, :])
                hit, near = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
                if not len(hit):
                    continue
                links = links[np.ix_(hit, near)]
                near = close[near]
                u, v = id_x[some][hit], id_y[near]
                yield u, u, links @ weight[near]
                edges = np.array(_two_sided_forest(links), np.int64).reshape(-1, 2)
                yield u[edges[:, 0]], v[edges[:, 1]], np.zeros(len(edges), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[pa.RecordBatch]:
            _, size, i, j = key
            # Each visits the other's cells; in a pair of one block with itself, its own.
            sides = [(i, j), (j, i)] if i != j else [(i, i)]
            for mine, theirs in sides:
                if held.get(mine) and held.get(theirs):
                    for found in found_in(size, held[mine], held[theirs]):
                        yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["u", "v", "n"])

        key, held = None, {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *group, own, node, weight, vec in zip(*columns, strict=True):
                if group != key:
                    if held:
                        yield from made()
                    key, held = group, {}
                held.setdefault(own, []).append((node, weight, vec))
        if held:
            yield from made()

    return run


def _all_links(nodes: DataFrame, books: Codebooks | None, reach: float, threshold: float) -> DataFrame:
    """`u`, `v`, `n` of all pairs of blocks; see `_links`."""
    group = ["label", "size"]
    most = F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_NUMBERS) / F.greatest("size", F.lit(1)))))
    counts = nodes.groupBy(*group).agg(F.count("*").alias("many"))
    counts = kept(counts.withColumn("blocks", F.ceil(F.col("many") / most).cast("int")))
    sent = counts.agg(F.sum("many").alias("n"), F.sum(F.col("many") * F.col("blocks")).alias("sent")).first()
    # A vector is sent to the pairs of its block with all blocks; a round sends about as many as there are.
    rounds = max(1, round(sent.sent / sent.n)) if sent.n else 1
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int")
    dealt = nodes.join(counts.select(*group, "blocks"), group).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    order = [*group, "i", "j"]
    dealt = dealt.select(
        *group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "weight", "vec"
    )
    out = None
    for i in range(rounds):
        some = dealt.filter(F.pmod(F.xxhash64(F.lit("round"), *order), F.lit(rounds)) == i)
        some = some.repartition(*order).sortWithinPartitions(*order)
        links = kept(in_arrow(some, _links(books, reach, threshold), "u long, v long, n long"))
        out = links if out is None else out.union(links)
    return out


def _two_sided_forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Row and column of edges of a spanning forest of a table of links."""
    fresh_row, fresh_column = np.ones(links.shape[0], bool), np.ones(links.shape[1], bool)
    edges = []
    for root in np.flatnonzero(links.any(1)).tolist():
        if not fresh_row[root]:
            continue
        fresh_row[root] = False
        queue = [(root, True)]
        for at, is_row in queue:
            fresh = fresh_column if is_row else fresh_row
            new = np.flatnonzero((links[at] if is_row else links[:, at]) & fresh).tolist()
            fresh[new] = False
            edges += [(at, k) if is_row else (k, at) for k in new]
            queue += [(k, not is_row) for k in new]
    return edges


def near_copies(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`df` with `n_links` (other rows linked directly), `component_id` (least id that links
    reach) and `kept` (whether that is its own).

    Only vectors of equal label and length are compared, by cosine in double precision.
    Null labels and vectors that are null, empty or zero or hold a null or no finite number
    link with nothing. Ids must be of an integer type; a null id comes before all others,
    and rows that share an id are linked as their vectors are, one by one. Repeated rows
    link with each other. An empty table gives no rows. Columns of the three names are
    replaced, others pass unchanged.
    """
    new = ("n_links", "component_id", "kept")
    rest = [c for c in df.columns if c.lower() not in new]
    low = F.lit(-(2**63))
    with tidy(df.sparkSession):
        named = _counted(packed(df, vec_id, vector, label, [vec_id]).drop("row"), threshold)
    rows = packed(df, vec_id, vector, label, rest)
    linked = rows.filter("vec IS NOT NULL").select("row", "same", "also").join(named, ["same", "also"]).select("row", "n", "c")
    alone = rows.filter("vec IS NULL").select("row", F.lit(0).cast("long").alias("n"), F.col("_id").alias("c"))
    out = linked.union(alone)
    component = F.when(F.col("c") != low, F.col("c"))
    return out.select(
        *[F.col(f"row.`{c}`") for c in rest],
        F.col("n").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col(f"row.`{vec_id}`").cast("long")).alias("kept"),
    )


def _counted(rows: DataFrame, threshold: float) -> DataFrame:
    """`same`, `also`, `n` (links) and `c` (least id of the class) of each distinct vector."""
    found = rows.filter("vec IS NOT NULL")
    first = found.groupBy("same", "also").agg(F.min(F.struct("_id", "label", "size", "vec")).alias("r"), F.count("*").alias("weight"))
    # The hash is the number of a distinct vector; ids can be shared.
    nodes = kept(first.select(F.col("same").alias("node"), "same", "also", "r.*", "weight"))
    books = fit_codebooks(nodes)
    # The squared distance of vectors of length 1 at the threshold.
    reach = 2 - 2 * threshold + 1e-9
    links = _all_links(nodes.select("node", "label", "size", "weight", "vec"), books, reach, threshold)
    counts = kept(links.filter("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n")))
    classes = kept(components(links.filter("u != v").select(F.col("u").alias("a"), F.col("v").alias("b"))))

    named = nodes.join(counts, "node", "left").join(classes, "node", "left")
    named = named.select("same", "also", "_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
                         F.coalesce("component", "node").alias("class"))
    named = kept(named)
    least = kept(named.groupBy("class").agg(F.min("_id").alias("c")))
    return kept(named.join(least, "class").select("same", "also", "n", "c"))


def op2_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings at cosine 0.98."""
    found = near_copies(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select("vec_id", "n_links", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
), u AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN e]) AND list_sum([x * x FOR x IN e]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION
  SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen
), c AS (
  SELECT node AS vec_id, min(seen) AS component_id FROM r GROUP BY node
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
