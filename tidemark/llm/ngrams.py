"""Exact Jaccard join of word n-gram sets by partitioning the universe.

Sets whose sizes lie in a band from a power of two to the next are compared in the band of
the smaller set. Within a band, a hash deals all n-grams into as many segments as the sets
can differ in, and some more. Two sets that link differ in at most k n-grams, so of the
segments that one of them fills at most k differ and the others are equal in both. Each set
sends a hash of each of its filled segments; sets that share one are candidates.

Which segments must be searched is a matter of cost: a set with y filled segments may leave
out y - k - 1 of them, and it leaves out those that most sets share. Passages that very
many documents have in common are thus not searched by. A set whose n-grams happen to fill
only k segments or fewer has no such guarantee; in its band all sets also send their
segments with each single n-gram left out (then two differences are needed to hide a
segment), or, where even that is too little, each n-gram by itself.

What a search takes on disk is bounded by taking it in slices. Segments are dealt into
slices, each with its part of the differences: where k + 1 is the sum of their parts, two
sets that link have a slice in which fewer segments differ than its part says. Texts are
sent to be compared in rounds of a part of all n-grams, and what a slice or round has
shuffled is removed when it ends. Segments whose sets all are of one class, by links found
so far, are not kept.

Equal sets are one: a set goes by a hash of its n-grams, and a task sends what it has to say
of a set once, so that a text which a third of all documents have sends few rows. Candidates
of a segment are compared with its least member and linked ones merged, so that a group of
close copies costs its size, not its square. Where members of different classes remain, all
that share segments, directly or over others, form a cluster. A large cluster whose segments
have few members each is compared segment by segment instead, where that is less work. Either
way members are dealt into blocks of bounded size; each pair of blocks is compared in one
task as a product of 0/1 matrices and gives back a spanning forest of its links. Pairs are
never listed, and every comparison is of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, in_arrow, keyed, kept, stored, table, tidy
from tidemark.llm.graph import components
from tidemark.llm.words import Hasher, Words, mix, new_key, signed, words_of
from tidemark.llm.words import gathered as joined
from tidemark.operators.scale import lookup_join

LENGTH = 5
#: The similarity, as a fraction.
SIMILARITY = (80, 100)
#: Stands for a null id.
NO_ID = -(2**63)
#: Segments for each n-gram that two sets of a band can differ in, and a constant more.
SPARE, MORE = 1.3, 8
#: Members of a block, and n-grams in their sets, on average at most.
BLOCK_SETS, BLOCK_GRAMS = 512, 1 << 18
#: Sets of a cluster beyond which it is asked whether segments by themselves are less work.
LARGE = 16 * BLOCK_SETS
#: N-grams that are columns of a matrix at a time.
TILE = 2048
#: Sets that a task remembers to have sent; then it begins anew.
REMEMBERED = 200_000
#: Slices that segments are searched in, at most, and n-grams of all sets for each.
SLICES, SLICE_GRAMS = 3, 8_000_000
#: N-grams that are sent to be compared in a round, as a part of those of all documents, and at
#: least.
ROUND, ROUND_GRAMS = 0.4, 4_000_000
#: Bits of the filter that keeps sets nobody compares from being sent.
FILTER_BITS = 1 << 22


@dataclass(frozen=True)
class Bands:
    """Sizes, differences and segments for a similarity of p / q."""

    p: int
    q: int

    def differ(self, small, large):
        """Most n-grams that are in one only of two linked sets of these sizes."""
        return (small + large) * (self.q - self.p) // (self.q + self.p)

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.floor(np.log2(size)).astype(np.int64)

    def segments(self, band: np.ndarray) -> np.ndarray:
        top = (np.int64(2) << band) - 1
        return np.ceil(SPARE * (self.differ(top, top * self.q // self.p) + 1)).astype(np.int64) + MORE

    def sides(self, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Side, which sets have it, their band there, and how much they can differ there:
        0, each in its own band; 1, with the smaller sets of the band below."""
        own = self.band(size)
        yield 0, np.ones(len(size), bool), own, self.differ(size, size * self.q // self.p)
        below = (np.int64(1) << own) - 1
        yield 1, (own > 0) & (size * self.p <= below * self.q), own - 1, self.differ(size, below)


def sets_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all rows, row by row in ascending order, and the index of
    each row's first. A row of fewer words has the hash of all of them."""
    hashes, starts = words.runs(length)
    owner = words.owner()[starts]
    counts = words.counts
    for n in range(1, length):
        short = np.flatnonzero(counts == n)
        if len(short):
            at = words.first[short]
            found = np.full(len(short), n, np.uint64)
            for i in range(n):
                found = mix(found + words.hashes[at + i])
            hashes, owner = np.concatenate([hashes, found]), np.concatenate([owner, short])
    # By owner and hash: a quick sort of the hashes, then a stable one of small numbers.
    turn = np.argsort(hashes)
    turn = turn[np.argsort(owner[turn].astype(np.uint16 if len(counts) <= 1 << 16 else np.int64), kind="stable")]
    hashes, owner = hashes[turn], owner[turn]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the rows' values."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def set_names(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's set, whatever order its n-grams are in."""
    size = np.diff(first).astype(np.uint64)
    return signed(mix(_sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), first) + size))


class _Fresh:
    """Whether a task meets a set for the first time, as far back as it remembers."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def __call__(self, names: np.ndarray) -> np.ndarray:
        fresh = np.ones(len(names), bool)
        for i, name in enumerate(names.tolist()):
            if name in self.seen:
                fresh[i] = False
            else:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen.add(name)
        return fresh


@dataclass
class Segments:
    """Filled segments of sets on one side: their set, hash, and the n-grams in them."""

    owner: np.ndarray
    hash: np.ndarray
    filled: np.ndarray  # of each set
    grams: np.ndarray  # hash of each n-gram in its segment
    gram_segment: np.ndarray
    number: np.ndarray  # of each filled segment, in its band

    @staticmethod
    def of(hashes: np.ndarray, first: np.ndarray, chosen: np.ndarray, band: np.ndarray, many: np.ndarray) -> Segments:
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        use = chosen[rows]
        rows, grams = rows[use], hashes[use]
        salted = mix(grams ^ (band[rows].astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))
        segment = ((salted >> np.uint64(20)) % many[rows].astype(np.uint64)).astype(np.int64)
        place = rows * (int(many.max(initial=1)) + 1) + segment
        turn = np.argsort(place)
        place, salted, rows, segment = place[turn], salted[turn], rows[turn], segment[turn]
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        starts = np.append(np.flatnonzero(new), len(place))
        owner = rows[starts[:-1]]
        name = mix(segment[starts[:-1]].astype(np.uint64) + band[owner].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        value = mix(salted)
        return Segments(
            owner, _sums(value, starts) + name, np.bincount(owner, minlength=len(first) - 1),
            value, np.cumsum(new) - 1, segment[starts[:-1]],
        )

    def shares(self, differ: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Which filled segments lie in a slice, and for each set how many of its segments
        there a linked set must share, if it shares so many in no other slice. The parts that
        slices have of `differ` + 1 add up to it; none has more than its filled segments."""
        inside = self.number % parts == part
        here = np.bincount(self.owner[inside], minlength=len(self.filled))
        upto = np.bincount(self.owner[self.number % parts <= part], minlength=len(self.filled))
        some = np.maximum(self.filled, 1)
        most = (differ + 1) * upto // some - (differ + 1) * (upto - here) // some
        return inside, np.where(self.filled > differ, here - most + 1, 0)


def describe(docs: DataFrame, length: int, bands: Bands, secret: bytes) -> DataFrame:
    """`_node`, `_id`, `n`, `set` (hash) of all documents, and `weak`: bands, times four,
    plus 2 or 3, in which the set fills too few segments, and what has to be sent there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(secret)
        for batch in batches:
            for words in words_of(batch.column(2), hasher, fold=True):
                hashes, first = sets_of(words, length)
                size = np.diff(first)
                whole = set_names(hashes, first)
                weak: list[list[int]] = [[] for _ in size]
                some = np.maximum(size, 1)
                for _, chosen, band, differ in bands.sides(some):
                    chosen = chosen & (size > 0)
                    filled = Segments.of(hashes, first, chosen, band, bands.segments(np.maximum(band, 0))).filled
                    for i in np.flatnonzero(chosen & (filled <= differ)):
                        weak[i].append(int(band[i]) * 4 + (2 if 2 * filled[i] > differ[i] else 3))
                rows = len(size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.row, rows), batch.column(1).slice(words.row, rows),
                     pa.array(size.astype(np.int64)), pa.array(whole), pa.array(weak, pa.list_(pa.int32()))],
                    ["_node", "_id", "n", "set", "weak"],
                )

    return in_arrow(docs.select("_node", "_id", "text"), run, "_node long, _id long, n long, set long, weak array<int>")


def signatures(
    docs: DataFrame, length: int, bands: Bands, levels: dict[int, int], secret: bytes, part: int = 0, parts: int = 1
) -> DataFrame:
    """`key` (hash of a segment), `_node` (name of the set), `code`: how many of its segments a
    linked set must share (times two, plus the side), of one of several slices of the segments.
    Several tasks may send the same rows.
    """

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        hasher, fresh = Hasher(secret), _Fresh()
        for batch in batches:
            for words in words_of(batch.column(0), hasher, fold=True):
                hashes, first = sets_of(words, length)
                size = np.diff(first)
                some = np.maximum(size, 1)
                node = set_names(hashes, first)
                wanted = fresh(node) & (size > 0)
                for side, chosen, band, differ in bands.sides(some):
                    chosen = chosen & wanted
                    found = Segments.of(hashes, first, chosen, band, bands.segments(np.maximum(band, 0)))
                    level = np.array([levels.get(int(b), 1) for b in band])
                    inside, share = found.shares(differ, part, parts)
                    code = (np.where(level > 1, 0, share).astype(np.int64) << 1) | side
                    owner = found.owner[inside]
                    yield found.hash[inside], node[owner], code[owner]
                    gram_owner = found.owner[found.gram_segment]
                    gram_inside = inside[found.gram_segment]
                    if (level > 1).any():
                        use = (level[gram_owner] > 1) & gram_inside
                        less = (found.hash[found.gram_segment] - found.grams)[use]
                        # A segment of one n-gram, without it, is empty and says nothing.
                        alone = np.bincount(found.gram_segment, minlength=len(found.owner))[found.gram_segment] == 1
                        use2 = ~alone[use]
                        yield less[use2], node[gram_owner[use]][use2], code[gram_owner[use]][use2]
                    if (level > 2).any():
                        use = (level[gram_owner] > 2) & gram_inside
                        single = mix(found.grams[use] ^ np.uint64(0x2545F4914F6CDD1D))
                        yield single, node[gram_owner[use]], code[gram_owner[use]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, code in joined(found_in(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(node), pa.array(code)], ["key", "_node", "code"]
            )

    return in_arrow(docs.select("text"), run, "key long, _node long, code long")


def _filter_of(nodes: DataFrame) -> np.ndarray:
    """The nodes as a table of FILTER_BITS truth values, whose size does not depend on their
    number; an entry may be true because of another node."""
    place = F.pmod("_node", F.lit(FILTER_BITS))
    bits = nodes.select(F.floor(place / 32).alias("word"), (place % 32).cast("int").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(FILTER_BITS, bool)
    for r in words.collect():
        table[r.word * 32 : r.word * 32 + 32] = [r.bits >> i & 1 for i in range(32)]
    return table


def gathered(docs: DataFrame, rows: DataFrame, first: DataFrame) -> DataFrame:
    """`rows`, which name sets (`_node`), each with the `text` of a document that has the set.
    `first` has the documents of sets (`set`, `_node`). A row can come several times, if its
    document does."""
    named = rows.withColumnRenamed("_node", "set").join(first.select("set", "_node"), "set")
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(_filter_of(named.select("_node"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(packed.value).view(bool)
        fresh = _Fresh()
        for batch in batches:
            nodes = np.asarray(batch.column(0)).astype(np.int64)
            at = np.flatnonzero(passes[nodes % FILTER_BITS])
            at = at[fresh(nodes[at])]
            yield batch.take(pa.array(at))

    found = in_arrow(docs.select("_node", "text"), run, "_node long, text string")
    return found.join(named, "_node").drop("_node").withColumnRenamed("set", "_node")


def _grams(texts: pa.Array, hasher: Hasher, length: int) -> list[np.ndarray]:
    """The n-grams of each text, in ascending order."""
    out = []
    for words in words_of(texts, hasher, fold=True):
        hashes, first = sets_of(words, length)
        out += [hashes[first[i] : first[i + 1]] for i in range(len(first) - 1)]
    return out


def _in_groups(
    rows: DataFrame, docs: DataFrame, first: DataFrame, group: tuple[str, ...], rest: tuple[str, ...], total: int,
    length: int, secret: bytes, found_in,
) -> DataFrame:
    """Links `a`, `b` that `found_in` finds in groups of rows: from the group's values and
    from each member once, with its `_node`, the values `rest` and its n-grams. Groups are
    dealt into rounds, and none sends much more than a part of the n-grams of all documents."""
    grams = rows.join(first.select(F.col("set").alias("_node"), "n"), "_node").agg(F.sum("n").alias("n")).first().n or 0
    rounds = max(1, -(-grams // max(ROUND_GRAMS, int(ROUND * total))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            found = found_in(key, list(held.values()))
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        hasher, key, held = Hasher(secret), None, {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns - 1)]
            for *values, own in zip(*columns, _grams(batch.column(batch.num_columns - 1), hasher, length), strict=True):
                if (new := tuple(values[: len(group)])) != key:
                    if held:
                        yield flush()
                    key, held = new, {}
                held[values[len(group)]] = (*values[len(group) :], own)
        if held:
            yield flush()

    out = None
    for i in range(rounds):
        some = rows.filter(F.pmod(F.xxhash64(F.lit("round"), *group), F.lit(rounds)) == i)
        texts = gathered(docs, some, first).select(*group, "_node", *rest, "text")
        links = kept(in_arrow(texts.repartition(*group).sortWithinPartitions(*group), run, "a long, b long"))
        out = links if out is None else out.union(links)
    return out


def linked(pairs: DataFrame, docs: DataFrame, first: DataFrame, total: int, length: int, bands: Bands, secret: bytes) -> DataFrame:
    """The pairs (`a`, `b`) whose sets reach the similarity. The sets that are paired with one
    are dealt into blocks, to each of which that one is sent as well."""

    def found_in(key: tuple, held: list[tuple]) -> list[tuple[int, int]]:
        centre = next((grams for node, grams in held if node == key[0]), None)
        if centre is None:
            return []
        found = []
        for node, grams in held:
            both = len(np.intersect1d(centre, grams, assume_unique=True)) if node != key[0] else 0
            if both and bands.q * both >= bands.p * (len(centre) + len(grams) - both):
                found.append((node, key[0]))
        return found

    many = kept(pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("parts")))
    members = pairs.join(many, "b").select("b", F.pmod(F.xxhash64(F.lit("star"), "a"), "parts").cast("int").alias("part"), F.col("a").alias("_node"))
    centres = many.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("b").alias("_node"))
    return _in_groups(kept(members.union(centres)), docs, first, ("b", "part"), (), total, length, secret, found_in)


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric table of links."""
    fresh, edges = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not fresh[root]:
            continue
        fresh[root] = False
        queue = [root]
        for u in queue:
            new = np.flatnonzero(links[u] & fresh)
            fresh[new] = False
            edges += [(u, v) for v in new.tolist()]
            queue += new.tolist()
    return edges


def _block_links(sets: list[np.ndarray], classes: np.ndarray, cross: np.ndarray | None, bands: Bands) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of different classes; with `cross`,
    only of links between sets for which it is true and sets for which it is not."""
    size = np.array([len(x) for x in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), size)
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    use = shared[gram]
    column = (np.cumsum(shared) - 1)[gram[use]]
    turn = np.argsort(column, kind="stable")
    column, rows = column[turn], rows[use][turn]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), TILE):
        low, high = np.searchsorted(column, (start, start + TILE))
        tile = np.zeros((len(sets), TILE), np.float32)
        tile[rows[low:high], column[low:high] - start] = 1
        both += tile @ tile.T
    # q * common >= p * (x + y - common), row by row so that no large table of sums is made.
    links = np.empty(both.shape, bool)
    for i, common in enumerate(both):
        links[i] = (bands.p + bands.q) * common.astype(np.int64) >= bands.p * (size[i] + size)
    links &= classes[:, None] != classes[None, :]
    if cross is not None:
        links &= cross[:, None] != cross[None, :]
    return _forest(links)


def compared(
    clusters: DataFrame, docs: DataFrame, first: DataFrame, classes: DataFrame, total: int, length: int, bands: Bands, secret: bytes
) -> DataFrame:
    """Links `a`, `b` that connect what is linked in a cluster across classes.

    `clusters` has `_node`, `cluster`; `classes` has `_node`, `c` where that is another. A cluster of n members in k blocks sends each member
    k times, with k about n / BLOCK_SETS, and at once if it is small.
    """

    def found_in(key: tuple, held: list[tuple]) -> list[tuple[int, int]]:
        if len(held) < 2 or len({h[1] for h in held}) < 2:
            return []
        own = np.array([h[2] for h in held])
        cross = own == key[1] if key[1] != key[2] else None
        found = _block_links([h[3] for h in held], np.array([h[1] for h in held]), cross, bands)
        return [(held[u][0], held[v][0]) for u, v in found]

    sizes = first.select(F.col("set").alias("_node"), "n")
    members = clusters.join(sizes, "_node").join(classes, "_node", "left")
    members = kept(members.select("cluster", "_node", F.coalesce("c", "_node").alias("c"), "n"))
    many = members.groupBy("cluster").agg(F.count("*").alias("many"), F.sum("n").alias("grams"))
    parts = F.greatest(F.ceil(F.col("many") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    dealt = members.join(kept(many.select("cluster", parts.alias("parts"))), "cluster")
    own = F.pmod(F.xxhash64(F.lit("block"), "_node"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "_node", "c", "own"
    )
    return _in_groups(dealt, docs, first, ("cluster", "i", "j"), ("c", "own"), total, length, secret, found_in)


def _fits(n: str, m: str, bands: Bands):
    """Sizes that allow the similarity at all."""
    low, high = F.least(n, m), F.greatest(n, m)
    return low * bands.q >= high * bands.p


def searched(keys: DataFrame) -> DataFrame:
    """Segments that several sets share and at least one is searched by: `key`, `_node`."""
    each = Window.partitionBy("key")
    told = {"times": F.count("*").over(each), "low": F.min("_node").over(each), "high": F.max("_node").over(each)}
    shared = keys.withColumns(told).filter("low != high").drop("low", "high").distinct()
    # One number of the side, the times and the segments to share makes the rows that move smaller.
    info = F.shiftleft(F.least("times", F.lit((1 << 30) - 1)), 32).bitwiseOR(F.col("code"))
    own = Window.partitionBy("_node", F.col("info") % 2)
    rank = F.row_number().over(own.orderBy(F.shiftright("info", 32), "key"))
    # Of its shared segments a set must have `code >> 1` in common with any that it links to.
    share = F.shiftright(F.col("info") % (1 << 32), 1)
    probe = rank <= F.count("*").over(own) - share + 1
    found = shared.select("key", "_node", info.alias("info")).select("key", "_node", probe.alias("probe"))
    group = Window.partitionBy("key")
    found = found.withColumns({"size": F.count("*").over(group), "any": F.max("probe").over(group)})
    return found.filter("size > 1 AND any").select("key", "_node")


def _mixed(found: DataFrame, class_of: DataFrame) -> DataFrame:
    """Of (`key`, `_node`) the segments with members of different classes."""
    group = Window.partitionBy("key")
    named = found.join(class_of, "_node", "left").withColumn("c", F.coalesce("c", "_node"))
    mixed = named.withColumns({"low": F.min("c").over(group), "high": F.max("c").over(group)})
    return mixed.filter("low != high").select("key", "_node")


def _dealt(mixed: DataFrame) -> DataFrame:
    """`_node`, `cluster`: what has to be compared with one another, from (`key`, `_node`),
    the segments with members of different classes."""
    ties = mixed.select(F.col("_node").alias("a"), F.min("_node").over(Window.partitionBy("key")).alias("b"))
    clusters = kept(components(ties.distinct()).select(F.col("node").alias("_node"), F.col("component").alias("cluster")))
    size = clusters.groupBy("cluster").agg(F.count("*").alias("n")).filter(F.col("n") > LARGE)
    if not size.limit(1).count():
        return clusters
    placed = kept(mixed.distinct().join(clusters, "_node"))
    # Pairs that are compared, and members that are sent (each for as many as a block has).
    each = placed.groupBy("cluster", "key").agg(F.count("*").alias("m"))
    work = each.groupBy("cluster").agg(F.sum(F.col("m") * (F.col("m") + BLOCK_SETS)).alias("by_key"))
    apart = size.join(work, "cluster").filter(F.col("by_key") < 2.0 * F.col("n") * F.col("n"))
    apart = kept(apart.select("cluster", F.lit(True).alias("apart")))
    whole = lookup_join(clusters, apart, "cluster").filter("apart IS NULL").select("_node", "cluster")
    single = lookup_join(placed, apart, "cluster").filter("apart")
    return whole.union(single.select("_node", F.xxhash64(F.lit("key"), "key")))


def _classed(
    df: DataFrame,
    doc_id: str,
    text: str,
    length: int = LENGTH,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """`row` (of `df`), `_node`, `n` (size of the set) and `least` (`_id` and `_node` of the
    least member of the class) of all documents.

    The set of a document is that of its runs of `length` words, A to Z taken as a to z;
    with fewer words, all of them as one. Documents without words have no set and link with
    nothing. Ids must be of an integer type; a null id comes before all others. Rows with
    equal id and text are one document; different texts of one id are different documents.
    An empty table gives no rows; other columns pass unchanged.
    """
    with tidy(df.sparkSession):
        return _classed_in_slices(df, doc_id, text, length, Bands(*similarity))


def _classed_in_slices(df: DataFrame, doc_id: str, text: str, length: int, bands: Bands) -> DataFrame:
    plain = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.col(f"`{text}`").alias("text"),
    )
    docs, secret = keyed(plain, "_id", "text"), new_key()
    sizes = kept(describe(docs, length, bands, secret))
    filled = sizes.filter("n > 0")
    weak = filled.select(F.explode("weak").alias("w")).groupBy((F.col("w") / 4).cast("int").alias("band"))
    levels = {r.band: r.level for r in weak.agg(F.max(F.col("w") % 4).alias("level")).collect()}  # one row a band

    first = filled.groupBy("set", "n").agg(F.min(F.struct("_id", "_node")).alias("r"))
    first = kept(first.select("set", "n", "r._id", "r._node"))
    total = sizes.agg(F.sum("n").alias("n")).first().n or 0
    parts = max(1, min(SLICES, -(-total // SLICE_GRAMS)))
    links, class_of, tried, slices = None, None, None, []
    for part in range(parts):
        found = stored(searched(signatures(docs, length, bands, levels, secret, part, parts)), "segments")
        if class_of is not None:
            whole, found = found, stored(_mixed(found, class_of), "segments")
            dropped(whole)
        star = found.withColumn("b", F.min("_node").over(Window.partitionBy("key"))).filter("_node != b")
        star = star.select(F.col("_node").alias("a"), "b").distinct()
        for end, n in (("a", "n"), ("b", "m")):
            star = star.join(first.select(F.col("set").alias(end), F.col("n").alias(n)), end)
        star = star.filter(_fits("n", "m", bands)).select("a", "b")
        star = kept(star if tried is None else star.join(tried, ["a", "b"], "left_anti"))
        tried = star if tried is None else tried.union(star)
        new = linked(star, docs, first, total, length, bands, secret)
        links = new if links is None else links.union(new)
        # A class so far is a least member and what links to it.
        class_of = kept(links.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("c")))
        slices.append(stored(_mixed(found, class_of), "segments"))
        dropped(found)

    mixed = slices[0]
    for some in slices[1:]:
        mixed = mixed.union(some)
    clusters = _dealt(mixed)
    across = compared(clusters, docs, first, class_of, total, length, bands, secret)
    classes = kept(components(links.union(across)))
    for some in slices:
        dropped(some)

    # From representatives to all sets, from sets to documents. Each least member is
    # written before it is joined, so that a large class can be split.
    named = first.join(classes.withColumnRenamed("node", "set"), "set", "left")
    own = F.struct("_id", "_node")
    named = kept(named.select("set", "n", own.alias("own"), F.coalesce("component", "set").alias("class")))
    least = kept(named.groupBy("class").agg(F.min("own").alias("least")))
    named = kept(named.join(least, "class").select("set", "n", "least"))
    members = filled.select("_node", "n", "set").join(named, ["set", "n"]).select("_node", "n", "least")
    alone = sizes.filter("n = 0").select("_node", "n", own.alias("least"))
    result = members.union(alone).distinct()
    return docs.select("row", "_node").join(result, "_node")


def similar_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """`df` with `n_shingles` and `component_id`, which replace columns of these names.

    `component_id` is the least id that links reach; see `_classed` for the rest.
    """
    taken = ("n_shingles", "component_id")
    component = F.when(F.col("least._id") != NO_ID, F.col("least._id"))
    rest = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in taken]
    return _classed(df, doc_id, text, **how).select(
        *rest, F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The least document of each class, in the columns of `df`; of rows that are repeated
    with equal id and text, one. Documents without words are all kept."""
    found = _classed(df, doc_id, text, **how).filter("_node = least._node")
    return found.dropDuplicates(["_node"]).select("row.*")


def op9_partitioned_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under Jaccard similarity 0.8 of five-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_classes(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))]) AS g
  FROM d WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
), r AS (
  SELECT doc_id AS node, doc_id AS seen FROM d
  UNION
  SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen
), c AS (
  SELECT node AS doc_id, min(seen) AS component_id FROM r GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
