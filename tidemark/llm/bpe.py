"""BPE encoding and decoding as bounded-lookahead transducers.

A merge decision depends on what follows only through rules that could take the right
neighbour away first. Such a rule must have a lower rank, its left part must lie on the
right edge of the neighbour's merge tree, and whether it applies depends in turn on rules
of still lower rank. The longest such chain, in bytes, is the merge list's sufficient
lookahead; one pass over the list in order of rank finds it. Boundaries that far from the
end of what was read can't change any more, and merging can start anew at each of them. So
the encoder holds a window of a fixed multiple of the lookahead, emits the tokens that are
stable, and goes on: memory is constant, however long a run of letters is. Pieces that fit
into a window are whole at once; those of one stretch of the texts are merged side by side,
one merge of each in a step.

The vocabulary file is of the `tokenizers` library: characters composed (NFC), lower case,
split by a pattern, bytes as characters, a mark at the end of a word. Special tokens in a
text are found before anything else. Characters that Python's tables do not know are
normalised and split by the library itself; so are texts with marks that its tables order
otherwise than Python's do, which is found out mark by mark.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_arrow, table, with_columns

#: Characters of a text that are taken at a time; a slice ends at white space.
SLICE = 1 << 16
#: Characters that are normalised before the stretches that are new among them are merged.
AHEAD = 1 << 18
#: Distinct stretches without white space whose tokens a worker remembers (as many again may
#: be left from before, until they are asked for or replaced; what is ahead may exceed it), and
#: the longest, in characters; longer ones and pieces of more bytes go window by window.
REMEMBERED, LONGEST = 120_000, 64
_NEVER, _NO_RULE = 1 << 60, np.int32((1 << 31) - 1)
#: Bits of a token's number in that of a pair.
SHIFT = 24
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\p{White_Space}+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others
    for the next characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


#: A mark of each of the common places: through, below, above, and last of all.
COMMON_MARKS = "\u0334\u0323\u0301\u0345"


def _marks() -> Iterator[str]:
    return (c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M")


@lru_cache(maxsize=1 << 16)
def _unassigned(char: str) -> bool:
    return unicodedata.category(char) == "Cn"


def _unknown(text: str) -> bool:
    """Whether Python's tables lack a character of the text."""
    return any(map(_unassigned, set(text)))


class Names:
    """The tokens of a vocabulary file, as text and as bytes: all that decoding needs."""

    def __init__(self, content: bytes):
        self.spec = spec = json.loads(content)
        model = spec["model"]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, to_bytes = spec["pre_tokenizer"]["pretokenizers"]
        if (
            steps != ["NFC", "Replace", "Lowercase"]
            or (split["type"], split["behavior"], split["invert"]) != ("Split", "Removed", True)
            or (to_bytes["type"], to_bytes["add_prefix_space"], to_bytes["use_regex"]) != ("ByteLevel", False, False)
            or spec["decoder"] is not None
            or any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"])
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        ):
            raise ValueError("a vocabulary of another kind")
        self.ends = model["end_of_word_suffix"]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        bytes_of = {c: b for b, c in enumerate(byte_characters())}
        self.bytes = {
            i: t.encode() if t in self.special else self._raw(t, bytes_of) for i, t in self.names.items()
        }

    def _raw(self, token: str, bytes_of: dict[str, int]) -> bytes:
        """Bytes that a token stands for; the end of a word stands for a space."""
        ends = token.endswith(self.ends)
        return bytes(bytes_of[c] for c in token.removesuffix(self.ends)) + b" " * ends

    def decode(self, ids: Iterable[int] | None) -> str:
        """As the library does where the file names no decoder: names, joined by a space."""
        return " ".join([self.names[i] for i in ids or ()])

    def text(self, ids: Iterable[int] | None) -> Iterator[str]:
        """Readable text, as far as bytes make whole characters; broken ones are replaced."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids or ():
            if out := machine.decode(self.bytes[i]):
                yield out
        if out := machine.decode(b"", final=True):
            yield out


class Bpe(Names):
    """The merge list of a vocabulary file, and what follows from it."""

    def __init__(self, content: bytes):
        super().__init__(content)
        spec, model = self.spec, self.spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(split["pattern"]["Regex"])
        pattern = tokenizers.Regex(split["pattern"]["Regex"])
        self.newer_split = tokenizers.pre_tokenizers.Split(pattern, "removed", invert=True)
        names = tokenizers.normalizers
        self.own_form = names.Sequence([names.NFC(), names.Lowercase()])
        odd = [c for c in _marks() if self._ordered_otherwise(c)]
        self.odd_marks = frozenset(odd).union(*(unicodedata.normalize("NFD", c) for c in odd))
        ids = model["vocab"]
        found = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(found)) if found else None
        chars = byte_characters()
        self.inner = [ids[c] for c in chars]
        self.final = [ids[c + self.ends] for c in chars]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)}
        # The same under one number for a pair, which is quicker to look up.
        self.packed = {a << SHIFT | b: r for (a, b), r in self.rank.items()}
        self.made = [ids[a + b] for a, b in merges]
        if len(set(self.made)) < len(merges):
            raise ValueError("two merges make the same token")
        self.parts = dict(zip(self.made, self.rank, strict=True))
        self.width = dict.fromkeys([*self.inner, *self.final], 1)
        self.lookahead = self._sufficient_lookahead()
        self.window = 4 * self.lookahead + 64
        # The same as arrays, pairs in order, to merge many words at a time.
        self.pairs = np.array(sorted(self.packed), np.int64)
        self.pair_ranks = np.array([self.packed[k] for k in self.pairs.tolist()], np.int32)
        self.made_of = np.array(self.made, np.int32)
        self.firsts, self.lasts = np.array(self.inner, np.int32), np.array(self.final, np.int32)
        self.first_ranks = self._ranks(self.firsts[:, None], self.firsts)
        self.last_ranks = self._ranks(self.firsts[:, None], self.lasts)
        self.digits = {i: str(i) for i in self.names}
        self.forget()

    def forget(self) -> None:
        """Let go of the stretches that were met."""
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ordered_otherwise(self, mark: str) -> bool:
        """Whether the library puts the mark at another place among marks of every kind, or
        makes it of other parts."""
        text = "".join(f"a{c}{mark}{c}" for c in COMMON_MARKS) + unicodedata.normalize("NFD", "a" + mark)
        return self.own_form.normalize_str(text) != unicodedata.normalize("NFC", text).lower()

    def _sufficient_lookahead(self) -> int:
        taker: dict[int, int] = {}  # most bytes that decide whether a rule takes this token
        for (left, right), made in zip(self.rank, self.made, strict=True):
            self.width[made] = self.width[left] + self.width[right]
            if any(self.rank.get(self.parts.get(x), -1) > self.rank[left, right] for x in (left, right)):
                raise ValueError("a merge precedes one that it needs")
            far, edge = 0, right
            while edge is not None:
                far = max(far, taker.get(edge, 0))
                edge = self.parts[edge][1] if edge in self.parts else None
            taker[left] = max(taker.get(left, 0), self.width[right] + far)
        return max(taker.values(), default=0)

    def merge(self, tokens: list[int]) -> list[int]:
        """Tokens after all merges, lowest rank first, then from left to right."""
        if len(tokens) > LONGEST:
            return self._merge_long(tokens)
        get, made, tokens = self.packed.get, self.made, list(tokens)
        ranks = [get(a << SHIFT | b, _NEVER) for a, b in pairwise(tokens)]
        while ranks and (least := min(ranks)) < _NEVER:
            i = ranks.index(least)
            tokens[i] = new = made[least]
            del ranks[i], tokens[i + 1]
            if i < len(ranks):
                ranks[i] = get(new << SHIFT | tokens[i + 1], _NEVER)
            if i:
                ranks[i - 1] = get(tokens[i - 1] << SHIFT | new, _NEVER)
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        size = len(tokens)
        here: list[int | None] = list(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i in range(size - 1) if (r := self.rank.get((here[i], here[i + 1]), _NEVER)) < _NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if here[i] is None or j >= size or self.rank.get((here[i], here[j])) != r:
                continue
            here[i], here[j] = self.made[r], None
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size and (again := self.rank.get((here[a], here[b]))) is not None:
                    heapq.heappush(heap, (again, a))
        return [t for t in here if t is not None]

    def piece(self, piece: str) -> Iterator[int]:
        """Ids of one match of the pattern, window by window."""
        data = piece.encode()
        start = 0
        while len(data) - start > self.window:
            stop = start + self.window
            end = start
            for token in self.merge([self.inner[b] for b in data[start:stop]]):
                if end + self.width[token] > stop - self.lookahead:
                    break
                end += self.width[token]
                yield token
            start = end
        tokens = [self.inner[b] for b in data[start:]]
        tokens[-1] = self.final[data[-1]]
        yield from self.merge(tokens)

    def matches(self, stretch: str) -> Iterator[str]:
        if not stretch.isascii() and _unknown(stretch):
            return (piece for piece, _ in self.newer_split.pre_tokenize_str(stretch))
        return (match[0] for match in self.pieces.finditer(stretch))

    def stretch(self, stretch: str) -> Iterator[int]:
        for match in self.matches(stretch):
            yield from self.piece(match)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; where a token is missing (-1) or no rule fits, `_NO_RULE`."""
        wanted = left.astype(np.int64) << SHIFT | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], _NO_RULE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Tokens, as 32-bit numbers, of words that are not empty, merged step by step together.

        A word takes one merge a step, the leftmost of its lowest rank, so after a step all
        words that go on are one token shorter. Words of like length share an array.
        """
        done = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for low, high in pairwise((0, 4, 6, 8, 10, 12, 16, 24, 32, LONGEST)):
            chosen = order[np.searchsorted(sizes[order], low, "right") : np.searchsorted(sizes[order], high, "right")]
            for start in range(0, len(chosen), 4096):
                some = chosen[start : start + 4096]
                self._merge_alike(words, some, sizes[some], done)
        return done

    def _merge_alike(self, words: list[bytes], left: np.ndarray, sizes: np.ndarray, done: list[bytes]) -> None:
        width, rows = int(sizes.max()), np.arange(len(left))
        filled = b"".join([words[i].ljust(width, b"\0") for i in left.tolist()])
        data = np.frombuffer(filled, np.uint8).reshape(len(left), width)
        tokens = np.where(np.arange(width) < sizes[:, None], self.firsts[data], np.int32(-1))
        tokens[rows, sizes - 1] = self.lasts[data[rows, sizes - 1]]
        ranks = self.first_ranks[data[:, :-1], data[:, 1:]]
        ranks[np.arange(1, width) >= sizes[:, None]] = _NO_RULE
        two = np.flatnonzero(sizes > 1)
        end = sizes[two]
        ranks[two, end - 2] = self.last_ranks[data[two, end - 2], data[two, end - 1]]
        while len(left):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                rank = ranks[rows, at]
                more = rank < _NO_RULE
            else:
                at, rank, more = rows, rows, np.zeros(len(left), bool)
            if not more.all():
                ready = ~more
                ended, wide = tokens[ready].tobytes(), 4 * tokens.shape[1]
                for k, (i, size) in enumerate(zip(left[ready].tolist(), sizes[ready].tolist(), strict=True)):
                    done[i] = ended[k * wide : k * wide + 4 * size]
                left, sizes, tokens, ranks = left[more], sizes[more], tokens[more], ranks[more]
                if not len(left):
                    return
                rows, at, rank = np.arange(len(left)), at[more], rank[more]
            # What stands right of the pair moves up by one, then its neighbours are asked anew.
            places = np.arange(tokens.shape[1] - 1)
            tokens = np.where(places > at[:, None], tokens[:, 1:], tokens[:, :-1])
            ranks = np.where(places[:-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            tokens[rows, at] = new = self.made_of[rank]
            sizes = sizes - 1
            after, before = np.flatnonzero(at < ranks.shape[1]), np.flatnonzero(at)
            ranks[after, at[after]] = self._ranks(new[after], tokens[after, at[after] + 1])
            ranks[before, at[before] - 1] = self._ranks(tokens[before, at[before] - 1], new[before])

    def learn(self, stretches: set[str]) -> None:
        """Remember the ids of stretches of up to `LONGEST` characters."""
        if len(self.memory) >= REMEMBERED:
            self.older, self.memory = self.memory, {}
        memory, older = self.memory, self.older
        alone: list[str] = []
        parts: dict[str, list[str]] = {}
        for stretch in stretches.difference(memory):
            if (found := older.get(stretch)) is not None:
                memory[stretch] = found
            elif len(stretch) <= LONGEST:
                # Letters alone are one match of the pattern.
                if stretch.isalpha():
                    alone.append(stretch)
                else:
                    parts[stretch] = list(self.matches(stretch))
        rest = {piece for matches in parts.values() for piece in matches}.difference(alone)
        known = {piece: memory[piece] for piece in rest if piece in memory and piece.isalpha()}
        pieces = [*alone, *rest.difference(known)]
        data = [piece.encode() for piece in pieces]
        for i, word in enumerate(data):
            if len(word) > LONGEST:
                known[pieces[i]] = np.fromiter(self.piece(pieces[i]), np.int32).tobytes()
                pieces[i] = data[i] = None
        known.update(zip(filter(None, pieces), self.merge_many(list(filter(None, data))), strict=True))
        for stretch in alone:
            memory[stretch] = known[stretch]
        for stretch, matches in parts.items():
            memory[stretch] = b"".join([known[piece] for piece in matches])

    def sections(self, text: str) -> Iterator[list[str] | int]:
        """Ids of special tokens, and lists of normalised stretches between white space."""
        marks = self.special_pattern.finditer(text) if self.special_pattern else ()
        start = 0
        for mark in marks:
            yield from self._slices(text, start, mark.start())
            yield self.special[mark[0]]
            start = mark.end()
        yield from self._slices(text, start, len(text))

    def _slices(self, text: str, start: int, end: int) -> Iterator[list[str]]:
        while start < end:
            stop = end
            if end - start > SLICE and (space := _SPACES.search(text, start + SLICE, end)):
                stop = space.end()
            part = text[start:stop]
            if part.isascii():
                part = part.lower()
            elif _unknown(part) or not self.odd_marks.isdisjoint(part):
                part = self.own_form.normalize_str(part)
            else:
                # Each character by itself: str.lower() alone would heed the end of a word.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            yield _SPACES.split(part) if _ODD_SPACE.search(part) else part.split()
            start = stop

    def encode(self, text: str | None) -> Iterator[int]:
        for _, ids in self.ids_of([text]):
            yield from ids.tolist()

    def chunks(self, text: str | None) -> Iterator[tuple[int, str, str]]:
        """Encoded and decoded text in step: counts of tokens, their ids and their names."""
        return (self.told(ids) for _, ids in self.ids_of([text]))

    def told(self, ids: np.ndarray) -> tuple[int, str, str]:
        """Number of ids, the ids and their names as text."""
        plain = ids.tolist()
        return len(plain), " ".join([self.digits[i] for i in plain]), self.decode(plain)

    def ids_of(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """Ids of several texts in order, some at a time (never none), each with the number of
        its text. They are read a few slices ahead, so that new words can be merged together."""
        held: list[tuple[int, list[str] | int]] = []
        ahead = 0
        for row, text in enumerate(texts):
            for section in self.sections(text or ""):
                held.append((row, section))
                ahead += 1 if isinstance(section, int) else sum(map(len, section)) + len(section)
                if ahead >= AHEAD:
                    yield from self._known(held)
                    held, ahead = [], 0
        yield from self._known(held)

    def _known(self, held: list[tuple[int, list[str] | int]]) -> Iterator[tuple[int, np.ndarray]]:
        self.learn(set().union(*[section for _, section in held if not isinstance(section, int)]))
        for row, section in held:
            if isinstance(section, int):
                yield row, np.array([section], np.int32)
                continue
            start = 0
            for i in [i for i, n in enumerate(map(len, section)) if n > LONGEST]:
                yield from self._remembered(row, section[start:i])
                tokens = self.stretch(section[i])
                while ids := list(islice(tokens, 4096)):
                    yield row, np.array(ids, np.int32)
                start = i + 1
            yield from self._remembered(row, section[start:] if start else section)

    def _remembered(self, row: int, stretches: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        if ids := b"".join(map(self.memory.__getitem__, stretches)):
            yield row, np.frombuffer(ids, np.int32)


@lru_cache(maxsize=4)
def _load(content: bytes) -> Bpe:
    return Bpe(content)


@lru_cache(maxsize=4)
def _load_names(content: bytes) -> Names:
    return Names(content)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes for the workers: a fixed size of a few MB, whatever the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _mapped(df: DataFrame, column: str, made: dict[str, T.DataType], each) -> DataFrame:
    """`df` with columns `made` from `column`, which replace those of the same names."""
    taken = {name.lower() for name in made}
    at = df.columns.index(column)
    rest = [i for i, c in enumerate(df.columns) if c.lower() not in taken]
    schema = with_columns(df.limit(0), **{k: F.lit(None).cast(v) for k, v in made.items()}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        convert, release = each()
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                rows = convert(batch.column(at).to_pylist())
                columns = [
                    pa.array([r[k] for r in rows], to_arrow_type(kind)) for k, kind in enumerate(made.values())
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in rest], *columns], [*[batch.schema.names[i] for i in rest], *made]
                )
        # The worker lives on, perhaps for a stage that needs the room.
        release()

    return in_arrow(df, run, schema)


def encode(df: DataFrame, words: Broadcast, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the ids of its texts; none for a null or empty text. One row at a time;
    the ids of a row are as long as they are. A column named `ids` is replaced."""

    def each():
        bpe = _load(words.value)

        def convert(values: list[str | None]) -> list[tuple[np.ndarray]]:
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int32)] for _ in values]
            for row, ids in bpe.ids_of(values):
                parts[row].append(ids)
            return [(np.concatenate(p),) for p in parts]

        return convert, _load.cache_clear

    return _mapped(df, text, {ids: T.ArrayType(T.IntegerType())}, each)


def decode(df: DataFrame, words: Broadcast, ids: str = "ids", text: str = "decoded", readable: bool = False) -> DataFrame:
    """`df` with the text of its ids: names joined by a space, or `readable` text."""

    def each():
        known = _load_names(words.value)

        def convert(values: list[list[int] | None]) -> list[tuple[str]]:
            return [("".join(known.text(v)) if readable else known.decode(v),) for v in values]

        return convert, _load_names.cache_clear

    return _mapped(df, ids, {text: T.StringType()}, each)


def fingerprints(df: DataFrame, words: Broadcast, text: str = "text") -> DataFrame:
    """`df` with `n_tokens`, `ids_sha256` and `decoded_sha256` of its texts.

    Encoder and decoder run in step and what they give goes into the digests at once, so
    neither ids nor decoded text of a document are ever held: memory is a few slices.
    Between its tasks a worker keeps the merge list (about 50 MB), not the words it met.
    """

    def each():
        bpe = _load(words.value)

        def convert(values: list[str | None]) -> list[tuple[int, str, str]]:
            told = [[0, hashlib.sha256(), hashlib.sha256()] for _ in values]
            for row, found in bpe.ids_of(values):
                count, some_ids, some_names = bpe.told(found)
                many, ids, names = told[row]
                if many:
                    ids.update(b" ")
                    names.update(b" ")
                told[row][0] = many + count
                ids.update(some_ids.encode())
                names.update(some_names.encode())
            return [(many, ids.hexdigest(), names.hexdigest()) for many, ids, names in told]

        return convert, bpe.forget

    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return _mapped(df, text, made, each)


def op6_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the tokens of all documents and of the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    return fingerprints(docs, words).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
