"""Words of many texts at once, as numpy arrays of 64-bit hashes, and hashes of runs of words.

A word is a longest run of bytes other than blank and tab to carriage return. Its hash is
made of its length and its bytes, eight at a time, by a mixture with numbers that each run of
a query draws anew, so no texts can be made whose words are taken as equal; words of more
than LONG bytes have a keyed BLAKE2 digest. A run of words is hashed from the hashes of its
words, pair by pair and pairs of pairs, by a mixture that is linear in neither. Equal words
and runs have equal hashes wherever they stand; different ones collide with a chance of about
2**-64.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at a time; a longer word is handled alone.
CHUNK = 1 << 18
#: Bytes of a word that are mixed eight at a time.
LONG = 64


def new_key() -> bytes:
    """A key for the hashes of one run, the same in all of its tasks."""
    return secrets.token_bytes(16)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; no two numbers become the same."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of runs that follow one another, from those of the two."""
    return mix(mix(left ^ np.uint64(0x9E3779B97F4A7C15)) + right)


class Hasher:
    """Hashes of words under a key."""

    def __init__(self, key: bytes) -> None:
        self.key = key
        numbers = [blake2b(bytes([i]), digest_size=8, key=key).digest() for i in range(LONG // 8 + 1)]
        self.numbers = np.frombuffer(b"".join(numbers), np.uint64)
        self.masks = np.append((np.uint64(1) << (8 * np.arange(8, dtype=np.uint64))) - np.uint64(1), ~np.uint64(0))

    def of(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Hashes of the words that lie in `data`, which has eight bytes more at its end."""
        eight = np.ndarray(max(len(data) - 7, 0), np.uint64, data, strides=(1,))
        hashes = mix(sizes.astype(np.uint64) + self.numbers[0])
        left, at = np.arange(len(starts)), 0
        while at < LONG:
            left = left[sizes[left] > at]
            if not len(left):
                return hashes
            part = eight[starts[left] + at] & self.masks[np.minimum(sizes[left] - at, 8)]
            at += 8
            hashes[left] = mix(mix(hashes[left] ^ part) + self.numbers[at // 8])
        for i in left[sizes[left] > LONG].tolist():
            word = data[starts[i] : starts[i] + sizes[i]].tobytes()
            hashes[i] = int.from_bytes(blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return hashes


@dataclass
class Words:
    """Words of some rows: `hashes` of all words in order, and for each row the index of
    its first word in them (`first`, with one entry more at the end)."""

    row: int  # of the batch, the first that is covered
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """For each word, which of the rows it belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `length` words that lie in one row, and the index of
        each run's first word."""
        n = len(self.hashes)
        if n < length:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        ends = np.repeat(self.first[1:], self.counts)
        starts = np.flatnonzero(np.arange(n) + length <= ends)
        # Runs of a power of two words, and of as many words as the bits of `length` so far.
        power, whole, done, size = self.hashes, None, 0, 1
        while True:
            if length & size:
                room = n - done - size + 1
                part = power[done : done + room]
                whole = part if whole is None else _joined(whole[:room], part)
                done += size
            if done == length:
                return mix(whole[starts]), starts
            power = _joined(power[: len(power) - size], power[size:])
            size *= 2


def _hashed(data: np.ndarray, cuts: np.ndarray, hasher: Hasher, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where they start. A new word begins at each of `cuts`."""
    n = len(data)
    if fold:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    room = np.zeros(n + 8, np.uint8)
    room[:n] = data
    return hasher.of(room, starts, stops - starts), starts


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in parts of about CHUNK bytes that end between words."""
    start = stop = 0
    while len(data) - start > CHUNK:
        stop = max(stop, start + CHUNK)
        if stop >= len(data):
            break
        block = data[stop : stop + CHUNK]
        blanks = np.flatnonzero((block == 32) | ((block >= 9) & (block <= 13)))
        if len(blanks):
            yield data[start : stop + blanks[0]]
            start = stop + blanks[0]
        else:
            stop += len(block)
    yield data[start:]


def words_of(column: pa.Array, hasher: Hasher, fold: bool = False) -> Iterator[Words]:
    """Words of a column of text, in groups of rows of about CHUNK bytes; null texts have
    none. With `fold`, A to Z count as a to z. A longer text is hashed part by part."""
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK, "right")) - 1)
        stop = min(stop, len(column))
        part = data[offsets[start] : offsets[stop]]
        places = offsets[start : stop + 1] - offsets[start]
        if len(part) > CHUNK:  # one text
            hashes = np.concatenate([_hashed(p, np.zeros(0, np.int64), hasher, fold)[0] for p in _pieces(part)])
            yield Words(start, hashes, np.array([0, len(hashes)]))
        else:
            cuts = places[:-1][places[:-1] < places[1:]]  # a new text begins a new word
            hashes, starts = _hashed(part, cuts, hasher, fold)
            yield Words(start, hashes, np.searchsorted(starts, places))
        start = stop


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


#: Entries that a task gathers before it hands them on, and in which it looks for repeats.
GATHERED = 300_000


def gathered(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of columns, joined to at least GATHERED entries each, as long as there are."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= GATHERED:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))
