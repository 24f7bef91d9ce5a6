"""Words of whole text columns as numpy arrays, hashes of words, and Rabin-Karp hashes of word windows.

A word is a longest run of characters other than space and U+0009 to U+000D. These separators are
ASCII, so words can be cut from the UTF-8 bytes. A column is handled in slices of whole texts of
about ``SLICE_BYTES`` together, which bounds the memory; a longer text is a slice of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
WORD_SQL = r"[^\\x20\\x09-\\x0D]+"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Spans up to here are mixed eight bytes at a time, all of them side by side; longer ones take a library digest each.
LONGEST_MIXED = 64
STEP = np.uint64(0x9E3779B97F4A7C15)
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of spans of bytes; no sums or powers, so no family of strings collides by structure."""
    size = ends - starts
    out = mixed(size.astype(np.uint64) * STEP + np.uint64(seed))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place
    active = np.flatnonzero(size <= LONGEST_MIXED)
    for at in range(0, LONGEST_MIXED, 8):
        active = active[size[active] > at]
        if not len(active):
            break
        held = eight[starts[active] + at] & MASKS[np.minimum(size[active] - at, 8)]
        out[active] = mixed((out[active] ^ held) + STEP)
    for i in np.flatnonzero(size > LONGEST_MIXED).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]], digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


#: The modulus 2**31 - 1: a remainder costs a shift and an addition, and products of remainders fit 64 bits.
BITS = np.uint64(31)
PRIME = np.uint64((1 << 31) - 1)


def folded(x: np.ndarray) -> np.ndarray:
    """A number below 2**33 with the same remainder, in place of one below 2**64; below 2**32 for one below 2**62."""
    return (x & PRIME) + (x >> BITS)


def remainder(x: np.ndarray) -> np.ndarray:
    x = folded(folded(x))
    return np.where(x >= PRIME, x - PRIME, x)


class RollingHash:
    """Polynomial hashes modulo a prime with two bases, from prefix sums: any span costs two lookups each.

    ``sum(value[i] * base**i)`` over a span, divided by ``base**start``, does not depend on where the
    span stands. A value is a pair of 31-bit numbers, one per base, and so is a hash. A power of two as modulus would be cheaper, but
    then some strings (Thue-Morse and its complement) collide for every base.
    """

    def __init__(self, base: int):
        self.bases = [(base + 0x9E3779B97F4A7C15 * i) % int(PRIME - np.uint64(2)) + 2 for i in (1, 2)]
        self.powers = [np.ones(1, np.uint32)] * 2
        self.inverses = [np.ones(1, np.uint32)] * 2

    @staticmethod
    def powers_of(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate((out, remainder(out[:n - len(out)] * np.uint64(pow(base, len(out), int(PRIME))))))
        return out.astype(np.uint32)

    def prefix(self, pairs: list[np.ndarray]) -> list[np.ndarray]:
        """Sums of the values, given as two columns of numbers below 2**31."""
        n = len(pairs[0]) + 1
        if n > len(self.powers[0]):
            room = n + n // 4
            self.powers = [self.powers_of(b, room) for b in self.bases]
            self.inverses = [self.powers_of(pow(b, -1, int(PRIME)), room) for b in self.bases]
        out = []
        for values, powers in zip(pairs, self.powers):
            sums = np.zeros(n, np.uint64)
            terms = np.multiply(values, powers[:n - 1], dtype=np.uint64)
            # folded terms are below 2**32, so the sums of 2**31 of them fit 63 bits
            np.cumsum(folded(terms), out=sums[1:])
            out.append(sums)
        return out

    def spans(self, sums: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        high, low = (remainder(folded(folded(own[ends] - own[starts])) * inverses[starts]) for own, inverses in zip(sums, self.inverses))
        return mixed((high << BITS) + low + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def halves(hashes: np.ndarray) -> list[np.ndarray]:
    """Two 31-bit numbers of each hash."""
    return [hashes & PRIME, (hashes >> BITS) & PRIME]


class Slice:
    """Some neighbouring texts: bytes ``data``, text i at ``at[i]:at[i + 1]``, rows ``first`` and on."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray):
        self.first, self.data, self.at, self.n = first, data, at, len(at) - 1
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        self.in_word = word = ~blank
        begins = np.zeros(len(data) + 1, bool)
        begins[at] = True
        after_blank, before_blank = np.ones(len(data), bool), np.ones(len(data), bool)
        after_blank[1:], before_blank[:-1] = blank[:-1], blank[1:]
        self.starts = np.flatnonzero(word & (begins[:-1] | after_blank))
        self.ends = np.flatnonzero(word & (begins[1:] | before_blank)) + 1
        self.text = np.searchsorted(at, self.starts, side="right") - 1
        self.n_words = np.bincount(self.text, minlength=self.n)
        self.first_word = np.concatenate(([0], np.cumsum(self.n_words)))

    def count_bytes(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def windows(self, size: int) -> np.ndarray:
        """Positions (in ``starts``) of the words that begin ``size`` words of one text."""
        last = len(self.text) - size + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[:last] == self.text[size - 1:])

    def raw(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()


class WordHasher:
    """Hashes of the words of a slice, and of its word windows: 62 bits, spread over 64."""

    def __init__(self, seed: int = 1):
        self.seed, self.by_word = seed, RollingHash(0x2545F4914F6CDD1D + 2 * seed)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans of bytes."""
        return span_hashes(data, starts, ends, self.seed)

    def words(self, part: Slice) -> np.ndarray:
        return self.spans(part.data, part.starts, part.ends)

    def windows(self, hashes: np.ndarray, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return self.by_word.spans(self.by_word.prefix(halves(hashes)), at, at + size)


def text_column(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), at


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def slices(column, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column into slices of whole texts."""
    data, at = text_column(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        own = data[at[first]:at[last]]
        yield Slice(first, lowered(own) if lower else own, at[first:last + 1] - at[first])
        first = last


def run_lengths(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
    return starts, np.diff(np.concatenate((starts, [len(ordered)])))


def repeated(keys: np.ndarray, *within: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once (with the same ``within``)."""
    order = np.lexsort((keys, *within)) if within else np.argsort(keys, kind="stable")
    same = np.ones(max(len(keys) - 1, 0), bool)
    for values in (keys, *within):
        ordered = values[order]
        same &= ordered[1:] == ordered[:-1]
    marks = np.zeros(len(keys), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    return marks


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n positions lie in a span of ``size`` from one of the starts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps)[:n] > 0
