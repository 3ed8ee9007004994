"""Vectorised work on the UTF-8 bytes of many texts at once: words, lines and 64-bit span hashes."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class SpanHash:
    """Hashes of any spans of one buffer: the sum, over a span's blocks of 8 bytes, of each block mixed with its place.

    Spans of equal items hash alike in every buffer of one item size.  Where equality decides a result, ``same`` confirms it."""

    def __init__(self, data: np.ndarray):
        width = data.itemsize
        self.per = 8 // width  # items in a block
        padded = np.zeros(len(data) + self.per, data.dtype)
        padded[: len(data)] = data
        self.blocks = np.ndarray(len(data) + 1, "<u8", padded, 0, (width,)).copy()
        self.masks = np.array([(1 << (8 * width * k)) - 1 for k in range(self.per + 1)], _U)

    def _rest(self, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, number, bytes) of every block behind the first one, by owner."""
        more = np.maximum(-(-size // self.per) - 1, 0)
        owner = np.repeat(np.arange(len(size)), more)
        k = np.arange(1, len(owner) + 1) - np.repeat(np.cumsum(more) - more, more)
        left = np.minimum(size[owner] - k * self.per, self.per)
        return owner, k, self.blocks[starts[owner] + k * self.per] & self.masks[left]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        total = mix((self.blocks[starts] & self.masks[np.minimum(size, self.per)]) + _U(0x9E3779B97F4A7C15))
        owner, k, block = self._rest(starts, size)
        if len(owner):
            sums = np.zeros(len(owner) + 1, _U)
            np.cumsum(mix(block ^ mix(k.astype(_U) * _U(0xD1342543DE82EF95))), out=sums[1:])
            edge = np.searchsorted(owner, np.arange(len(size) + 1))
            total += sums[edge[1:]] - sums[edge[:-1]]
        return mix(total + size.astype(_U) * _U(0x8CB92BA72F3D8DD7))

    def same(self, starts: np.ndarray, ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Do the spans numbered ``i`` hold the same items as those numbered ``j``?"""
        size = (ends - starts)[i]
        out = size == (ends - starts)[j]
        i, j, size = i[out], j[out], size[out]
        mask = self.masks[np.minimum(size, self.per)]
        equal = (self.blocks[starts[i]] & mask) == (self.blocks[starts[j]] & mask)
        owner, _, block = self._rest(starts[i], size)
        equal[owner[block != self._rest(starts[j], size)[2]]] = False
        out[out] = equal
        return out


def exact(keys: np.ndarray, same) -> np.ndarray:
    """``keys``, changed where items that share one differ: afterwards equal keys mean equal items.

    ``same(i, j)`` says which of the items numbered ``i`` equal those numbered ``j``."""
    while True:
        order = np.argsort(keys)
        ranked = keys[order]
        first = np.append(True, ranked[1:] != ranked[:-1])[: len(keys)]
        rest = np.flatnonzero(~first)
        leader = order[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))[rest]]
        wrong = order[rest[~same(order[rest], leader)]]
        if not len(wrong):
            return keys
        keys = keys.copy()
        keys[wrong] = mix(keys[wrong] + _U(1))


_tables = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64, at least."""
    if len(_tables[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            step = np.full(max(n, 1 << 16), base, _U)
            step[0] = 1
            _tables[k] = np.cumprod(step)
    return _tables


class ShortHash:
    """Hashes of spans of some tens of items, from prefix sums of a polynomial modulo 2**64.

    Cheaper than SpanHash for many overlapping spans; long spans (a thousand items) can be built to collide."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * powers[: len(data)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts])


class Words:
    """Words (runs of bytes that are not space, tab to carriage return) of texts laid end to end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        """``inside`` marks the positions that belong to words, if other than the above."""
        solid = np.empty(len(data) + 2, bool)
        solid[0] = solid[-1] = False
        solid[1:-1] = ~SPACE[data] if inside is None else inside
        first = solid[1:-1] & ~solid[:-2]
        last = solid[1:-1] & ~solid[2:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        if len(inner):  # a word ends where its text ends
            first[inner] = solid[1:-1][inner]
            last[inner - 1] = solid[1:-1][inner - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.solid = solid[1:-1]
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]:bounds[i+1]
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of byte flags for each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the key found twice or more, is it one of all but one of the positions with its key) for each position."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    many, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    many[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return many, later


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in a window of ``width`` at one of the starts."""
    edge = np.zeros(n + width + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


_CODES = 0x32400  # no letters are assigned beyond
_letters: list = []


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, lower case) by code point, built once a process."""
    if not _letters:
        chars = [chr(i) for i in range(_CODES)]
        _letters.append(np.array([c.isalpha() for c in chars]))
        _letters.append(np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32))
    return _letters[0], _letters[1]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts as code points and their offsets."""
    first = (data & 0xC0) != 0x80
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(first, out=before[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), before[offsets]


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, "Words"]:
    """Lower-cased code points, and the words that are runs of letters."""
    is_letter, lower = letter_tables()
    points, marks = code_points(data, offsets)
    low = np.minimum(points, _CODES - 1)
    return np.where(points < _CODES, lower[low], points), Words(points, marks, is_letter[low])


def gather(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``first``, end to end."""
    ends = np.cumsum(size)
    return values[np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
