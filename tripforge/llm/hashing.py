"""Hashes of words and of byte strings in a batch, from prefix polynomial hashes modulo 2**64."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finish)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, start: int) -> np.ndarray:
    """n fixed 64-bit words; another start gives other words."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(_BASE) + _U(start * 0x51ED270B + 1))


_BYTES = seeds(256, 1)


class _Powers:
    """Powers of a number modulo 2**64, extended when a longer batch comes."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, _U)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            have = len(self.values)
            step = _U(pow(self.base, have, 1 << 64))
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """len + 1 prefix sums of values[i] * base**i; ``between`` reads any stretch off them."""
    sums = np.empty(len(values) + 1, _U)
    sums[0] = 0
    np.cumsum(values * _UP.upto(len(values)), out=sums[1:])
    return sums


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end), equal for equal stretches wherever they stand."""
    down = _DOWN.upto(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def byte_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix hashes of a byte string."""
    return prefix_hashes(_BYTES[data])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


class Words:
    """The words of a batch of texts: places in the bytes, row of each, and a 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        """``is_word``: for each of the 256 byte values, whether words are made of it."""
        inside = is_word[data]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False  # no word crosses into the next text
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Of each text, the number of its first word; one more at the end.
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        sums = byte_hashes(self.data)
        return mix(between(sums, self.starts, self.ends) + (self.ends - self.starts).astype(_U))

    def mixed_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word that mixes it eight bytes at a time, so that no pattern of bytes cancels out."""
        size = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        # All eight-byte words of the texts, at every byte.
        words = np.ndarray((len(self.data) + 1,), "<u8", buffer=padded, strides=(1,))
        found = mix(size.astype(_U) * _U(_BASE))
        at, left, rows = self.starts.copy(), size.copy(), np.arange(len(size))
        while len(rows):
            taken = np.minimum(left, 8)
            part = words[at] & (_U(0xFFFFFFFFFFFFFFFF) >> ((_U(8) - taken.astype(_U)) * _U(8)))
            found[rows] = mix((found[rows] ^ mix(part ^ _U(_BASE))) * _U(_BASE))
            more = left > 8
            at, left, rows = at[more] + 8, left[more] - 8, rows[more]
        return found

    def text(self, first: int, last: int) -> bytes:
        """Words first .. last - 1, joined by one space."""
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last]))


def byte_table(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in texts without A-Z; bytes from 0x80 on are
#: parts of other characters.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
