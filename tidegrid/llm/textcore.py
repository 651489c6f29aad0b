"""Vectorised tokenising and hashing of whole Arrow string columns with numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D.  These bytes never occur inside a
multi-byte UTF-8 character, so that splitting bytes equals splitting characters.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text that are handled at once: arrays of so many numbers stay in the cache and in reused memory.  Of a longer text, only
#: what is known of its words and lines is held as a whole.
CHUNK = 1 << 16
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = tuple(np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
#: Stretches of bytes are hashed as polynomials modulo a prime, with a base that has no structure: unlike those modulo a power
#: of two, no family of different strings (Thue-Morse ones are) has equal hashes for every base.
PRIME = (1 << 61) - 1
ROOT = 0x0B7E151628AED2A6ABF7158809CF4F3C % PRIME
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_1, _30, _31, _61 = (np.uint64(x) for x in (1, 30, 31, 61))
_powers = {}


def reduced(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME, of any 64-bit values."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Modulo PRIME, of values under it."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return reduced(((a1 * b1) << _1) + (middle >> _30) + ((middle & _LOW30) << _31) + a0 * b0)


def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first n powers of the base (high and low 31 bits) and of its inverse."""
    have = _powers.get("n", 0)
    if have < n:
        n = max(n, CHUNK + 4096)
        for key, base in (("up", ROOT), ("down", pow(ROOT, -1, PRIME))):
            out, size = np.ones(n, np.uint64), 1
            while size < n:
                more = min(size, n - size)
                out[size : size + more] = product(out[:more], np.uint64(pow(base, size, PRIME)))
                size += more
            _powers[key] = out
        _powers["high"], _powers["low"] = _powers["up"] >> _31, _powers.pop("up") & _LOW31
        _powers["n"] = n
    return _powers["high"][:n], _powers["low"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a well-known public hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= MIX[0]
    x ^= x >> np.uint64(33)
    x *= MIX[1]
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which ``span_values`` gets any stretch of some bytes (about CHUNK of them: the tables of powers are as long)."""
    n = len(data)
    high, low, _ = powers(n + 1)
    value = data.astype(np.uint64) + _1
    sums = tuple(np.zeros(n + 1, np.uint64) for _ in range(2))
    for out, power in zip(sums, (high, low), strict=True):
        np.cumsum(value * power[:n], out=out[1:])
    return sums


def span_values(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomials of the stretches [start, end), modulo PRIME: equal bytes have equal values wherever they are."""
    _, _, down = powers(len(sums[0]))
    high, low = (x[end] - x[start] for x in sums)
    return product(reduced((high >> _30) + ((high & _LOW30) << _31) + low), down[start])


def sealed(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(values + length.astype(np.uint64) * MIX[2])


def span_hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return sealed(span_values(sums, start, end), end - start)


def hashes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches that lie in order and don't overlap, as ``span_hash`` gives them, in CHUNKs of the bytes."""
    out = np.zeros(len(start), np.uint64)
    for a in range(0, len(data), CHUNK):
        b = min(len(data), a + CHUNK)
        i, j = np.searchsorted(start, (a, b))
        open_ = i > 0 and end[i - 1] > a
        if i == j and not open_:
            continue
        sums = prefix_sums(data[a:b])
        out[i:j] = span_values(sums, start[i:j] - a, np.minimum(end[i:j], b) - a)
        if open_:  # a stretch that began in an earlier part goes on
            more = int(span_values(sums, np.zeros(1, np.int64), np.minimum(end[i - 1 : i], b) - a)[0])
            out[i - 1] = (int(out[i - 1]) + more * pow(ROOT, int(a - start[i - 1]), PRIME)) % PRIME
    return sealed(out, end - start)


def same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the stretches of ``length`` bytes at ``one`` and at ``other`` are equal."""
    out = np.ones(len(one), bool)
    long = length > CHUNK
    for k in np.flatnonzero(long):
        out[k] = np.array_equal(data[one[k] : one[k] + length[k]], data[other[k] : other[k] + length[k]])
    short = np.flatnonzero(~long & (length > 0))
    total = np.concatenate(([0], np.cumsum(length[short])))
    for i, j in chunks(total):
        some, edges = short[i:j], total[i : j + 1] - total[i]
        step = np.arange(edges[-1]) - np.repeat(edges[:-1], length[some])
        unequal = data[np.repeat(one[some], length[some]) + step] != data[np.repeat(other[some], length[some]) + step]
        out[some] = ~np.logical_or.reduceat(unequal, edges[:-1])
    return out


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, null as empty, and the offsets of its rows."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def joined_bytes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def chunks(offsets: np.ndarray, most: int = CHUNK):
    """Row ranges [i, j) whose texts have about ``most`` bytes together, at least a row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words of some texts: ``start`` and ``end`` in ``data``; text d has the words ``first[d]:first[d + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        start, end = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a in range(0, len(data), CHUNK):
            b = min(len(data), a + CHUNK)
            word = ~SPACE[data[a:b]]
            edge = np.zeros(b - a, bool)
            i, j = np.searchsorted(offsets, (a, b))
            edge[offsets[i:j] - a] = True
            before = np.empty(b - a, bool)
            before[0] = a > 0 and not SPACE[data[a - 1]]
            before[1:] = word[:-1]
            start.append(np.flatnonzero(word & (~before | edge)) + a)
            end.append(np.flatnonzero(before & (~word | edge)) + a)
        if len(data) and not SPACE[data[-1]]:
            end.append(np.array([len(data)]))
        self.start, self.end = np.concatenate(start), np.concatenate(end)
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return hashes_of(self.data, self.start, self.end)


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row, and the text each is in."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    m = len(hashes) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = (out + hashes[k : k + m]) * BASE
    whole = text[:m] == text[n - 1 :]
    return mix(out[whole]), text[:m][whole]


def sums_by(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of values[edges[i]:edges[i + 1]]."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[edges[1:]] - total[edges[:-1]]


def count_bytes(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each text's bytes the table of 256 flags has, in CHUNKs of the bytes."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for a in range(0, len(data), CHUNK):
        b = min(len(data), a + CHUNK)
        total = np.concatenate(([0], np.cumsum(table[data[a:b]])))
        i, j = max(0, int(np.searchsorted(offsets, a, "right")) - 1), int(np.searchsorted(offsets, b, "left"))
        out[i:j] += np.diff(total[np.clip(offsets[i : j + 1], a, b) - a])
    return out


def positions(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where the bytes are that the table of 256 flags has."""
    return np.concatenate([np.empty(0, np.int64), *(np.flatnonzero(table[data[a : a + CHUNK]]) + a for a in range(0, len(data), CHUNK))])
