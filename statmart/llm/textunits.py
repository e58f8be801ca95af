"""Vectorised splitting of texts into units that a byte-level BPE encodes on their own.

The public pre-tokenisation pattern never lets a piece run over certain places
(before a single space between visible characters, around a single line break,
where letters, digits and other signs meet). Cutting a text there and encoding the
units one by one gives the ids of the whole text. Units repeat a lot, so an encoder
keeps the ids of those it has met and only new units reach the tokenizer.

Character classes are taken from code points whose category has been the same since
Unicode 3.2; at any other character no cut is made, so tokenizers that follow another
Unicode version still agree. White space is handled the same way: runs of it are
never cut.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from statmart.llm.common import HELD

OTHER, LETTER, DIGIT, SPACE, UNKNOWN = 0, 1, 2, 3, 4
BASE = 0x9E3779B97F4A7C15 | 1
SLICE = 1 << 20  # characters worked on at once; a longer text is taken whole
_U = np.uint64


def _classes() -> np.ndarray:
    out = np.full(0x110000, UNKNOWN, dtype=np.uint8)
    old = unicodedata.ucd_3_2_0
    kinds = {"L": LETTER, "N": DIGIT, "P": OTHER, "S": OTHER, "M": OTHER}
    for cp in range(0x30000):
        ch = chr(cp)
        now = unicodedata.category(ch)[0]
        if ch.isspace() or cp < 32 or 0x7F <= cp < 0xA1:
            out[cp] = SPACE  # control characters count as white space: never cut beside them
        elif now == old.category(ch)[0] and now in kinds:
            out[cp] = kinds[now]
    return out


_CLASS: np.ndarray | None = None
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSE = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, powers of the base and of its inverse modulo 2**64, for ``n`` places."""
    global _CLASS, _POWERS, _INVERSE
    if _CLASS is None:
        _CLASS = _classes()
    if len(_POWERS) <= n:
        size = 1 << n.bit_length()
        _POWERS = np.cumprod(np.concatenate([[_U(1)], np.full(size, BASE, dtype=np.uint64)]))
        inv = _U(pow(BASE, -1, 1 << 64))
        _INVERSE = np.cumprod(np.concatenate([[_U(1)], np.full(size, inv, dtype=np.uint64)]))
    return _CLASS, _POWERS, _INVERSE


def _drop_powers() -> None:
    global _POWERS, _INVERSE
    _POWERS = _INVERSE = np.ones(1, dtype=np.uint64)


HELD["powers"] = _drop_powers


def finish(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit sum over all its bits (in place on a copy)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def running_hash(symbols: np.ndarray) -> np.ndarray:
    """Sums from which :func:`hash_between` takes the hash of any span of ``symbols`` (unsigned integers)."""
    _, powers, _ = _tables(len(symbols))
    x = finish(symbols.astype(np.uint64) + _U(1)) if symbols.dtype != np.uint8 else _BYTE_HASH[symbols]
    x *= powers[:len(x)]
    total = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x, out=total[1:])
    return total


def hash_between(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, independent of its place."""
    _, _, inverse = _tables(len(total) - 1)
    h = (total[ends] - total[starts]) * inverse[starts]
    return finish(h + (ends - starts).astype(np.uint64))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_between(running_hash(symbols), starts, ends)


_BYTE_HASH = finish(np.arange(1, 257, dtype=np.uint64))


def _few_at_once(column: pa.Array) -> Iterator[str | None]:
    for at in range(0, len(column), 64):
        yield from column.slice(at, 64).to_pylist()


def slices(texts: list[str | None] | pa.Array, most: int = SLICE) -> Iterator[list[str]]:
    """Consecutive texts in groups of about ``most`` characters; null counts as empty.

    Of an Arrow column only the texts of a group become Python strings at a time.
    """
    part, size = [], 0
    for t in _few_at_once(texts) if isinstance(texts, pa.Array) else texts:
        t = t or ""
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, unit starts, unit ends, and units per text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    n = len(points)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return points, empty, empty, np.zeros(len(texts), dtype=np.int64)
    classes, _, _ = _tables(n)
    kind = classes[points]
    seen = kind < SPACE  # letters, digits and other signs
    first = np.zeros(n + 1, dtype=bool)
    borders = np.concatenate([[0], np.cumsum(lengths)])
    if n > 1:
        before, after = kind[:-1], kind[1:]
        # where two kinds of visible characters meet, but not after an apostrophe
        first[1:n] = (before != after) & seen[:-1] & seen[1:] & ~((points[:-1] == 39) & (after == LETTER))
    if n > 2:
        blank = (points[1:-1] == 32) & seen[:-2] & seen[2:]
        line = (points[1:-1] == 10) & seen[:-2] & seen[2:]
        inside = np.ones(n - 2, dtype=bool)  # the neighbours belong to the same text
        edges = borders[(borders > 0) & (borders < n)]
        inside[(edges - 1)[edges - 1 < n - 2]] = False
        inside[(edges - 2)[edges - 2 >= 0]] = False
        first[1:n - 1] |= (blank | line) & inside
        first[2:n] |= line & inside
    first[borders[:-1][lengths > 0]] = True
    starts = np.flatnonzero(first[:n])
    ends = np.append(starts[1:], n)
    index = np.searchsorted(starts, borders)
    return points, starts, ends, np.diff(index)


class UnitEncoder:
    """Ids of texts, with the ids of known units kept in a bounded hash table.

    ``encode`` gets distinct new units and returns one id list for each. When the
    table holds ``bound`` units it starts over, which costs time and changes nothing.
    Units are told apart by a 64-bit hash of their characters.
    """

    PROBES = 16

    def __init__(self, encode: Callable[[list[str]], list], bound: int = 1 << 20):
        self._encode, self._bound = encode, bound
        self._size = 2 * bound
        self._reset()

    def _reset(self) -> None:
        self._keys = np.zeros(self._size, dtype=np.uint64)
        self._slot = np.zeros(self._size, dtype=np.int32)
        self._offset = np.zeros(1 << 12, dtype=np.int64)
        self._ids = np.zeros(1 << 14, dtype=np.uint32)
        self._count = 0
        self._used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Unit number of each hash, -1 where it is new."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        todo = np.arange(len(hashes))
        mask = _U(self._size - 1)
        for p in range(self.PROBES):
            at = ((hashes[todo] + _U(p)) & mask).astype(np.int64)
            key = self._keys[at]
            hit = key == hashes[todo]
            out[todo[hit]] = self._slot[at[hit]]
            todo = todo[~hit & (key != 0)]
            if not len(todo):
                break
        return out

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = _U(self._size - 1)
        for p in range(self.PROBES):
            at = ((hashes + _U(p)) & mask).astype(np.int64)
            free = self._keys[at] == 0
            self._keys[at[free]] = hashes[free]
            won = free & (self._keys[at] == hashes)
            self._slot[at[won]] = numbers[won]
            hashes, numbers = hashes[~won], numbers[~won]
            if not len(hashes):
                return
        # no place within the probes: the unit stays unknown and is encoded again when met

    def _add(self, hashes: np.ndarray, units: list[str]) -> np.ndarray:
        lists = self._encode(units)
        numbers = np.arange(self._count, self._count + len(units))
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.concatenate([np.asarray(x, dtype=np.uint32) for x in lists]) if lists else np.zeros(0, np.uint32)
        while self._count + len(units) + 1 > len(self._offset):
            self._offset = np.concatenate([self._offset, np.zeros_like(self._offset)])
        while self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[self._used:self._used + len(flat)] = flat
        self._offset[self._count + 1:self._count + len(units) + 1] = self._used + np.cumsum(sizes)
        self._used += len(flat)
        self._count += len(units)
        self._place(hashes, numbers)
        return numbers

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids per text."""
        if self._count >= self._bound:
            self._reset()
        points, starts, ends, units = cut(texts)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), units
        hashes = span_hashes(points, starts, ends)
        hashes[hashes == 0] = 1
        number = self._find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            at = new[where]
            raw = [points[s:e].tobytes().decode("utf-32-le", "surrogatepass")
                   for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            number[new] = self._add(distinct, raw)[back]
        size = self._offset[number + 1] - self._offset[number]
        before = np.cumsum(size) - size
        ids = self._ids[np.repeat(self._offset[number] - before, size) + np.arange(int(size.sum()))]
        edge = np.concatenate([[0], np.cumsum(units)])
        counted = np.concatenate([[0], np.cumsum(size)])
        return ids, counted[edge[1:]] - counted[edge[:-1]]
