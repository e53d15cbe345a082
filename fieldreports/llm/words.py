"""Words, word hashes and word windows of a batch of texts, as flat numpy arrays.

Texts arrive as Arrow string columns. All functions work on the UTF-8 bytes of
many texts at once; :func:`chunks` bounds the bytes handled together, so the
temporary arrays stay small whatever the batch size (a single longer text is
its own chunk). A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20
# Words longer than this are hashed one by one, so that one huge word does not
# make every other word of its chunk wait for it.
LONG_WORD = 256

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_WINDOW_BASE = _U(0xD6E8FEB86659FD93)
_TAIL = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over byte values, true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


# [^\x20\x09-\x0D]: every byte but the six ASCII white-space characters.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] of lower-cased text: digits, a-z and all beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Texts:
    """``raw`` bytes of the texts back to back; text i is ``raw[off[i]:off[i+1]]``."""

    raw: np.ndarray
    off: np.ndarray

    def __len__(self) -> int:
        return len(self.off) - 1


@dataclass
class Words:
    """Word k is ``raw[start[k]:end[k]]``; text i owns words ``at[i]:at[i+1]``."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, off - off[0])


def chunks(texts: Texts, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """``(first, last + 1, texts)`` with at most ``limit`` bytes each, or one longer text."""
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(texts.off, texts.off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        lo, hi = texts.off[i], texts.off[j]
        yield i, j, Texts(texts.raw[lo:hi], texts.off[i : j + 1] - lo)
        i = j


def split_words(texts: Texts, inside: np.ndarray = NON_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes of the class ``inside``; no word crosses a text's end."""
    raw = np.zeros(len(texts.raw) + 8, dtype=np.uint8)  # padded for eight-byte loads
    n = len(texts.raw)
    raw[:n] = LOWER[texts.raw] if lower else texts.raw
    mark = np.zeros(n + 2, dtype=bool)
    mark[1 : n + 1] = inside[raw[:n]]
    full = texts.off[:-1] < texts.off[1:]
    first = mark[1 : n + 1] & ~mark[:n]
    heads = texts.off[:-1][full]
    first[heads] = mark[heads + 1]
    last = mark[1 : n + 1] & ~mark[2 : n + 2]
    tails = texts.off[1:][full] - 1
    last[tails] = mark[tails + 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(raw, start, end, np.searchsorted(start, texts.off))


def joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words back to back with one space between them, and where each one begins and ends there."""
    size = words.end - words.start
    end = np.cumsum(size + 1) - 1
    out = np.full(end[-1] if len(end) else 0, 0x20, dtype=np.uint8)
    at = np.arange(int(size.sum()))
    out[at + np.repeat(np.arange(len(size)), size)] = words.raw[at + np.repeat(words.start - (np.cumsum(size) - size), size)]
    return out.tobytes(), end - size, end


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> _U(30))
    h *= _K2
    h ^= h >> _U(27)
    h *= _K3
    h ^= h >> _U(31)
    return h


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each ``raw[start:end]``; ``raw`` has eight bytes of padding."""
    n = end - start
    h = mix(n.astype(np.uint64) * _K1 + _U(seed))
    loads = np.ndarray((max(len(raw) - 7, 0),), dtype="<u8", buffer=raw, strides=(1,))
    todo = np.flatnonzero((n > 0) & (n <= LONG_WORD))
    at = 0
    while todo.size:
        rest = np.minimum(n[todo] - at, 8)
        h[todo] = mix(h[todo] * _K1 + (loads[start[todo] + at] & _TAIL[rest]))
        at += 8
        todo = todo[n[todo] > at]
    for k in np.flatnonzero(n > LONG_WORD):
        h[k] = xxhash.xxh64_intdigest(raw[start[k] : end[k]].tobytes(), seed & 0xFFFFFFFF)
    return h


def hash_words(words: Words, seed: int = 0) -> np.ndarray:
    return hash_spans(words.raw, words.start, words.end, seed)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive entries of ``h`` (``len(h) - size + 1`` of them)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = h[:n].copy()
    for j in range(1, size):
        acc *= _WINDOW_BASE
        acc += h[j : j + n]
    return mix(acc)


def inside_text(words: Words, size: int) -> np.ndarray:
    """For every window start of :func:`window_hashes`: whether one text holds the window."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    owner = words.owner()
    return owner[:n] == owner[size - 1 :]


def covered(n: int, start: np.ndarray, length) -> np.ndarray:
    """Boolean mask over ``n`` positions: inside any ``[start, start + length)``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` over each text's positions ``at[i]:at[i+1]``."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]
