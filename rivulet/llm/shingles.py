"""Word shingles of texts, hashed in batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: texts are hashed in groups of about so many bytes (a longer text is a group of its own)
GROUP_BYTES = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODE = np.arange(1, 257, dtype=np.uint64)
_CODE[ord("A"):ord("Z") + 1] += 32
_CODE[_SPACE] = 0
_M = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased) in order, and the index of each word's text."""
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(data))
    inside = place - np.maximum.accumulate(np.where(first, place, 0))
    inside[space] = 0
    powers = np.cumprod(np.full(int(inside.max()) + 1, _M, np.uint64))
    words = mixed(np.add.reduceat(_CODE[data] * powers[inside], at))
    begin = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return words, np.searchsorted(begin, at, "right")


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of text i, ascending, are hashes[bounds[i]:bounds[i + 1]]. A text of fewer
    than ``words`` words, but at least one, has its whole sequence as its one shingle."""
    w, owner = word_hashes(texts)
    steps = [mixed(np.array([j + 1], np.uint64))[0] | np.uint64(1) for j in range(words)]
    n = max(0, len(w) - words + 1)
    total = np.zeros(n, np.uint64)
    for j in range(words):
        total += w[j:j + n] * steps[j]
    inside = owner[:n] == owner[words - 1:words - 1 + n]
    hashes, of = [mixed(total[inside])], [owner[:n][inside]]
    count = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(count) - count
    for i in np.flatnonzero((count > 0) & (count < words)):
        part = w[begin[i]:begin[i] + count[i]]
        whole = (part * np.array(steps[:len(part)], np.uint64)).sum(keepdims=True, dtype=np.uint64)
        hashes.append(mixed(whole + np.uint64(len(part))))
        of.append(np.array([i]))
    h, o = np.concatenate(hashes), np.concatenate(of)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(len(texts) + 1))


def groups(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of ``batches`` in slices of about GROUP_BYTES, with their texts as UTF-8 (null: empty)."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
        begin, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= GROUP_BYTES or i == len(texts) - 1:
                yield batch.slice(begin, i + 1 - begin), texts[begin:i + 1]
                begin, size = i + 1, 0
