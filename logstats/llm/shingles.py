"""Hashed word shingles of many texts at a time, with numpy.

Words are runs of anything but ASCII white space after A-Z is lower-cased. A shingle is
``WIDTH`` words in a row; a text of fewer words is one shingle; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

WIDTH = 5
# Texts are hashed together, or a long one in parts, of so many bytes.
PART_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Odd multipliers; any would do.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)


def mixed(values: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(size, _BASE, dtype=np.uint64))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in some bytes, and where it starts."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    starts, ends = edge[0::2], edge[1::2]
    if len(starts) == 0:
        return np.empty(0, dtype=np.uint64), starts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    letters = data[~space].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    longest = int(lengths.max())
    powers = _powers(1 << max(10, longest.bit_length()))
    hashes = np.add.reduceat(letters * powers[place], first)
    return mixed(hashes + lengths.astype(np.uint64) * _PLACES[0]), starts


def _cut(data: bytes) -> Iterator[bytes]:
    """Parts that end between words; a word longer than a part is not cut."""
    at = 0
    while at < len(data):
        end = min(at + PART_BYTES, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def _shingles(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of words in a row and the text each belongs to; short texts apart."""
    if len(words) < WIDTH:
        return np.empty(0, dtype=np.uint64), owner[:0]
    total = words[: len(words) - WIDTH + 1] * _PLACES[0]
    for i in range(1, WIDTH):
        total = total + words[i : len(words) - WIDTH + 1 + i] * _PLACES[i]
    whole = owner[: len(owner) - WIDTH + 1] == owner[WIDTH - 1 :]
    return mixed(total[whole]), owner[: len(owner) - WIDTH + 1][whole]


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted, as unsigned integers."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text_bytes(text)
        if held and size + len(data) > PART_BYTES:
            yield from _sets_of(held)
            held, size = [], 0
        held.append(data)
        size += len(data)
    yield from _sets_of(held)


def _sets_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    if len(texts) == 1:
        parts = [_word_hashes(np.frombuffer(part, dtype=np.uint8))[0] for part in _cut(texts[0])]
        words = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
        owner = np.zeros(len(words), dtype=np.int64)
    else:
        data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        words, starts = _word_hashes(data)
        lengths = np.array([len(text) + 1 for text in texts])
        owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    hashes, of = _shingles(words, owner)
    ends = np.cumsum(np.bincount(of, minlength=len(texts)))
    word_ends = np.cumsum(counts)
    for i, count in enumerate(counts):
        if count >= WIDTH:
            yield np.unique(hashes[ends[i] - (count - WIDTH + 1) : ends[i]])
        elif count:
            few = words[word_ends[i] - count : word_ends[i]]
            yield mixed(np.sum(few * _PLACES[:count], keepdims=True) + np.uint64(count))
        else:
            yield np.empty(0, dtype=np.uint64)
