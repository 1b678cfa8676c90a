"""Words and shingles of many texts at once, as 64-bit numbers in numpy.

A word is a maximal run of bytes other than ``0x20 0x09-0x0D`` of the UTF-8
text, with A-Z lower-cased.  The functions take an Arrow string array and work
on its buffer, so no Python string is made.  Null texts have no words.

Hashes are 64 bits wide.  Among n different values two share a hash with a
probability of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
SLICE = 1 << 20  # bytes of text handled in one numpy pass
_LONG = 64  # longer words are hashed one by one

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U)
_PLACE = mix(np.arange(77, 93, dtype=_U) * _U(0x2545F4914F6CDD1D)) | _U(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = texts.buffers()[2] if n else None
    if data is None or raw[-1] == raw[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[raw[0] : raw[-1]], raw - raw[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes; a longer text is a run alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1, first + 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of words; text i has first[i]:first[i + 1].  ``between`` tells the bytes that are in no word."""
    solid = ~between[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    before[edge] = False
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[edge[1:] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True, long: int = _LONG) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A-Z folded unless told otherwise:
    eight bytes at a time, and spans over ``long`` one by one."""
    if not len(starts):
        return np.zeros(0, _U)
    text = np.zeros(len(data) + 8, dtype=np.uint8)
    text[: len(data)] = _LOWER[data] if fold else data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=text, strides=(1,))
    lengths = ends - starts
    out = mix((eight[starts] & _MASKS[np.minimum(lengths, 8)]) + lengths.astype(_U) * _U(0x9FB21C651E98DF25))
    more = np.flatnonzero(lengths > 8)
    done = 8
    while len(more) and done < long:
        out[more] = mix(out[more] * _U(0x9E3779B97F4A7C15) + (eight[starts[more] + done] & _MASKS[np.minimum(lengths[more] - done, 8)]))
        done += 8
        more = more[lengths[more] > done]
    for i in more:
        out[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of the ``width``-word shingles of each text, in order.

    A text of fewer words has the whole sequence as its one shingle; a text
    without words has none.
    """
    counts = np.diff(first)
    n = len(hashes)
    full = np.zeros(max(n - width + 1, 0), dtype=_U)
    for k in range(width):
        full += hashes[k : k + len(full)] * _PLACE[k]
    keep = np.ones(len(full), dtype=bool)
    ends = first[1:][counts > 0]
    for k in range(1, width):  # a shingle must not run into the next text
        at = ends - k
        keep[at[(at >= 0) & (at < len(full))]] = False
    short = np.flatnonzero((counts > 0) & (counts < width))
    for i in short:  # its last words were cleared above, as were the words that end the text before
        at = first[i]
        parts = np.append(hashes[at : at + counts[i]] * _PLACE[: counts[i]], counts[i : i + 1].astype(_U) * _PLACE[width])
        value = parts.sum(dtype=_U)
        if at < len(full):
            full[at], keep[at] = value, True
        else:
            full = np.append(full, np.zeros(at - len(full) + 1, dtype=_U))
            keep = np.append(keep, np.zeros(at - len(keep) + 1, dtype=bool))
            full[at], keep[at] = value, True
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    return mix(full[keep]), np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order."""
    data, offsets = buffers(texts)
    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = words(part, offsets[a : b + 1] - offsets[a])
        values, at = shingles(word_hashes(part, starts, ends), first, width)
        for i in range(b - a):
            yield np.unique(values[at[i] : at[i + 1]])
