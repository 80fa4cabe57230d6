"""64-bit hashes of words and of word windows, vectorised over a column of texts."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

_BYTE = np.random.default_rng(97).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LOWER = _BYTE.copy()
_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse, for i up to n, modulo 2 ** 64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        a = np.full(n + 1, b, np.uint64)
        a[0] = 1
        out.append(np.cumprod(a, dtype=np.uint64))
    return out[0], out[1]


def _upto(base: int, n: int):
    return _powers(base, 1 << max(16, int(n).bit_length()))


def word_hashes(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space) and where each text's begin, one more at the end. Texts are not null. lower: A-Z count as a-z."""
    h, at, _, _, _ = word_spans(texts, lower)
    return h, at


def word_spans(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What word_hashes gives, then each word's first byte and the byte after its last, and the bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    parts, counts, starts, ends, i = [], [], [], [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + _CHUNK, "right")) - 1)
        j = min(j, len(texts))
        h, n, start, end = _chunk(data[at[i] : at[j]], at[i : j + 1] - at[i], _LOWER if lower else _BYTE)
        parts.append(h)
        counts.append(n)
        starts.append(start + at[i])
        ends.append(end + at[i])
        i = j
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.concatenate(starts), np.concatenate(ends), data


def _chunk(b: np.ndarray, at: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[b]
    first = np.zeros(len(b) + 1, bool)  # a text begins here
    first[at] = True
    before, after = np.empty(len(b), bool), np.empty(len(b), bool)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    start = np.flatnonzero(word & (~before | first[:-1]))
    end = np.flatnonzero(word & (~after | first[1:])) + 1
    power, inverse = _upto(_BASE, len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(byte[b] * power[: len(b)], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return h, np.diff(np.searchsorted(start, at)), start, end


def ragged(starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + count[i] - 1, for each i in turn."""
    count = count.astype(np.int64)
    return np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(count.sum())


def windows(h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of k words within one text each, and the position of each one's first word."""
    n = np.diff(at)
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    power, inverse = _upto(_STEP, len(h))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], out=total[1:])
    ok = np.arange(len(h)) + k <= np.repeat(at[1:], n)
    i = np.flatnonzero(ok)
    return mix((total[i + k] - total[i]) * inverse[i] + np.uint64(k)), i


def planes(a: np.ndarray, width: int) -> bytes:
    """The low bytes of each number, then the next ones, and so on: small numbers leave planes of zeros."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view("<u8").astype(np.int64)
