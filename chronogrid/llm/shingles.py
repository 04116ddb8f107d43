"""Vectorised hashing over the bytes of many texts at once: words, shingles, prefix hashes."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

_U = np.uint64
#: An odd base, so that its powers have inverses modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15 | 1
#: Start of the words' hashes; bytes from which a word is hashed by a cryptographic function.
_KEY, _LONG = 0x5851F42D4C957F2D, 512
#: The white-space bytes of the contracts.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    return _powers(1 << max(10, (n - 1).bit_length()), base)[:n]


@lru_cache(maxsize=8)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            k = min(done, n - done)
            out[done : done + k] = out[:k] * _U(pow(base, done, 1 << 64))
            done += k
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets of its values; nulls are empty."""
    column = column.cast(pa.large_binary())
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]] if bufs[2] is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word, ASCII capitals lowered, and the words' n + 1 offsets by text.

    Words are runs of bytes that aren't white space; none crosses a text's end.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z.astype(_U), z, z, np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    inside = ~_WHITE[low]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    prev = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~prev | cut[:n]))
    after = np.concatenate([~inside[1:] | cut[1:n], [True]])
    ends = np.flatnonzero(inside & after) + 1
    return _hash_ranges(low, starts, ends), starts, ends, np.searchsorted(starts, offsets)


def _hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges: eight bytes are stirred in at a time, so that nothing is linear in them."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        h = mix(size.astype(_U) * _U(0xA24BAED4963EE407) + _U(_KEY))
        open_, at = np.flatnonzero(size <= _LONG), 0
        while len(open_):
            left = size[open_] - at
            x = lanes[starts[open_] + at]
            x = np.where(left >= 8, x, x & ((_U(1) << (_U(8) * np.minimum(left, 7).astype(_U))) - _U(1)))
            h[open_] = mix((h[open_] ^ x) * _U(0xD6E8FEB86659FD93) + _U(at))
            at += 8
            open_ = open_[left > 8]
    for i in np.flatnonzero(size > _LONG):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of each text's ``k``-word shingles, sorted, and their offsets by text.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    h, _, _, at = word_hashes(data, offsets)
    n_words = np.diff(at)
    with np.errstate(over="ignore"):
        seq = np.zeros(max(0, len(h) - k + 1), _U)
        for j in range(k):
            seq = seq * _U(0xD6E8FEB86659FD93) + h[j : j + len(seq)] if len(seq) else seq
        seq = mix(seq + _U(k))
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n_words)), counts)
    first = np.cumsum(counts) - counts
    values = np.zeros(len(text), _U)
    local = np.arange(len(text)) - np.repeat(first, counts)
    long = (n_words >= k)[text]
    values[long] = seq[at[text[long]] + local[long]]
    for t in np.flatnonzero((n_words > 0) & (n_words < k)):
        x = _U(0)
        with np.errstate(over="ignore"):
            for w in h[at[t] : at[t + 1]]:
                x = x * _U(0xD6E8FEB86659FD93) + w
            values[first[t]] = mix(np.array([x + _U(n_words[t])], _U))[0]
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[keep], text[keep]
    return values, np.searchsorted(text, np.arange(len(n_words) + 1))
