"""Words, word hashes and word windows of whole batches of texts, as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. These six
separators are ASCII, so a UTF-8 buffer can be cut byte by byte. A batch is the
concatenation of its texts; a word never crosses from one text into the next.
"""

from __future__ import annotations

import hashlib

import numpy as np

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

U = np.uint64
_A, _B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
#: Words longer than this are hashed one by one by BLAKE2.
LONG = 2048


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (a bijection)."""
    x = x ^ (x >> U(32))
    x *= _A
    x ^= x >> U(29)
    x *= _B
    x ^= x >> U(32)
    return x


class Batch:
    """Words of a batch of texts.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``starts`` and
    ``ends`` are byte positions in ``buf``.
    """

    def __init__(self, data: bytes, offsets: np.ndarray) -> None:
        self.data, self.offsets, n = data, offsets, len(data)
        self.buf = np.frombuffer(data, dtype=np.uint8)
        word = ~SEPARATOR[self.buf]
        before = np.zeros(n, dtype=bool)
        before[1:] = word[:-1]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner] = False
        after = np.zeros(n, dtype=bool)
        after[:-1] = word[1:]
        after[inner - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        # a text of no bytes shares its offset with the next one
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``; spans of up to 8 bytes and equal length never collide."""
    length = ends - starts
    h = mix(length.astype(np.uint64) * _B + _A)
    if not len(h):
        return h
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8)
    at8 = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live, done = None, 0
    while True:
        rest = (length if live is None else length[live]) - done
        x = at8[(starts if live is None else starts[live]) + done] & _MASKS[np.minimum(rest, 8)]
        x = mix((h if live is None else h[live]) ^ x)
        if live is None:
            h = x
        else:
            h[live] = x
        more = (rest > 8) & ((length if live is None else length[live]) <= LONG)
        live = np.flatnonzero(more) if live is None else live[more]
        done += 8
        if not len(live):
            break
    for i in np.flatnonzero(length > LONG):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return h


def factors(k: int) -> np.ndarray:
    """k odd multipliers for the places of a window."""
    return mix(np.arange(1, k + 1, dtype=np.uint64) * _A) | U(1)


def windows(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every k consecutive words of one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    c = factors(k)
    s = h[:n] * c[0]
    for j in range(1, k):
        s += h[j : n + j] * c[j]
    left = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n)
    at = np.flatnonzero(left >= k)
    return mix(s[at]), at


def short_hashes(h: np.ndarray, first: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each text with 1 to k - 1 words, taken as one sequence."""
    c, texts, out = factors(k), np.flatnonzero((counts > 0) & (counts < k)), []
    for d in texts:
        m = int(counts[d])
        out.append(int((h[first[d] : first[d] + m] * c[:m]).sum(dtype=np.uint64)) ^ (m * 0x5851F42D4C957F2D & (1 << 64) - 1))
    return mix(np.array(out, dtype=np.uint64)), texts
