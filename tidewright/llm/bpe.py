"""Byte-level BPE encoding and decoding, equal to what the tiktoken library gives.

Pre-tokenisation uses no regular expression. Every code point of a batch has a
class; a small transducer over the classes marks where pieces begin. Its
transition functions compose associatively, and the functions that compositions
can reach are few, so each is a number and a table composes two of them. The
scan folds all chunks of a batch side by side, one column at a time, then the
chunks' totals, then reads the boundaries at every place.

The pieces, as byte slices, are told apart by hash and bytes; each distinct one
is merged once and cached. Ids are gathered for all pieces at once. Offsets of
the ids in the bytes are kept, so decoding is a gather too.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .batches import lean, slices, text_batch
from .words import span_hashes

#: Classes of code points. Fixed: the pre-tokenisation pattern names these letters and pairs after an apostrophe.
LETTER, NUMBER, OTHER, SPACE, BLANK, SPACE_LAST, BLANK_LAST, QUOTE1, QUOTE2, START = range(10)
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
#: Code points of the White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Cached pieces of a worker, and the bytes of the longest; the cache is emptied beyond.
CACHE, LONGEST = 300_000, 64
#: New pieces of so many bytes are merged side by side, longer ones one by one.
SHORT = 32
#: Bytes of text encoded at once.
SLICE = 1 << 20


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point, by general category."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = BLANK
    out[32] = SPACE
    return out


# States after a code point. HELD: the last blank of a run was a space, which the next piece takes along.
# TAKE2, TAKE1: so many code points of a contraction are still to come. DONE: a contraction has ended.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_BLANK, HELD, TAKE2, TAKE1, DONE = range(8)


def _step(state: int, c: int) -> int:
    if c == START:  # set before the first code point of a text; see _boundaries
        return DONE
    if state == TAKE2:
        return TAKE1
    if state == TAKE1:
        return DONE
    if c in (QUOTE1, QUOTE2):
        free = state not in (IN_OTHER, HELD)
        return (TAKE1 if c == QUOTE1 else TAKE2) if free else IN_OTHER
    return {LETTER: IN_LETTER, NUMBER: IN_NUMBER, OTHER: IN_OTHER, SPACE: IN_BLANK, BLANK: IN_BLANK, SPACE_LAST: HELD, BLANK_LAST: DONE}[c]


def _begins(state: int, c: int) -> bool:
    """Whether a code point of class c begins a piece when met in this state."""
    if state in (TAKE1, TAKE2):
        return False
    if c in (SPACE_LAST, BLANK_LAST):
        return True
    if c in (SPACE, BLANK):
        return state != IN_BLANK
    if state == HELD:
        return False
    kind = {LETTER: IN_LETTER, NUMBER: IN_NUMBER}.get(c, IN_OTHER)
    return state != kind


#: A class of a text's first code point counts this much more; NOTHING fills up a grid.
FIRST, NOTHING, COLUMNS = 10, 20, 21


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(composition table, the same with one class after it, whether a piece begins at a class after it), by function number.

    The functions are those that compositions of the classes' own reach; 0 is the identity.
    """
    fresh = tuple(_step(s, START) for s in range(8))
    own = [tuple(_step(s, c) for s in range(8)) for c in range(FIRST)]
    own += [tuple(own[c][x] for x in fresh) for c in range(FIRST)] + [tuple(range(8))]
    known = {tuple(range(8)): 0}
    for f in own:
        known.setdefault(f, len(known))
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in own:
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
    functions = list(known)
    table = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], dtype=np.int32)
    then = np.array([[known[tuple(g[x] for x in f)] for g in own] for f in functions], dtype=np.int32)
    begins = np.array([[_begins(DONE if c >= FIRST else f[DONE], c % FIRST) for c in range(NOTHING)] + [False] for f in functions])
    return table, then, begins


def _scan(c: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each place: all chunks of c side by side, by the composition of the functions before it."""
    table, then, begins = _monoid()
    n = len(c)
    width = max(16, int(n**0.5) // 4)
    rows = -(-n // width)
    grid = np.full(rows * width, NOTHING, dtype=np.uint8)
    grid[:n] = c
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    then, begins = then.ravel(), begins.ravel()
    total = np.zeros(rows, dtype=np.int32)
    for column in grid:
        total = then.take(total * COLUMNS + column)
    before, now = np.zeros(rows, dtype=np.int32), 0
    for i, x in enumerate(total.tolist()):
        before[i] = now
        now = table[now, x]
    out = np.empty(grid.shape, dtype=bool)
    for i, column in enumerate(grid):
        at = before * COLUMNS + column
        begins.take(at, out=out[i])
        before = then.take(at)
    return out.T.ravel()[:n]


def boundaries(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points begin a piece; ``first`` are the places where texts begin."""
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=bool)
    c = _classes().take(codes)
    white = (c == SPACE) | (c == BLANK)
    # the last blank of a run stands apart if a text's visible character follows
    opens = np.zeros(n + 3, dtype=bool)
    opens[first] = True
    opens[n:] = True
    last = np.zeros(n, dtype=bool)
    last[:-1] = white[:-1] & ~white[1:] & ~opens[1:n]
    c += last * np.uint8(SPACE_LAST - SPACE)
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        padded = np.concatenate((codes, [0, 0]))
        next1 = np.where(opens[quote + 1], 0, padded[quote + 1])
        next2 = np.where(opens[quote + 1] | opens[quote + 2], 0, padded[quote + 2])
        one, two = np.zeros(len(quote), dtype=bool), np.zeros(len(quote), dtype=bool)
        for x in SUFFIXES:
            if len(x) == 1:
                one |= next1 == ord(x)
            else:
                two |= (next1 == ord(x[0])) & (next2 == ord(x[1]))
        c[quote[one]] = QUOTE1
        c[quote[two & ~one]] = QUOTE2
    # each text starts afresh: what came before its first code point is forgotten
    c[np.unique(first[first < n])] += np.uint8(FIRST)
    return _scan(c)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join neighbours of least rank first, leftmost on ties, until none is left; n log n in the piece's length."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is piece[i:end[i]]
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    gone = bytearray(n + 1)
    while heap:
        _, i, e = heapq.heappop(heap)
        if gone[i] or end[i] >= n or end[end[i]] != e:
            continue
        j = end[i]
        gone[j] = 1
        end[i] = e
        if e < n:
            prev[e] = i
        if prev[i] >= 0:
            offer(prev[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def _places(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ..., n[0] of them, then those of the next."""
    total = np.cumsum(n)
    return np.repeat(begin - (total - n), n) + np.arange(total[-1] if len(total) else 0)


#: The rank of a pair that makes no token.
NEVER = 1 << 40


class Decoder:
    """The bytes of a vocabulary's tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.widths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.widths)))
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all texts, their bounds by text)."""
        n = self.widths[ids]
        total = np.concatenate(([0], np.cumsum(n)))
        out = self.bytes[np.repeat(self.offsets[ids] - total[:-1], n) + np.arange(total[-1])]
        return out.tobytes(), total[bounds]


class Encoder(Decoder):
    """Encodes batches with one vocabulary; kept by each worker."""

    def __init__(self, path: str) -> None:
        self.ranks = load_ranks(path)
        super().__init__(self.ranks)
        # the pairs of tokens that make a token
        pairs = {self.ranks[t[:k]] << 32 | self.ranks[t[k:]]: r for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        self.pairs, self.joined = pd.Index(np.fromiter(pairs, dtype=np.int64)), np.append(np.fromiter(pairs.values(), dtype=np.int64), NEVER)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self._empty_cache()

    def _empty_cache(self) -> None:
        """The cache: by a piece's hash a row of (ids, bytes) in flat arrays."""
        self.known = pd.Index(np.zeros(0, dtype=np.uint64))
        self.ids, self.id_bounds = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.text, self.text_bounds = np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)

    def pieces(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts of the pieces, their number before each text), in bytes."""
        buf = np.frombuffer(data, dtype=np.uint8)
        if not len(buf):
            return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
        lead = (buf & 0xC0) != 0x80
        if lead.all():
            codes, at = buf.astype(np.uint32), None
            first = offsets
        else:
            codes = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            at = np.flatnonzero(lead)
            first = np.searchsorted(at, offsets)
        starts = np.flatnonzero(boundaries(codes, first[:-1]))
        starts = starts if at is None else at[starts]
        return starts, np.searchsorted(starts, offsets)

    def encode(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their bounds by text)."""
        starts, per_text = self.pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        h = span_hashes(data, starts, ends)
        kind, distinct = pd.factorize(h)
        which = np.empty(len(distinct), dtype=np.int64)
        which[kind[::-1]] = np.arange(len(h) - 1, -1, -1)
        if not self._same(data, starts, ends, starts[which][kind]):
            # two pieces with one hash: tell all apart by their bytes
            seen: dict[bytes, int] = {}
            kind = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts, ends, strict=True)])
            which = np.unique(kind, return_index=True)[1]
            rows = self._rows(data, starts[which], ends[which], np.zeros(0, dtype=np.uint64))
        else:
            rows = self._rows(data, starts[which], ends[which], distinct)
        sizes, begin = np.diff(rows[1]), rows[1][:-1]
        n = sizes[kind]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = rows[0][np.repeat(begin[kind] - total[:-1], n) + np.arange(total[-1])]
        return ids, total[per_text]

    def _rows(self, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of distinct pieces; with their hashes, by way of the cache."""
        cached = len(hashes) == len(starts)
        at = self.known.get_indexer(hashes) if cached else np.full(len(starts), -1)
        hit = np.flatnonzero(at >= 0)
        if len(hit) and not self._equal(data, starts[hit], ends[hit], at[hit]):
            at[:], cached = -1, False
        new = np.flatnonzero(at < 0)
        flat, n = self._merged(data, starts[new], ends[new])
        sizes = np.empty(len(starts), dtype=np.int64)
        sizes[new] = n
        old = at >= 0
        sizes[old] = (self.id_bounds[at[old] + 1] - self.id_bounds[at[old]])
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(bounds[-1], dtype=np.uint32)
        out[_places(bounds[:-1][new], sizes[new])] = flat
        out[_places(bounds[:-1][old], sizes[old])] = self.ids[_places(self.id_bounds[at[old]], sizes[old])]
        if cached and len(new):
            short = (ends - starts)[new] <= LONGEST
            if len(self.known) + len(new) > CACHE:
                self._empty_cache()
            keep = new[short]
            self.known = self.known.append(pd.Index(hashes[keep]))
            self.ids = np.concatenate((self.ids, out[_places(bounds[:-1][keep], sizes[keep])]))
            self.id_bounds = np.concatenate((self.id_bounds, self.id_bounds[-1] + np.cumsum(sizes[keep])))
            length = (ends - starts)[keep]
            self.text = np.concatenate((self.text, np.frombuffer(data, dtype=np.uint8)[_places(starts[keep], length)]))
            self.text_bounds = np.concatenate((self.text_bounds, self.text_bounds[-1] + np.cumsum(length)))
        return out, bounds

    def _merged(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number for each piece) of pieces that are not cached.

        Each round joins one pair of every short piece that still has one: the first
        of least rank. Pieces are rows of a matrix, filled up with -1.
        """
        length = ends - starts
        whole = [self.ranks.get(data[a:b], -1) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        whole = np.array(whole, dtype=np.int64)
        lists: list[tuple[int, list[int]]] = [(i, merge(data[starts[i] : ends[i]], self.ranks)) for i in np.flatnonzero((whole < 0) & (length > SHORT))]
        sizes = np.ones(len(starts), dtype=np.int64)
        for i, x in lists:
            sizes[i] = len(x)
        many = np.flatnonzero((whole < 0) & (length <= SHORT))
        many = many[np.argsort(length[many], kind="stable")]
        found = []
        for part in np.array_split(many, max(1, len(many) // 8192)):
            if not len(part):
                continue
            width = int(length[part].max())
            at = starts[part][:, None] + np.arange(width)
            inside = np.arange(width) < length[part][:, None]
            ids = np.where(inside, self.single[np.frombuffer(data, dtype=np.uint8)[np.minimum(at, len(data) - 1)]], -1)
            rank = self._rank(ids[:, :-1], ids[:, 1:])
            done = []
            rows = part
            while len(rows):
                i = rank.argmin(axis=1)
                every = np.arange(len(rows))
                best = rank[every, i]
                ended = best == NEVER
                if ended.any():
                    done.append((rows[ended], ids[ended]))
                    rows, ids, rank, i, best = rows[~ended], ids[~ended], rank[~ended], i[~ended], best[~ended]
                    every = np.arange(len(rows))
                    if not len(rows):
                        break
                ids[every, i] = best
                after = np.arange(ids.shape[1] - 1) > i[:, None]
                ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
                ids[:, -1] = -1
                rank[:, :-1] = np.where(after[:, :-1], rank[:, 1:], rank[:, :-1])
                rank[:, -1] = NEVER
                nxt = ids[every, np.minimum(i + 1, ids.shape[1] - 1)]
                rank[every, i] = self._rank(best, nxt)
                left = np.flatnonzero(i > 0)
                rank[left, i[left] - 1] = self._rank(ids[left, i[left] - 1], best[left])
            found += done
        for rows, ids in found:
            sizes[rows] = (ids >= 0).sum(axis=1)
        begin = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), dtype=np.uint32)
        one = whole >= 0
        out[begin[one]] = whole[one]
        for i, x in lists:
            out[begin[i] : begin[i] + len(x)] = x
        for rows, ids in found:
            out[_places(begin[rows], sizes[rows])] = ids[ids >= 0]
        return out, sizes

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, NEVER if it makes no token or lacks a side."""
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -1)
        return self.joined[self.pairs.get_indexer(key.ravel())].reshape(key.shape)

    def _equal(self, data: bytes, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> bool:
        """Whether the pieces have the bytes of their rows."""
        n = self.text_bounds[rows + 1] - self.text_bounds[rows]
        if (n != ends - starts).any():
            return False
        far = n > 8
        return bool((np.frombuffer(data, dtype=np.uint8)[_places(starts[far], n[far])] == self.text[_places(self.text_bounds[rows[far]], n[far])]).all())

    @staticmethod
    def _same(data: bytes, starts: np.ndarray, ends: np.ndarray, models: np.ndarray) -> bool:
        """Whether each piece has the bytes of its model; pieces of up to 8 bytes and one length can't share a hash."""
        far = np.flatnonzero(ends - starts > 8)
        n = (ends - starts)[far]
        first = np.repeat(np.cumsum(n) - n, n)
        step = np.arange(int(n.sum())) - first
        buf = np.frombuffer(data, dtype=np.uint8)
        other = np.minimum(np.repeat(models[far], n) + step, len(buf) - 1)
        return bool((buf[np.repeat(starts[far], n) + step] == buf[other]).all())


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(4)
def decoder(path: str) -> Decoder:
    return Decoder(load_ranks(path))


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (doc_id, ids binary, n_tokens).

    ids: little-endian unsigned 32-bit integers, without special tokens. A null
    text counts as empty and gives no ids. Rows of a null or repeated id are
    encoded like any other. Other columns are ignored; an empty table gives an
    empty result. ``vocabulary`` is the path of a file of ranks on every machine.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in slices(rows, "text", SLICE):
            ids, bounds = own.encode(*text_batch(batch.column(1)))
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), data.cast(pa.binary()), pa.array(np.diff(bounds), pa.int64())], names=["doc_id", "ids", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, ids binary, n_tokens long")


def bpe_decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with one more column, decoded (binary): the bytes of the ids; null ids give null."""
    # numbered names, as mapInArrow does not quote those of its input
    plain = encoded.toDF(*[f"c{i}" for i in range(len(encoded.columns))])
    schema = StructType([*plain.schema.fields, StructField("decoded", BinaryType())])
    at = encoded.columns.index(ids_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(vocabulary)
        for whole in rows:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                column = batch.column(at)
                lists = [b"" if x is None else x for x in column.to_pylist()]
                bounds = np.concatenate(([0], np.cumsum([len(x) // 4 for x in lists]))).astype(np.int64)
                data, ends = own.decode(np.frombuffer(b"".join(lists), dtype="<u4"), bounds)
                out = pa.array([data[x:y] if ok else None for x, y, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "decoded"])

    return plain.mapInArrow(lean(run), schema).toDF(*encoded.columns, "decoded")
