"""Substring dedup: relative Lempel-Ziv parsing of each document against the documents before it.

The reference of the parse is the corpus in the order of ids, of which each window
of 13 words is indexed at its first occurrence: a document and a place in it. The
index is dealt by hash into blocks, and each document's windows are looked up in
all of them. The parse is greedy: at the first window that an earlier document has,
a factor begins, (document, place, length), and it grows word by word as long as the
next window's first occurrence is the next place of that document; then, at the
first window that the factor does not cover, the next one may begin. So windows
over the boundary of two factors are looked up like all others, and a factor
decodes to words of the reference. Factors have 13 words or more; the words under
them are duplicates.

As a window counts at its first occurrence only, a passage that was itself put
together from earlier ones parses into factors of these. The words under factors are
the same as in a parse against all occurrences, for which every earlier document would
have to meet every later one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import ask, batch_table, bucket_bits, bucket_bounds, cut_keys, join_keys, meet, text_batch, unpack
from ..store import release, written
from .words import Batch, windows

WORDS = 13
_CODEC = pa.Codec("zstd", compression_level=1)
#: Bytes that are worth a compressed frame.
_WORTH = 64


class _Windows:
    """The windows of a batch whose texts are ordered by id.

    ``keys[i]``, in the order of hashes, is first found in the text ``owner[i]`` at its word ``spot[i]``;
    ``at[j]`` is the key of the window that starts at word ``place[j]``.
    """

    def __init__(self, payload: bytes, k: int) -> None:
        table = unpack(payload)
        self.ids = table["doc_id"]
        self.known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.id = self.ids.fill_null(0).to_numpy().astype(np.int64)
        self.words = b = Batch(*text_batch(table["text"]))
        keys, place = windows(b.hashes(), b.counts, k)
        ok = self.known[b.doc[place]]
        keys, self.place = keys[ok], place[ok]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        head = np.ones(len(keys), dtype=bool)
        head[1:] = keys[1:] != keys[:-1]
        self.keys = keys[head]
        self.at = np.empty(len(keys), dtype=np.int64)
        self.at[order] = np.cumsum(head) - 1
        self.found = self.place[order[head]]
        self.owner = b.doc[self.found]
        self.spot = self.found - b.first[self.owner]

    def requests(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, their bounds, keys by index); a bucket's keys are in the order of the texts that own them and of their places there."""
        buckets, bounds = bucket_bounds(self.keys, bits)
        # one sort for all buckets: words are numbered through the batch, text by text
        return buckets, bounds, np.argsort(np.repeat(np.arange(len(buckets)), np.diff(bounds)) * len(self.words.starts) + self.found)


def _small(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each, first bytes first, compressed if there are some; their width and number before them."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(x) or int(x.max()) < 1 << (8 * w))
    planes = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return bytes([width]) + len(x).to_bytes(4, "little") + (_CODEC.compress(planes).to_pybytes() if len(planes) >= _WORTH else planes)


def _large(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:5], "little")
    if not n:
        return np.zeros(0, dtype=np.int64)
    planes = _CODEC.decompress(data[5:], decompressed_size=width * n) if width * n >= _WORTH else data[5:]
    planes = np.frombuffer(planes, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _request(bits: int, k: int):
    lead = bits // 8

    def request(batch: int, payload: bytes) -> Iterator[pa.RecordBatch]:
        w = _Windows(payload, k)
        buckets, bounds, own = w.requests(bits)
        if not len(buckets):
            return
        owner, spots = w.owner[own], w.spot[own]
        # a run holds the keys that one text owns in one bucket
        new = np.ones(len(own), dtype=bool)
        new[1:] = owner[1:] != owner[:-1]
        new[bounds[:-1]] = True
        run = np.flatnonzero(new)
        counts, ids, cuts = np.diff(np.append(run, len(own))), w.id[owner[run]], np.searchsorted(run, bounds)
        steps = np.diff(ids, prepend=0)
        # places as steps from one to the next within a text
        spots, starts = np.diff(spots, prepend=0), spots[run]
        spots[run] = starts
        keys, wide = cut_keys(w.keys[own], lead), 8 - lead
        runs, places = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)), list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(buckets, pa.int32()),
                "batch": pa.array([batch] * len(buckets), pa.int64()),
                "first_id": pa.array(ids[cuts[:-1]], pa.int64()),
                "steps": pa.array([_small(steps[a + 1 : b]) for a, b in runs], pa.binary()),
                "counts": pa.array([_small(counts[a:b]) for a, b in runs], pa.binary()),
                "spots": pa.array([_small(spots[x:y]) for x, y in places], pa.binary()),
                "keys": pa.array([keys[wide * x : wide * y] for x, y in places], pa.binary()),
            }
        )

    return request


def _answer(bits: int):
    lead = bits // 8

    def answer(table: pa.Table) -> pa.Table:
        """For each key of each batch: whether an earlier document has it, and for those that document's id and the place there."""
        parts, ids, places = [], [], []
        for first, steps, counts, spots, keys in zip(*(table[c].to_pylist() for c in ("first_id", "steps", "counts", "spots", "keys")), strict=True):
            counts, spots = _large(counts), _large(spots)
            parts.append(join_keys(keys, lead))
            ids.append(np.repeat(first + np.concatenate(([0], np.cumsum(_large(steps)))), counts))
            run, starts = np.cumsum(spots), np.cumsum(counts) - counts
            places.append(run - np.repeat(run[starts] - spots[starts], counts))
        keys, doc, place = np.concatenate(parts), np.concatenate(ids), np.concatenate(places)
        order = np.lexsort((place, doc, keys))
        sorted_keys = keys[order]
        head = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        owner = np.empty(len(keys), dtype=np.int64)
        owner[order] = np.repeat(order[head], np.diff(np.append(head, len(keys))))
        cuts, known, source, spot = np.cumsum([0, *map(len, parts)]), [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            least = doc[owner[a:b]]
            earlier = least < doc[a:b]
            known.append(np.packbits(earlier).tobytes())
            source.append(least[earlier].astype("<i8").tobytes())
            spot.append(_small(place[owner[a:b]][earlier]))
        return pa.table({"batch": table["batch"].cast(pa.int64()), "bucket": table["bucket"].cast(pa.int32()), "known": pa.array(known, pa.binary()), "source": pa.array(source, pa.binary()), "spot": pa.array(spot, pa.binary())})

    return answer


_SCHEMA = "doc_id long, n_words long, n_removed long, n_factors long, spans array<struct<start:long,length:long,source:long,place:long>>, kept_text string"


def _finish(bits: int, k: int):
    def finish(batch: int, payload: bytes, replies: pa.Table) -> pa.Table:
        w = _Windows(payload, k)
        b = w.words
        # the first occurrence of each key: in this batch, or in an answer
        source, spot = w.id[w.owner], w.spot.copy()
        got = {x: (known.as_py(), found.as_py(), where.as_py()) for x, known, found, where in zip(replies["bucket"].to_pylist(), replies["known"], replies["source"], replies["spot"], strict=True)}
        buckets, bounds, order = w.requests(bits)
        for bucket, x, y in zip(buckets.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            known, found, where = got[bucket]
            earlier = order[x:y][np.unpackbits(np.frombuffer(known, dtype=np.uint8), count=y - x).astype(bool)]
            source[earlier], spot[earlier] = np.frombuffer(found, dtype="<i8"), _large(where)
        src, spot = source[w.at], spot[w.at]
        hit = src < w.id[b.doc[w.place]]
        at, src, spot = w.place[hit], src[hit], spot[hit]
        # a factor goes on where the next window's first occurrence is the next place of its source
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (src[1:] != src[:-1]) | (spot[1:] != spot[:-1] + 1) | (b.doc[at[1:]] != b.doc[at[:-1]])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(at)) - 1 if len(begin) else begin
        start, length = at[begin], at[last] - at[begin] + k
        n = len(b.starts)
        step = np.zeros(n + 1, dtype=np.int64)
        np.add.at(step, start, 1)
        np.add.at(step, start + length, -1)
        keep = np.cumsum(step[:-1]) == 0
        docs = len(b.counts)
        removed = np.bincount(b.doc, weights=~keep, minlength=docs).astype(np.int64)
        # kept words, each with one space after it but for a text's last
        kept = np.flatnonzero(keep)
        last_kept = np.ones(len(kept), dtype=bool)
        last_kept[:-1] = b.doc[kept[1:]] != b.doc[kept[:-1]]
        step = np.zeros(len(b.buf) + 1, dtype=np.int8)
        step[b.starts[kept]] += 1
        np.subtract.at(step, b.ends[kept], 1)
        mask = np.cumsum(step, dtype=np.int8)[:-1].astype(bool)
        out = b.buf.copy()
        spaces = b.ends[kept[~last_kept]]
        out[spaces] = 0x20
        mask[spaces] = True
        offsets = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[b.offsets]
        text = pa.LargeStringArray.from_buffers(docs, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[mask].tobytes())).cast(pa.string())
        per_doc = np.bincount(b.doc[start], minlength=docs)
        spans = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(per_doc))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(start - b.first[b.doc[start]]), pa.array(length), pa.array(src[begin]), pa.array(spot[begin])], names=["start", "length", "source", "place"]),
        )
        return pa.table({"doc_id": w.ids.cast(pa.int64()), "n_words": pa.array(b.counts, pa.int64()), "n_removed": pa.array(removed), "n_factors": pa.array(per_doc, pa.int64()), "spans": spans, "kept_text": text})

    return finish


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS) -> DataFrame:
    """One row per row of docs: (doc_id, n_words, n_removed, n_factors, spans, kept_text).

    Words are runs of bytes other than white space, unchanged. A word is removed
    if a window of k consecutive words over it also starts in a document of a
    smaller id; windows are judged on the input. spans: the factors, as (first
    word, words, source document, first word there); the words under them are those
    that go, and are the source's own. Neighbours may overlap where the source changes.
    kept_text: the kept words, joined by one space. A null text has no words. A row
    without an id loses nothing and is no source; rows of one id do not remove each
    other. Other columns are ignored. An empty table gives an empty result. Windows
    are compared by 64-bit hashes.
    """
    batches = batch_table(docs, id_col, text_col, "substring-batches")
    bits = bucket_bits(batches.agg(F.sum("n_words")).first()[0] or 0)
    replies = written(ask(batches, _request(bits, k), _answer(bits), "first_id long, steps binary, counts binary, spots binary, keys binary", "known binary, source binary, spot binary"), "substring-replies")
    # the questions, which are larger than the texts, are not needed any more
    release(docs.sparkSession)
    return meet(batches, replies, _finish(bits, k), _SCHEMA)
