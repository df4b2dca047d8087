"""Batches of texts, and questions that batches put to hash buckets.

Operators that compare every word window of a corpus with every other one send,
for each batch of texts, its distinct 64-bit window hashes to hash buckets: one
row for a batch and bucket, the hashes packed into a binary, the whole bytes
that the bucket itself tells left out. A bucket answers each batch in the order
it was asked, so an answer costs a bit or a byte for a hash, not an identifier.

A hash that is frequent is sent once by each batch, however many of its texts
hold it: a bucket grows with the number of batches, not with the hottest key.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import written
from .words import Batch

#: Bytes of text of a batch; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
#: Keys that one bucket holds at most, on average.
BUCKET_KEYS = 4_000_000
SIZES = 64

_IPC = pa.ipc.IpcWriteOptions(compression="zstd")


def trim() -> None:
    """Give freed memory back to the system, which the C library else keeps for a worker's next task of another kind."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def lean(run: Callable) -> Callable:
    """A function of batches, as mapInArrow takes it, that trims the worker's memory at its end."""

    @functools.wraps(run)
    def out(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(rows)
        finally:
            trim()

    return out


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_IPC) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.BufferReader(payload)).read_all()


def text_batch(texts: pa.Array | pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) and texts.num_chunks else texts
    if not len(texts):
        return b"", np.zeros(1, dtype=np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (data.to_pybytes() if data else b"")[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def batch_table(docs: DataFrame, id_col: str, text_col: str, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Write docs as (batch, n_words, sizes, payload); sizes[k] counts texts of k words, k < SIZES.

    payload: an Arrow stream of (doc_id, text), ordered by doc_id, compressed.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in slices(rows, "text", batch_bytes):
            table = pa.Table.from_batches([batch]).sort_by("doc_id")
            counts = Batch(*text_batch(table["text"])).counts
            sizes = np.bincount(counts[counts < SIZES], minlength=SIZES)
            yield pa.RecordBatch.from_pydict(
                {"batch": pa.array([part << 20 | seq], pa.int64()), "n_words": pa.array([int(counts.sum())], pa.int64()), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())), "payload": pa.array([pack(table)], pa.binary())}
            )
            seq += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(lean(cut), "batch long, n_words long, sizes array<long>, payload binary"), name)


def bucket_bits(n_keys: int) -> int:
    """How many leading bits of a hash name its bucket: as few as the keys allow, from 8 to 24.

    The number of rows is that of batches times that of buckets, so one bucket more than needed costs a row for each batch.
    """
    return min(24, max(8, (max(0, n_keys - 1) // BUCKET_KEYS).bit_length()))


def cut_keys(keys: np.ndarray, lead: int) -> bytes:
    """64-bit keys without their ``lead`` leading bytes."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - lead]).tobytes()


def join_keys(data: bytes, lead: int) -> np.ndarray:
    """The inverse of cut_keys; the leading bytes, equal in a bucket, stay zero."""
    part = np.frombuffer(data, dtype=np.uint8).reshape(-1, 8 - lead)
    whole = np.zeros((len(part), 8), dtype=np.uint8)
    whole[:, : 8 - lead] = part
    return whole.view("<u8").ravel()


def bucket_bounds(sorted_keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets that occur, their bounds) in sorted keys."""
    b = (sorted_keys >> np.uint64(64 - bits)).astype(np.int64)
    if not len(b):
        return b, np.zeros(1, dtype=np.int64)
    at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    return b[at], np.concatenate((at, [len(b)]))


def ask(batches: DataFrame, request: Callable, answer: Callable, columns: str, replies: str) -> DataFrame:
    """request: payload -> rows of (bucket, ...); answer: one bucket's rows -> rows of replies (batch, ...)."""

    def ask_all(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for batch, payload in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                yield from request(batch, payload.as_py())

    asked = batches.select("batch", "payload").mapInArrow(lean(ask_all), f"bucket int, batch long, {columns}")
    def answered(table: pa.Table) -> pa.Table:
        out = answer(table)
        trim()
        return out

    return asked.groupBy("bucket").applyInArrow(answered, f"batch long, bucket int, {replies}")


def meet(batches: DataFrame, replies: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """finish(batch, payload, replies of the batch) for every batch."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        # a reply without its batch can't be: both come from the one written table
        out = pa.concat_tables([finish(b, x.as_py(), right) for b, x in zip(left["batch"].to_pylist(), left["payload"], strict=True)])
        trim()
        return out

    return batches.select("batch", "payload").groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(both, schema)
