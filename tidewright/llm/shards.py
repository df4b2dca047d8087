"""Training-order materialisation of token ids as binary shards.

Documents are put in the order of their ids, and of the hashes of their texts where
ids are repeated, encoded and cut into sequences of a fixed number of ids, which are
numbered in that order: so the numbers depend on the documents alone, not on how Spark
splits them. A keyed
Feistel network over the number of sequences, walked along its cycles until it
falls into their range, is a permutation, so each sequence has one global slot and
no slot is left or shared. Slots are dealt by range: a shard holds the ids of
``per_shard`` slots one after the other, each of the same number of bytes. Slot s
stands in shard s // per_shard at byte (s % per_shard) * stride, so a reader goes
through the training order sequentially and resumes at any slot by arithmetic. Ids take two bytes where the vocabulary
allows it, else four, little-endian.

``export_shards`` writes the shards as raw files with a manifest, ``resume`` reads them
from any slot on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import lean, slices, text_batch
from .bpe import SLICE, encoder
from ..store import release, written

LENGTH = 1024
PER_SHARD = 1024
#: Shards that a task writes one after the other.
RANGE = 8
ROUNDS = 8


def feistel(x: np.ndarray, n: int, key: str) -> np.ndarray:
    """The places of 0 <= x < n under the permutation of that key."""
    if n <= 1:
        return np.zeros_like(x)
    half = max(1, -(-(n - 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{i}".encode()).digest()[:8], "little")) for i in range(ROUNDS)]
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        v = out[todo]
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(32)
            f *= np.uint64(0xD6E8FEB86659FD93)
            f ^= f >> np.uint64(29)
            left, right = right, left ^ (f & mask)
        out[todo] = (left << np.uint64(half)) | right
        # walk on from values out of range; the walk ends, for the cycle comes back to x
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def id_type(vocabulary: str, pad: int) -> np.dtype:
    """The unsigned type that holds all ids and the padding."""
    return np.dtype("<u2" if max(pad, len(encoder(vocabulary).widths) - 1) < 1 << 16 else "<u4")


def sequences(docs: DataFrame, vocabulary: str, length: int, id_col: str, text_col: str, pad: int, kind: np.dtype) -> DataFrame:
    """(part, row, doc_id, seq, n_tokens, ids): each document's ids in pieces of ``length``, the last one padded.

    (part, row) says of each piece its place in the order of documents, part after part.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, row = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in slices(rows, "text", SLICE):
            ids, bounds = own.encode(*text_batch(batch.column(1)))
            size = np.diff(bounds)
            pieces = -(-size // length)
            doc = np.repeat(np.arange(len(size)), pieces)
            seq = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            n = np.minimum(length, size[doc] - seq * length)
            grid = np.full((len(doc), length), pad, dtype=kind)
            where = np.repeat(np.arange(len(doc)) * length, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            grid.ravel()[where] = ids
            data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((np.arange(len(doc) + 1) * (kind.itemsize * length)).astype("<i4")), pa.py_buffer(grid.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(doc), part), pa.int32()), pa.array(np.arange(row, row + len(doc))), batch.column(0).take(pa.array(doc)), pa.array(seq, pa.int32()), pa.array(n, pa.int32()), data], names=["part", "row", "doc_id", "seq", "n_tokens", "ids"]
            )
            row += len(doc)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # a hash for the order of texts of one id
    own = F.xxhash64("text")
    ranged = rows.repartitionByRange("doc_id", own).sortWithinPartitions("doc_id", own)
    return ranged.mapInArrow(lean(cut), "part int, row long, doc_id long, seq int, n_tokens int, ids binary")


def write_shards(docs: DataFrame, vocabulary: str, key: str, length: int = LENGTH, per_shard: int = PER_SHARD, id_col: str = "doc_id", text_col: str = "text", pad: int = 50256) -> tuple[DataFrame, DataFrame]:
    """Write the shards and return (shards, index).

    shards: (shard, first_slot, n_slots, payload), a row for each shard of the
    table written; payload has n_slots times length ids. index: (slot, doc_id, seq,
    n_tokens), a row for each sequence. A null or empty text has no sequence, a very long
    one has as many as it needs. Rows of null ids come first, rows of repeated ids in the order of a hash of
    their texts; all are materialised like others. Other columns are ignored. An empty table gives no shard.
    """
    spark = docs.sparkSession
    kind = id_type(vocabulary, pad)
    cut = written(sequences(docs, vocabulary, length, id_col, text_col, pad, kind), "shard-sequences")
    release(spark)
    # a row for each part, not for each sequence
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "shard-parts")
    n = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            yield pa.RecordBatch.from_arrays([pa.array(feistel(b.column(0).to_numpy(), n, key)), *b.columns[1:]], names=["slot", *b.schema.names[1:]])

    counted = cut.join(parts.select("part", "first"), "part").withColumn("place", F.col("first") + F.col("row"))
    placed = counted.select("place", "ids").mapInArrow(lean(place), "slot long, ids binary").withColumn("shard", F.floor(F.col("slot") / per_shard))
    index = counted.select("place", "doc_id", "seq", "n_tokens").mapInArrow(lean(place), "slot long, doc_id long, seq int, n_tokens int")

    def join(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequences in the order of slots -> shards; a task has whole shards only."""
        now, first, held = -1, 0, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"shard": pa.array([now], pa.int64()), "first_slot": pa.array([first], pa.int64()), "n_slots": pa.array([len(held)], pa.int32()), "payload": pa.array([b"".join(held)], pa.binary())})

        for b in rows:
            for shard, slot, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if shard != now:
                    if held:
                        yield made()
                    now, first, held = shard, slot, []
                held.append(ids)
        if held:
            yield made()

    # slots are a permutation: every shard but the last holds exactly per_shard sequences, and every range RANGE shards
    ranges = max(1, -(-n // (per_shard * RANGE)))
    ranged = placed.select("shard", "slot", "ids").repartitionById(ranges, F.floor(F.col("shard") / RANGE).cast("int")).sortWithinPartitions("slot")
    shards = written(ranged.mapInArrow(lean(join), "shard long, first_slot long, n_slots int, payload binary"), "shards")
    del ranged
    release(spark)
    return shards, index


def read_slots(shards: DataFrame) -> DataFrame:
    """The sequences of a table of shards, in no order: (slot, shard, offset, ids)."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for i in range(whole.num_rows):
                shard, first, n = (whole.column(c)[i].as_py() for c in range(3))
                data = whole.column(3)[i].as_buffer()
                stride = data.size // n
                at = np.arange(n, dtype=np.int64)
                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * stride).astype("<i4")), data])
                yield pa.RecordBatch.from_arrays([pa.array(first + at), pa.array(np.full(n, shard)), pa.array(at * stride), ids], names=["slot", "shard", "offset", "ids"])

    return shards.mapInArrow(lean(cut), "slot long, shard long, offset long, ids binary")


def export_shards(shards: DataFrame, path: str, key: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> None:
    """Write a table of shards as raw files: path/shards/shard=N/..., each the ids of its slots and one byte after them, and path/manifest.

    Spark's writer of text lines writes a line's bytes as they are, so this works on
    every store that Spark writes to. The manifest, JSON, tells the number of slots
    and shards, the bytes of a slot, slots of a shard and the SHA-256 of the key; it comes last, so a
    folder without it is not whole. A path that is there is an error.
    """
    stride = F.octet_length("payload") / F.col("n_slots")
    facts = shards.agg(F.coalesce(F.sum("n_slots"), F.lit(0)).alias("slots"), F.count(F.lit(1)).alias("shards"), F.coalesce(F.max(stride), F.lit(0)).cast("long").alias("stride"))
    shards.select("shard", F.col("payload").cast("string").alias("value")).write.partitionBy("shard").text(f"{path}/shards")
    facts = facts.select("*", F.lit(length).alias("length"), F.lit(per_shard).alias("per_shard"), F.lit(hashlib.sha256(key.encode()).hexdigest()).alias("key_sha256"))
    facts.coalesce(1).write.json(f"{path}/manifest")


def resume(spark: SparkSession, path: str, slot: int = 0) -> DataFrame:
    """(slot, ids) of exported shards from that slot on; only the files of shards that hold such slots are read."""
    facts = spark.read.schema("slots long, shards long, stride long, per_shard long").json(f"{path}/manifest").first()
    if facts is None:
        raise ValueError(f"{path} has no manifest: the export did not end")
    stride, per_shard = facts.stride, facts.per_shard
    files = [f"{path}/shards/shard={i}" for i in range(max(0, slot) // per_shard if per_shard else 0, facts.shards)]
    if slot >= facts.slots or not files:
        return spark.createDataFrame([], "slot long, ids binary")

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = data.as_buffer()
                n = data.size // stride
                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * stride).astype("<i4")), data])
                yield pa.RecordBatch.from_arrays([pa.array(shard * per_shard + np.arange(n)), ids], names=["slot", "ids"])

    found = spark.read.format("binaryFile").load(files).select(F.regexp_extract("path", r"shard=(\d+)/", 1).cast("long").alias("shard"), "content")
    return found.mapInArrow(cut, "slot long, ids binary").where(F.col("slot") >= slot)
