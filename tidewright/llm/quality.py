"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are hashed n-grams of its characters and of their shapes
(upper, lower, digit, blank, the mark itself). The vectors of a bounded sample of
labelled texts give inverse document frequencies and, by a truncated singular
value decomposition, the latent space. These vectors, at most SAMPLE, are
broadcast; every document takes its exact cosine with all of them, in blocks, and
its NEIGHBOURS nearest vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .batches import lean, slices, text_batch, trim
from .langid import held_out

#: Bound of the labelled rows that the classifier is fitted on and broadcasts: those of the least hashed ids.
SAMPLE = 4096
DIMENSIONS = 64
NEIGHBOURS = 32
#: Similarities are raised to this power for the vote.
SHARPNESS = 4
THRESHOLD = 0.3
_HALF = 4096
_DOCS = 256
SLICE = 1 << 19


@lru_cache(1)
def _shapes() -> np.ndarray:
    """The shape of each byte: a for lower case and all of other scripts, A for upper case, 9 for digits."""
    out = np.arange(256, dtype=np.uint64)
    out[ord("a") : ord("z") + 1] = ord("a")
    out[ord("A") : ord("Z") + 1] = ord("A")
    out[ord("0") : ord("9") + 1] = ord("9")
    out[128:] = ord("a")
    return out


def counts(texts: pa.Array) -> np.ndarray:
    """[texts, 2 * _HALF] counts: hashed byte trigrams, then shape n-grams of one to four."""
    data, offsets = text_batch(texts)
    n = len(offsets) - 1
    out = np.zeros(n * 2 * _HALF, dtype=np.float32)
    buf = np.frombuffer(data, dtype=np.uint8)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    left = offsets[doc + 1] - np.arange(len(buf))
    for series, orders, half in ((buf.astype(np.uint64), (3,), 0), (_shapes()[buf], (1, 2, 3, 4), 1)):
        for order in orders:
            m = len(series) - order + 1
            if m <= 0:
                continue
            h = np.full(m, order, dtype=np.uint64)
            for j in range(order):
                h = (h + series[j : m + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            ok = left[:m] >= order
            cell = doc[:m][ok] * (2 * _HALF) + (half * _HALF) + (h[ok] >> np.uint64(52)).astype(np.int64)
            out += np.bincount(cell, minlength=len(out)).astype(np.float32)
    return out.reshape(n, 2 * _HALF)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # [2 * _HALF, dimensions]
    vectors: np.ndarray  # [labelled, dimensions], of length 1 or 0
    labels: np.ndarray
    prior: float


def _weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic frequencies by rarity; each half of length 1. Done in place."""
    np.log1p(x, out=x)
    x *= idf
    for half in (x[:, :_HALF], x[:, _HALF:]):
        length = np.sqrt(np.einsum("ij,ij->i", half, half))
        half /= np.where(length > 0, length, 1)[:, None].astype(np.float32)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _sparse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(rows, "text", SLICE):
        for a in range(0, batch.num_rows, _DOCS):
            part = batch.slice(a, _DOCS)
            x = counts(part.column(1))
            at = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()), pa.array([r[i].astype("<f4").tobytes() for r, i in zip(x, at, strict=True)], pa.binary())], names=["label", "at", "value"]
            )


class _Sample:
    """Weighted vectors of the sample, kept sparse; blocks of them are made whole one after the other."""

    def __init__(self, rows: list) -> None:
        self.rows = [(np.frombuffer(r.at, dtype="<u2"), np.frombuffer(r.value, dtype="<f4")) for r in rows]
        seen = np.zeros(2 * _HALF, dtype=np.int64)
        for at, _ in self.rows:
            seen[at] += 1
        self.idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + np.float32(0.1)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        for a in range(0, len(self.rows), _DOCS):
            part = self.rows[a : a + _DOCS]
            x = np.zeros((len(part), 2 * _HALF), dtype=np.float32)
            for i, (at, value) in enumerate(part):
                x[i, at] = value
            yield a, _weighted(x, self.idf)

    def times(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ q for _, x in self.blocks()])

    def transposed_times(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros((2 * _HALF, y.shape[1]), dtype=np.float32)
        for a, x in self.blocks():
            out += x.T @ y[a : a + len(x)]
        return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows (doc_id, label): those whose hashed ids are least.

    docs: (doc_id, text). Labels that are null, or of documents that are not there,
    are left out. Of several labels of one id the greatest counts, of several texts
    the one whose MD5 is least, so reruns agree.
    """
    chosen = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.col("text").cast("string").alias("text"))
    # a document id that is repeated would be drawn as often
    one = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.struct(F.md5(F.col("text").cast("binary")))).alias("text"))
    got = one.orderBy("doc_id").select("label", "text").mapInArrow(lean(_sparse), "label int, at binary, value binary").collect()
    y = np.array([r.label for r in got], dtype=np.float32)
    x = _Sample(got)
    del got
    size = min(DIMENSIONS, max(1, len(y)))
    q = np.random.default_rng(7).standard_normal((2 * _HALF, size + 16)).astype(np.float32)
    axes = q[:, :size]
    if len(y):
        for _ in range(4):
            q = np.linalg.qr(x.transposed_times(x.times(q)))[0]
        axes = (q @ np.linalg.svd(x.times(q), full_matrices=False)[2].T[:, :size]).astype(np.float32)
    vectors = _unit(x.times(axes)) if len(y) else np.zeros((0, size), dtype=np.float32)
    out = Model(x.idf, axes, vectors.astype(np.float32), y, float(y.mean()) if len(y) else 0.5)
    trim()
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with one more column: the score, 0 to 1, higher where label 1 is likelier.

    A text without any feature (null, empty) or labelled neighbour gets the share of label 1 in the sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = min(NEIGHBOURS, len(m.labels))
        for batch in slices(rows, f"c{at}", SLICE):
            for a in range(0, batch.num_rows, _DOCS):
                part = batch.slice(a, _DOCS)
                v = _unit(_weighted(counts(part.column(at)), m.idf) @ m.axes)
                out = np.full(part.num_rows, m.prior)
                if k:
                    near = v @ m.vectors.T
                    top = np.argpartition(near, -k, axis=1)[:, -k:]
                    weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** SHARPNESS
                    total = weight.sum(axis=1)
                    np.divide((weight * m.labels[top]).sum(axis=1), total, out=out, where=total > 0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.clip(out, 0, 1))], names=[*part.schema.names, "score"])

    # numbered names, as mapInArrow does not quote those of its input
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = StructType([*plain.schema.fields, StructField("score", DoubleType())])
    return plain.mapInArrow(lean(run), schema).toDF(*docs.columns, score_col)


def learned(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Model:
    """Fit on labels.quality outside the fold."""
    rows = labels.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, fold)).select("doc_id", F.col("quality").alias("label"))
    return fit(docs.select("doc_id", "text"), rows)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """Learn outside the fold, score all documents: (doc_id, held_out, score, predicted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(rows, learned(docs, labels, folds, fold))
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score the threshold or more."""
    name = "quality_score_" + "_" * max(map(len, docs.columns))  # longer than, so unlike, any column
    return score(docs, learned(docs, labels), score_col=name).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
