"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts by language in each partition, as packed arrays,
and sums these in two steps. The log-probability matrix, languages by buckets,
is broadcast in blocks of at most LANGUAGES languages, which bounds each; a text meets one block after the
other and keeps its best language and the sum of all likelihoods. Scoring is numpy on Arrow
batches: each text's n-grams are looked up and summed at once for a batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import lean, slices, text_batch
from ..store import forget, written

ORDERS = (1, 2, 3)
BITS = 16
#: Bound of a broadcast: 512 KiB a language.
LANGUAGES = 128
SLICE = 1 << 19
_PARTS = 16
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@lru_cache(1)
def _folded() -> np.ndarray:
    """Each code point's lower case if it is a letter, else a space."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if unicodedata.category(x)[0] == "L":
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngrams(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of each order: (buckets, bounds by text); last, the number of letters of each text.

    Runs of other characters than letters count as one space; n-grams have a letter at least.
    """
    data, offsets = text_batch(texts)
    buf = np.frombuffer(data, dtype=np.uint8)
    codes = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offsets]
    folded = _folded()[codes]
    letter = folded != 32
    letters = np.concatenate(([0], np.cumsum(letter)))[first]
    begins = np.zeros(len(folded) + 1, dtype=bool)
    begins[first] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep |= begins[:-1]
    at = np.flatnonzero(keep)
    x = folded[at].astype(np.uint64)
    bounds = np.searchsorted(at, first)
    n, buckets, ends = len(x), [], []
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    for order in ORDERS:
        m = max(0, n - order + 1)
        h = np.full(m, order * 0x27D4EB2F165667C5 & (1 << 64) - 1, dtype=np.uint64)
        some = np.zeros(m, dtype=bool)
        for j in range(order):
            h += (x[j : m + j] + np.uint64(1)) * np.uint64(_PLACES[j])
            some |= x[j : m + j] != 32
        ok = some & (left[:m] >= order)
        h = h[ok]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        buckets.append((h >> np.uint64(64 - BITS)).astype(np.int64))
        ends.append(np.concatenate(([0], np.cumsum(ok)))[np.minimum(bounds, m)])
    return buckets, ends, np.diff(letters)


def _summed(table: pa.Table) -> pa.Table:
    """One row of the same language and part with the sums of all."""
    total = np.sum([np.frombuffer(x.as_py(), dtype="<i8") for x in table["counts"]], axis=0, dtype=np.int64)
    return pa.table({"lang": table["lang"][:1], "part": table["part"][:1], "salt": pa.array([0], pa.int32()), "docs": pa.array([sum(table["docs"].to_pylist())], pa.int64()), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


_COUNTS = "lang string, part int, salt int, docs long, counts binary"


@dataclass
class Model:
    """What is learned of a block of languages: names in order, log-probabilities [languages, buckets], log-priors."""

    langs: list[str]
    log_p: np.ndarray
    prior: np.ndarray


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Iterator[Model]:
    """The model of all rows with a language, in blocks of languages, of which the driver holds one at a time."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in slices(rows, "text", SLICE):
            langs = batch.column(1).to_pylist()
            names = {x: i for i, x in enumerate(sorted(set(langs)))}
            which = np.array([names[x] for x in langs])
            counts = np.zeros(len(names) << BITS, dtype=np.int64)
            buckets, ends, _ = ngrams(batch.column(0))
            for b, e in zip(buckets, ends, strict=True):
                counts += np.bincount((np.repeat(which, np.diff(e)) << BITS) + b, minlength=len(counts))
            for x, i in names.items():
                own = counts[i << BITS : (i + 1) << BITS]
                totals[x] = totals[x] + own if x in totals else own
                docs[x] = docs.get(x, 0) + int((which == i).sum())
        salt = TaskContext.get().partitionId() % 256
        for x, own in totals.items():
            cuts = np.split(own, _PARTS)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([x] * _PARTS), "part": pa.array(range(_PARTS), pa.int32()), "salt": pa.array([salt] * _PARTS, pa.int32()), "docs": pa.array([docs[x] if i == 0 else 0 for i in range(_PARTS)], pa.int64()), "counts": pa.array([c.astype("<i8").tobytes() for c in cuts], pa.binary())}
            )

    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    partial = rows.mapInArrow(lean(count), _COUNTS)
    found = written(partial.groupBy("lang", "part", "salt").applyInArrow(_summed, _COUNTS).groupBy("lang", "part").applyInArrow(_summed, _COUNTS), "language-counts")
    # a row for each language
    sizes = {r.lang: r.n for r in found.groupBy("lang").agg(F.sum("docs").alias("n")).collect()}
    langs, total = sorted(sizes), max(1, sum(sizes.values()))
    for a in range(0, len(langs), LANGUAGES):
        own = langs[a : a + LANGUAGES]
        counts = np.zeros((len(own), _PARTS, (1 << BITS) // _PARTS))
        for r in found.where(F.col("lang").between(own[0], own[-1])).collect():
            counts[own.index(r.lang), r.part] = np.frombuffer(r.counts, dtype="<i8")
        counts = counts.reshape(len(own), 1 << BITS)
        log_p = np.log(counts + 0.5) - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * (1 << BITS))
        yield Model(own, log_p, np.log(np.array([sizes[x] for x in own]) / total))
    forget(found)


def predict(docs: DataFrame, model: Iterable[Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (doc_id, lang_pred, score).

    score: the posterior probability of lang_pred. A text that is null or has no
    letter is ``und`` with score 0, as is every text if nothing was learned. Ties go
    to the language that comes first by code point. Other columns are ignored.
    """

    def scorer(shared, last: bool):
        def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in slices(rows, "text", SLICE):
                buckets, ends, letters = ngrams(batch.column(1))
                n, every = batch.num_rows, np.arange(batch.num_rows)
                total = np.tile(m.prior, (n, 1))
                for b, e in zip(buckets, ends, strict=True):
                    filled = np.flatnonzero(np.diff(e))
                    if len(filled):
                        for i in range(len(m.langs)):
                            total[filled, i] += np.add.reduceat(m.log_p[i][b], e[filled])
                # what blocks before this one have found: the best language, its likelihood, and the sum of all relative to that
                best, top = total.argmax(axis=1), total.max(axis=1)
                rest = np.exp(total - top[:, None]).sum(axis=1)
                names = np.array(m.langs, dtype=object)[best]
                old = batch.column(3).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                names = np.where(old >= top, np.array(batch.column(2).to_pylist(), dtype=object), names)
                most = np.maximum(old, top)
                sums = rest * np.exp(top - most) + batch.column(4).fill_null(0.0).to_numpy(zero_copy_only=False) * np.exp(old - most)
                known = letters[every] > 0
                found = [pa.array(np.where(known, names, None), pa.string()), pa.array(most, mask=~known), pa.array(sums, mask=~known)]
                # the text goes on to the next block only
                yield pa.RecordBatch.from_arrays([batch.column(0), *([] if last else [batch.column(1)]), *found], names=schema(last))

        return lean(score)

    def schema(last: bool) -> list[str]:
        return ["doc_id", *([] if last else ["text"]), "lang_pred", "top", "sums"]

    kinds = {"doc_id": "long", "text": "string", "lang_pred": "string", "top": "double", "sums": "double"}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("sums"))
    blocks = iter(model)
    block = next(blocks, None)
    while block is not None:
        shared, block = docs.sparkSession.sparkContext.broadcast(block), next(blocks, None)
        rows = rows.mapInArrow(scorer(shared, block is None), ", ".join(f"{x} {kinds[x]}" for x in schema(block is None)))
    return rows.select("doc_id", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.coalesce(1 / F.col("sums"), F.lit(0.0)).alias("score"))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def language_id(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn from the documents outside the fold that have an id and a language, predict all: (doc_id, held_out, lang_pred, score)."""
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, fold)))
    return predict(docs, model).select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "lang_pred", "score")
