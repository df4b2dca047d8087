"""Limits, shuffles, unions, interleaving and batches, all on explicit ids."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce
from numbers import Real

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import col, numbered


def validate_probabilities(probabilities: Iterable[object], count: int) -> list[float]:
    """As floats; an error unless there are ``count`` finite numbers in [0, 1] that add up to 1."""
    given = list(probabilities) if isinstance(probabilities, Iterable) else []
    # comparisons are false for NaN and infinity
    odd = [v for v in given if not (isinstance(v, Real) and not isinstance(v, bool) and 0 <= v <= 1)]
    if odd or len(given) != count or abs(1 - math.fsum(given)) > 1e-8:
        raise ValueError(f"{count} probabilities in [0, 1] that add up to 1 are needed, not {probabilities!r}")
    return list(map(float, given))


def validate_buffer(size: object) -> int:
    if isinstance(size, bool) or not isinstance(size, int) or size <= 0:
        raise ValueError(f"a shuffle buffer is a positive whole number, not {size!r}")
    return size


def take(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first n rows in that order; all if n is None."""
    return df if n is None else df.orderBy(*order).limit(n)


def shuffle_rank(seed: int, key: str) -> Column:
    """What a shuffle sorts by: a hash of seed and key."""
    return F.md5(F.concat_ws("\u0001", F.lit(str(seed)), F.col(key).cast("string")))


def seeded_shuffle(df: DataFrame, seed: int, key: str, buffer: int | None = None, row: str | None = None) -> DataFrame:
    """In a random order that seed and key decide. With a buffer, only blocks of so many rows, by ``row``, are shuffled within."""
    rank = shuffle_rank(seed, key)
    if buffer is None:
        return df.orderBy(rank, key)
    if row is None:
        raise ValueError("a buffered shuffle needs the column that numbers the rows")
    return df.orderBy(F.floor(F.col(row) / validate_buffer(buffer)), rank, key)


def standardise(df: DataFrame, language: str | None = None, text: str = "text", default: str = "", audio: str | None = None) -> DataFrame:
    """(text, language) or, with the name of a column of sound, (audio, text, language): the fixed schema of sources that are mixed.

    language: the source's, else the model's, else nothing. A missing column is an error.
    """
    for c in filter(None, (text, audio)):
        if c not in df.columns:
            raise ValueError(f"table has no column {c}")
    sound = [col(audio).alias("audio")] if audio else []
    return df.select(*sound, col(text).cast("string").alias("text"), F.lit(language if language is not None else default).alias("language"))


def concatenate(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def interleave(sources: Sequence[DataFrame], order: Sequence[str], seed: int, probabilities: Sequence[float] | None = None) -> DataFrame:
    """Rows of all sources with columns source, step and round, until each source was used up once.

    A source's k-th row has step k of its own sequence of draws: its place is the sum
    of k + 1 steps of the mean 1 / p that a keyed hash jitters, so rates are as
    given and the order is reproducible. Sources that end restart (round 1, 2, ...)
    until the longest, by rows over probability, has ended. Order decides each
    source's own sequence. Sources must have the same columns.
    """
    p = validate_probabilities(probabilities, len(sources)) if probabilities is not None else [1 / len(sources)] * len(sources)
    sizes = [s.count() for s in sources]
    if not all(x > 0 for x, n in zip(p, sizes, strict=True) if n):
        raise ValueError("a source with probability 0 is never used up")
    horizon = max((n / x for n, x in zip(sizes, p, strict=True) if n), default=0.0)
    out = []
    for i, (source, n, x) in enumerate(zip(sources, sizes, p, strict=True)):
        if not n:
            continue
        drawn = max(n, math.floor(horizon * x))
        held = numbered(source, list(order), "interleave-rows")
        # only as many rounds as the rest of the mix is long; a row that is not reached again is not repeated
        again = held.withColumn("round", F.explode(F.sequence(F.lit(0), F.floor((F.lit(drawn - 1) - F.col("row_")) / n).cast("int"))))
        k = F.col("round") * n + F.col("row_")
        digest = F.md5(F.concat_ws("\u0001", F.lit(str(seed)), F.lit(str(i)), k.cast("string")))
        jitter = F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / float(1 << 20)
        out.append(again.withColumn("source", F.lit(i)).withColumn("step", (k + jitter) / x).drop("row_"))
    return concatenate(out) if out else sources[0].limit(0).withColumn("round", F.lit(0)).withColumn("source", F.lit(0)).withColumn("step", F.lit(0.0))


def batches(df: DataFrame, order: Sequence[str], size: int, drop_last: bool = True) -> DataFrame:
    """df with batch and place_in_batch, both from 0; without the last batch if it is not full."""
    rows = numbered(df, list(order), "batch-rows")
    out = rows.withColumn("batch", F.floor(F.col("row_") / size)).withColumn("place_in_batch", (F.col("row_") % size).cast("int"))
    if drop_last:
        out = out.where(F.col("batch") < rows.count() // size)
    return out.drop("row_")


def accumulation_steps(total: int, devices: int, per_device: int) -> int:
    return max(total // devices // per_device, 1)


def exposure(mixture: DataFrame, steps: int, batch: int) -> DataFrame:
    """mixture (name, probability, nominal_rows) with epochs: how often a source's rows are seen."""
    return mixture.withColumn("epochs", F.col("probability") * steps * batch / F.col("nominal_rows"))


def language_share(mixture: DataFrame) -> DataFrame:
    return mixture.groupBy("language").agg(F.sum("probability").alias("share"))
