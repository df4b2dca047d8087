"""Corpus error rates from edit operations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

COUNTS = StructType([StructField(c, LongType()) for c in ("s", "d", "i", "h")])
#: Above so many cells the alignment goes by diagonals first, and by the matrix only if the two are far apart.
SMALL = 1 << 14
#: Above so many cells it goes by diagonals only: the matrix of two long texts would not fit.
MATRIX = 1 << 22
#: Fronts between two that are kept; those of one such block are made again on the way back.
BLOCK = 256


def edit_operations(reference: Sequence, hypothesis: Sequence) -> tuple[int, int, int, int]:
    """(substitutions, deletions, insertions, hits) of one cheapest alignment.

    Common ends are cut off first. Among cheapest alignments the one is taken that,
    read from the end, prefers a deletion, then an insertion, then the diagonal.
    """
    n, m, a = len(reference), len(hypothesis), 0
    while a < min(n, m) and reference[a] == hypothesis[a]:
        a += 1
    b = 0
    while b < min(n, m) - a and reference[n - 1 - b] == hypothesis[m - 1 - b]:
        b += 1
    hits = a + b
    ref, hyp = reference[a : n - b], hypothesis[a : m - b]
    n, m = len(ref), len(hyp)
    if not n or not m:
        return 0, n, m, hits
    if n * m > SMALL and (found := _by_diagonals(ref, hyp, n + m if n * m > MATRIX else (n + m) // 16)):
        return *found[:3], found[3] + hits
    codes = {x: i for i, x in enumerate(dict.fromkeys([*ref, *hyp]))}
    r, h = np.array([codes[x] for x in ref]), np.array([codes[x] for x in hyp])
    cost = np.zeros((n + 1, m + 1), dtype=np.int32)
    cost[0] = np.arange(m + 1)
    steps = np.arange(m + 1)
    for k in range(1, n + 1):
        row = np.minimum(cost[k - 1] + 1, np.concatenate(([k], cost[k - 1, :-1] + (h != r[k - 1]))))
        row[0] = k
        # insertions run along the row: a running minimum of cost less place
        cost[k] = np.minimum.accumulate(row - steps) + steps
    s = d = i = 0
    x, y = n, m
    while x or y:
        if x and cost[x, y] == cost[x - 1, y] + 1:
            d, x = d + 1, x - 1
        elif y and cost[x, y] == cost[x, y - 1] + 1:
            i, y = i + 1, y - 1
        else:
            if r[x - 1] == h[y - 1]:
                hits += 1
            else:
                s += 1
            x, y = x - 1, y - 1
    return s, d, i, hits


def _by_diagonals(ref: Sequence, hyp: Sequence, most: int) -> tuple[int, int, int, int] | None:
    """As edit_operations, for two sequences that are not empty; None if the distance is over ``most``.

    Takes time in proportion to the lengths and the square of the distance, and
    memory of distance ** 2 / BLOCK and BLOCK * distance.

    front(e)[k] is the largest x so that ref[:x] becomes hyp[:x + k] at a cost of e
    at most. Costs never fall along a diagonal, so the fronts say of every cell
    whether its cost is e or less, which is all that the way back asks.
    """
    n, m = len(ref), len(hyp)
    codes = {x: i for i, x in enumerate(dict.fromkeys([*ref, *hyp]))}
    kind = np.dtype(np.uint8 if len(codes) < 255 else np.uint16 if len(codes) < 65535 else np.uint32)
    step = 8 // kind.itemsize
    bits = 64 // step

    def words(items: Sequence, end: int) -> np.ndarray:
        # eight bytes from every place on; the ends differ, so no run goes past them
        flat = np.array([codes[x] for x in items] + [len(codes) + end] * step, dtype=kind)
        return np.lib.stride_tricks.sliding_window_view(flat, step).copy().view(np.uint64).ravel()

    r, h = words(ref, 0), words(hyp, 1)

    def slide(x: np.ndarray, low: int) -> None:
        at = np.flatnonzero(x >= 0)
        while len(at):
            here = x[at]
            differ = r[here] ^ h[here + at + low]
            same = differ == 0
            lowest = np.frexp((differ & (~differ + np.uint64(1))).astype(np.float64))[1] - 1
            x[at] = here + np.where(same, step, lowest // bits)
            at = at[same]

    def after(e: int, low: int, x: np.ndarray) -> tuple[int, np.ndarray]:
        """Front e from front e - 1, which begins at the diagonal low."""
        first, last = max(-e, -n), min(e, m)
        wide = np.full(last - first + 3, -2, dtype=np.int64)
        wide[low - first + 1 : low - first + 1 + len(x)] = x
        k = np.arange(first, last + 1)
        new = np.maximum(np.maximum(wide[1:-1] + 1, wide[2:] + 1), wide[:-2])
        new = np.minimum(np.minimum(new, n), m - k)
        slide(new, first)
        return first, new

    start = np.zeros(1, dtype=np.int64)
    slide(start, 0)
    kept, block, e = [], [(0, start)], 0
    while not 0 <= m - n - block[-1][0] < len(block[-1][1]) or block[-1][1][m - n - block[-1][0]] < n:
        e += 1
        if e > most:
            return None
        new = after(e, *block[-1])
        if len(block) == BLOCK:
            kept.append(block[0])
            block = []
        block.append(new)
    begin = e - len(block) + 1

    def reached(e: int, k: int, x: int) -> bool:
        low, front = block[e - begin]
        return 0 <= k - low < len(front) and front[k - low] >= x

    s = d = i = hits = 0
    x, y = n, m
    while e:
        if e - 1 < begin:
            begin -= BLOCK
            block = [kept.pop()]
            while len(block) < BLOCK:
                block.append(after(begin + len(block), *block[-1]))
        if x and reached(e - 1, y - x + 1, x - 1):
            d, x, e = d + 1, x - 1, e - 1
        elif y and reached(e - 1, y - 1 - x, x):
            i, y, e = i + 1, y - 1, e - 1
        elif ref[x - 1] == hyp[y - 1]:
            hits, x, y = hits + 1, x - 1, y - 1
        else:
            s, x, y, e = s + 1, x - 1, y - 1, e - 1
    return s, d, i, hits + x


def _words(text: str) -> list[str]:
    return [w for w in text.strip().split(" ") if w]


def _counter(cut):
    @F.pandas_udf(COUNTS)
    def count(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
        rows = [(None,) * 4 if r is None or h is None else edit_operations(cut(r), cut(h)) for r, h in zip(reference, hypothesis, strict=True)]
        return pd.DataFrame(rows, columns=["s", "d", "i", "h"]).astype("Int64")

    return count


def char_edits(reference: Column, hypothesis: Column) -> Column:
    """struct(s, d, i, h) over characters of the stripped texts; null if either is null."""
    return _counter(lambda x: x.strip())(reference, hypothesis)


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """struct(s, d, i, h) over words, which single spaces or runs of them divide."""
    return _counter(_words)(reference, hypothesis)


def rate(s: Column, d: Column, i: Column, h: Column, normalise: bool = True) -> Column:
    """(s + d + i) / (s + d + h), insertions added below if normalised; null where that is 0."""
    below = s + d + h + i if normalise else s + d + h
    return F.when(below > 0, (s + d + i) / below)


def error_rate(df: DataFrame, edits: str, out: str, by: Sequence[str] = (), normalise: bool = True) -> DataFrame:
    """Micro-average: the edits of all rows over all their references, not the mean of the rows' rates."""
    sums = {c: F.sum(f"{edits}.{c}") for c in "sdih"}
    return df.groupBy(*by).agg(rate(sums["s"], sums["d"], sums["i"], sums["h"], normalise).alias(out))


def row_rate(edits: Column, normalise: bool = True) -> Column:
    return rate(*(edits[c] for c in "sdih"), normalise)
