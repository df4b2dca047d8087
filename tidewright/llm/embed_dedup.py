"""Embedding near-duplicates by collision-counting projections.

Unit vectors with a cosine of at least c lie within sqrt(2 - 2c) of each other,
so on a random direction their projections differ little. Each vector has WINDOWS
one-dimensional projections, in steps of 1 / STEPS; a pair collides on one if the
second lies in the window centred on the first. The pairs with at least as many collisions as a true
pair reaches with probability RECALL (binomial) are verified by cosine in doubles.

Counting over all pairs would be quadratic: a window holds a third of all vectors,
however many there are. So vectors are first dealt to cells,
by the signs of some projections, in so many tables that a true pair shares a cell
with probability RECALL or more; cells keep their size as the input grows. In a
cell, one projection is sorted and pairs in its window are counted on, projection
after projection, as long as they can still reach the count.

Only the projections, a byte each, go to all tables. Where they leave candidates, the
vectors of these follow, and a pair that shares several cells is verified in the
first only. Equal vectors are one
vector with a multiplicity. A hot cell is split into a grid of chunks. From a cell
leave one row a vector: its number of links, and its root among the cell's links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import lean
from .components import connected_components
from ..store import forget, written
from .vectors import matrix, usable

RECALL = 0.999
WINDOWS = 32
#: Half width of a window in standard deviations of a true pair's difference.
WIDTH = 2.0
#: Steps of a projection, whose deviation is 1, that a byte tells apart.
STEPS = 16
#: Vectors that a cell holds on average, and at most before it is split.
CELL, CHUNK = 512, 1024
_TILE = 256


def tables_needed(cosine: float, bits: int) -> int:
    """Tables after which a pair of that cosine has shared a cell with probability RECALL."""
    once = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(1 - RECALL) / math.log(1 - once))


def count_needed() -> int:
    """The most collisions that a pair of the least cosine reaches with probability RECALL."""
    p, tail = math.erf(WIDTH / math.sqrt(2)), 0.0
    for c in range(WINDOWS, 0, -1):
        tail += math.comb(WINDOWS, c) * p**c * (1 - p) ** (WINDOWS - c)
        if tail >= RECALL:
            return c
    return 1


def _directions(dim: int, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([dim, 20])
    return rng.standard_normal((dim, tables * bits)), rng.standard_normal((dim, WINDOWS))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable over the pairs (a, b), by label propagation with shortcuts."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of vectors: (vec_id, n_links, component_id, kept).

    n_links: other vectors found with that cosine or more; component_id: the least
    id reachable by links, itself included; kept: whether that is its own. Every
    link is verified; a pair just at the cosine is found with probability near
    RECALL squared, a closer one with more. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of
    different lengths. A row of a null id gets 0, null and null. Rows of one id
    count as one vector; if they hold different vectors they link through the id.
    Other columns are ignored. An empty table gives an empty result.
    """
    def clean(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            ok = usable(b.column(1))
            v = b.column(1).filter(pa.array(ok))
            sums = np.zeros(b.num_rows)
            flat = np.abs(v.flatten().to_numpy(zero_copy_only=False))
            if len(flat):
                sums[ok] = np.add.reduceat(flat, np.concatenate(([0], np.cumsum(np.diff(np.asarray(v.offsets)))))[:-1])
            yield b.filter(pa.array(sums > 0))

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = rows.where("id is not null").mapInArrow(lean(clean), "id long, v array<double>")
    keyed = good.withColumn("key", F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256)).dropDuplicates(["id", "key"])
    # equal vectors: one class, its least id and the number of its ids
    members = written(keyed, "near-members")
    classes = members.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("many"))
    # ids of vectors that differ may be the same, so classes are numbered
    numbers = written(classes.withColumn("cid", F.monotonically_increasing_id()), "near-classes")
    reps = written(members.join(numbers, "key").where("id = rep").select("cid", "rep", "many", "v"), "near-reps")
    n = numbers.count()
    bits = max(2, math.ceil(math.log2(max(2, n / CELL))))
    tables, most = tables_needed(cosine, bits), WINDOWS - count_needed()
    width = math.floor(WIDTH * math.sqrt(2 - 2 * cosine) * STEPS) + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x, at in _by_length(whole.column(1)):
                signs, lines = _directions(x.shape[1], tables, bits)
                # 32 bits of signs, 8 of the table, the rest for the length
                cells = _codes(x, signs, tables, bits) + ((np.arange(tables, dtype=np.int64) << 32) + (x.shape[1] << 40))[None]
                steps = np.clip(np.floor(x @ lines * STEPS), -128, 127).astype(np.int8)
                cid = whole.column(0).take(pa.array(np.repeat(at, tables)))
                held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WINDOWS), len(x), [None, pa.py_buffer(steps.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([cid, pa.array(cells.ravel()), held.take(pa.array(np.repeat(np.arange(len(x)), tables)))], names=["cid", "cell", "lines"])

    dealt = reps.select("cid", "v").mapInArrow(lean(deal), "cid long, cell long, lines binary")
    # known before the join, so that few hot cells are sent to the tasks and not all vectors to the hot cells
    hot = written(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).select("cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "near-hot")
    # chunk i of a cell meets chunk j in the sub-cell (i, j), i <= j
    spread = dealt.join(hot, "cell", "left").withColumn("own", F.coalesce(F.pmod(F.xxhash64("cid"), F.col("chunks")), F.lit(0)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    spread = spread.select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "cid", "lines")

    def count(table: pa.Table) -> pa.Table:
        """The vectors of a cell that have a candidate in it."""
        found = candidates(np.frombuffer(b"".join(table["lines"].to_pylist()), dtype=np.int8).reshape(table.num_rows, -1), table["own"].to_numpy(), table["lo"][0].as_py() != table["hi"][0].as_py(), width, most)
        return table.select(["cell", "lo", "hi", "own", "cid"]).take(pa.array(np.flatnonzero(found)))

    some = written(spread.groupBy("cell", "lo", "hi").applyInArrow(count, "cell long, lo int, hi int, own int, cid long"), "near-candidates")

    def verify(table: pa.Table) -> pa.Table:
        n = table.num_rows
        (x, _), = _by_length(table["v"])
        signs, _ = _directions(x.shape[1], tables, bits)
        codes, t = _codes(x, signs, tables, bits), (table["cell"][0].as_py() >> 32) & 255
        own, split = table["own"].to_numpy(), table["lo"][0].as_py() != table["hi"][0].as_py()
        left, right = [], []
        for a in range(0, n, _TILE):
            i, j = np.nonzero(x[a : a + _TILE] @ x[a:].T >= cosine - 1e-9)
            ok = j > i
            i, j = i[ok] + a, j[ok] + a
            ok = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
            if split:
                ok &= own[i] != own[j]
            if t:
                ok &= (codes[i, :t] != codes[j, :t]).all(axis=1)
            left.append(i[ok])
            right.append(j[ok])
        i, j = (np.concatenate(z) for z in (left, right))
        many, rep = table["many"].to_numpy(), table["rep"].to_numpy()
        links = np.bincount(i, weights=many[j], minlength=n) + np.bincount(j, weights=many[i], minlength=n)
        linked = np.flatnonzero(links)
        root = _roots(n, i, j)
        return pa.table({"cid": table["cid"].take(pa.array(linked)), "rep": pa.array(rep[linked], pa.int64()), "root": pa.array(rep[root[linked]], pa.int64()), "links": pa.array(links[linked].astype(np.int64))})

    found = some.join(reps, "cid").select("cell", "lo", "hi", "own", "cid", "rep", "many", "v").groupBy("cell", "lo", "hi").applyInArrow(verify, "cid long, rep long, root long, links long")
    found = written(found, "near-links")
    forget(some, hot)
    of = members.select("key", "id").join(numbers, "key")
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionAll(of.select(F.col("rep").alias("a"), F.col("id").alias("b")))
    comps = connected_components(edges, "near-components")
    links = of.join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
    links = links.groupBy("id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"))
    out = rows.select("id").join(links, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("root", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))


def _by_length(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(unit vectors, their rows) of each length."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(np.asarray(column.offsets))
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        x = matrix(column.take(pa.array(at)))
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        yield x, at


def _codes(x: np.ndarray, signs: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """[rows, tables]: the signs of each table's projections as a number."""
    # row by row sums, not a matrix product, so that a vector has the same signs in whatever company
    products = np.stack([np.einsum("ij,j->i", x, s) for s in signs.T], axis=1)
    return ((products > 0).reshape(len(x), tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def candidates(lines: np.ndarray, own: np.ndarray, split: bool, width: int, most: int) -> np.ndarray:
    """Which rows of projections have a partner, of another chunk if split, that misses at most ``most`` of their windows."""
    n = len(lines)
    order = np.argsort(lines[:, 0], kind="stable")
    sorted_, own = lines[order].astype(np.int16), own[order]
    columns = np.ascontiguousarray(sorted_.T)
    ends = np.searchsorted(columns[0], columns[0] + width, side="right")
    half = max(1, len(columns) // 2)
    out = np.zeros(n, dtype=bool)
    for a in range(0, n, _TILE):
        b = min(n, a + _TILE)
        for c in range(a, int(ends[b - 1]), 4 * _TILE):
            d = min(n, c + 4 * _TILE)
            missed = np.zeros((b - a, d - c), dtype=np.int8)
            for line in columns[:half]:
                missed += np.abs(line[a:b, None] - line[None, c:d]) > width
            ok = (missed <= most) & (np.arange(c, d)[None] > np.arange(a, b)[:, None])
            if split:
                ok &= own[a:b, None] != own[None, c:d]
            i, j = np.nonzero(ok)
            if len(i):
                missed = missed[i, j].astype(np.int64)
                i, j = i + a, j + c
                for line in columns[half:]:
                    missed += np.abs(line[i] - line[j]) > width
                out[i[missed <= most]] = True
                out[j[missed <= most]] = True
    return out[np.argsort(order, kind="stable")]
