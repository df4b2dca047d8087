"""Exact top-k search by inner product, with pivot-table elimination.

With one more component, the root of what its squared length lacks of the
greatest, every vector gets one length, and the largest inner product becomes the
least Euclidean distance. A table holds each vector's distances to many pivots.
In Euclidean space they say more than that two distances to a pivot differ: they
place a vector above the pivots' simplex, at known coordinates and a known height,
and the distance of two such places bounds theirs from below. That is the maximum
of all bounds that the table can give, and never less than the largest
difference of distances to one pivot. A query takes its candidates in the order of
bounds and stops where the bound exceeds its k-th distance; the result is exact.

Candidates are dealt to the cells of CENTRES centres, and these to blocks. Each query
first meets one block of its own cell. With the k-th distance found there it goes
on to the cells whose bounding boxes, in the table's coordinates, it can't rule out;
a cell that no query goes to is not moved. Only the best of a block leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import lean, trim
from ..store import written
from .vectors import matrix, usable

#: Pivots beside the first one, at most, and of how many components there is one.
PIVOTS, SHARE = 256, 7 / 8
CENTRES = 64
#: Bounded sample that pivots and centres are chosen from, and lengths of vectors that get some; others are compared with all of their length.
SAMPLE, LENGTHS = 1024, 64
CANDIDATES, QUERIES = 8192, 16384
#: Candidates evaluated before the k-th distance is looked at again, and queries whose bounds are held at once.
_CHUNK, _ROWS = 128, 128
_LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(x: np.ndarray) -> np.ndarray:
    return np.floor(1024.0 * x)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole inner products; of values too large for exact doubles, by Python's integers, ended at a long's limits."""
    most = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1])
    if most < 2**53:
        return (x @ q).astype(np.int64)
    q = [int(v) for v in q]
    return np.array([min(_LONG[1], max(_LONG[0], sum(int(a) * b for a, b in zip(r, q, strict=True)))) for r in x], dtype=np.int64)


@dataclass
class Table:
    """What places vectors of one length: the greatest squared length, the pivots and the centres, all lifted."""

    most: float
    pivots: np.ndarray
    centres: np.ndarray

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Scaled vectors with their added component; a query has none of it."""
        return np.hstack([x, np.zeros((len(x), 1)) if query else np.sqrt(np.maximum(0, self.most - (x * x).sum(axis=1)))[:, None]])

    def distances(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        """The squared distances of lifted vectors."""
        return np.maximum(0, (x * x).sum(axis=1)[:, None] + (to * to).sum(axis=1)[None] - 2 * x @ to.T)

    def places(self, x: np.ndarray) -> np.ndarray:
        """[rows, pivots]: coordinates above the pivots' simplex, from the distances to the pivots alone, and the height."""
        if not len(self.pivots):
            return np.zeros((len(x), 0))
        own = self.distances(x, self.pivots)
        legs = self.pivots[1:] - self.pivots[0]
        inner = (own[:, :1] - own[:, 1:] + (legs * legs).sum(axis=1)[None]) / 2
        at = np.linalg.solve(self.lower, inner.T).T if len(legs) else inner
        return np.hstack([at, np.sqrt(np.maximum(0, own[:, 0] - (at * at).sum(axis=1)))[:, None]])

    def __post_init__(self) -> None:
        legs = self.pivots[1:] - self.pivots[0] if len(self.pivots) else self.pivots
        self.lower = np.linalg.cholesky(legs @ legs.T) if len(legs) else np.zeros((0, 0))

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + np.sqrt(self.most))


def _chosen(sample: np.ndarray, k: int) -> np.ndarray:
    """Pivots: each next one is the sample's vector farthest from the flat that those chosen span."""
    if not len(sample):
        return sample
    rest, chosen = sample - sample[0], [0]
    floor = 1e-3 * (1 + np.linalg.norm(rest, axis=1).max())
    while len(chosen) <= k:
        far = np.linalg.norm(rest, axis=1)
        i = int(far.argmax())
        if far[i] <= floor:
            break
        chosen.append(i)
        axis = rest[i] / far[i]
        rest = rest - (rest @ axis)[:, None] * axis[None]
    return sample[chosen]


def _spread(sample: np.ndarray, k: int) -> np.ndarray:
    """Centres: each next one is the sample's vector farthest from those chosen."""
    if not len(sample):
        return sample
    chosen, gap = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(k, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def make_table(sample: np.ndarray, most: float, n: int) -> Table:
    """sample: scaled vectors, of n. Squares beyond doubles leave no pivot, so every candidate is evaluated."""
    if not np.isfinite(most) or most > 1e200 or not len(sample):
        return Table(float(np.nan_to_num(most, posinf=0)), np.zeros((0, sample.shape[1] + 1)), np.zeros((1, sample.shape[1] + 1)))
    lifted = Table(most, np.zeros((0, 1)), np.zeros((0, 1))).lifted(sample, False)
    return Table(most, _chosen(lifted, min(PIVOTS, int(SHARE * sample.shape[1]))), _spread(lifted, min(CENTRES, -(-n // CANDIDATES))))


def search(table: Table, x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, kth: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Of each query the best (ids, scores) of a block that may be among its k, and the number of pairs evaluated.

    kth: what each query's k-th squared distance is known not to exceed. Scores below all of its best may be left out.
    """
    px, pq = table.places(table.lifted(x, False)), table.places(table.lifted(q, True))
    base = (px * px).sum(axis=1)
    order = np.argsort(ids, kind="stable")
    out, evaluated = [], 0
    length = (q * q).sum(axis=1) + table.most
    for a in range(0, len(q), _ROWS):
        rows = pq[a : a + _ROWS]
        bounds = base[None] + (rows * rows).sum(axis=1)[:, None] - 2 * rows @ px.T
        for i in range(a, min(len(q), a + _ROWS)):
            bound, limit = bounds[i - a], kth[i]
            # rounding may take a bound a little too high
            slack = table.slack * (2 * np.sqrt(max(limit, 0)) + table.slack) if np.isfinite(limit) else 0
            at = order[bound[order] <= limit + slack] if np.isfinite(limit) else order
            at = at[ids[at] != qids[i]]
            first = min(len(at), max(k, _CHUNK))
            own = bound[at]
            if len(at) > first:
                part = np.argpartition(own, first - 1)
                near, far = part[:first], part[first:]
            else:
                near, far = np.arange(len(at)), np.zeros(0, dtype=np.int64)
            best_s, best_id = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            queue = [at[near]]
            while queue:
                now = queue.pop()
                evaluated += len(now)
                s, c = np.concatenate((best_s, _products(x[now], q[i]))), np.concatenate((best_id, ids[now]))
                keep = np.lexsort((c, -s.astype(object) if len(s) and s.min() == _LONG[0] else -s))[:k]
                best_s, best_id = s[keep], c[keep]
                if len(best_s) == k:
                    limit = min(limit, length[i] - 2.0 * float(best_s[-1]))
                if len(far):
                    # the next ones in the order of bounds, as long as a bound does not exceed the k-th distance
                    slack = table.slack * (2 * np.sqrt(max(limit, 0)) + table.slack) if np.isfinite(limit) else 0
                    far = far[own[far] <= limit + slack]
                    far = far[np.argsort(own[far], kind="stable")]
                    if len(far):
                        queue.append(at[far[:_CHUNK]])
                        far = far[_CHUNK:]
            out.append((best_id, best_s))
    return out, evaluated


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k best rows of vectors: (query_id, rank, vec_id, score).

    A component x counts as floor(1024 * x). score: the integer inner product; ties
    go to the smaller id. A query's own id is no candidate. Rows that are null in
    id or vector, or whose vectors are empty or hold null or non-finite components,
    take no part; vectors of different lengths are not compared. A query with fewer
    than k candidates gets all; with none, no row. Repeated queries count once, by
    the least of their vectors; repeated candidates each. Scores beyond a long's
    range end at its limits. Other columns are ignored.
    """
    spark = vectors.sparkSession

    def clean(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            ok = usable(b.column(1)) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(ok))

    def of(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(clean, "id long, v array<double>").withColumn("dim", F.size("v"))

    cand, query = of(vectors), of(queries).groupBy("id", "dim").agg(F.min("v").alias("v")).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("x")).select("id", "x.v", "x.dim")
    query = written(query, "topk-queries")
    floor2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.floor(x * 1024.0).cast("double") * F.floor(x * 1024.0).cast("double"))
    most = {r.dim: (r.m, r.n) for r in cand.groupBy("dim").agg(F.max(floor2).alias("m"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()}
    sample = cand.select(F.xxhash64("id").alias("h"), "id", "v").orderBy("h", "id", "v").limit(SAMPLE).collect()
    tables = {d: make_table(scaled(np.array([r.v for r in sample if len(r.v) == d], dtype=np.float64).reshape(-1, d)), *m) for d, m in most.items()}
    shared = spark.sparkContext.broadcast(tables)

    def table_of(dim: int) -> Table:
        return shared.value.get(dim) or Table(0.0, np.zeros((0, dim + 1)), np.zeros((1, dim + 1)))

    def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        lengths = np.diff(np.asarray(column.offsets))
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            yield int(d), at, scaled(matrix(column.take(pa.array(at))))

    def cells(column: pa.Array, asking: bool) -> np.ndarray:
        """The centre nearest to each vector."""
        out = np.zeros(len(column), dtype=np.int32)
        for d, at, x in by_length(column):
            t = table_of(d)
            out[at] = t.distances(t.lifted(x, asking), t.centres).argmin(axis=1)
        return out

    def dealt(asking: bool):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells(b.column(1), asking))], names=[*b.schema.names, "cell"])

        return lean(run)

    schema = "id long, v array<double>, dim int, cell int"
    left, right = cand.mapInArrow(dealt(False), schema), query.mapInArrow(dealt(True), schema)

    def extent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The box of each cell's places in a partition."""
        found: dict[tuple[int, int], list] = {}
        for b in rows:
            cell = b.column(3).to_numpy()
            for d, at, x in by_length(b.column(1)):
                t = table_of(d)
                p = t.places(t.lifted(x, False))
                for c in np.unique(cell[at]):
                    own = p[cell[at] == c]
                    lo, hi, n = own.min(axis=0), own.max(axis=0), len(own)
                    if (d, int(c)) in found:
                        lo0, hi0, n0 = found[d, int(c)]
                        lo, hi, n = np.minimum(lo, lo0), np.maximum(hi, hi0), n + n0
                    found[d, int(c)] = [lo, hi, n]
        for (d, c), (lo, hi, n) in found.items():
            m = len(lo) + 1
            yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * m, pa.int32()), "cell": pa.array([c] * m, pa.int32()), "axis": pa.array(range(-1, m - 1), pa.int32()), "lo": pa.array([0.0, *lo]), "hi": pa.array([0.0, *hi]), "n": pa.array([n] + [0] * (m - 1), pa.int64())})

    boxes: dict[int, dict[int, tuple]] = {}
    sized = left.mapInArrow(lean(extent), "dim int, cell int, axis int, lo double, hi double, n long").groupBy("dim", "cell", "axis").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    # lengths without a table have one cell and no axis
    for r in sized.orderBy("dim", "cell", "axis").collect():
        if r.axis < 0:
            boxes.setdefault(r.dim, {})[r.cell] = (max(1, -(-r.n // CANDIDATES)), [], [])
        else:
            boxes[r.dim][r.cell][1].append(r.lo)
            boxes[r.dim][r.cell][2].append(r.hi)
    blocks = [(d, c, n) for d, own in boxes.items() for c, (n, *_) in own.items()]
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    known = spark.sparkContext.broadcast({d: (np.array(list(own)), np.array([x[0] for x in own.values()]), np.array([x[1] for x in own.values()]).reshape(len(own), -1), np.array([x[2] for x in own.values()]).reshape(len(own), -1)) for d, own in boxes.items()})
    counted = F.broadcast(spark.createDataFrame(blocks, "dim int, cell int, blocks int"))
    left = left.join(counted, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")).drop("blocks")
    home = right.join(counted, ["dim", "cell"], "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.lit(-1))).drop("blocks").withColumn("kth", F.lit(None).cast("long"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            x, q, qids = scaled(matrix(left["v"])), scaled(matrix(right["v"])), right["id"].to_numpy()
            t = table_of(x.shape[1])
            kth = right["kth"].cast(pa.float64()).fill_null(-np.inf).to_numpy()
            kth = (q * q).sum(axis=1) + t.most - 2 * kth if len(t.pivots) else np.full(len(q), np.inf)
            found, _ = search(t, x, left["id"].to_numpy(), q, qids, kth, k)
            out = [(np.full(len(s), qid), c, s) for qid, (c, s) in zip(qids, found, strict=True)]
            trim()
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 3
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.int64())})

    def met(left: DataFrame, right: DataFrame, queries_of: DataFrame) -> DataFrame:
        """Blocks and the queries that go to them, at most QUERIES at once; queries_of: (dim, cell, asked) for each block of a cell."""
        groups = F.broadcast(queries_of.select("dim", "cell", F.ceil(F.col("asked") / QUERIES).cast("int").alias("groups")))
        spread = left.join(groups, ["dim", "cell"]).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
        asked = right.join(groups, ["dim", "cell"]).withColumn("g", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int")).drop("groups")
        key = ["dim", "cell", "block", "g"]
        return spread.select(*key, "id", "v").groupBy(*key).cogroup(asked.select(*key, "id", "v", "kth").groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score long")

    # the cells are as many as centres and lengths, both bounded
    first = written(met(left, home.where("block >= 0"), home.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("asked"))), "topk-first")
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") == k).select(F.col("query_id").alias("id"), "kth")
    limited = home.drop("kth").join(kth, "id", "left").select("id", "v", "dim", "cell", "block", "kth")

    def route(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the blocks of the cells that its k-th distance does not rule out, but for the block it has met."""
        for whole in rows:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                home_cell, home_block = b.column(3).to_numpy(), b.column(4).to_numpy()
                kth = b.column(5).cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                for d, at, q in by_length(b.column(1)):
                    if d not in known.value:
                        continue
                    cell, n, lo, hi = known.value[d]
                    t = table_of(d)
                    p = t.places(t.lifted(q, True))
                    out = np.maximum(0, np.maximum(lo[None] - p[:, None], p[:, None] - hi[None]))
                    limit = (q * q).sum(axis=1) + t.most - 2 * kth[at] if len(t.pivots) else np.full(len(q), np.inf)
                    limit = np.where(np.isfinite(limit), limit + t.slack * (2 * np.sqrt(np.maximum(limit, 0)) + t.slack), np.inf)
                    i, c = np.nonzero((out * out).sum(axis=2) <= limit[:, None])
                    many = n[c]
                    i, c = np.repeat(i, many), np.repeat(c, many)
                    block = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
                    new = (cell[c] != home_cell[at[i]]) | (block != home_block[at[i]])
                    i, c, block = at[i[new]], c[new], block[new]
                    pick = pa.array(i)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), b.column(2).take(pick), pa.array(cell[c], pa.int32()), pa.array(block, pa.int32()), b.column(5).take(pick)], names=["id", "v", "dim", "cell", "block", "kth"])

    routed = limited.mapInArrow(lean(route), "id long, v array<double>, dim int, cell int, block int, kth long")
    asked = routed.groupBy("dim", "cell", "block").agg(F.count(F.lit(1)).alias("asked")).groupBy("dim", "cell").agg(F.max("asked").alias("asked"))
    found = first.unionByName(met(left, routed, written(asked, "topk-asked")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
