"""N-gram Jaccard join: texts whose sets of word shingles overlap by 3/4 or more.

Size-aware heavy-light join. Sets a and b link when 7 |a & b| >= 3 (|a| + |b|),
which is a Jaccard similarity of at least 3/4.

Light sets (at most x shingles) enumerate, for every size t that a partner may
have, all their subsets of exactly the overlap that sizes (s, t) need. Two light
sets link if and only if they share such a subset, so nothing is left to verify.
Heavy sets go through inverted lists. Hash buckets first count in how many
texts each shingle occurs; shingles of one text can't be in any overlap, so a
set with too many of them is out at once. A set that stays scans the lists of
its rarest shingles, as many as a partner can't all miss. The lists name
candidates, whose overlap is then counted on the whole sets. Sets that are
light but may have a heavy partner take both ways. The boundary x is where the
counted subsets and list entries cost least, over the sizes found in the data.

A list of m sets is not expanded into m * m pairs: rounds compare its members
with one pivot each and join those that link; only members that still lie in
different components are compared pair by pair in the end, whatever their number,
so components are exact. Before two whole sets meet, their sketches do: a sketch
holds the parity of a set in each of SKETCH cells, so cells that differ are a lower
bound of the shingles in which the sets differ, and 7 times these can't exceed the
sum of the sizes of sets that link. Long lists compare sketches inside a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import SIZES, ask, batch_table, bucket_bits, bucket_bounds, cut_keys, join_keys, lean, meet, text_batch, unpack
from .components import connected_components
from ..store import forget, release, written
from .words import LOWER, Batch, factors, mix, short_hashes, windows

WORDS = 5
#: Cost of a list entry (count, candidate, verification) in subsets enumerated.
ENTRY_COST = 8
MOST_LIGHT = 24
#: Rounds with one pivot a list, at most, before members of different components are compared pair by pair.
PIVOT_ROUNDS = 3
#: Cells of a sketch.
SKETCH = 2048
#: Lists of more members compare sketches in tasks, each on two chunks of at most CHUNK.
SHORT_LIST, CHUNK = 16, 2048
#: Pairs with so many shingles in all (8 bytes each) meet as whole sets; more meet by their sketches first.
FEW_SHINGLES = 1 << 23
#: Bytes of text handled at once.
BATCH = 4 << 20


def needed(s: int, t: int) -> int:
    """Least overlap with which sets of sizes s and t link."""
    return -(-3 * (s + t) // 7)


def subset_shapes(n: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) for each partner size of a set of n."""
    ups = [(n, t, needed(n, t)) for t in range(n, 4 * n // 3 + 1)]
    downs = [(s, n, needed(s, n)) for s in range(-(-3 * n // 4), n)]
    return [x for x in ups + downs if x[2] <= x[0]]


def boundary(sizes: list[int]) -> int:
    """The largest light size x of least cost; sizes[n] is the number of sets of n shingles."""

    def cost(x: int) -> float:
        light = sum(c * sum(math.comb(n, k) for *_, k in subset_shapes(n)) for n, c in enumerate(sizes) if 0 < n <= x)
        return light + sum(ENTRY_COST * n * c for n, c in enumerate(sizes) if 4 * n >= 3 * (x + 1))

    return min(range(1, MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def subset_keys(shingles: np.ndarray) -> tuple[list[int], list[int]]:
    """Keys of all subsets of a light set (sorted, distinct hashes): as the smaller set of a pair, and as the larger.

    A key holds both sizes. Sets link if they share a key that one of them has as
    the smaller set; two that share one as the larger set need not.
    """
    n, out = len(shingles), ([], [])
    for s, t, k in subset_shapes(n):
        rows = np.array(list(combinations(range(n), k)), dtype=np.int64)
        tag = np.uint64((s << 32) + t)
        keys = mix((shingles[rows] * factors(k)).sum(axis=1, dtype=np.uint64) + mix(np.array([tag])))
        out[s < n].extend(keys.view(np.int64).tolist())
    return out


class _Sets:
    """The shingle sets of a batch: (key, text) pairs, sorted by key and then text, without repeats."""

    def __init__(self, payload: bytes) -> None:
        table = unpack(payload)
        self.ids = table["doc_id"]
        data, offsets = text_batch(table["text"])
        b = Batch(data.translate(LOWER), offsets)
        h = b.hashes()
        keys, at = windows(h, b.counts, WORDS)
        short, texts = short_hashes(h, b.first, b.counts, WORDS)
        keys, docs = np.concatenate((keys, short)), np.concatenate((b.doc[at], texts))
        order = np.argsort(docs, kind="stable")
        keys, docs = keys[order], docs[order]
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        self.n_docs = table.num_rows
        keys, self.docs = keys[new], docs[new]
        head = np.ones(len(keys), dtype=bool)
        head[1:] = keys[1:] != keys[:-1]
        self.sizes = np.bincount(self.docs, minlength=self.n_docs)
        # a text without an id takes part in nothing
        known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.at = np.cumsum(head) - 1
        self.keys = keys[head]
        self.known = known
        self.counts = np.bincount(self.at, weights=known[self.docs], minlength=len(self.keys)).astype(np.int64)


def _request(bits: int):
    def request(batch: int, payload: bytes) -> Iterator[pa.RecordBatch]:
        sets = _Sets(payload)
        buckets, bounds = bucket_bounds(sets.keys, bits)
        if not len(buckets):
            return
        counts = np.minimum(sets.counts, 65535).astype("<u2")
        cuts = list(zip(bounds[:-1], bounds[1:], strict=True))
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(buckets, pa.int32()),
                "batch": pa.array([batch] * len(buckets), pa.int64()),
                "keys": pa.array([cut_keys(sets.keys[a:b], bits // 8) for a, b in cuts], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in cuts], pa.binary()),
            }
        )

    return request


def _answer(bits: int):
    def answer(table: pa.Table) -> pa.Table:
        """For each hash of each batch: 0 if one text has it, else a rank that grows with the number of texts."""
        parts = [join_keys(x.as_py(), bits // 8) for x in table["keys"]]
        keys = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x.as_py(), dtype="<u2") for x in table["counts"]]).astype(np.int64)
        order = np.argsort(keys)
        sorted_keys = keys[order]
        head = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        total = np.add.reduceat(counts[order], head)
        rank = np.where(total < 2, 0, np.minimum(255, 1 + 8 * np.log2(np.maximum(total, 2) / 2))).astype(np.uint8)
        out = np.empty(len(keys), dtype=np.uint8)
        out[order] = np.repeat(rank, np.diff(np.append(head, len(keys))))
        cuts = np.cumsum([0, *map(len, parts)])
        return pa.table({"batch": table["batch"].cast(pa.int64()), "bucket": table["bucket"].cast(pa.int32()), "ranks": pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return answer


_SET_SCHEMA = "doc_id long, row long, n int, set_a long, set_b long, shared binary, rarest array<long>, sketch array<long>, subsets array<long>, supersets array<long>"


def _finish(bits: int, light: int):
    heavy_from = -(-3 * (light + 1) // 4)

    def finish(batch: int, payload: bytes, replies: pa.Table) -> pa.Table:
        sets = _Sets(payload)
        rank = np.zeros(len(sets.keys), dtype=np.uint8)
        buckets, bounds = bucket_bounds(sets.keys, bits)
        where = dict(zip(buckets.tolist(), bounds[:-1].tolist(), strict=True))
        for b, x in zip(replies["bucket"].to_pylist(), replies["ranks"], strict=True):
            got = np.frombuffer(x.as_py(), dtype=np.uint8)
            rank[where[b] : where[b] + len(got)] = got
        order = np.argsort(sets.docs, kind="stable")
        keys, rank = sets.keys[sets.at[order]], rank[sets.at[order]]
        ends = np.cumsum(sets.sizes)
        filled = np.flatnonzero(sets.sizes)
        fp = np.zeros((2, sets.n_docs), dtype=np.uint64)
        if len(filled):
            begins = (ends - sets.sizes)[filled]
            fp[0, filled] = np.add.reduceat(mix(keys), begins)
            fp[1, filled] = np.add.reduceat(mix(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)), begins)
        in_many = np.bincount(sets.docs[order], weights=rank > 0, minlength=sets.n_docs)
        shared, rarest, sketch, subsets, supersets = ([None] * sets.n_docs for _ in range(5))
        for d in filled[sets.known[filled]]:
            n, e = int(sets.sizes[d]), int(ends[d])
            own, own_rank = keys[e - n : e], rank[e - n : e]
            if n <= light:
                subsets[d], supersets[d] = subset_keys(own)
            least = -(-3 * n // 4)
            if in_many[d] < least:
                continue
            if n >= heavy_from:
                sketch[d] = _sketch(own)
            many = own_rank > 0
            own, own_rank = own[many], own_rank[many]
            shared[d] = own.astype("<u8").tobytes()
            if n >= heavy_from:
                rarest[d] = own[np.lexsort((own, own_rank))[: max(0, len(own) - least + 1)]].view(np.int64).tolist()
        return pa.table(
            {
                "doc_id": sets.ids.cast(pa.int64()),
                "row": pa.array((batch << 20) + np.arange(sets.n_docs)),
                "n": pa.array(sets.sizes, pa.int32()),
                "set_a": pa.array(fp[0].view(np.int64)),
                "set_b": pa.array(fp[1].view(np.int64)),
                "shared": pa.array(shared, pa.binary()),
                "rarest": pa.array(rarest, pa.list_(pa.int64())),
                "sketch": pa.array(sketch, pa.list_(pa.int64())),
                "subsets": pa.array(subsets, pa.list_(pa.int64())),
                "supersets": pa.array(supersets, pa.list_(pa.int64())),
            }
        )

    return finish


def _sketch(shingles: np.ndarray) -> list[int]:
    cells = (mix(shingles ^ np.uint64(0x3C6EF372FE94F82B)) % np.uint64(SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=SKETCH) & 1).astype(bool)).view("<i8").tolist()


def _long_list(table: pa.Table) -> pa.Table:
    """The pairs of a list, or of two chunks of it, in different components, whose sizes and sketches allow a link."""
    rep, row, n, comp, own = (table[c].to_numpy() for c in ("rep", "row", "n", "comp", "own"))
    sketch = pa.concat_arrays(table["sketch"].chunks).flatten().to_numpy(zero_copy_only=False).reshape(len(rep), -1)
    split = table["lo"][0].as_py() != table["hi"][0].as_py()
    order = np.argsort(n, kind="stable")
    rep, row, n, comp, own, sketch = rep[order], row[order], n[order], comp[order], own[order], sketch[order].view(np.uint64)
    left, right = [], []
    for i in range(len(rep) - 1):
        j = np.arange(i + 1, np.searchsorted(n, 4 * int(n[i]) // 3, side="right"))
        j = j[(comp[j] != comp[i]) & (own[j] != own[i] if split else True)]
        if len(j):
            differ = np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            j = j[7 * differ <= n[j].astype(np.int64) + int(n[i])]
            left.append(np.full(len(j), i))
            right.append(j)
    i, j = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
    swap = rep[i] > rep[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    return pa.table({"a": pa.array(rep[i], pa.int64()), "b": pa.array(rep[j], pa.int64()), "ra": pa.array(row[i], pa.int64()), "rb": pa.array(row[j], pa.int64()), "na": pa.array(n[i], pa.int32()), "nb": pa.array(n[j], pa.int32())})


def _linked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b) whose sets overlap enough; equal neighbouring sets are decoded once."""
    for part in rows:
        a, b, na, nb = (part.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        keep = np.zeros(len(a), dtype=bool)
        for i, (x, y) in enumerate(zip(part.column(4), part.column(5), strict=True)):
            x, y = (np.frombuffer(z.as_buffer(), dtype="<u8") for z in (x, y))
            both = np.concatenate((x, y))
            both.sort()
            keep[i] = 7 * int((both[1:] == both[:-1]).sum()) >= 3 * (int(na[i]) + int(nb[i]))
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pairs (a, b, ra, rb, na, nb) of sets, by id and row, -> those that link, as (a, b), and the written table they come from."""

    def side(end: str, column: str) -> DataFrame:
        return sets.select(F.col("row").alias(f"r{end}"), F.col(column).alias(f"{column}_{end}"))

    near = pairs = written(pairs, "ngram-pairs")
    if (pairs.agg(F.sum(F.col("na").cast("long") + F.col("nb"))).first()[0] or 0) > FEW_SHINGLES:
        differ = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        near = pairs.join(side("a", "sketch"), "ra").join(side("b", "sketch"), "rb").where(7 * differ <= F.col("na") + F.col("nb")).select("a", "b", "ra", "rb", "na", "nb")
    links = near.join(side("a", "shared"), "ra").join(side("b", "shared"), "rb").select("a", "b", "na", "nb", "shared_a", "shared_b")
    return links.mapInArrow(lean(_linked), "a long, b long"), pairs


def _candidates(lists: DataFrame, pivots: DataFrame, which: str = "rep <> p.rep") -> DataFrame:
    """Each member of a list with the list's pivots, where both sizes and components allow a new link."""
    return (
        lists.join(pivots, "key")
        .where(f"{which} and comp <> p.comp and 4 * least(n, p.n) >= 3 * greatest(n, p.n)")
        .selectExpr("least(rep, p.rep) a", "greatest(rep, p.rep) b", "if(rep < p.rep, row, p.row) ra", "if(rep < p.rep, p.row, row) rb", "if(rep < p.rep, n, p.n) na", "if(rep < p.rep, p.n, n) nb")
        .distinct()
    )


def _open_keys(lists: DataFrame, turn: int) -> DataFrame:
    """A row for each key whose members lie in different components: (key, m members, s, the sum of squares of members by component, its pivot p).

    Members are counted by component first, so a hot list is no single task. The result is a written table: its
    size is known before lists are moved, and adaptive execution can split a hot list that is joined with it.
    """
    by = "struct(rep, row)" if turn == 0 else f"struct(xxhash64(rep, {turn}), rep, row)"
    parts = lists.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.expr(f"min(struct({by} by, struct(rep, row, n, comp) p)) least"))
    keys = parts.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.expr("min(least).p p"))
    return written(keys.where("lo <> hi").select("key", "m", "s", "p"), "ngram-keys")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (doc_id, n_shingles, component_id).

    Words are runs of bytes other than white space, A-Z in lower case. The set of
    a text: its distinct 5-word shingles; the whole sequence if it has fewer words;
    empty, and linked with nothing, if it is null or has no word. Component: the
    least id reachable over links, itself included. Rows of a null id are returned
    with their size and a null component, and link with nothing. Repeated rows are
    returned as often as given. Other columns are ignored. An empty table gives an
    empty result. Sets are compared by 64-bit hashes of their shingles.
    """
    batches = batch_table(docs, id_col, text_col, "ngram-batches", BATCH)
    n_words = batches.agg(F.sum("n_words")).first()[0] or 0
    words = dict(batches.select(F.posexplode("sizes").alias("k", "c")).groupBy("k").agg(F.sum("c")).collect())
    sizes = [0] * (SIZES - WORDS + 1)
    for k, c in words.items():
        sizes[min(max(1, k - WORDS + 1) if k else 0, SIZES - WORDS)] += c
    light, bits = boundary(sizes), bucket_bits(n_words)

    replies = written(ask(batches, _request(bits), _answer(bits), "keys binary, counts binary", "ranks binary"), "ngram-replies")
    # the questions are larger than the texts, and not needed any more
    release(docs.sparkSession)
    all_sets = written(meet(batches, replies, _finish(bits, light), _SET_SCHEMA), "ngram-sets")
    forget(batches, replies)
    del replies, batches
    release(docs.sparkSession)

    # copies of a set become one representative; row numbers tell repeated rows apart
    live = all_sets.where("doc_id is not null and (shared is not null or subsets is not null)")
    ids = live.select("doc_id", "row", "set_a", "set_b", "n")
    classes = ids.groupBy("set_a", "set_b", "n").agg(F.min(F.struct("doc_id", "row")).alias("rep"))
    owners = written(ids.join(classes, ["set_a", "set_b", "n"]).select("doc_id", F.col("rep.doc_id").alias("rep"), F.col("rep.row").alias("rep_row"), "row"), "ngram-owners")
    one = owners.where("row = rep_row").select("row")
    sets = written(live.join(one, "row", "left_semi").select(F.col("doc_id").alias("rep"), "row", "n", "shared", "rarest", "sketch", "subsets", "supersets"), "ngram-reps")
    owners = owners.where("doc_id <> rep").select("doc_id", "rep").distinct()
    sizes = written(all_sets.select("doc_id", "n"), "ngram-sizes")
    forget(all_sets)
    del all_sets, live, ids, classes, one
    release(docs.sparkSession)

    # light sets: those that have a key as the smaller set link with all that have it
    smaller = sets.where("subsets is not null").select(F.explode("subsets").alias("key"), "rep")
    larger = sets.where("supersets is not null").select(F.explode("supersets").alias("key"), "rep")
    first = smaller.groupBy("key").agg(F.min("rep").alias("a"))
    light_edges = smaller.unionAll(larger).join(first, "key").where("rep <> a").select("a", F.col("rep").alias("b"))

    # heavy sets: inverted lists of their rarest shared shingles
    heavy = sets.where("rarest is not null").select("row", "shared", "sketch")
    found = connected_components(light_edges, "ngram-components")
    members = written(_in_components(sets.where("rarest is not null").select("rep", "row", "n", "rarest"), found), "ngram-members")
    lists = members.select(F.explode("rarest").alias("key"), "rep", "row", "n", "comp")
    several = written(lists.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key"), "ngram-open")
    lists = written(lists.join(several, "key", "left_semi"), "ngram-lists")
    forget(members, several)
    for turn in range(PIVOT_ROUNDS + 1):
        keys = _open_keys(lists, turn)
        entries, pairs = keys.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum((F.col("m") * F.col("m") - F.col("s")) / 2), F.lit(0))).first()
        if not entries or pairs <= 2 * entries or turn == PIVOT_ROUNDS:
            break
        links, met = _verified(_candidates(lists, keys.select("key", "p")), heavy)
        then = connected_components(_star(found).unionByName(links), "ngram-components")
        del links
        # lists that are closed by now can't be open later
        still = written(_in_components(lists.join(keys, "key", "left_semi").drop("comp"), then), "ngram-lists")
        forget(lists, keys, met)
        lists, found = still, then
        release(docs.sparkSession)
    lengths = keys.select("key", "m")
    short = lists.join(lengths.where(F.col("m") <= SHORT_LIST).select("key"), "key", "left_semi")
    pairs = _candidates(short, short.select("key", F.struct("rep", "row", "n", "comp").alias("p")), "rep < p.rep")
    long = lists.join(lengths.where(F.col("m") > SHORT_LIST), "key").withColumn("chunks", F.ceil(F.col("m") / CHUNK).cast("int"))
    long = long.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    long = long.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "row", "n", "comp").join(heavy.select("row", "sketch"), "row")
    pairs = pairs.unionByName(long.groupBy("key", "lo", "hi").applyInArrow(_long_list, "a long, b long, ra long, rb long, na int, nb int")).distinct()
    links, met = _verified(pairs, heavy)

    # a document that is a copy hangs on its representative
    copies = owners.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comps = connected_components(_star(found).unionByName(links).unionByName(copies), "ngram-components")
    forget(sets, lists, keys, met)
    return (
        sizes.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
        .join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    )


def _in_components(members: DataFrame, components: DataFrame) -> DataFrame:
    """members (rep, ...) with the component of each."""
    return members.join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("root", "rep")).drop("root")


def _star(components: DataFrame) -> DataFrame:
    """What is known of components, as edges."""
    return components.select(F.col("root").alias("a"), F.col("node").alias("b"))
