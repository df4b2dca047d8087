"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. Within a source a document's expected
number of copies grows with its weight, a whole number; the level that makes the
expected words meet the target is found from sums by weight. The whole part of an
expectation is taken for certain. For the rest, documents are ranked by random odds
divided by the odds of their inclusion, and the first of them are taken, as far as
their words fit into what is left of the target; the WINDOW documents after that are
gone through once more, and what still fits is taken. In the end one more is taken
if that makes the gap smaller. The random numbers are keyed hashes of id and text,
so reruns agree.

Rows of one source, id and text are copies of one document: they rank as one, with
a multiplicity, and any number of them may be taken.

The cut in a source's ranking is found by sums over two levels of bins of the rank,
so that no source is ever sorted in one task. What a source has decided is one row:
its level, its bins, and the few documents around the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import col, forget, free_name, written

WORD = r"[^\x20\x09-\x0D]+"
MOST_COPIES = 3
BINS = 4096
#: Documents after the cut that may still fill the gap.
WINDOW = 64
#: Weights are whole numbers from 1 to this.
MOST_WEIGHT = 4096


def source_targets(per: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = MOST_COPIES) -> DataFrame:
    """(source, source_size), a row for each source -> with sid and target.

    Sources in the order of code points, null last, weigh ``weights``, repeated.
    Targets add up to all sizes; one stops at cap times its source's size and the
    excess goes to the others by weight. The level at which that ends is found
    from sums over the sources in the order in which they stop. This works on one
    row for each source, the size of a list of sources.
    """
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("most", F.col("source_size") * float(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = per.select(
        "*",
        F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("stopped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        F.sum("source_size").over(whole).alias("all"),
    ).withColumn("level", (F.col("all") - F.col("stopped")) / F.col("open"))
    # the first source, in that order, that does not stop below its level
    found = F.first(F.when(F.expr("level <= most / weight"), F.col("level")), ignorenulls=True).over(whole)
    return level.withColumn("level", found).select("sid", "source", "source_size", F.least("most", F.col("weight") * F.coalesce("level", F.lit(0.0))).alias("target"))


def size_weight(size: Column) -> Column:
    """The weight that the query gives a document: the binary digits of its number of words."""
    return F.length(F.bin(size)).cast("int")


def _facts(text: Column, doc_id: Column, key: str) -> dict[str, Column]:
    """What the mix needs of a row: words, a hash of the text, and a number in (0, 1) from a keyed hash, 52 bits of an MD5."""
    digest = F.coalesce(F.md5(text.cast("binary")), F.lit("0" * 32))
    keyed = F.md5(F.concat_ws("\u0001", F.lit(key), F.coalesce(doc_id.cast("string"), F.lit("-")), digest).cast("binary"))
    return {
        "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "hash": F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"),
        "u": (F.conv(F.substring(keyed, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52),
    }


def _rank(expected: Column, u: Column) -> tuple[Column, Column, Column]:
    """(copies for certain, rank: random odds / inclusion odds or null, bin of the rank, which grows with it)."""
    part = expected - F.floor(expected)
    q = F.when(part > 0, (u / (1 - u)) * ((1 - part) / part))
    return F.floor(expected).cast("long"), q, F.least(F.floor(q / (1 + q) * (BINS * BINS)), F.lit(BINS * BINS - 1)).cast("long")


def _plan(rows: DataFrame) -> DataFrame:
    """rows (source, size, w, ...) -> a row for each source: (sid, source, source_size, target, level, rest).

    Expected copies are min(MOST_COPIES, level * w); rest: what of the target the
    certain copies leave. Works on one row for each source and weight.
    """
    classes = written(rows.groupBy("source", "w").agg(F.sum("size").alias("words")), "mix-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")))
    t = targets.withColumnRenamed("source", "source_")
    c = classes.join(t, classes.source.eqNullSafe(t.source_)).drop("source_")
    # heavy weights reach the limit of copies first
    heavy = Window.partitionBy("sid").orderBy(F.desc("w"))
    c = c.select("*", F.coalesce(F.sum("words").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full"), F.sum(F.col("words") * F.col("w")).over(heavy.rowsBetween(0, Window.unboundedFollowing)).alias("mass"))
    level = F.when(F.col("mass") > 0, (F.col("target") - MOST_COPIES * F.col("full")) / F.col("mass"))
    c = c.withColumn("level", level).withColumn("fits", F.coalesce(F.col("level") * F.col("w") <= MOST_COPIES, F.lit(False)))
    # the heaviest weight that the level does not lift over the limit; none if all are taken as often as may be
    found = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(heavy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    c = c.withColumn("level", F.coalesce(found, F.when(F.col("target") > 0, float(MOST_COPIES)).otherwise(0.0)))
    sure = F.sum(F.floor(F.least(F.lit(float(MOST_COPIES)), F.col("level") * F.col("w"))) * F.col("words"))
    return c.groupBy("sid", "source", "source_size", "target", "level").agg((F.col("target") - sure).alias("rest"))


def _cut(bins: DataFrame, left: DataFrame, b: str) -> DataFrame:
    """bins (sid, b, words, docs), left (sid, rest) -> (sid, rest, lo, hi).

    lo: the bin in which the source's running sum exceeds rest, hi: the one that
    holds the WINDOW-th document after that bin; rest: what is left of it at lo. A
    source whose sum never exceeds rest has no row.
    """
    order = Window.partitionBy("sid").orderBy(b).rowsBetween(Window.unboundedPreceding, 0)
    run = bins.join(left, "sid").select("*", F.sum("words").over(order).alias("upto"), F.sum("docs").over(order).alias("place"))
    lo = F.min(F.when(F.col("upto") > F.col("rest"), F.struct(b, "place", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")))).over(Window.partitionBy("sid"))
    run = run.withColumn("lo", lo).where("lo is not null")
    enough = F.min(F.when(F.col("place") - F.col("lo.place") >= WINDOW, F.col(b)))
    return run.groupBy("sid", "lo").agg(F.coalesce(enough, F.max(b)).alias("hi")).select("sid", F.col("lo.rest").alias("rest"), F.col(f"lo.{b}").alias("lo"), "hi")


def _decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """plan with what is cut where: (..., lo, entries), the entries (q, doc_id, size, hash, many, k) of the documents that are taken from bin lo on."""
    p = plan.select(F.col("source").alias("source_"), "sid", "level")
    whole, q, bin_ = _rank(F.least(F.lit(float(MOST_COPIES)), F.col("level") * F.col("w")), F.col("u"))
    ranked = rows.join(p, rows.source.eqNullSafe(p.source_)).select("sid", "doc_id", "size", "hash", q.alias("q"), bin_.alias("bin")).where("q is not null")
    ranked = written(ranked, "mix-ranked")
    sums = [F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")]
    coarse = F.floor(F.col("bin") / BINS).cast("long")
    cut0 = written(_cut(ranked.groupBy("sid", coarse.alias("b")).agg(*sums), plan.select("sid", "rest"), "b"), "mix-cut")
    near = ranked.join(cut0.select("sid", "lo", "hi"), "sid").where(coarse.between(F.col("lo"), F.col("hi")))
    cut1 = written(_cut(near.groupBy("sid", "bin").agg(*sums), cut0.select("sid", "rest"), "bin"), "mix-cut")
    # the last two bins of both levels, a document with all its copies in a row
    few = ranked.join(cut1.select("sid", "rest", "lo", "hi"), "sid").where("bin between lo and hi").groupBy("sid", "rest", "lo", "q", "doc_id", "size", "hash").agg(F.count(F.lit(1)).alias("many"))
    order = Window.partitionBy("sid").orderBy("q", "doc_id", "size", "hash")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    few = few.select("*", F.row_number().over(order).alias("n"), F.sum(F.col("many") * F.col("size")).over(upto).alias("upto"), (F.sum("many").over(upto) - F.col("many")).alias("place"))
    stop = F.min(F.when(F.col("upto") > F.col("rest"), F.struct("n", "place"))).over(Window.partitionBy("sid"))
    few = few.withColumn("at", stop).where(F.col("place") < F.col("at.place") + WINDOW).withColumn("stop", F.col("at.n"))
    entry = F.struct("n", "q", "doc_id", "size", "hash", "many")
    one = few.groupBy("sid", "lo", "stop").agg(
        (F.first("rest") - F.coalesce(F.sum(F.when(F.col("n") < F.col("stop"), F.col("many") * F.col("size"))), F.lit(0))).alias("gap"),
        F.array_sort(F.collect_list(F.when(F.col("n") < F.col("stop"), entry))).alias("before"),
        F.array_sort(F.collect_list(F.when(F.col("n") >= F.col("stop"), entry))).alias("after"),
    )
    # once through the window, taking of each document what fits
    fits = lambda gap, e: F.when(e["size"] > 0, F.least(e["many"], F.greatest(F.floor(gap / e["size"]), F.lit(0)).cast("long"))).otherwise(e["many"])
    start = F.struct(F.col("gap").alias("gap"), F.array().cast("array<bigint>").alias("ks"))
    one = one.withColumn("f", F.aggregate("after", start, lambda acc, e: F.struct((acc["gap"] - fits(acc["gap"], e) * e["size"]).alias("gap"), F.array_append(acc["ks"], fits(acc["gap"], e)).alias("ks"))))
    # one more of the document that leaves the least gap, if that is less than the gap that is
    left = F.zip_with("after", F.col("f.ks"), lambda e, k: F.when(k < e["many"], F.struct(F.abs(F.col("f.gap") - e["size"]).alias("d"), e["n"].alias("n"))))
    best = F.array_min(F.filter(left, lambda x: x.isNotNull() & (x["d"] < F.col("f.gap"))))
    one = one.withColumn("best", best["n"])
    taken = F.zip_with("after", F.col("f.ks"), lambda e, k: _entry(e, k + F.when(e["n"].eqNullSafe(F.col("best")), 1).otherwise(0)))
    entries = F.filter(F.concat(F.transform("before", lambda e: _entry(e, e["many"])), taken), lambda e: e["k"] > 0)
    out = written(plan.join(one.select("sid", "lo", entries.alias("entries")), "sid", "left").drop("sid", "rest"), "mix-decided")
    forget(ranked, cut0, cut1)
    return out


def _entry(e: Column, k: Column) -> Column:
    return F.struct(e["q"].alias("q"), e["doc_id"].alias("doc_id"), e["size"].alias("size"), e["hash"].alias("hash"), e["many"].alias("many"), k.cast("long").alias("k"))


def _copies(rows: DataFrame, decided: DataFrame, names: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """rows, of whose columns ``names`` tells those of ``_facts``, with source_size, target and copies, under the names that are returned."""
    at = {k: col(v) for k, v in names.items()}
    used, new = rows.columns, {}
    for x in ("source", "source_size", "target", "level", "lo", "entries", "whole", "bin", "q", "extra", "k", "row", "part", "group", "before"):
        new[x] = free_name(f"mix_{x}", [*used, *new.values()])
    made = {k: col(v) for k, v in new.items()}
    d = decided.select(*[col(x).alias(new[x]) for x in ("source", "source_size", "target", "level", "lo", "entries")])
    whole, q, bin_ = _rank(F.least(F.lit(float(MOST_COPIES)), made["level"] * at["w"]), at["u"])
    out = rows.join(d, at["source"].eqNullSafe(made["source"])).withColumn(new["q"], q).withColumn(new["bin"], bin_).withColumn(new["whole"], whole)
    same = lambda e: (e["q"] == made["q"]) & e["doc_id"].eqNullSafe(at["doc_id"]) & (e["size"] == at["size"]) & (e["hash"] == at["hash"])
    found = F.get(F.filter(made["entries"], same), F.lit(0))
    out = out.withColumn(new["k"], F.when(made["bin"] >= made["lo"], F.when(found["k"] < found["many"], found["k"])))
    taken = F.when(made["q"].isNull(), 0).when(made["lo"].isNull() | (made["bin"] < made["lo"]) | found.isNotNull(), 1).otherwise(0)
    out = out.withColumn(new["extra"], taken)
    if decided.where(F.exists("entries", lambda e: e["k"] < e["many"])).limit(1).count():
        # copies are alike, so it only counts how many of them are taken: those of the first rows of a written table, counted over its parts
        partial = written(out.where(made["k"].isNotNull()).withColumn(new["row"], F.monotonically_increasing_id()), "mix-partial")
        group = F.xxhash64(*[F.coalesce(at[x].cast("string"), F.lit("\u0000")) for x in ("doc_id", "source", "size", "hash")])
        partial = partial.withColumn(new["part"], F.shiftright(made["row"], 33)).withColumn(new["group"], group)
        parts = partial.groupBy(new["group"], new["part"]).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(new["group"]).orderBy(new["part"]).rowsBetween(Window.unboundedPreceding, 0)
        parts = parts.select(new["group"], new["part"], (F.sum("n").over(upto) - F.col("n")).alias(new["before"]))
        place = F.row_number().over(Window.partitionBy(new["group"], new["part"]).orderBy(new["row"]))
        partial = partial.withColumn(new["row"], place).join(parts, [new["group"], new["part"]]).withColumn(new["extra"], (made["row"] + made["before"] <= made["k"]).cast("int"))
        out = out.where(made["k"].isNull()).unionByName(partial.select(*[col(c) for c in out.columns]))
    out = out.select(*[col(c) for c in used], made["source_size"], made["target"], (made["whole"] + made["extra"]).cast("long").alias(new["k"]))
    return out, {"source_size": new["source_size"], "target": new["target"], "copies": new["k"]}


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key: str = "mix", weight: str | None = "size") -> DataFrame:
    """One row per row of docs: (doc_id, source, size, source_size, target, copies, taken).

    size: words of the text, 0 for null. copies: how often the mix takes the
    document; taken: copies * size. Within a source a document's expected copies
    are in proportion to its weight, at most MOST_COPIES: by default the binary
    digits of its size, with ``weight`` a column (rounded to whole numbers from 1 to
    MOST_WEIGHT; null counts as 1), with None the same for all. A source's taken
    words come as near to its target as the WINDOW documents after the cut allow.
    Rows of a null or repeated id are documents like others; rows of one id and text are
    copies, of which any number may be taken. Other columns are ignored. An empty
    table gives an empty result.
    """
    facts = _facts(col(text_col).cast("string"), col(id_col), key)
    w = F.lit(1) if weight is None else size_weight(F.col("size")) if weight == "size" else F.col("w")
    w = F.greatest(F.lit(1), F.least(F.lit(MOST_WEIGHT), F.coalesce(F.round(w).cast("int"), F.lit(1))))
    given = col(weight).cast("double") if weight not in (None, "size") else F.lit(1)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(source_col).cast("string").alias("source"), given.alias("w"), *[c.alias(n) for n, c in facts.items()]).withColumn("w", w)
    rows = written(rows, "mix-rows")
    out, made = _copies(rows, _decided(rows, written(_plan(rows), "mix-plan")), {x: x for x in ("doc_id", "source", "w", "size", "hash", "u")})
    copies = F.col(made["copies"])
    return out.select("doc_id", "source", "size", F.col(made["source_size"]).alias("source_size"), F.col(made["target"]).alias("target"), copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key: str = "mix") -> DataFrame:
    """docs, each row as often as ``pareto_mix`` takes it; all columns, of whatever names, are kept as they are.

    The texts are not moved: what each source has decided meets them in one join.
    """
    facts = _facts(col(text_col).cast("string"), col(id_col), key)
    names = {}
    for x in (*facts, "w", "source", "doc_id", "copies"):
        names[x] = free_name(f"mixed_{x}", [*docs.columns, *names.values()])
    rows = docs.select("*", col(id_col).cast("long").alias(names["doc_id"]), col(source_col).cast("string").alias(names["source"]), *[c.alias(names[n]) for n, c in facts.items()])
    rows = rows.withColumn(names["w"], size_weight(col(names["size"])))
    own = ("doc_id", "source", "w", "size", "hash", "u")
    narrow = written(rows.select(*[col(names[x]).alias(x) for x in own]), "mix-rows")
    decided = _decided(narrow, written(_plan(narrow), "mix-plan"))
    forget(narrow)
    out, made = _copies(rows, decided, {x: names[x] for x in own})
    copies = F.col(made["copies"])
    return out.withColumn(names["copies"], F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies)))).select(*[col(c) for c in docs.columns])
