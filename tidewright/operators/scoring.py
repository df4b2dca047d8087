"""Scores over combinations of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import written


def pruned_cube(df: DataFrame, categories: Sequence[str], aggregates: dict[str, Column], count: str = "n") -> DataFrame:
    """A row for each combination of category values, or "any" (null), that says something.

    Specified categories filter one after the other, from left to right. A
    combination stays if each of its filters leaves some rows, but fewer than
    before: a value that the filters to its left imply adds nothing and is
    dropped. Rows whose value in a category is null count in "any" only. One
    grouping-sets aggregation gives all counts, which are written: each combination
    then meets those of its prefixes by key.
    """
    k = len(categories)
    names = [f"cat_{i}" for i in range(k)]
    cube = df.select("*", *[F.col(f"`{c}`").alias(x) for c, x in zip(categories, names, strict=True)]).cube(*names).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias(count), *[v.alias(a) for a, v in aggregates.items()])
    bit = [1 << (k - 1 - i) for i in range(k)]  # set where the category is "any"
    # small, and read once for each prefix
    cube = written(cube.where(_and([(F.col("gid").bitwiseAND(F.lit(b)) != 0) | F.col(x).isNotNull() for b, x in zip(bit, names, strict=True)])), "score-cube")
    out = cube
    for i in range(k):
        # the combination without the categories from i on, and with those up to i
        for what, upto in (("before", i), ("after", i + 1)):
            mask = sum(bit[upto:])
            prefix = cube.where(F.col("gid").bitwiseAND(F.lit(mask)) == mask).select(F.col("gid").alias("pgid"), *[F.col(x).alias(f"p_{x}") for x in names[:upto]], F.col(count).alias(f"{what}_{i}"))
            same = [F.col("gid").bitwiseOR(F.lit(mask)) == F.col("pgid"), *[F.col(x).eqNullSafe(F.col(f"p_{x}")) for x in names[:upto]]]
            out = out.join(prefix, _and(same), "left").drop("pgid", *[f"p_{x}" for x in names[:upto]])
        any_ = F.col("gid").bitwiseAND(F.lit(bit[i])) != 0
        out = out.where(any_ | ((F.col(f"after_{i}") > 0) & (F.col(f"after_{i}") < F.col(f"before_{i}")))).drop(f"before_{i}", f"after_{i}")
    return out.select(*[F.col(x).alias(c) for c, x in zip(categories, names, strict=True)], count, *aggregates)


def _and(conditions: Sequence[Column]) -> Column:
    out = conditions[0] if conditions else F.lit(True)
    for c in conditions[1:]:
        out = out & c
    return out
