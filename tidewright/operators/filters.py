"""Row filters. Plain predicates, so Catalyst pushes what it can down to the scan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank


def require_columns(df: DataFrame, columns: list[str], what: str = "table") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} has no column {', '.join(missing)}")


def row_filters(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Rows equal to every given value; null equals null. A missing column is an error before anything is read."""
    require_columns(df, list(filters))
    return df.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in filters.items()], F.lit(True)))


def within_duration(samples: Column, rate: Column | int, least: float, most: float) -> Column:
    """Whether an array lasts longer than least and shorter than most seconds, by its number of samples."""
    rate = F.lit(rate) if isinstance(rate, int) else rate
    return (F.size(samples) > rate * least) & (F.size(samples) < rate * most)


def has_text(text: Column) -> Column:
    return ~is_blank(text)


def not_rejected(df: DataFrame, column: str = "validated") -> DataFrame:
    """Without rows whose validation says "rejected"; null is kept, and all rows where there is no such column."""
    return df.where(F.coalesce(F.col(column) != "rejected", F.lit(True))) if column in df.columns else df


def has_targets(labels: Column, input_length: Column) -> Column:
    """Whether there are labels and an input of positive length."""
    return F.coalesce((F.size(labels) > 0) & (input_length > 0), F.lit(False))


def below_rate(rate: Column, most: float) -> Column:
    return F.coalesce(rate < most, F.lit(False))


def examples(df: DataFrame, samples: str, rate: Column | int, text: str, least: float, most: float) -> DataFrame:
    """The usable rows: duration, text and validation."""
    return not_rejected(df.where(within_duration(F.col(samples), rate, least, most) & has_text(F.col(text))))


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows are gone."""
    a, b = before.agg(F.count(F.lit(1)).alias("before")), after.agg(F.count(F.lit(1)).alias("after"))
    return a.join(F.broadcast(b)).select((F.col("before") - F.col("after")).alias("removed"))
