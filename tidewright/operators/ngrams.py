"""Sentence corpora for language models: n-gram counts, vocabulary, decontamination."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import contains_join


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def ngram_counts(df: DataFrame, text: str, order: int, thresholds: Sequence[int] = (0, 1), marks: bool = False) -> DataFrame:
    """(n, ngram, count) of orders 1 to ``order``, without those counted no more often than their order's threshold.

    The last threshold holds for all further orders. With marks, sentences begin
    with <s> and end with </s>. The words of a text lie beside themselves, moved by
    one, by two and so on, so that each place gives a row of words by built-in
    functions alone.
    """
    tokens = words(F.col(text))
    if marks:
        tokens = F.concat(F.array(F.lit("<s>")), tokens, F.array(F.lit("</s>")))
    names = [f"w{i}" for i in range(order)]
    beside = F.arrays_zip(*[(F.col("w") if i == 0 else F.slice("w", i + 1, F.size("w"))).alias(x) for i, x in enumerate(names)])
    rows = df.select(tokens.alias("w")).where("size(w) > 0").select(F.inline(beside))
    each = F.array(*[F.struct(F.lit(n).alias("n"), F.when(F.col(names[n - 1]).isNotNull(), F.concat_ws(" ", *names[:n])).alias("ngram")) for n in range(1, order + 1)])
    counted = rows.select(F.inline(each)).where("ngram is not null").groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("count"))
    limit = F.element_at(F.array(*map(F.lit, thresholds)), F.least(F.col("n"), F.lit(len(thresholds))))
    return counted.where(F.col("count") > limit)


def distinct_sentences(df: DataFrame, text: str) -> DataFrame:
    return df.select(text).distinct()


def vocabulary(df: DataFrame, text: str, extra: Sequence[str] = ("|",)) -> DataFrame:
    """(char, id): the distinct characters and the extra ones, in the order of code points."""
    chars = df.select(F.explode(F.split(F.col(text), "")).alias("char")).where("char <> ''").distinct()
    more = df.sparkSession.createDataFrame([(x,) for x in extra], "char string")
    # one row for each character: the order needs one task, and has few rows
    return chars.union(more).distinct().select("char", (F.row_number().over(Window.orderBy("char")) - 1).cast("bigint").alias("id"))


def extend_vocabulary(known: DataFrame, keep: DataFrame, char: str = "char") -> DataFrame:
    """Characters of keep (char, place) that are not known, once each, in the order of their places, with ids after the last."""
    new = keep.join(known.select(char), char, "left_anti").groupBy(char).agg(F.min("place").alias("place"))
    last = known.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("last"))
    return new.join(F.broadcast(last)).select(char, (F.col("last") + F.row_number().over(Window.orderBy("place"))).alias("id"))


def decontaminate(texts: DataFrame, phrases: DataFrame, text_id: str, text: str, phrase: str) -> DataFrame:
    """(text_id, text, changed): texts without the phrases that they contain; emptied ones are gone.

    Longer phrases go first, then by code point; the empty phrase counts for nothing.
    White space that a removal leaves doubled becomes one space. Rows of a null or
    repeated id are told apart by their texts. Null texts go.
    """
    own = texts.select(F.col(text_id).alias("id_"), F.col(text).alias("text_")).withColumn("hash_", F.md5(F.col("text_").cast("binary")))
    seen = phrases.select(F.col(phrase).alias("phrase_")).where("phrase_ <> ''").distinct()
    met = contains_join(own, seen, "text_", "phrase_").groupBy(F.col("id_").alias("met_id_"), F.col("hash_").alias("met_hash_")).agg(F.array_sort(F.collect_set("phrase_")).alias("found_"))
    ordered = F.transform(F.array_sort(F.transform("found_", lambda p: F.struct((-F.length(p)).alias("l"), p.alias("p")))), lambda x: x["p"])
    without = F.trim(F.regexp_replace(F.aggregate(ordered, F.col("text_"), lambda s, p: F.replace(s, p, F.lit(""))), " +", " "))
    same = F.col("id_").eqNullSafe(F.col("met_id_")) & (F.col("hash_") == F.col("met_hash_"))
    out = own.join(met, same, "left").select("id_", F.when(F.col("found_").isNull(), F.col("text_")).otherwise(without).alias("text_"), F.col("found_").isNotNull().alias("changed"))
    return out.where("text_ <> ''").select(F.col("id_").alias(text_id), F.col("text_").alias(text), "changed")


def patch_arpa_header(text: str) -> str:
    """An ARPA file with </s> added after <s> if it lacks it, and its unigram count raised by one."""
    if re.search(r"(?m)^[^\t\n]*\t</s>(\t|$)", text):
        return text
    text = re.sub(r"(?m)^ngram 1=(\d+)$", lambda m: f"ngram 1={int(m[1]) + 1}", text, count=1)
    return re.sub(r"(?m)^([^\t\n]*)\t<s>((?:\t.*)?)$", lambda m: f"{m[0]}\n{m[1]}\t</s>{m[2]}", text, count=1)
