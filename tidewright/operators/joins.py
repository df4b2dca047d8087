"""Joins: transcripts, lookups, containment, positions, membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..store import written
from .filters import require_columns


def transcript_join(audio: DataFrame, transcripts: DataFrame, audio_key: str, transcript_key: str, transcript_text: str) -> DataFrame:
    """Inner join of audio rows with the usable transcripts; the result has audio's columns and ``text``.

    Errors, found before the join: a missing column, keys of different types, keys
    that are arrays, maps or structs, a null transcript key, a key that occurs
    twice (even if one text is blank), no usable transcript at all. Blank texts
    are left out. The planner broadcasts the transcripts if they are small enough
    and shuffles both sides otherwise.
    """
    require_columns(audio, [audio_key], "audio")
    require_columns(transcripts, [transcript_key, transcript_text], "transcripts")
    types = audio.schema[audio_key].dataType, transcripts.schema[transcript_key].dataType
    if types[0] != types[1]:
        raise TypeError(f"join keys differ in type: {types[0].simpleString()} and {types[1].simpleString()}")
    if types[0].typeName() in ("array", "map", "struct", "variant"):
        raise TypeError(f"{types[0].simpleString()} can't be a join key")
    if transcripts.schema[transcript_text].dataType.typeName() != "string":
        raise ValueError("no usable transcript")
    keyed = transcripts.select(F.col(f"`{transcript_key}`").alias("key_"), F.col(f"`{transcript_text}`").alias("text_"))
    usable = ~is_blank(F.col("text_"))
    facts = keyed.groupBy("key_").agg(F.count(F.lit(1)).alias("n"), F.max(usable).alias("ok"))
    seen = facts.agg(F.max(F.when(F.col("key_").isNull(), F.lit(True))).alias("null_key"), F.max("n").alias("most"), F.max("ok").alias("ok")).first()
    if seen.null_key:
        raise TypeError("a transcript has no key")
    if (seen.most or 0) > 1:
        raise ValueError("a transcript key occurs twice")
    if not seen.ok:
        raise ValueError("no usable transcript")
    keep = [F.col(f"`{c}`") for c in audio.columns if c != "text"]
    left = audio.withColumn("join_key_", F.col(f"`{audio_key}`"))
    return left.join(keyed.where(usable), left["join_key_"] == keyed["key_"]).select(*keep, F.col("text_").alias("text"))


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str) -> DataFrame:
    """Left join with a table of one value a key; unknown keys give null."""
    found = table.select(F.col(table_key).alias("lookup_key_"), F.col(value).alias("lookup_value_"))
    return df.join(found, F.col(key) == F.col("lookup_key_"), "left").withColumn(out, F.col("lookup_value_")).drop("lookup_key_", "lookup_value_")


#: Short phrases, and bytes of them, that are searched for in every text, at most.
FEW_PHRASES, FEW_BYTES = 16, 1 << 16
#: Bytes of phrases that are sent to every task, at most.
MOST_BYTES = 8 << 20
#: Characters of a short phrase that its texts are met by.
HEAD = 12


def contains_join(texts: DataFrame, phrases: DataFrame, text: str, phrase: str, words: int = 4) -> DataFrame:
    """Pairs of a row of texts and a row of phrases that its text contains; columns of both, which must differ.

    Phrases of ``words`` + 2 words or more meet texts by a word n-gram inside them.
    Shorter ones, which no whole inner n-gram can tell, meet texts by their first
    HEAD characters, or all of them, a pass over the texts for each length that
    occurs; a few are searched for instead. All these are equi-joins that are then
    verified. Phrases of MOST_BYTES together, counted first, are sent to the tasks; if they
    are more, texts are written with numbers, and only these move with the n-grams.
    """
    phrases = phrases.where(F.col(phrase).isNotNull() & (F.col(phrase) != ""))
    contained = F.contains(F.col(text), F.col(phrase))
    parts = F.split(F.col(phrase), " ")
    long = F.size(parts) >= words + 2
    length = F.octet_length(phrase)
    size = phrases.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("b"), F.count_if(~long).alias("short"), F.coalesce(F.sum(F.when(~long, length)), F.lit(0)).alias("short_b")).first()
    if not size.n:
        return texts.join(phrases, F.lit(False))
    met = []
    # the words are a column of their own below the explode, so that they are split once
    held = lambda df: df.withColumn("words_", F.split(F.col(text), " "))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words_") - words + 1, F.lit(1)))
    by_words = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice("words_", i, F.lit(words)), " ")))
    ways = [(held, by_words, phrases.where(long).withColumn("gram_", F.array_join(F.slice(parts, F.lit(2), F.lit(words)), " ")))] if size.n > size.short else []
    few = size.short <= FEW_PHRASES and size.short_b <= FEW_BYTES
    if few and size.short:
        met.append(texts.join(F.broadcast(phrases.where(~long)), contained))
    elif size.short:
        headed = phrases.where(~long).withColumn("gram_", F.substring(phrase, 1, HEAD))
        for n in sorted(r.n for r in headed.select(F.length("gram_").alias("n")).distinct().collect()):
            places = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
            ways.append((lambda df: df, F.array_distinct(F.transform(places, _cutter(text, n))), headed.where(F.length("gram_") == n)))
    small = size.b <= MOST_BYTES
    numbered = texts if small or not ways else written(texts.withColumn("row_", F.monotonically_increasing_id()), "contained-texts")
    for prepare, grams, own in ways:
        if small:
            met.append(prepare(texts).withColumn("gram_", F.explode(grams)).join(F.broadcast(own), "gram_").where(contained).select(*texts.columns, *phrases.columns))
            continue
        pairs = prepare(numbered).select("row_", F.explode(grams).alias("gram_")).join(own, "gram_").drop("gram_")
        met.append(numbered.join(pairs, "row_").where(contained).select(*texts.columns, *phrases.columns))
    return reduce(DataFrame.unionByName, met)


def _cutter(text: str, n: int):
    return lambda i: F.substr(F.col(text), i, F.lit(n))


def zip_by_id(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """What a positional zip means: an equi-join on an explicit id."""
    return left.join(right, row_id)


def missing_members(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys expected that are not there."""
    return expected.select(key).distinct().join(actual.select(key), key, "left_anti")
