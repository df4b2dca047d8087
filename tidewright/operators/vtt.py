"""WebVTT captions: blocks, cues, rolling overlap, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cue_id
from ..functions.text import BLANK, clean_caption, strip

# The shape of a time and the first words of blocks that are no cues.
TIME = r"^(?:(\d+):)?([0-5]\d):([0-5]\d)[.,](\d{3})$"
NO_CUE = r"^(WEBVTT|NOTE|STYLE|REGION)"


def seconds(c: Column) -> Column:
    """Seconds of [hours:]mm:ss.mmm, null if it is no time."""
    hours, minutes, whole, part = (F.regexp_extract(c, TIME, i) for i in range(1, 5))
    hours = F.when(hours == "", F.lit(0)).otherwise(hours.try_cast("bigint"))
    # the casts give null, not an error, where there is no match
    value = hours * 3600 + minutes.try_cast("int") * 60 + whole.try_cast("int") + part.try_cast("int") / 1000
    return F.when(c.rlike(TIME), value.cast("double"))


def remove_overlap(previous: Column, current: Column) -> Column:
    """current without what it repeats of the caption before it.

    Nothing is left of an equal one; of one that begins with all of the previous,
    the rest; else the most words that end the previous and begin the current go.
    """
    a, b = (F.filter(F.split(x, " "), lambda w: w != "") for x in (previous, current))
    most = F.least(F.size(a), F.size(b))
    k = F.coalesce(F.get(F.filter(F.when(most > 0, F.sequence(most, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>")), lambda n: F.slice(a, -n, n) == F.slice(b, F.lit(1), n)), F.lit(0)), F.lit(0))
    rest = F.array_join(F.slice(b, k + 1, F.size(b)), " ")
    return F.when((previous == "") | previous.isNull(), current).when(previous == current, "").when(F.startswith(current, previous), strip(F.substr(current, F.length(previous) + 1))).when(k == 0, current).otherwise(rest)


def blocks(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, block, lines) of each file; valid: whether the file begins with WEBVTT."""
    text = F.regexp_replace(F.replace(F.col(content), F.lit("\ufeff"), F.lit("")), r"\r\n?", "\n")
    body = files.select(F.col(path).alias("path"), F.startswith(strip(text), F.lit("WEBVTT")).alias("valid"), F.posexplode(F.split(strip(text), rf"(?U)\n{BLANK}*\n")).alias("block", "body"))
    return body.select("path", "valid", "block", F.transform(F.split(strip(F.col("body")), "\n"), strip).alias("lines"))


def cues(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, block, start, end, text, status), a row for each block with a time line.

    status: ok, or why a cue is skipped: several_times, bad_time, empty, bad_order.
    Overlap is taken from the cleaned text of the last well-timed cue, whether or not
    that was kept. Files that do not begin with WEBVTT give nothing.
    """
    timed = blocks(files, path, content).where("valid").where(~F.coalesce(F.get("lines", F.lit(0)).rlike(NO_CUE), F.lit(False)))
    arrow = F.filter("lines", lambda x: F.contains(x, F.lit("-->")))
    timed = timed.withColumn("arrows", arrow).where("size(arrows) > 0")
    sides = F.split(F.get("arrows", F.lit(0)), "-->", 2)
    at = F.array_position("lines", F.get("arrows", F.lit(0)))
    timed = timed.select(
        "path", "block", F.size("arrows").alias("n"), seconds(strip(F.get(sides, F.lit(0)))).alias("start"),
        seconds(F.get(F.split(strip(F.get(sides, F.lit(1))), rf"(?U){BLANK}+"), F.lit(0))).alias("end"),
        clean_caption(F.array_join(F.slice("lines", (at + 1).cast("int"), F.size("lines")), " ")).alias("clean"),
    )
    ok = (F.col("n") == 1) & F.col("start").isNotNull() & F.col("end").isNotNull()
    before = F.lag(F.when(ok, F.col("clean")), 1).over(Window.partitionBy("path").orderBy("block"))
    last = F.last(F.when(ok, F.col("clean")), ignorenulls=True).over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    timed = timed.withColumn("text", F.when(ok, remove_overlap(F.coalesce(before, last), F.col("clean"))))
    status = F.when(F.col("n") > 1, "several_times").when(~ok, "bad_time").when(F.col("text") == "", "empty").when(F.col("end") <= F.col("start"), "bad_order").otherwise("ok")
    return timed.select("path", "block", "start", "end", "text", status.alias("status"))


def manifest(cue: DataFrame, audio: DataFrame, language: str) -> DataFrame:
    """cues and (path, wav_path, audio_duration) -> the manifest's rows; a cue that ends after its audio is left out."""
    joined = cue.where("status = 'ok'").join(audio, "path").where("end <= audio_duration")
    return joined.select(
        F.col("wav_path").alias("source_wav_path"), "start", "end", (F.col("end") - F.col("start")).alias("duration"), "text", cue_id(F.col("wav_path"), F.col("start"), F.col("end"), F.col("text")).alias("id"), F.lit(language).alias("language")
    )


def summary(cue: DataFrame, audio: DataFrame) -> DataFrame:
    """One row of counters: files seen, written and skipped; cues written and skipped. Files without captions, or whose captions have no header, are skipped files."""
    late = F.coalesce(F.col("end") > F.col("audio_duration"), F.lit(False))
    per = audio.join(cue, "path", "left").groupBy("wav_path").agg(F.count_if((F.col("status") == "ok") & ~late).alias("w"), F.count_if(F.col("status").isNotNull() & ((F.col("status") != "ok") | late)).alias("s"))
    return per.agg(F.count(F.lit(1)).alias("files_seen"), F.count_if(F.col("w") > 0).alias("files_written"), F.count_if(F.col("w") == 0).alias("files_skipped"), F.coalesce(F.sum("w"), F.lit(0)).alias("cues_written"), F.coalesce(F.sum("s"), F.lit(0)).alias("cues_skipped"))
