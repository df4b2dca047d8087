"""Caption manifests, caption files, corpora and metrics, read and written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import vtt
from ..store import written

# Configuration keys that hold secrets or paths.
SECRETS = {
    "access_token", "api_key", "apikey", "auth_token", "client_secret", "cookie", "credentials", "hf_token", "huggingface_hub_token", "huggingface_token",
    "password", "private_key", "refresh_token", "secret", "secret_key", "token", "wandb_api_key",
}
PATHS = {"cache", "manifest", "output", "path"}

SCHEMA = "source_wav_path string, start double, end double, duration double, text string, id string, language string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, line): the lines of a text file, or of files in the order of their names, numbered from 0.

    Lines are written once with their place in their task. A row for each block of a
    file then tells where the block's lines begin.
    """
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = written(read, "manifest-lines")
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("n")).select("file", "block", "from", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return lines.join(blocks, ["file", "block"]).select((F.col("first") + F.col("at") - F.col("from")).alias("place"), "line")


def read_manifest(spark: SparkSession, path: str, least: float, most: float, shards: Sequence[int] = (0,), num_shards: int = 1) -> DataFrame:
    """The manifest's rows longer than least and shorter than most seconds, of the given shards.

    Line n, from 1, belongs to shard (n - 1) modulo num_shards. A line that is no JSON
    object with a duration, or has a negative one, is an error that names the line,
    whichever shard it belongs to; so are shards that are not in [0, num_shards).
    """
    if not _is_whole(num_shards) or num_shards <= 0:
        raise ValueError("num_shards must be a positive whole number")
    if not shards or not all(_is_whole(s) and 0 <= s < num_shards for s in shards):
        raise ValueError(f"shards must be whole numbers in [0, {num_shards})")
    parsed = F.from_json("line", SCHEMA + ", bad_ string", {"columnNameOfCorruptRecord": "bad_"})
    rows = numbered_lines(spark, path).where("line <> ''").select("place", parsed.alias("r"))
    wrong = F.when(F.col("r.bad_").isNotNull() | F.col("r.duration").isNull(), "no row of a manifest").when(F.col("r.duration") < 0, "negative duration")
    first = rows.select("place", wrong.alias("wrong")).where("wrong is not null").agg(F.min(F.struct("place", "wrong")).alias("w")).first().w
    if first:
        raise ValueError(f"line {first.place + 1}: {first.wrong}")
    return rows.where((F.col("place") % num_shards).isin(*shards)).select("r.*").drop("bad_").where(f"duration > {float(least)} and duration < {float(most)}")


def _is_whole(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def read_captions(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of every .vtt file below the folder; content is null where it is no UTF-8, which stops no other file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.vtt").load(folder)
    text = F.col("content").cast("string")
    return files.select("path", F.when(F.is_valid_utf8(text), text).alias("content"))


def pair_with_audio(captions: DataFrame, audio: DataFrame) -> DataFrame:
    """audio (wav_path) with the captions of the same stem, null where there are none: (wav_path, path, content)."""
    stem = lambda c: F.regexp_replace(c, r"\.[^./]+$", "")
    left, right = audio.withColumn("stem_", stem(F.col("wav_path"))), captions.withColumn("stem_", stem(F.col("path")))
    return left.join(right, "stem_", "left").drop("stem_")


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines, first written beside the path and then put in its place.

    What was there is moved aside before, and back if the new one can't be put in its
    place, so either the old or the new manifest is there at the end.
    """
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    staged, aside = (f"{path.rstrip('/')}.{uuid.uuid4().hex}.{end}" for end in ("tmp", "old"))
    new, old, target = (jvm.org.apache.hadoop.fs.Path(x) for x in (staged, aside, path))
    fs = target.getFileSystem(conf)
    try:
        df.write.json(staged)
        there = fs.exists(target)
        if there and not fs.rename(target, old):
            raise OSError(f"{path} can't be moved aside")
        if not fs.rename(new, target):
            if there:
                fs.rename(old, target)
            raise OSError(f"{path} can't be put in place")
        fs.delete(old, True)
    finally:
        fs.delete(new, True)


def write_corpus(df: DataFrame, path: str, text: str = "text") -> None:
    """One sentence a line."""
    df.select(F.col(text).alias("value")).write.mode("overwrite").text(path)


def write_scores(df: DataFrame, path: str) -> None:
    """A small table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_metrics(spark: SparkSession, step: int, logs: Mapping[str, float], path: str) -> bool:
    """Append the step's eval_*, loss and learning_rate as a JSON line with sorted keys; False if there is none."""
    kept = {k: float(v) for k, v in sorted(logs.items()) if k.startswith("eval_") or k in ("loss", "learning_rate")}
    if not kept:
        return False
    spark.createDataFrame([(step, *kept.values())], ", ".join(["step long", *[f"`{k}` double" for k in kept]])).coalesce(1).write.mode("append").json(path)
    return True


def write_table(df: DataFrame, path: str) -> None:
    """A materialised dataset."""
    df.write.mode("overwrite").parquet(path)


def vocabulary_json(df: DataFrame) -> dict[str, int]:
    """char -> id of a vocabulary, which is as small as an alphabet."""
    return {r["char"]: r["id"] for r in df.orderBy("id").collect()}


def write_vocabulary(df: DataFrame, path: str) -> None:
    """The vocabulary as one JSON object in one file, in the order of ids."""
    text = json.dumps(vocabulary_json(df), ensure_ascii=False)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def build_manifest(captions: DataFrame, audio: DataFrame, path: str, language: str) -> Row:
    """Write the manifest of all cues of (path, content) that lie within their audio (wav_path, audio_duration) of the same stem, and return its counters.

    A file that can't be read as captions gives no row and counts as skipped, whatever else is there.
    """
    pairs = pair_with_audio(captions, audio)
    cue = written(vtt.cues(pairs.where("content is not null").select("path", "content")), "manifest-cues")
    held = pairs.select("wav_path", "audio_duration", "path")
    write_manifest(vtt.manifest(cue, held, language), path)
    return vtt.summary(cue, held).first()


def redact(value: object, key: str = "") -> object:
    """A nested configuration without secrets and paths, for publication."""
    if value is None:
        return None
    name = key.lower().replace("-", "_")
    if name == "resume_from_checkpoint":
        return value if isinstance(value, bool) else "<redacted>"
    if name in SECRETS:
        return "<redacted>"
    if isinstance(value, Mapping):
        return {k: redact(v, str(k)) for k, v in value.items()}
    if name in PATHS or name.endswith(("_dir", "_path")):
        return "<redacted>"
    if isinstance(value, (list, tuple)):
        return [redact(v, key) for v in value]
    return value
