from __future__ import annotations

import io
import json
import os
import wave

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.sources import arrow, audio, manifest, shards
from tidewright.streaming import captions

REVISION = "0123456789abcdef0123456789abcdef01234567"


def test_shards(spark, tmp_path):
    there = [f"data/train-{i:05d}.parquet" for i in (0, 1, 3, 4, 5)]
    pick = {"template": "data/train-{shard:05d}.parquet", "start": 1, "end": 4}
    assert shards.select_shards(pick, there, REVISION) == [there[1], there[2], there[3]]
    for change in ({"start": -1}, {"start": 5}, {"template": "x"}, {"template": "{other:05d}"}, {"template": "http://x/{shard:05d}"}, {"template": "/{shard:05d}"}, {"template": "{shard:05d}?x"}, {"end": 10**6}, {"start": True}, {"end": 1, "start": 2}, {"more": 1}):
        with pytest.raises(ValueError):
            shards.select_shards({**pick, **change}, there, REVISION)
    with pytest.raises(ValueError):
        shards.select_shards(pick, there, "main")
    for i in (0, 1, 3):
        spark.range(i, i + 1).write.parquet(str(tmp_path / f"data/train-{i:05d}.parquet"))
    assert sorted(r.id for r in shards.read_shards(spark, str(tmp_path), pick, there[:3], REVISION).collect()) == [1, 3]


def test_names_and_identity(spark, tmp_path):
    assert shards.parse_name("a/b") == ("a/b", None, None)
    assert shards.parse_name("a/b::s@r") == ("a/b", "s", "r") == shards.parse_name("a/b@r::s")
    assert shards.parse_name("a/b@r") == ("a/b", None, "r")
    base = dict(dataset_id="a/b", subset=None, split="test", revision=REVISION, purpose="eval")
    ids = {shards.cache_identity(**base)} | {shards.cache_identity(**{**base, **c}) for c in ({"subset": "s"}, {"split": "x"}, {"purpose": "y"}, {"max_samples": 3}, {"lower": True})}
    assert len(ids) == 6 and all(i.startswith("a--b-") for i in ids)
    calls = []
    build = lambda: calls.append(1) or spark.range(3)
    assert [shards.cached(spark, str(tmp_path), "x", build).count() for _ in range(2)] == [3, 3] and len(calls) == 1


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    rows = [dict(source_wav_path="a.wav", start=0.0, end=d, duration=d, text=f"t{i}", id=f"cue-{i}", language="da") for i, d in enumerate((0.5, 1.5, 2.0, 8.0, 8.5))]
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    assert [r.id for r in manifest.read_manifest(spark, str(path), 1, 8).orderBy("id").collect()] == ["cue-1", "cue-2"]
    assert [r.id for r in manifest.read_manifest(spark, str(path), 1, 8, [0], 2).collect()] == ["cue-2"]
    path.write_text(path.read_text() + json.dumps({**rows[0], "duration": -1.0}) + "\n")
    with pytest.raises(ValueError, match="line 6"):
        manifest.read_manifest(spark, str(path), 1, 8, [0], 3)
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "x")], "a int, text string")
    manifest.write_manifest(df, out)
    manifest.write_manifest(df.union(df), out)
    assert spark.read.json(out).count() == 2 and not list(tmp_path.glob("*.tmp"))
    with pytest.raises(Exception):
        manifest.write_manifest(df.select(F.raise_error(F.lit("no")).cast("string").alias("x")), out)
    assert spark.read.json(out).count() == 2 and not list(tmp_path.glob("*.tmp"))
    manifest.write_corpus(df, str(tmp_path / "corpus"))
    assert spark.read.text(str(tmp_path / "corpus")).first()[0] == "x"
    assert manifest.append_metrics(spark, 5, {"eval_loss": 1, "loss": 2, "other": 3}, str(tmp_path / "metrics")) and not manifest.append_metrics(spark, 6, {"other": 1}, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first().asDict() == {"step": 5, "eval_loss": 1.0, "loss": 2.0}
    assert manifest.redact({"token": "x", "a": {"model_dir": "/x", "n": 1}, "resume_from_checkpoint": True, "l": [{"password": 1}]}) == {"token": "<redacted>", "a": {"model_dir": "<redacted>", "n": 1}, "resume_from_checkpoint": True, "l": [{"password": "<redacted>"}]}


def test_captions_meet_audio(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.vtt").write_text("WEBVTT")
    found = manifest.read_captions(spark, str(tmp_path))
    stem = found.first().path[:-4]
    pairs = manifest.pair_with_audio(found, spark.createDataFrame([(stem + ".wav",), ("/z.wav",)], "wav_path string")).orderBy(F.col("content").isNull()).collect()
    assert [r.content for r in pairs] == ["WEBVTT", None]


def _wav(samples, rate=8000, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.asarray(samples) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_audio(spark):
    tone = np.sin(2 * np.pi * 200 * np.arange(16000) / 8000) * 0.5
    data = _wav(tone)
    x = audio.decode(data, 1.0, 2.0, 16000)
    assert len(x) == 16000 and abs(np.abs(x[100:-100]).max() - 0.5) < 0.02
    assert np.allclose(audio.decode(data, None, None, None), tone, atol=1e-3)
    stereo = _wav(np.stack([tone, -tone], axis=1), channels=2)
    assert np.abs(audio.decode(stereo, None, None, None)).max() < 1e-3 and np.allclose(audio.decode(stereo, None, None, None, channel=2), -tone, atol=1e-3)
    for bad in ((-1.0, 1.0), (1.0, 0.5), (1.0, 3.0)):
        with pytest.raises(ValueError):
            audio.decode(data, *bad, None)
    assert audio.offset_window(16000, 16000, 16000, 8000, 12000) == (8000, 4000, 4000)
    rows = spark.createDataFrame([("a", 0.0, 0.5, 1), ("a", 0.5, 1.0, 2)], "source_wav_path string, start double, end double, id int")
    got = audio.decode_slices(rows, spark.createDataFrame([("a", bytearray(data))], "path string, content binary"), 8000)
    assert [len(r.audio) for r in got.collect()] == [4000, 4000]
    one, two = (audio.augment(got, 3).orderBy("id").collect() for _ in range(2))
    assert one == two


def test_arrow(spark, tmp_path):
    table = pa.table({"a": [1, 2, 3]})
    with pa.OSFile(str(tmp_path / "data-0.arrow"), "wb") as f, pa.ipc.new_stream(f, table.schema) as out:
        out.write_table(table)
    with pa.OSFile(str(tmp_path / "data-1.arrow"), "wb") as f, pa.ipc.new_file(f, table.schema) as out:
        out.write_table(table)
    assert arrow.read_arrow(spark, str(tmp_path), "a long").count() == 6


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [dict(source_wav_path="a", start=0.0, end=d, duration=d, text=str(d), id=str(i), language="da") for i, d in enumerate((0.5, 2.0, 9.0))]
    (source / "1.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    query = captions.stream_manifest(spark, str(source), 1, 8).writeStream.format("memory").queryName("manifest_rows").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [r.id for r in spark.table("manifest_rows").collect()] == ["1"]
    cues = tmp_path / "cues"
    cues.mkdir()
    texts = ["hello", "hello world", "hello world again"]
    for i, t in enumerate(texts):
        (cues / f"{i}.json").write_text(json.dumps({"path": "a", "block": i, "text": t}) + "\n")
        os.utime(cues / f"{i}.json", (1_000_000 + i, 1_000_000 + i))  # files are taken by age
    stream = spark.readStream.schema("path string, block int, text string").option("maxFilesPerTrigger", 1).json(str(cues))
    query = captions.stream_overlap(stream).writeStream.format("memory").queryName("cue_rows").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [r.text for r in spark.table("cue_rows").orderBy("block").collect()] == ["hello", "world", "again"]
