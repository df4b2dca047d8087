"""Validation of transcripts, rates of token ids, whole collators."""

from __future__ import annotations

import io
import wave

import numpy as np
import pytest
from tidewright.operators import collate, mix, validation
from tidewright.sources import audio, manifest, shards

KEEP = "abcdefghijklmnopqrstuvwxyzæøå0123456789"


def test_validations(spark):
    rows = [(1, "Hej med dig!", [0.1] * 16, "hej med dig"), (2, "Hej med dig", [0.1] * 16, "noget helt andet"), (3, "for kort", [0.1] * 4, "for kort"), (4, " ", [0.1] * 16, "x"), (5, None, [0.1] * 16, "x"), (6, "to et", [0.1] * 16, "2 et")]
    df = spark.createDataFrame(rows, "id int, text string, audio array<double>, guess string")
    out = validation.add_validations(df, "text", "audio", "guess", 16, "m", KEEP, 0.5).orderBy("id")
    assert out.columns == ["id", "text", "audio", "asr_prediction", "asr_label", "asr_validation_model", "asr_cer", "asr_wer"]
    got = [(r.id, r.text, r.asr_prediction, r.asr_label, r.asr_validation_model, r.asr_cer, r.asr_wer) for r in out.collect()]
    assert got == [(1, "Hej med dig!", "hej med dig", "hej med dig", "m", 0.0, 0.0), (6, "to et", "to et", "to et", "m", 0.0, 0.0)]


def test_token_rates(spark):
    words = {0: "a", 1: "b", 2: " ", 3: "<pad>"}
    df = spark.createDataFrame([([0, 1, 2, 0, -100], [0, 1, 2, 1, -100]), ([0, -100], [0, 0])], "p array<int>, l array<int>")
    got = validation.token_error_rates(df, "p", "l", words, 3).first()
    # "ab a" and "ab b", "a" and "aa"
    assert got.cer == pytest.approx(2 / 6) and got.wer == pytest.approx(2 / 3)
    one = lambda i: [1.0 if j == i else 0.0 for j in range(4)]
    logits = spark.createDataFrame([([one(0), one(0), [-100.0] * 4, one(1)], [0, 1])], "p array<array<double>>, l array<int>")
    assert validation.token_error_rates(logits, "p", "l", words, 3).first().cer == 0
    for kind in ("int", "array<array<array<double>>>"):
        with pytest.raises(ValueError, match="arrays of ids"):
            validation.token_error_rates(spark.createDataFrame([], f"p {kind}, l array<int>"), "p", "l", words, 3)


def test_ctc_batches(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5, 0.5], [7]), (1, [0.1], [7, 8]), (2, [0.2], [9])], "b int, audio array<double>, labels array<int>")
    rows = lambda **k: sorted(map(tuple, collate.ctc_batch(df, "b", "audio", "labels", 2, 2.5, 600, **k).collect()))
    assert rows() == [(1, [0.1, 0.0, 0.0], [7, 8], [1, 0, 0], [1, 1]), (1, [0.5] * 3, [7, -100], [1] * 3, [1, 0]), (2, [0.2], [9], [1], [1])]
    full = rows(padding="max_length")
    assert all(len(r[1]) == 5 and len(r[2]) == 512 for r in full)
    assert [len(r[1]) for r in rows(padding="do_not_pad")] == [1, 3, 1]
    with pytest.raises(ValueError):
        rows(padding="nonsense")


def test_mel_batches(spark):
    df = spark.createDataFrame([(1, [[1.0], [2.0]], 1), (1, [[1.0, 1.5], [2.0, 2.5]], 2)], "b int, f array<array<double>>, length int")
    assert sorted(map(tuple, collate.mel_batch(df, "b", "f", "length").collect())) == [(1, [[1.0, 0.0], [2.0, 0.0]], 1), (1, [[1.0, 1.5], [2.0, 2.5]], 2)]
    with pytest.raises(Exception, match="share mel bins"):
        collate.mel_batch(df.union(spark.createDataFrame([(1, [[1.0]], 1)], df.schema)), "b", "f", "length").collect()


def test_transducer_batches(spark):
    df = spark.createDataFrame([(1, [5, 6], [0, 5, 6]), (1, [7], [0, 7])], "b int, l array<int>, d array<int>")
    assert sorted(map(tuple, collate.transducer_batch(df, "b", "l", 0, 9, "rnnt", "d").collect())) == [(1, [5, 6], [0, 5, 6]), (1, [7, 0], [0, 7, 9])]
    assert sorted(map(tuple, collate.transducer_batch(df.drop("d"), "b", "l", 0, 9, "tdt").collect())) == [(1, [5, 6]), (1, [7, 9])]
    assert [len(r.l) for r in collate.transducer_batch(df, "b", "l", 0, 9, "tdt", "d", "do_not_pad").collect()] == [2, 1]
    for bad, message in (((1, [8], None), "or none"), ((1, [8], [8]), "blank followed")):
        with pytest.raises(Exception, match=message):
            collate.transducer_batch(df.union(spark.createDataFrame([bad], df.schema)), "b", "l", 0, 9, "rnnt", "d").collect()
    none = spark.createDataFrame([(1, [8], None)], df.schema)
    assert collate.transducer_batch(none, "b", "l", 0, 9, "rnnt", "d").first().d is None
    with pytest.raises(ValueError):
        collate.transducer_batch(df, "b", "l", 0, 9, "rnnt", "d", "max_length")


def test_prompts(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "l array<int>")
    assert tuple(collate.prompted(df, [7, 8], "l", 2).first()) == ([1, 2], [7, 8])


def test_sound_stays_with_its_text(spark):
    df = spark.createDataFrame([([0.5], "x")], "wave array<double>, t string")
    assert tuple(mix.standardise(df, "da", "t", audio="wave").first()) == ([0.5], "x", "da")
    with pytest.raises(ValueError):
        mix.standardise(df, "da", "t", audio="nope")


def _wav(samples, rate):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.asarray(samples) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_windows_of_sound(spark):
    data = _wav(np.full(8000, 0.5), 8000)
    x = audio.decode_window(data, 12_000, 8000, 16_000)
    assert len(x) == 8000 and abs(x[2000] - 0.5) < 0.01 and not x[4100:].any()
    assert len(audio.decode_window(data, 99_999, 10, 16_000)) == 10 and len(audio.decode_window(data, 4000, None, 8000)) == 4000
    rows = spark.createDataFrame([("a", 0, 100), ("a", 7990, 100)], "path string, offset long, length long")
    got = audio.decode_windows(rows, spark.createDataFrame([("a", bytearray(data))], "path string, content binary"), 8000).collect()
    assert [len(r.audio) for r in got] == [100, 100]


def test_augmentation_with_noises(spark):
    rows = spark.createDataFrame([(i, [float(np.sin(j / 3)) for j in range(400)]) for i in range(30)], "id int, audio array<double>")
    one, two = (audio.augment(rows, 1, noises=[[0.5, -0.5, 0.1]]).orderBy("id").collect() for _ in range(2))
    assert one == two and all(np.isfinite(r.audio).all() and len(r.audio) == 400 for r in one)
    tone = np.sin(2 * np.pi * 1000 * np.arange(4000) / 16000)
    power = lambda kind, low, high: float((audio._filtered(tone, 16000, kind, low, high) ** 2).mean())
    assert power(0, 500, 2000) > 0.4 > 0.01 > power(0, 3000, 5000) and power(1, 500, 2000) < 0.1 and power(2, 4000, 8000) < 0.01 and power(3, 1, 200) < 0.01


def test_manifest_errors_and_secrets(spark, tmp_path):
    good = '{"duration": 2.0, "id": "%d"}'
    path = tmp_path / "m.jsonl"
    path.write_text("\n".join(good % i for i in range(9)))
    assert sorted(r.id for r in manifest.read_manifest(spark, str(path), 1, 3, [0, 2], 3).collect()) == ["0", "2", "3", "5", "6", "8"]
    for bad in ([3], [-1], [], [True], ["0"]):
        with pytest.raises(ValueError):
            manifest.read_manifest(spark, str(path), 1, 3, bad, 3)
    for line in ("not json", '{"id": "x"}'):
        path.write_text((good % 1) + "\n" + line)
        with pytest.raises(ValueError, match="line 2"):
            manifest.read_manifest(spark, str(path), 1, 3)
    assert manifest.redact({"api-key": "x", "token": None, "n": None, "hf-token": "y", "resume_from_checkpoint": None}) == {"api-key": "<redacted>", "token": None, "n": None, "hf-token": "<redacted>", "resume_from_checkpoint": None}


def test_names_and_templates():
    assert shards.parse_name("a/b:s") == ("a/b", "s", None) and shards.parse_name("a/b:s@r") == ("a/b", "s", "r")
    for bad in ("a@b@c", "a::b::c", "", "a::", "::x"):
        with pytest.raises(ValueError):
            shards.parse_name(bad)
    assert shards.select_shards({"template": "x-{shard}.parquet", "start": 9, "end": 10}, ["x-9.parquet", "x-10.parquet"], "0" * 40) == ["x-9.parquet", "x-10.parquet"]
    # fixed value: the MD5 of "a,b"
    assert shards.corpus_file("/c/", ["a", "b"]) == "/c/ngram-sentences-b345e1dc09f20fdefdea469f09167892.txt"


def test_captions_with_tabs_and_marks(spark):
    from tidewright.operators import vtt

    files = spark.createDataFrame([("a", "\ufeffWEBVTT\n\n00:01.000 -->\t00:02.000\talign:start\n\ufeffhello\n \t\n  NOTE x --> y\n\n00:03.000 --> 00:04.000\nhello you\n")], "path string, content string")
    got = [(r.start, r.end, r.text, r.status) for r in vtt.cues(files).orderBy("block").collect()]
    assert got == [(1.0, 2.0, "hello", "ok"), (3.0, 4.0, "you", "ok")]


def test_a_bad_caption_file_stops_no_other(spark, tmp_path):
    (tmp_path / "good.vtt").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nhello\n\n00:03.000 --> 00:09.000\nlate\n", encoding="utf-8")
    (tmp_path / "broken.vtt").write_bytes(b"WEBVTT\n\n00:01.000 --> 00:02.000\n\xff\xfe\n")
    (tmp_path / "headless.vtt").write_text("00:01.000 --> 00:02.000\nhello\n")
    captions = manifest.read_captions(spark, str(tmp_path))
    assert captions.where("content is null").count() == 1
    stems = sorted(r.path[:-4] for r in captions.collect())
    audio_ = spark.createDataFrame([(f"{s}.wav", 5.0) for s in [*stems, "/no/captions"]], "wav_path string, audio_duration double")
    found = manifest.build_manifest(captions, audio_, str(tmp_path / "out"), "da")
    assert tuple(found) == (4, 1, 3, 1, 1)
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert [(r.text, r.start, r.end, r.language) for r in rows] == [("hello", 1.0, 2.0, "da")]


def test_local_splits_and_vocabulary(spark, tmp_path):
    import pyarrow as pa

    from tidewright.sources import arrow

    data = pa.table({"a": [1, 2]})
    for name in ("one/train/data-0.arrow", "three/x.arrow"):
        (tmp_path / name).parent.mkdir(parents=True)
        with pa.OSFile(str(tmp_path / name), "wb") as f, pa.ipc.new_stream(f, data.schema) as out:
            out.write_table(data)
    spark.range(3).withColumnRenamed("id", "a").write.parquet(str(tmp_path / "two/train"))
    assert [arrow.read_local(spark, str(tmp_path / d), "train", "a long").count() for d in ("one", "two", "three")] == [2, 3, 2]
    manifest.write_vocabulary(spark.createDataFrame([("å", 1), ("|", 0)], "char string, id long"), str(tmp_path / "v"))
    assert spark.read.text(str(tmp_path / "v")).first()[0] == '{"|": 0, "å": 1}'
