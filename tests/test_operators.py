from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewright.functions import arrays, scalars
from tidewright.operators import filters, joins, metrics, mix, ngrams, scoring, vtt


def test_row_filters(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "s string, t string")
    assert filters.row_filters(df, {"s": "a", "t": None}).collect() == [("a", None)]
    with pytest.raises(ValueError, match="nope"):
        filters.row_filters(df, {"nope": 1})


def test_duration_is_exclusive(spark):
    df = spark.createDataFrame([(n, "x", v) for n, v in ((16, None), (17, None), (31, "ok"), (32, None), (20, "rejected"))], "n int, text string, validated string").withColumn("a", F.array_repeat(F.lit(0.0), F.col("n")))
    assert [r.n for r in filters.examples(df, "a", 16, "text", 1, 2).orderBy("n").collect()] == [17, 31]
    assert filters.removed(df, df.limit(2)).first()[0] == 3


def test_targets(spark):
    df = spark.createDataFrame([([1], 1), ([], 1), ([1], 0), (None, 1), ([1], None)], "labels array<int>, n int")
    assert df.where(filters.has_targets(F.col("labels"), F.col("n"))).count() == 1


def test_transcript_join(spark):
    audio = spark.createDataFrame([("one", "old"), ("two", "old"), ("three", "old")], "key string, text string")
    words = spark.createDataFrame([("one", "ja"), ("three", " "), ("four", "x")], "k string, w string")
    assert joins.transcript_join(audio, words, "key", "k", "w").collect() == [("one", "ja")]
    same = joins.transcript_join(audio, words.toDF("key", "text"), "key", "key", "text")
    assert same.columns == ["key", "text"] and same.count() == 1
    with pytest.raises(ValueError, match="twice"):
        joins.transcript_join(audio, words.union(spark.createDataFrame([("one", "")], "k string, w string")), "key", "k", "w")
    with pytest.raises(ValueError, match="usable"):
        joins.transcript_join(audio, words.where("w = ' '"), "key", "k", "w")
    with pytest.raises(TypeError):
        joins.transcript_join(audio, words.withColumn("k", F.length("k")), "key", "k", "w")
    with pytest.raises(TypeError, match="no key"):
        joins.transcript_join(audio, words.union(spark.createDataFrame([(None, "x")], "k string, w string")), "key", "k", "w")
    with pytest.raises(ValueError, match="missing|no column"):
        joins.transcript_join(audio, words, "nope", "k", "w")


@pytest.mark.parametrize(("few", "most"), [(2000, 1 << 20), (0, 1 << 20), (0, 0), (2000, 0)])
def test_contains_join(spark, monkeypatch, few, most):
    monkeypatch.setattr(joins, "FEW_PHRASES", few)
    monkeypatch.setattr(joins, "MOST_BYTES", most)
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice("abc") for _ in range(12))) for i in range(40)]
    phrases = [(i, " ".join(rng.choice("abc") for _ in range(n))) for i, n in enumerate((1, 3, 5, 6, 7, 6, 6, 7))] + [(9, ""), (10, None), (11, texts[3][1][2:-2])]
    got = joins.contains_join(spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame(phrases, "j int, p string"), "t", "p").select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for i, t in texts for j, p in phrases if p and p in t)
    none = joins.contains_join(spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame([(1, "")], "j int, p string"), "t", "p")
    assert none.columns == ["i", "t", "j", "p"] and none.collect() == []


def test_decontaminate(spark):
    texts = spark.createDataFrame([(1, "a b c d"), (2, "b"), (3, "x"), (4, None)], "i int, t string")
    phrases = spark.createDataFrame([("b",), ("b c",), ("",)], "p string")
    assert ngrams.decontaminate(texts, phrases, "i", "t", "p").orderBy("i").collect() == [(1, "a d", True), (3, "x", False)]
    odd = spark.createDataFrame([(None, "x b"), (None, "y"), (5, "b z"), (5, "w"), (5, "b z")], "i int, t string")
    got = sorted(map(repr, map(tuple, ngrams.decontaminate(odd, phrases, "i", "t", "p").collect())))
    assert got == sorted(map(repr, [(None, "x", True), (None, "y", False), (5, "z", True), (5, "z", True), (5, "w", False)]))


def test_probabilities():
    assert mix.validate_probabilities([0.5, 0.500000005], 2)
    for bad in ([0.5], [0.5, 0.6], [True, 0.0], [math.nan, 1.0], [-0.5, 1.5], ["a", 1], 3):
        with pytest.raises(ValueError):
            mix.validate_probabilities(bad, 2)
    for bad in (0, -1, True, 1.5):
        with pytest.raises(ValueError):
            mix.validate_buffer(bad)


def test_interleave(spark):
    a, b = spark.range(100).withColumn("s", F.lit("a")), spark.range(30).withColumn("s", F.lit("b"))
    rows = mix.interleave([a, b], ["id"], 7, [0.5, 0.5]).collect()
    assert {r.id for r in rows if r.s == "a"} == set(range(100)) and {r.id for r in rows if r.s == "b"} == set(range(30))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix.interleave([a, b], ["id"], 7, [0.5, 0.5]).collect()))
    first = sorted(rows, key=lambda r: r.step)[:60]
    assert 20 <= sum(r.s == "a" for r in first) <= 40
    assert sum(r.s == "b" for r in rows) == 100


def test_shuffle_take_batches(spark):
    df = spark.range(25).repartition(3)
    a, b = ([r.id for r in mix.seeded_shuffle(df, 1, "id").collect()] for _ in range(2))
    assert a == b != sorted(a) and sorted(a) == list(range(25))
    blocks = [r.id for r in mix.seeded_shuffle(df, 1, "id", buffer=5, row="id").collect()]
    assert [x // 5 for x in blocks] == [i // 5 for i in range(25)]
    assert [r.id for r in mix.take(df, 3, ["id"]).collect()] == [0, 1, 2]
    rows = mix.batches(df, ["id"], 10).orderBy("id").collect()
    assert [(r.id, r.batch, r.place_in_batch) for r in rows] == [(i, i // 10, i % 10) for i in range(20)]
    assert mix.batches(df, ["id"], 10, drop_last=False).count() == 25
    assert mix.accumulation_steps(256, 2, 8) == 16 and mix.accumulation_steps(1, 2, 8) == 1


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_operations():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(2))
        s, d, i, h = metrics.edit_operations(a, b)
        assert s + d + i == _distance(a, b) and s + d + h == len(a) and s + i + h == len(b)


def test_error_rates(spark):
    df = spark.createDataFrame([("ab", "ab"), ("abcd", "axcde"), (None, "x"), ("", "")], "r string, p string")
    rows = df.withColumn("c", metrics.char_edits(df.r, df.p)).withColumn("w", metrics.word_edits(df.r, df.p))
    assert metrics.error_rate(rows, "c", "cer", normalise=False).first()[0] == pytest.approx(2 / 6)
    assert metrics.error_rate(rows, "c", "cer").first()[0] == pytest.approx(2 / 7)
    assert metrics.error_rate(rows, "w", "wer").first()[0] == pytest.approx(1 / 2)
    assert metrics.error_rate(rows.limit(0), "c", "cer").first()[0] is None


def test_pruned_cube(spark):
    rng = random.Random(5)
    for trial in range(3):
        rows = [tuple(rng.choice([None, *"xyz"][: 2 + k + (trial > 1)]) for k in range(3)) for _ in range(12)]
        got = scoring.pruned_cube(spark.createDataFrame(rows, "a string, b string, c string"), ["a", "b", "c"], {}).collect()
        want = []
        for combo in itertools.product(*[[None, *sorted({r[k] for r in rows} - {None})] for k in range(3)]):
            left, ok = rows, True
            for k, v in enumerate(combo):
                if v is not None:
                    kept = [r for r in left if r[k] == v]
                    ok &= 0 < len(kept) < len(left)
                    left = kept
            if ok:
                want.append((*combo, len(left)))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_ages_and_dialects(spark):
    df = spark.createDataFrame([(0.0,), (24.9,), (25.0,), (50.0,), (-1.0,), (math.nan,), (None,)], "a double")
    assert [r[0] for r in df.select(scalars.age_group(F.col("a"))).collect()] == ["0-25", "0-25", "25-50", "50+", None, None, None]
    df = spark.createDataFrame([("fynsk", None), ("fynsk", "SE"), ("?", "DK"), (None, "DK")], "s string, c string")
    assert [r[0] for r in df.select(scalars.dialect(F.col("s"), F.col("c"))).collect()] == ["Fynsk", "Non-native", None, None]
    assert scalars.retry_after("7", 0) == 7 and scalars.retry_after("x", 0) == 120 and scalars.retry_after(None, 0) == 120 and scalars.retry_after("9999", 0) == 300
    assert scalars.retry_after("-5", 0) == 120 and scalars.retry_after("nan", 0) == 120 and scalars.retry_after("inf", 0) == 120
    assert scalars.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 10) == 50


def test_captions(spark):
    files = [
        ("a.vtt", "WEBVTT\r\n\r\n00:00.000 --> 00:01.000\r\nhello\r\n\r\n1\n00:01.000 --> 00:02.000 align:start\nhello world\n\n00:02.000 --> 00:03.000\nhello world\nagain"),
        ("b.vtt", "no header\n\n00:00.000 --> 00:01.000\nx"),
        ("c.vtt", "WEBVTT\n\nNOTE\n00:00.000 --> 00:01.000\n\n00:61.000 --> 00:01.000\nbad\n\n01:00:00.500 --> \nx\n\n00:00.000 --> 00:01.000\na\n00:00.000 --> 00:01.000\n\n00:02.000 --> 00:01.000\nturned\n\nwords only"),
    ]
    rows = vtt.cues(spark.createDataFrame(files, "path string, content string")).orderBy("path", "block").collect()
    assert [(r.start, r.end, r.text) for r in rows if r.path == "a.vtt"] == [(0.0, 1.0, "hello"), (1.0, 2.0, "world"), (2.0, 3.0, "again")]
    assert [r.status for r in rows if r.path == "c.vtt"] == ["bad_time", "bad_time", "several_times", "bad_order"]
    assert not [r for r in rows if r.path == "b.vtt"]
    cue = vtt.cues(spark.createDataFrame(files, "path string, content string"))
    audio = spark.createDataFrame([("a.vtt", "a.wav", 2.5), ("z.vtt", "z.wav", 1.0)], "path string, wav_path string, audio_duration double")
    assert [r.text for r in vtt.manifest(cue, audio, "da").orderBy("start").collect()] == ["hello", "world"]
    assert vtt.summary(cue, audio).first().asDict() == {"files_seen": 2, "files_written": 1, "files_skipped": 1, "cues_written": 2, "cues_skipped": 1}


def test_overlap(spark):
    pairs = [("", "a", "a"), ("a", "a", ""), ("hel", "hello", "lo"), ("a b c", "b c d", "d"), ("a b", "c d", "c d"), ("x a", "a", "")]
    df = spark.createDataFrame(pairs, "p string, c string, e string")
    assert [r[0] for r in df.select(vtt.remove_overlap(F.col("p"), F.col("c"))).collect()] == [e for *_, e in pairs]


def test_ngrams(spark):
    df = spark.createDataFrame([("a b a",), ("a b",), ("",), (None,)], "t string")
    assert sorted(map(tuple, ngrams.ngram_counts(df, "t", 2).collect())) == [(1, "a", 3), (1, "b", 2), (2, "a b", 2)]
    assert sorted(map(tuple, ngrams.ngram_counts(df, "t", 2, (0, 0)).collect()))[-1] == (2, "b a", 1)
    vocab = ngrams.vocabulary(df, "t")
    assert [(r["char"], r.id) for r in vocab.orderBy("id").collect()] == [(" ", 0), ("a", 1), ("b", 2), ("|", 3)]
    keep = spark.createDataFrame([("z", 0), ("a", 1), ("y", 2), ("z", 3)], "char string, place int")
    assert [tuple(r) for r in ngrams.extend_vocabulary(vocab, keep).orderBy("id").collect()] == [("z", 4), ("y", 5)]
    arpa = "\\data\\\nngram 1=2\nngram 2=12\n\n\\1-grams:\n-1\t<unk>\t0\n-2\t<s>\t-0.3\n"
    assert ngrams.patch_arpa_header(arpa) == "\\data\\\nngram 1=3\nngram 2=12\n\n\\1-grams:\n-1\t<unk>\t0\n-2\t<s>\t-0.3\n-2\t</s>\t-0.3\n"
    assert ngrams.patch_arpa_header(ngrams.patch_arpa_header(arpa)) == ngrams.patch_arpa_header(arpa)


def test_arrays(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    arr = lambda *x: F.array(*map(F.lit, x))
    assert get(arrays.peak_normalise(arr(1.0, -2.0))) == [0.5, -1.0] and get(arrays.peak_normalise(arr(0.0))) == [0.0]
    assert get(arrays.down_mix(F.array(arr(1.0, 3.0), arr(3.0, 5.0)))) == [2.0, 4.0]
    assert get(arrays.fit_length(arr(1, 2), 3, F.lit(0))) == [1, 2, 0] and get(arrays.fit_length(arr(1, 2), 1, F.lit(0))) == [1]
    decoder, labels = arrays.prompt_batch_row(arr(7, 8, 9), arr(1, 2), 3)
    assert get(decoder) == [7, 8, 9, 1, 2] and get(labels) == [-100, -100, 1, 2, 3]
    with pytest.raises(Exception, match="no room"):
        get(arrays.prompt_batch_row(arr(7, 8, 9), arr(1), 3, max_length=3)[0])
    assert get(arrays.transducer_is_valid(arr(0, 1), arr(1), 0)) and not get(arrays.transducer_is_valid(arr(1), arr(1), 0))
    assert get(arrays.logits_to_ids(F.array(arr(1.0, 5.0, 5.0), arr(-100.0, -100.0, -100.0)), 9)) == [1, 9]
    assert get(arrays.replace_ignored(arr(1, -100), 0)) == [1, 0]
    assert get(arrays.pad_frames(F.array(arr(1.0), arr(2.0)), F.lit(2))) == [[1.0, 0.0], [2.0, 0.0]]
    assert get(arrays.char_labels(F.lit("a b"), {"a": 0, "|": 1}, 9)) == [0, 1, 9]
    prompt = arrays.language_prompt("da", True, ["da"])
    assert len(prompt) == 10 and prompt.count("<|da|>") == 2
    assert get(arrays.prompt_ids(prompt, {t: i for i, t in enumerate(dict.fromkeys(prompt))}))[4] == 4
    with pytest.raises(ValueError, match="language"):
        arrays.language_prompt("xx", True, ["da"])
    from pyspark.sql import Window

    rows = spark.createDataFrame([(1, [5, 1]), (1, [5]), (2, [5, 2]), (2, [6])], "b int, l array<bigint>")
    assert sorted(map(str, (r[0] for r in rows.select(arrays.drop_common_first(F.col("l"), 5, Window.partitionBy("b"))).collect()))) == ["[1]", "[5, 2]", "[6]", "[]"]
