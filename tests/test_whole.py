"""Queries that take whole rows and whole texts, against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from test_operators import _distance
from tidewright.operators import metrics
from tidewright.plans import catalogue

LONG = "The other gather never went there. " * 4 + "x" * 40


def _tables(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def _transcripts(spark, path, end):
    rng = random.Random(2)
    docs = [(i, LONG + " ".join(rng.choice(("mother", "then ", "Thin", "a,b")) for _ in range(30 + i)) + end, "en" if i % 5 else "fr", f"src{i % 2}") for i in range(12)]
    return docs, _tables(spark, path, documents=(docs, "doc_id long, text string, lang string, source string"), labels=([(i,) for i in range(12)], "doc_id long"))


def _edits(docs):
    """(doc_id, reference, hypothesis) of the transcripts, as whole texts."""
    for i, text, lang, _ in docs:
        if lang == "en":
            ref = re.sub("[^a-z ]", " ", text.lower())
            yield i, ref.strip(), re.sub("e[rn] ", "es ", ref.replace("th", "t")).strip()


@pytest.mark.parametrize("end", ["", " mother then there "])
def test_score_cubes_take_whole_texts(spark, tmp_path, end):
    docs, path = _transcripts(spark, tmp_path, end)
    pairs = [(r, h) for _, r, h in _edits(docs)]
    everything = [r for r in catalogue.score_cube_whole(spark, path).collect() if r[:3] == (None, None, None)][0]
    assert everything.n == len(pairs) and everything.cer == pytest.approx(sum(_distance(r, h) for r, h in pairs) / sum(len(r) for r, _ in pairs))
    for edits, cut in ((metrics.char_edits, str), (metrics.word_edits, str.split)):
        found = metrics.error_rate(catalogue._scored(spark, path).withColumn("e", edits(F.col("text"), F.col("prediction"))), "e", "rate").first()
        counts = [metrics.edit_operations(cut(r), cut(h)) for r, h in pairs]
        assert [sum(c[:3]) for c in counts] == [_distance(cut(r), cut(h)) for r, h in pairs]
        assert found.rate == pytest.approx(sum(sum(c[:3]) for c in counts) / sum(sum(c) for c in counts))


def test_cer_by_turn_takes_whole_turns(spark, tmp_path):
    rng = random.Random(3)
    turns = [(c, t, "same start " * 20 + "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 150)))) for c in range(3) for t in range(4)]
    path = _tables(spark, tmp_path, conversations=(turns, "conv_id long, turn int, text string"))
    want = {}
    for (c, _, p), (d, _, t) in zip(turns, turns[1:], strict=False):
        if c == d:
            counts = metrics.edit_operations(p.strip(), t.strip())
            assert sum(counts[:3]) == _distance(p.strip(), t.strip())
            want[c] = [x + y for x, y in zip(want.get(c, [0] * 4), counts, strict=True)]
    got = {r.conv_id: r.cer for r in catalogue.cer_by_turn(spark, path).collect()}
    assert got == {c: pytest.approx(sum(n[:3]) / (sum(n) - n[2])) for c, n in want.items()}


def test_long_alignments_are_the_matrix_ones(monkeypatch):
    rng, cases = random.Random(4), []
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 60))]
        b = [rng.choice("abc") for _ in range(rng.randint(1, 60))] if rng.random() < 0.5 else [rng.choice("abc") if rng.random() < 0.1 else x for x in a if rng.random() < 0.9]
        cases.append((a, b))
    a = [rng.randint(0, 999) for _ in range(500)]
    cases.append((a, [x for x in a if x % 9] + [1, 2]))
    monkeypatch.setattr(metrics, "SMALL", 1 << 40)
    want = [metrics.edit_operations(a, b) for a, b in cases]
    monkeypatch.setattr(metrics, "SMALL", 0)
    monkeypatch.setattr(metrics, "MATRIX", 0)
    monkeypatch.setattr(metrics, "BLOCK", 5)
    assert [metrics.edit_operations(a, b) for a, b in cases] == want


def test_very_long_texts_are_aligned():
    rng = random.Random(6)
    a = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    s, d, i, h = metrics.edit_operations(a, a[:100] + "#" + a[101:50_000] + a[50_007:] + "!!")
    assert (s + d + i, s + d + h) == (10, 60_000)


def test_interleave_takes_every_language(spark, tmp_path):
    docs = [(i, ("en", "fr", "de", "es", None)[i % 5]) for i in range(40)]
    rows = catalogue.interleave(spark, _tables(spark, tmp_path, documents=(docs, "doc_id long, lang string"))).collect()
    assert {(r.doc_id, r.lang) for r in rows} == set(docs) and len({r.source for r in rows}) == 5
