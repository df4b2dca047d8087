"""The pipeline's stages, each on its own input."""

from __future__ import annotations

import re

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
PII = re.compile(r"\+1 \(\d{3}\) 555-\d{4}|[a-z]+\.\d+@mail\d+\.example\.com")


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), name)
        out.append((name, docs))
    return out


def test_stages(spark, steps):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in steps] == ["quality_classifier", "near_duplicates", "pii", "mixing", "byte_level_bpe"]
    assert all(df.columns == columns for _, df in steps[:-1])


def test_decisions_take_effect(spark, steps):
    by = dict(steps)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < by["quality_classifier"].count() < docs.count()
    kept = by["near_duplicates"]
    again = P.near_duplicates(spark, kept, SF)
    assert again.count() == kept.count() < by["quality_classifier"].count()
    before = [r.text for r in kept.collect() if PII.search(r.text)]
    after = {m for r in by["pii"].collect() for m in PII.findall(r.text)}
    assert before and not after & {m for t in before for m in PII.findall(t)}
    assert by["pii"].where("n_chars <> length(text)").count() == 0
    mixed = by["mixing"].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 3
    last = by["byte_level_bpe"]
    want = by["mixing"].select("doc_id", F.sha2("text", 256).alias("decoded_sha256"))
    assert sorted(map(tuple, last.select("doc_id", "decoded_sha256").collect())) == sorted(map(tuple, want.collect()))


NAMES = ["size", "a.b", "copies", "id_", "n_entities", "key_", "TEXT_MD5", "quality_score_", "gone"]


def test_nulls_and_extra_columns(spark):
    own = ["x"] * len(NAMES)
    rows = [(1, "a b c d e f g", "en", "s", 13, *own), (1, "a b c d e f g", "en", "s", 13, *own), (1, "quite another text of this very id", "en", "s", 34, *own)]
    rows += [(2, "a b c d e f g", None, None, None, *own), (None, None, None, None, None, *own), (3, "", "en", "s", 0, *own), (4, "word " * 100_000, "en", "s", 500_000, *own), (None, "+1 212 555 0101", None, "s", 15, *own)]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"`{n}` string" for n in NAMES]]))
    kept = P.near_duplicates(spark, df, SF)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 1, 3, 4, None, None]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        assert all(list(r[5:]) == own for r in out.collect())
        assert stage(spark, df.limit(0), SF).count() == 0
    texts = {r.text for r in P.pii(spark, df, SF).where("doc_id is null").collect()}
    assert None in texts and "+1 212 555 0101" not in texts
    assert P.byte_level_bpe(spark, df, SF).count() == len(rows) and P.byte_level_bpe(spark, df.limit(0), SF).count() == 0
