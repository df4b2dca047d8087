"""Trained models and the pipeline's stages against plain Python, on small fixtures."""

from __future__ import annotations

import hashlib
import math
import unicodedata

import corpus_pipeline as P
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import langid, quality, queries

SF = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


def _grams(text):
    """Hashed n-grams of one text, counted one by one."""
    folded = []
    for c in text:
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            folded.append(ord(low) if len(low) == 1 else ord(c))
        elif not folded or folded[-1] != 32:
            folded.append(32)
    out = []
    for order in langid.ORDERS:
        for i in range(len(folded) - order + 1):
            part = folded[i : i + order]
            if any(x != 32 for x in part):
                h = (order * 0x27D4EB2F165667C5 + sum((x + 1) * p for x, p in zip(part, langid._PLACES, strict=False))) & M64
                h = ((h ^ h >> 31) * 0xD6E8FEB86659FD93) & M64
                out.append(h >> (64 - langid.BITS))
    return out


@pytest.mark.parametrize("block", [128, 1, 2])
def test_posteriors(spark, monkeypatch, block):
    monkeypatch.setattr(langid, "LANGUAGES", block)
    rows = [(i, r.text[:300], r.lang) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect())]
    rows += [(100, "  Été! 12 été  ", "fr"), (101, None, "fr"), (102, "?? 77", "en"), (103, "abc", None), (None, "the", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts, docs = {}, {}
    for r in df.where(F.col("doc_id").isNotNull() & ~langid.held_out("doc_id", 4, 2)).collect():
        if r.text is not None and r.lang is not None:
            docs[r.lang] = docs.get(r.lang, 0) + 1
            own = counts.setdefault(r.lang, [0] * (1 << langid.BITS))
            for g in _grams(r.text):
                own[g] += 1
    sums = {x: sum(own) + 0.5 * (1 << langid.BITS) for x, own in counts.items()}
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in langid.language_id(df).collect():
        text = texts[r.doc_id]
        if text is None or not any(unicodedata.category(c)[0] == "L" for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        grams = _grams(text)
        total = {x: math.log(docs[x] / sum(docs.values())) + sum(math.log((own[g] + 0.5) / sums[x]) for g in grams) for x, own in counts.items()}
        best = min(total, key=lambda x: (-total[x], x))
        assert r.lang_pred == best and r.score == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total.values()), abs=1e-9)


def _features(text):
    out, data = [0.0] * (2 * quality._HALF), text.encode()
    shapes = [int(quality._shapes()[b]) for b in data]
    for series, orders, half in ((list(data), (3,), 0), (shapes, (1, 2, 3, 4), 1)):
        for order in orders:
            for i in range(len(series) - order + 1):
                h = order
                for x in series[i : i + order]:
                    h = (h + x) * 0x9E3779B97F4A7C15 & M64
                    h ^= h >> 29
                out[half * quality._HALF + (h >> 52)] += 1
    return out


def test_votes(spark):
    """Each score is the weighted vote of the nearest labelled vectors, found by comparing with all of them one by one."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.withColumn("text", F.substring("text", 1, 400)).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string"))).select("doc_id", "text")
    model = quality.learned(docs, labels)
    scored = quality.score(docs, model).limit(40).collect() + quality.score(docs.where("text is null"), model).collect()
    for r in scored:
        x = [math.log1p(c) * float(w) for c, w in zip(_features(r.text or ""), model.idf, strict=True)]
        for a in (0, quality._HALF):
            length = math.sqrt(sum(v * v for v in x[a : a + quality._HALF]))
            x[a : a + quality._HALF] = [v / length if length else v for v in x[a : a + quality._HALF]]
        v = np.array(x) @ model.axes.astype(np.float64)
        v = v / np.linalg.norm(v) if np.linalg.norm(v) > 0 else v
        near = sorted(((float(v @ m), float(y)) for m, y in zip(model.vectors.astype(np.float64), model.labels, strict=True)), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(0.0, s) ** quality.SHARPNESS for s, _ in near]
        want = sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights) if sum(weights) else model.prior
        assert r.score == pytest.approx(want, abs=2e-3)


def test_repeated_labels_and_texts_are_fitted_alike(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 5) for i in range(30)] + [(3, "another"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 0), (3, 1), (4, 1), (5, None)], "doc_id long, quality int")
    one, two = quality.learned(docs, labels), quality.learned(docs.repartition(7, "text"), labels.repartition(5, "quality"))
    assert one.labels.tolist() == two.labels.tolist() and np.allclose(one.vectors, two.vectors, atol=1e-5)


def _components(rows):
    """Least id of the texts that link, by comparing all sets of five-word shingles."""
    sets = []
    for i, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append((i, {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()))
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i in root}


def test_stages(spark, tmp_path):
    """Each stage on the rows that it gets, against Python, SQL or the reference encoder."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = P.quality_classifier(spark, docs, SF)
    scores = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= quality.THRESHOLD}

    plain = docs.where("n_chars < 6000 and doc_id < 120")
    rows = [(r.doc_id, r.text) for r in plain.collect()]
    rows += [(1000 + i, " ".join(t.split()[: max(1, len(t.split()) * 9 // 10)])) for i, t in rows[:25]]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    ones = P.near_duplicates(spark, table, SF)
    assert sorted(r.doc_id for r in ones.collect()) == sorted(i for i, c in _components(rows).items() if i == c)

    mixed = P.mixing(spark, docs, SF).groupBy("doc_id").count()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, mixed.collect())) == sorted(con.sql(f"SELECT doc_id, copies FROM ({queries.OP5_SQL}) WHERE copies > 0").fetchall())

    coder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in P.byte_level_bpe(spark, docs, SF).collect():
        ids = np.array(coder.encode_ordinary(texts[r.doc_id]), dtype="<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
