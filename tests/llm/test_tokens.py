"""Byte-level BPE and binary shards."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.llm.batches import text_batch
from tidewright.llm.bpe import bpe_decode, bpe_encode, encoder, merge
from tidewright.llm.shards import feistel, read_slots, write_shards

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder(PATH).ranks, special_tokens={})


def check(texts, reference):
    data, offsets = text_batch(pa.array(texts, pa.string()))
    ids, bounds = encoder(PATH).encode(data, offsets)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == reference.encode_ordinary(t or ""), repr(t)[:200]
    decoded, ends = encoder(PATH).decode(ids, bounds)
    assert decoded == data and (ends == offsets).all()


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=list("'strevmld  \n\t\r AÉ9½ 中.-!́\x85\x1c"), max_size=30), st.text(max_size=20)), max_size=6))
def test_equals_tiktoken(texts):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder(PATH).ranks, special_tokens={})
    check(texts, own)


def test_every_code_point(reference):
    points = [c for c in range(0, 0x110000, 3) if not 0xD800 <= c < 0xE000]
    check(["".join(map(chr, points[i : i + 64])) for i in range(0, len(points), 64)], reference)


def test_long_pieces(reference):
    check(["a" * 20000, " " * 5000 + "x", "ab" * 5000 + "'ll", "'s't're", "x's 's ''s", None, ""], reference)
    assert merge(b"", encoder(PATH).ranks) == []


def test_round_trip(spark):
    rows = [(1, "héllo 'll wörld\n\n  x"), (2, None), (3, ""), (None, "x"), (3, "y"), (4, "  " * 3000)]
    out = bpe_decode(bpe_encode(spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)), PATH), PATH).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in out), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert all(r.n_tokens * 4 == len(r.ids) for r in out)
    assert bpe_encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_feistel_is_a_permutation():
    for n in (0, 1, 2, 3, 7, 64, 65, 5000):
        a = feistel(np.arange(n), n, "k")
        assert sorted(a.tolist()) == list(range(n))
    assert (feistel(np.arange(5000), 5000, "k") != feistel(np.arange(5000), 5000, "l")).any()


def test_shards(spark, reference):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["hello", "wörld", "x"]) for _ in range(rng.randint(0, 60)))) for i in range(50)] + [(50, None), (None, "null id"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    shards, index = write_shards(df, PATH, "k", length=8, per_shard=10)
    held, found = {r.slot: bytes(r.ids) for r in read_slots(shards).collect()}, index.collect()
    assert sorted(held) == sorted(r.slot for r in found) == list(range(len(held)))
    assert all(r.n_slots == 10 and len(r.payload) == 10 * 8 * 2 and r.first_slot == 10 * r.shard for r in shards.orderBy("shard").collect()[:-1])
    texts = {}
    for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.seq)):
        if r.doc_id != 3:
            texts.setdefault(r.doc_id, []).extend(np.frombuffer(held[r.slot], dtype="<u2")[: r.n_tokens].tolist())
    assert texts == {i: reference.encode_ordinary(t) for i, t in rows if t and i != 3}
    none, index = write_shards(df.limit(0), PATH, "k")
    assert none.collect() == [] and index.collect() == []


def test_order_does_not_depend_on_splits(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(20)]), " ".join(rng.choice(["hello", "wörld", "x"]) for _ in range(rng.randint(0, 40)))) for _ in range(120)] + [(3, "tie"), (3, "tie"), (4, None)]
    found = []
    for n in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n).withColumn("part", F.lit("clash")).withColumn("row", F.lit(1))
        shards, index = write_shards(df, PATH, "k", length=8, per_shard=10)
        found.append((sorted((r.slot, bytes(r.ids)) for r in read_slots(shards).collect()), sorted(map(repr, index.collect()))))
    assert found[0] == found[1] and len(found[0][0]) > 100


def test_exported_shards_are_resumed(spark, tmp_path):
    from tidewright.llm.shards import export_shards, resume

    rows = [(i, f"word{i} " * (i % 7)) for i in range(60)] + [(70, "\n\r\0" * 40)]
    shards, _ = write_shards(spark.createDataFrame(rows, "doc_id long, text string"), PATH, "k", length=8, per_shard=10)
    path = str(tmp_path / "out")
    export_shards(shards, path, "k", 8, 10)
    want = sorted((r.slot, bytes(r.ids)) for r in read_slots(shards).collect())
    for slot in (0, 1, 25, len(want) - 1, len(want), 10**6):
        got = resume(spark, path, slot)
        assert sorted((r.slot, bytes(r.ids)) for r in got.collect()) == want[slot:]
    # by arithmetic alone: slot s stands in shard s // 10 at byte (s % 10) * 16
    import glob

    (file,) = glob.glob(f"{path}/shards/shard=2/part-*")
    with open(file, "rb") as f:
        f.seek(5 * 16)
        assert f.read(16) == want[25][1]
    with pytest.raises(Exception):
        export_shards(shards, path, "k", 8, 10)
    empty, _ = write_shards(spark.createDataFrame([], "doc_id long, text string"), PATH, "k")
    export_shards(empty, str(tmp_path / "none"), "k")
    assert resume(spark, str(tmp_path / "none")).collect() == []
