"""The queries of the subpackage against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from tidewright.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = queries.queries()[name](spark, DATA)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_near_vectors_against_sql(spark, tmp_path):
    """Vectors that do link, for the driver's tables hold few."""
    import numpy as np

    rng = np.random.default_rng(3)
    v = np.repeat(rng.standard_normal((40, 16)), 5, axis=0) + rng.standard_normal((200, 16)) * 0.1
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)] + [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    for name, sql in (("op8_embedding_near_dedup", queries.OP8_SQL),):
        df, want = queries.queries()[name](spark, str(tmp_path)), con.sql(sql)
        found = want.fetchall()
        assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, found)) and sum(r[1] for r in found) > 200
