"""Row numbers over tables that a sample of ranges doesn't see whole, and what is built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import mix
from tidewright.store import free_name, numbered


def test_numbers_of_a_million_rows_in_one_partition(spark):
    df = spark.range(0, 1_200_000, 1, 1).select((F.col("id") * 7919 % 1_200_000).alias("x"), F.lit("a").alias("row.n"))
    for _ in range(2):
        out = numbered(df, ["x"], "test-rows")
        found = out.agg(F.count(F.lit(1)), F.countDistinct("row_"), F.min("row_"), F.max("row_"), F.count_if(F.col("row_") != F.col("x"))).first()
        assert tuple(found) == (1_200_000, 1_200_000, 0, 1_199_999, 0) and out.columns == ["x", "row.n", "row_"]


def test_batches_and_interleaving_lose_no_row(spark):
    a, b = (spark.range(0, n, 1, 1) for n in (400_000, 100_000))
    sizes = mix.batches(a, ["id"], 60).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), (F.max("id") - F.min("id")).alias("wide"))
    assert sizes.count() == 400_000 // 60 and sizes.where("n <> 60 or wide <> 59").count() == 0
    rows = mix.interleave([a, b], ["id"], 1, [0.5, 0.5]).groupBy("source", "round").count().collect()
    assert {(r.source, r["round"]): r["count"] for r in rows} == {(0, 0): 400_000, **{(1, i): 100_000 for i in range(4)}}


def test_nothing_is_numbered(spark):
    assert numbered(spark.range(0), ["id"], "test-rows").collect() == []
    assert free_name("A", ["a", "A_"]) == "A__"


def test_tables_go_when_nothing_needs_them(spark, tmp_path):
    import os

    from tidewright.store import forget, release, shared_folder, written

    folder = shared_folder(spark)
    table = written(spark.range(5), "kept")
    (path,) = [p for p in os.listdir(folder) if p.startswith("kept-")]
    assert table.count() == 5
    forget(table)
    release(spark)
    assert not os.path.exists(os.path.join(folder, path))


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from tidewright.store import shared_folder

    class Conf:
        @staticmethod
        def get(*_):
            return None

    class Session:
        conf = Conf

        class sparkContext:  # noqa: N801
            master = "yarn"

            @staticmethod
            def getConf():  # noqa: N802
                return Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_few_splits_are_spread(spark):
    from tidewright.store import spread

    cores = spark.sparkContext.defaultParallelism
    one, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 3 * cores)
    assert spread(one).rdd.getNumPartitions() == cores and spread(many) is many and sorted(r.id for r in spread(one).collect()) == list(range(100))
