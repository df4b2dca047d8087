"""Tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Paths of tables that are still there, with their sessions.
_KEPT: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a local session gets a temporary one; on a cluster it is an error."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", place)
        atexit.register(shutil.rmtree, place, True)
    return place.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet; what is there when the driver's process ends is deleted."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _KEPT:
        atexit.register(_forget_all)
    _KEPT[path] = spark
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: short lineage that survives lost executors.

    What ``forget`` has not deleted by then goes when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewright_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing needs any more."""
    for df in tables:
        _delete(df.sparkSession, df._tidewright_path)
        _KEPT.pop(df._tidewright_path, None)


def _forget_all() -> None:
    for path, spark in _KEPT.items():
        try:
            _delete(spark, path)
        except Exception:  # the session has ended before the process: nothing can be deleted through it
            return


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more; else they stay on disk until the driver happens to collect garbage.

    Spark's own threads refer to the plan that ran last, so a plan without files has to be that one.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all cores where it has fewer splits than there are cores, as a file of one row group has; else as it is.

    For costly work on each row. Tables of many splits, which is all large ones, are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with as many underscores after it as make it unlike any of ``taken``, whatever the case."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def col(name: str):
    """The column of that very name, which may hold dots and backquotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame, order: list[str], name: str, row: str = "row_") -> DataFrame:
    """df with ``row``, its rows' numbers from 0 in that order. Nothing is gathered.

    The rows are dealt by range and sorted once, and written with their places. From
    the written table come both the sizes of the ranges and the rows, so a second
    evaluation that cuts other ranges can't part them.
    """
    part, at, n, first = (free_name(x, df.columns) for x in ("part__", "at__", "n__", "first__"))
    ranged = df.repartitionByRange(*[col(c) for c in order]).sortWithinPartitions(*[col(c) for c in order])
    held = written(ranged.withColumn(at, F.monotonically_increasing_id()), name)
    held = held.withColumn(part, F.shiftright(col(at), 33)).withColumn(at, col(at).bitwiseAND(F.lit((1 << 33) - 1)))
    # a row for each range
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy(part).agg(F.count(F.lit(1)).alias(n)).select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    return held.join(sizes, part).withColumn(row, col(first) + col(at)).drop(part, at, first)
