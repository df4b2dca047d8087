"""Arrow IPC files, which Spark has no reader for."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read_arrow(spark: SparkSession, folder: str, schema: str, glob: str = "data-*.arrow") -> DataFrame:
    """The rows of Arrow stream or file format files below a folder, a file for a task at least."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for data in part.column(0):
                buffer = data.as_buffer()
                try:
                    table = pa.ipc.open_stream(buffer).read_all()
                except pa.ArrowInvalid:
                    table = pa.ipc.open_file(buffer).read_all()
                yield from table.to_batches(max_chunksize=10_000)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select("content").mapInArrow(run, schema)


def read_local(spark: SparkSession, folder: str, split: str, schema: str) -> DataFrame:
    """A split of a dataset on disk: Arrow files data-*.arrow below folder/split, else Parquet files there, else Arrow files anywhere below the folder."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    own = f"{folder.rstrip('/')}/{split}"

    def there(pattern: str) -> bool:
        place = path(pattern)
        return bool(place.getFileSystem(conf).globStatus(place))

    if there(f"{own}/data-*.arrow"):
        return read_arrow(spark, own, schema)
    if there(f"{own}/*.parquet"):
        return spark.read.schema(schema).parquet(own)
    return read_arrow(spark, folder, schema, "*.arrow")
