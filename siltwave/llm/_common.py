"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.files import scratch_dir


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the session's jobs have written; tables and DataFrames that read it are of no use afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: what follows survives lost executors.

    The shuffle files of the write are dropped as soon as it ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with columns c0, c1, ... and its schema as text, since Arrow functions fail on names with dots."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)


def lean_memory() -> None:
    """Arrow memory of this process comes from the system, to which it goes back at once; workers live long."""
    pa.set_memory_pool(pa.system_memory_pool())


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python strings, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def pieces(batches, max_bytes: int = 8 << 20, name: str = "text"):
    """Cut Arrow batches so that each piece holds about ``max_bytes`` of text, or one document."""
    for batch in batches:
        if batch.num_rows and batch.nbytes <= max_bytes:
            yield batch
            continue
        start, held = 0, 0
        sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column(name).cast(pa.large_binary())]
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
