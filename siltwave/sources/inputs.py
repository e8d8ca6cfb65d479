"""Hit tables of many files as one scan, with a table of what each file is good for."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import file_system

#: What a column may have been written as, so that Spark's reader can take it as the type on the left.
READABLE_AS = {
    "int": ("int8", "int16", "int32", "uint8", "uint16"), "bigint": ("int8", "int16", "int32", "int64", "uint8", "uint16", "uint32"),
    "double": ("float", "double", "int8", "int16", "int32"), "boolean": ("bool",), "string": ("string", "large_string"),
}
#: Columns that older hit tables lack, and what stands for them.
LATER = {"trunc_left": False, "trunc_right": False, "significance": -1.0}
HEALTH = "path string, feu int, readable boolean, usable boolean, rows bigint, old boolean, reason string"


def plain_path(path):
    """A path as Spark gives it in ``_metadata.file_path`` and in listings, without the scheme of local files."""
    return F.regexp_replace(path, "^file:/*", "/")


def fields_of(schema: str) -> dict[str, str]:
    return dict(x.strip().split(" ") for x in schema.split(","))


def footer(path: str) -> pq.FileMetaData:
    """The footer of a Parquet file on any file system that Arrow knows; nothing else of it is read."""
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as f:
        return pq.ParquetFile(f).metadata


def looked_at(path: str, wanted: dict[str, str], needed: tuple[str, ...]) -> tuple:
    """``readable, usable, rows, old, reason`` of one file."""
    try:
        meta = footer(path)
    except (OSError, pa.ArrowException) as e:
        return False, False, None, None, type(e).__name__
    own = {f.name: str(f.type) for f in meta.schema.to_arrow_schema()}
    missing = [c for c in needed if c not in own]
    if missing:
        return True, False, meta.num_rows, None, "lacks " + ", ".join(missing)
    odd = [c for c, kind in wanted.items() if c in own and own[c] not in READABLE_AS[kind]]
    if odd:
        return True, False, meta.num_rows, None, "other type: " + ", ".join(odd)
    return True, True, meta.num_rows, any(c in wanted and c not in own for c in LATER), None


def health(inputs: DataFrame, schema: str, needed: tuple[str, ...] = ("channel", "amplitude"), tasks: int | None = None) -> DataFrame:
    """One row for each of ``inputs`` (``path, feu``): can the file be read, is it a table of hits, how many rows has it.

    Footers are read in tasks, so neither the driver nor the plan grows with the number of files. A file that is missing, empty or
    broken isn't readable; one without the ``needed`` columns, or with a column of another type, isn't usable; ``old`` says that
    it lacks columns that came later. A path that is listed twice, with one unit or two, is looked at twice.
    """
    wanted = fields_of(schema)
    spark = inputs.sparkSession
    spread = inputs.select("path", F.col("feu").cast("int").alias("feu")).repartition(tasks or 4 * spark.sparkContext.defaultParallelism)

    def run(batches):
        for b in batches:
            found = [looked_at(p, wanted, needed) if p else (False, False, None, None, "no path") for p in b.column("path").to_pylist()]
            readable, usable, rows, old, reason = zip(*found) if found else ([],) * 5
            kinds = (pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.string())
            arrays = [pa.array(x, k) for x, k in zip((readable, usable, rows, old, reason), kinds)]
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("feu"), *arrays], [x.split(" ")[0] for x in HEALTH.split(", ")])

    return spread.mapInArrow(run, HEALTH)


def read_inputs(spark: SparkSession, found: DataFrame, schema: str) -> DataFrame:
    """All rows of the usable files of a health table in one scan, with each file's ``path`` and unit.

    The union has one scan however many files it takes; only their paths pass through the driver, where Spark keeps its list of
    files anyway. Columns that older files lack get false, false and -1; a null in a file that has the column stays null.
    A file that is listed for two units gives its rows to both. No usable file gives no rows.
    """
    usable = found.filter("usable")
    paths = [r.path for r in usable.select(plain_path("path").alias("path")).distinct().toLocalIterator()]
    columns = fields_of(schema)
    if not paths:
        hits = spark.createDataFrame([], schema).withColumn("path", F.lit(""))
    else:
        hits = spark.read.schema(schema).parquet(*paths).withColumn("path", plain_path(F.col("_metadata.file_path")))
    known = usable.select(plain_path("path").alias("path"), F.col("feu"), "old")
    rows = hits.drop("feu").join(known, "path")
    filled = {c: F.when(F.col("old"), F.coalesce(F.col(c), F.lit(v))).otherwise(F.col(c)) for c, v in LATER.items() if c in columns}
    return rows.withColumns(filled).drop("old")
