"""Sources and sinks: frame files, tables, strip maps, configurations, listings; and the decode job."""

from __future__ import annotations

import fnmatch
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.bits import CLASSES, FIELDS
from ..operators import loss
from ..operators.catalog import catalogue


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this session in the one that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a fresh local one; on a cluster executors would write where nobody reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.siltwave.scratch", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-siltwave-")
        spark.conf.set("spark.siltwave.scratch", base)
    return f"{base.rstrip('/')}/siltwave-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the scratch folder, read back: made once, and safe from lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(path: str):
    """The Arrow file system of a path (local, HDFS, S3, GCS, ABFS), for tasks that read a part of a file, and the path in it."""
    return arrow_fs.FileSystem.from_uri(path if "://" in path else "/" + path.removeprefix("file:").lstrip("/"))


def list_files(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(base).select("path", "length", "modificationTime")


def read_frames(spark: SparkSession, paths: list[str], glob: str = "*.fdf") -> DataFrame:
    """One row for each frame file that isn't empty, with file number and unit from its name."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true").load(paths)
    return catalogue(raw.filter("length > 0").select("path", "content"))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table by its fixed schema; files of another schema fail rather than vanish."""
    return spark.read.schema(schema).parquet(path)


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, order: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in ``buckets`` by ``keys``, sorted by them and ``order``, read back.

    Tables with equal buckets join and group by ``keys`` without a shuffle. The table lies in the scratch folder under a name of its own.
    """
    name = f"siltwave_{uuid.uuid4().hex}"
    out = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *order)
    out.option("path", f"{scratch_dir(df.sparkSession)}/{name}").saveAsTable(name)
    return df.sparkSession.table(name)


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ("run", "sub_run", "file_num"), page_rows: int = 200) -> None:
    """Parquet, in folders by file and never by event; rows of one file go together so that files stay few.

    Tables of entries are sorted by unit and entry, with pages of ``page_rows`` rows, so that a condition on ``entry`` (such as the
    first 200 of a file, which tell whether it is sparse) reads a few pages by the page index, however long the file is.
    """
    own = [c for c in by if c in df.columns]
    out = df.repartition(*own) if own else df
    if "entry" in df.columns:
        out = out.sortWithinPartitions(*own, *[c for c in ("feu", "entry") if c in df.columns])
    out.write.mode("overwrite").option("parquet.page.row.count.limit", page_rows).partitionBy(*own).parquet(path)


def read_strip_map(spark: SparkSession, path: str) -> DataFrame:
    """The strip map: blank lines go, the first line left is the header, lines with fewer than 9 columns go.

    One such file describes one detector: a few hundred lines.
    """
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    rows = lines.withColumn("rank", F.row_number().over(W.orderBy("line_no"))).filter("rank > 1").withColumn("c", F.split("value", ",")).filter(F.size("c") >= 9)
    c = lambda i: F.trim(F.col("c")[i])
    neighbours = F.transform(F.filter(F.split(c(6), ":"), lambda x: x != ""), lambda x: x.cast("int"))
    return rows.select(
        "line_no", c(0).cast("int").alias("connector"), c(1).cast("int").alias("connectorChannel"), c(2).cast("int").alias("stripNumber"), c(3).alias("axis"),
        c(4).cast("double").alias("pitch"), c(5).cast("double").alias("interpitch"), neighbours.alias("neighbours"), c(7).cast("double").alias("x"), c(8).cast("double").alias("y"),
    )


def spread(df: DataFrame, key: str, rows: int = 1000) -> DataFrame:
    """``df``, each row of which stands for a file to open, dealt by ``key`` over tasks of about ``rows`` rows, however few bytes these are."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, df.count() // rows + 1)
    return df.repartition(min(n, 10_000), key)


def read_run_config(spark: SparkSession, runs: DataFrame, path: str, glob: str = "run_config.json") -> DataFrame:
    """``runs`` (with ``run``) and four settings from the file in ``path``/<run>.

    A missing file or key gives 60 ns, false, false and null. Each task opens the files of its own runs, so that neither a listing
    of all runs nor a single task has to go through them.
    """
    fs, inner = file_system(path)
    if fs.get_file_info(inner).type != arrow_fs.FileType.Directory:
        raise FileNotFoundError(path)

    def content_of(fs, file: str) -> bytes:
        with fs.open_input_file(file) as f:
            return f.readall()

    def run(batches):
        fs, inner = file_system(path)
        for b in batches:
            names, texts = [], []
            for name in b.column("run").to_pylist():
                found = [] if name is None else fs.get_file_info(arrow_fs.FileSelector(f"{inner}/{name}", allow_not_found=True))
                own = [x.path for x in found if x.type == arrow_fs.FileType.File and x.base_name[0] not in "._" and fnmatch.fnmatchcase(x.base_name, glob)]
                for file in own or [None]:
                    names.append(name)
                    texts.append(None if file is None else content_of(fs, file))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["run", "content"])

    settings = "sample_period:double,zero_suppress:boolean,pedestal_subtraction:boolean,daq_config_template_path:string"
    read = spread(runs.select(F.col("run").cast("string").alias("run")), "run").mapInArrow(run, "run string, content binary")
    d = read.select("run", F.from_json(F.col("content").cast("string"), f"dream_daq_info struct<{settings}>").getField("dream_daq_info").alias("d"))
    return d.select(
        "run", F.coalesce("d.sample_period", F.lit(60.0)).alias("sample_period"), F.coalesce("d.zero_suppress", F.lit(False)).alias("zero_suppress"),
        F.coalesce("d.pedestal_subtraction", F.lit(False)).alias("pedestal_subtraction"), F.col("d.daq_config_template_path").alias("daq_config_template_path"),
    )


def read_config_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")


def read_combine_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=" ", schema="path string, feu int")


FRAMES = "path string, file_num int, feu int, frame_idx bigint, event_id bigint, timestamp bigint, sample_id bigint, ftst int, zs boolean, eoe boolean, bad_blocks int, n_data bigint, channel array<int>, amplitude array<int>"
ENTRIES = "path string, file_num int, feu int, entry bigint, reason bigint, eventId bigint, timestamp bigint, ftst int, n_frames bigint, seen array<int>, any_zs boolean, any_raw boolean, bad_blocks bigint, sample array<int>, channel array<int>, amplitude array<int>"


class Words:
    """The 16-bit words of a file with the ends of their runs by class; two bytes a word and one for its class."""

    HEAD, TRAILER, OPENS, DATA, OTHER = range(5)

    def __init__(self, content: bytes):
        self.w = np.frombuffer(content[: len(content) // 2 * 2], ">u2").astype(np.uint16)
        self.kind = np.full(len(self.w), self.OTHER, np.uint8)
        for code, name in ((self.DATA, "data"), (self.OPENS, "data_header"), (self.TRAILER, "final_trailer"), (self.HEAD, "header")):
            mask, shift, value = CLASSES[name]
            self.kind[(self.w & np.uint16(mask)) == value << shift] = code
        self.ends = np.append(np.flatnonzero(self.kind[1:] != self.kind[:-1]) + 1, len(self.w))
        self.heads = np.append(np.flatnonzero(self.kind == self.HEAD), len(self.w))
        self.stops = np.append(np.flatnonzero((self.kind == self.HEAD) | (self.kind == self.TRAILER)), len(self.w))

    def run_end(self, at: int) -> int:
        return int(self.ends[np.searchsorted(self.ends, at, side="right")])

    def next_head(self, at: int) -> int:
        return int(self.heads[np.searchsorted(self.heads, at)])


def field_of(x, name: str):
    mask, shift = FIELDS[name]
    return (x & mask) >> shift


def decode_words(content: bytes):
    """Frames of one file: header fields, the end marker, and channels with amplitudes.

    A frame begins with a run of header words and ends with its final trailer, after which one word is skipped. Blocks
    are found by the ends of runs of one word class: in sparse frames pairs of words, in dense ones the words between
    data headers and trailers. ``cut`` says that the words ended before the frame did.
    """
    words = Words(content)
    w, kind, n = words.w, words.kind, len(words.w)
    at = words.next_head(0)
    while at < n:
        i = words.run_end(at)
        h = np.zeros(8, np.int64)
        h[: min(8, i - at)] = w[at : min(i, at + 8)]
        part = field_of(h, "event_part")
        frame = {
            "event_id": int(part[1] + (part[4] << 12)), "timestamp": int(part[2] + (part[5] << 12) + (part[6] << 24) + ((h[7] & 0xFF) << 36)),
            "sample_id": int(((h[0] & 0x800) >> 3) + field_of(h[3], "sample_id")), "ftst": int(h[3] & 7), "zs": bool(field_of(h[0], "zs")),
        }
        channels, values, bad, ended, cut = [], [], 0, False, True
        while i < n and kind[i] != words.HEAD:
            if kind[i] == words.TRAILER:
                ended, cut = bool(field_of(int(w[i]), "end_of_event")), False
                i += 2
                break
            if frame["zs"] and kind[i] == words.DATA and i + 1 < n:
                stop = words.run_end(i)
                pairs = max(1, (stop - i) // 2)  # the second word of a pair is taken whatever its class
                own = w[i : i + 2 * pairs].astype(np.int32)
                channels.append(field_of(own[0::2], "chip_zs") * 64 + field_of(own[0::2], "channel"))
                values.append(field_of(own[1::2], "adc"))
                i += 2 * pairs
            elif not frame["zs"] and kind[i] == words.OPENS:
                first, i = i, words.run_end(i)
                chip = int(field_of(int(w[first + 3]), "chip_raw")) if i - first >= 4 else 0
                first = i
                if i < n and kind[i] == words.DATA:
                    i = words.run_end(i)
                bad += i - first != 64
                channels.append(chip * 64 + np.arange(i - first, dtype=np.int32))
                values.append(field_of(w[first:i].astype(np.int32), "adc"))
            else:
                i += 1
        empty = np.zeros(0, np.int32)
        yield frame | {"eoe": ended, "cut": cut and i >= n, "bad_blocks": bad, "channel": np.concatenate([empty, *channels]), "amplitude": np.concatenate([empty, *values])}
        at = words.next_head(min(i, n))  # a file may end with a trailer


def closed_entries(frames):
    """The entries of one file's frames in order, each as (reason, its frames); frames left over come with None.

    An entry closes with the end marker (0), before another event id (1) or with the file (2), the latter two only
    where it has data.
    """
    held: list[dict] = []
    n_data = 0
    for f in frames:
        if n_data and f["event_id"] != held[-1]["event_id"]:
            yield 1, held
            held, n_data = [], 0
        held.append(f)
        n_data += len(f["channel"])
        if f["eoe"]:
            yield 0, held
            held, n_data = [], 0
    if held:
        yield (2 if n_data else None), held


def _batches(rows, schema: str, most: int, size):
    """Row dictionaries as Arrow batches of at most ``most`` values of the arrays."""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    types = dict(x.split(" ") for x in schema.split(", "))
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    held, n = [], 0

    def batch():
        columns = []
        for c in names:
            values = [r[c] for r in held]
            if types[c] == "array<int>":
                stops = np.cumsum([0, *map(len, values)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32))))
            else:
                columns.append(pa.array(values, kinds[types[c]]))
        return pa.RecordBatch.from_arrays(columns, names)

    for r in rows:
        held.append(r)
        n += size(r)
        if n >= most:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _per_file(files: DataFrame, rows_of, schema: str) -> DataFrame:
    def run(batches):
        def rows():
            for b in batches:
                for i in range(b.num_rows):
                    key = {c: b.column(c)[i].as_py() for c in ("path", "file_num", "feu")}
                    for r in rows_of(b.column("content")[i].as_py() or b""):
                        yield key | r

        yield from _batches(rows(), schema, 1 << 20, lambda r: 64 + len(r["channel"]))

    return files.select("path", "file_num", "feu", "content").mapInArrow(run, schema)


def decode(files: DataFrame) -> DataFrame:
    """One row for each frame of each file; a file can't be cut, since payload words can look like headers.

    Frames leave in small batches; nothing is shuffled.
    """

    def rows_of(content):
        for k, f in enumerate(decode_words(content)):
            yield f | {"frame_idx": k, "n_data": len(f["channel"])}

    return _per_file(files, rows_of, FRAMES)


def decode_events(files: DataFrame) -> DataFrame:
    """One row for each event of each file, with what the loss accounting needs, in one pass and without a shuffle.

    A file is read in order, so its events are numbered on the way and no window over frames is needed. Frames at the
    end of a file that belong to no event come as one row with a null entry and without samples.
    """

    def rows_of(content):
        for k, (reason, own) in enumerate(closed_entries(decode_words(content))):
            last = own[-1]
            n = [len(f["channel"]) for f in own]
            yield {
                "entry": None if reason is None else k, "reason": reason, "eventId": last["event_id"], "timestamp": last["timestamp"], "ftst": last["ftst"], "n_frames": len(own),
                "seen": sorted({f["sample_id"] for f in own}), "any_zs": any(f["zs"] for f in own), "any_raw": not all(f["zs"] for f in own), "bad_blocks": sum(f["bad_blocks"] for f in own),
                "sample": np.repeat([f["sample_id"] for f in own], n), "channel": np.concatenate([f["channel"] for f in own]), "amplitude": np.concatenate([f["amplitude"] for f in own]),
            }

    return _per_file(files, rows_of, ENTRIES)


def write_decoded(entries: DataFrame, path: str, file: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write events, loss figures and sample acceptance of decoded files below ``path``, and read all three back.

    The files are decoded once; the accounting reads the written table without its samples.
    """
    spark, schema = entries.sparkSession, entries.schema
    entries.write.mode("overwrite").parquet(f"{path}/entries")
    written = spark.read.schema(schema).parquet(f"{path}/entries")
    found = written.withColumnRenamed("eventId", "event_id")
    loss.decode_stats(found, file).write.mode("overwrite").parquet(f"{path}/decode_stats")
    loss.sample_acceptance(found, file).write.mode("overwrite").parquet(f"{path}/sample_acceptance")
    events = written.filter("entry is not null").select(*file, "entry", "eventId", "timestamp", "ftst", "sample", "channel", "amplitude")
    return events, spark.read.parquet(f"{path}/decode_stats"), spark.read.parquet(f"{path}/sample_acceptance")
