"""The given tables in the roles of the library's inputs; every value is a whole number so that sums are exact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WAVES = 128  # channels of an event of the embeddings table


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def samples(spark: SparkSession, sf_dir: str, inject: bool = False) -> DataFrame:
    """``feu, entry, channel, sample, amplitude`` from embeddings; ``inject`` adds one pulse to every 16th channel."""
    e = read(spark, sf_dir, "embeddings")
    rows = e.select(F.floor(F.col("vec_id") / WAVES).alias("entry"), (F.col("vec_id") % WAVES).alias("channel"), F.posexplode("embedding").alias("sample", "e"))
    a = F.floor(256 + 1000 * F.col("e").cast("double"))
    if inject:
        bump = F.greatest(F.lit(0), 2400 - 300 * F.abs(F.col("sample") - 20 - F.col("channel") % 8))
        a = F.when(F.col("channel") % 16 == F.col("entry") % 16, F.least(F.lit(4095), a + bump)).otherwise(a)
    return rows.select((F.col("entry") % 2).alias("feu"), "entry", "channel", F.col("sample").cast("long").alias("sample"), a.cast("long").alias("amplitude"))


def events(spark: SparkSession, sf_dir: str, inject: bool = True) -> DataFrame:
    """Event rows with three parallel arrays."""
    return packed(samples(spark, sf_dir, inject))


def packed(rows: DataFrame) -> DataFrame:
    events_ = rows.groupBy("feu", "entry").agg(F.sort_array(F.collect_list(F.struct("channel", "sample", "amplitude"))).alias("s"))
    return events_.select("feu", "entry", F.col("entry").alias("eventId"), (F.col("entry") * 1000).alias("timestamp"), (F.col("entry") % 6).cast("int").alias("ftst"), *[F.col("s").getField(c).alias(c) for c in ("channel", "sample", "amplitude")])


def shaped_samples(spark: SparkSession, sf_dir: str, quiet: bool = False) -> DataFrame:
    """``feu, entry, channel, sample, amplitude``: small noise and, by channel and entry, every kind of pulse.

    One peak, two and three on top of each other, a saturated one, plateaus inside and at the start, and pulses cut by
    either end of the window, one of them saturated; ``quiet`` leaves them out.
    """
    rows = read(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / WAVES).alias("entry"), (F.col("vec_id") % WAVES).alias("channel"), F.posexplode("embedding").alias("sample", "e"))
    a, t = F.floor(256 + 100 * F.col("e").cast("double")), F.col("sample")

    def peak(at, height: int, slope: int):
        return F.greatest(F.lit(0), height - slope * F.abs(t - at))

    shapes = {
        0: a + peak(20 + F.col("channel") % 8, 1600, 300), 1: a + peak(20, 1200, 200) + peak(30, 1000, 200), 2: a + peak(30, 6000, 900),
        3: F.when(F.abs(t - 25) < 8, 256 + F.least(F.lit(1000), 1600 - 200 * F.abs(t - 25))).otherwise(a), 4: a + peak(0, 900, 150), 5: a + peak(63, 900, 150),
        6: a + peak(15, 800, 200) + peak(24, 1200, 200) + peak(33, 900, 200), 7: a + 500 * F.greatest(F.lit(0), t - 52),
        8: F.when(t.between(40, 43), 956).when(t.between(44, 46), 556).otherwise(a),
    }
    v = a
    for k, shape in {} if quiet else shapes.items():
        v = F.when((F.col("channel") + F.col("entry")) % 16 == k, shape).otherwise(v)
    return rows.select((F.col("entry") % 2).alias("feu"), "entry", "channel", t.cast("long").alias("sample"), F.least(F.lit(4095), v).cast("long").alias("amplitude"))


def shaped_events(spark: SparkSession, sf_dir: str, quiet: bool = False) -> DataFrame:
    return packed(shaped_samples(spark, sf_dir, quiet))


def large_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feu, event, channel, sample, amplitude, ord`` from lineitem; a place may occur twice."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_suppkey") % 8).alias("feu"), F.col("l_orderkey").alias("entry"), (F.col("l_partkey") % 512).alias("channel"), F.col("l_linenumber").cast("long").alias("sample"),
        F.col("l_quantity").cast("long").alias("amplitude"), (F.col("l_extendedprice") * 100).cast("long").alias("ord"),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event, channel, pulse_idx, amplitude, time`` from events."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.floor(F.col("event_id") / 8).alias("event"), (F.col("event_id") * 37 % 128).alias("channel"), F.col("event_id").alias("pulse_idx"),
        F.floor(F.col("value") * 100).cast("long").alias("amplitude"), (F.col("event_id") * 7 % 25).cast("double").alias("time"),
    )


def strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strip map from parts; sizes go from 1 to 50, so channels 0 and 51 to 63 of each connector have no strip."""
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(
        k.alias("line_no"), (k % 2).alias("connector"), F.col("p_size").alias("connectorChannel"), F.when(F.floor(k / 2) % 2 == 0, "x").otherwise("y").alias("axis"),
        (k % 10).cast("double").alias("x"), (k % 7).cast("double").alias("y"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence of frames from events: a file for each event type, ids that change with the user."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("file"), F.col("event_id").alias("frame_idx"), F.floor(F.col("event_id") / 40).alias("event_id"), (F.col("user_id") % 32).alias("sample_id"),
        (F.col("event_id") % 7 == 0).alias("eoe"), (F.col("user_id") % 5).alias("n_data"), (F.col("event_id") % 3 == 0).alias("zs"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "ok").otherwise("running")
    return o.select(
        F.concat("o_orderpriority", F.lit(":"), F.col("o_orderkey").cast("string")).alias("key"), status.alias("status"), F.floor("o_totalprice").cast("double").alias("secs"),
        F.floor(F.col("o_totalprice") / 10).cast("long").alias("bytes"), (F.col("o_custkey") % 3).alias("rc"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of data and pedestal files from lineitem and part."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 12).alias("feu"))
    kind = F.when(F.col("k") % 10 == 0, "pedthr").otherwise("datrun")
    run = F.concat(F.lit("run_"), (F.col("k") % 50).cast("string"))
    num = F.lpad((F.floor(F.col("k") / 50) % 1000).cast("string"), 3, "0")
    name = F.concat(F.lit("/data/"), run, F.lit("/det_123_45_"), kind, F.lit("_x_"), num, F.lit("_"), F.lpad(F.col("feu").cast("string"), 2, "0"), F.lit(".fdf"))
    return o.select(run.alias("run"), name.alias("path"), F.col("k").alias("length"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select((F.col("l_partkey") * 31 % 65536).cast("int").alias("w"), (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k"))


def encoded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame files built from events, a file for 500 of them: ``path, file_num, feu, content``.

    Sparse frames carry a few channels; every 11th frame is dense, with one block of 64 words, or of 63 now and then.
    """
    e, event = read(spark, sf_dir, "events"), F.col("event_id")
    dense = event % 11 == 0

    def words(*w):
        return F.array(*[(x if hasattr(x, "cast") else F.lit(x)).cast("int") for x in w])

    number = F.floor(event / 40)
    head = words(24576 + F.when(dense, 7).otherwise(0x407), 24576 + number % 4096, 24576 + event % 4096, 24576 + F.col("user_id") % 32 * 8 + event % 8, 24576 + F.floor(number / 4096), 24576, 24576, 24576)
    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.col("user_id") % 5), lambda j: words(4096 + F.floor((event * 7 + j) % 512 / 64) * 64 + (event * 7 + j) % 64, (event * 13 + j * 101) % 4096)))
    sparse = F.when(F.col("user_id") % 5 > 0, pairs).otherwise(F.array().cast("array<int>"))
    block = F.transform(F.sequence(F.lit(1), F.when(event % 33 == 0, 63).otherwise(64)), lambda j: ((event * 3 + j * 17) % 4096).cast("int"))
    body = F.when(dense, F.concat(words(8192, 8192, 8192, 8192 + event % 8 * 512), block, words(16384))).otherwise(sparse)
    tail = words(28672 + F.when(event % 7 == 0, 2048).otherwise(0), 4660)
    hexed = F.array_join(F.transform(F.concat(head, body, tail), lambda w: F.lpad(F.hex(w), 4, "0")), "")
    files = e.select(F.floor(event / 500).cast("int").alias("file_num"), event.alias("k"), hexed.alias("hexed")).groupBy("file_num")
    whole = files.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "hexed"))), lambda x: x.hexed), "").alias("hexed"))
    return whole.select(F.concat(F.lit("/f_"), F.col("file_num").cast("string")).alias("path"), "file_num", (F.col("file_num") % 4).cast("int").alias("feu"), F.unhex("hexed").alias("content"))


def chip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a chip configuration from suppliers: units and ``*``, known and unknown codes, comments, short lines."""
    s, k = read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    unit = F.when(k % 5 == 0, "*").otherwise((k % 7).cast("string"))
    line = F.concat(F.lit("Feu "), unit, F.lit(" Dream * "), (k % 3).cast("string"), F.lit(" 0x0 0x"), F.hex(k * 29 % 256), F.when(k % 4 == 0, " # slow").otherwise(""))
    return s.select(k.alias("line_no"), F.when(k % 13 == 0, F.concat(F.lit("# "), line)).when(k % 17 == 0, "Feu 1 Dream").otherwise(line).alias("value"))
