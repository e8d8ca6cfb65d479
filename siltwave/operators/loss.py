"""Event assembly from frames, and the accounting of what was lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_IDS = 1024  # greater ids are counted nowhere


def assemble(frames: DataFrame, file: list[str], chunk: int = 1 << 16) -> DataFrame:
    """``frames`` with ``entry`` and ``reason``: how the entry that a frame belongs to was closed.

    An entry ends with a frame that has the end marker (0), before a frame of another event id (1), or with the file
    (2); the latter two only where it has data. So frames without data run on into the next entry, and those at the end
    of a file belong to none: their entry and reason are null. ``frames`` has ``frame_idx, event_id, eoe, n_data``. The
    decode job does the same as it reads a file; this form is for frames that come as a table.

    A file is cut into chunks of ``chunk`` frame numbers, so one long file spreads over all tasks, and frames are shuffled
    once, by file and chunk. Each chunk gives one row to a small table, in which what crosses the cuts (the last event id, data
    of an entry that is still open, the number of entries so far, the next entry's reason) is carried along the file.
    """
    part = [*file, "chunk"]
    order = W.partitionBy(*part).orderBy("frame_idx")
    cut = F.lag("eoe").over(order) | (F.lag("event_id").over(order) != F.col("event_id"))  # null for a chunk's first frame
    rows = frames.withColumn("chunk", F.floor(F.col("frame_idx") / chunk)).withColumn("cut", cut)
    rows = rows.withColumn("run", F.sum(F.coalesce(F.col("cut").cast("int"), F.lit(0))).over(order))  # 0: may go on from the chunk before
    rows = rows.withColumn("total", F.sum("n_data").over(order))
    begun = F.last(F.when(F.col("cut"), F.col("total") - F.col("n_data")), ignorenulls=True).over(order)
    rows = rows.withColumn("data", F.col("total") - F.coalesce(begun, F.lit(0)))  # of the run so far
    carried = _carry(_chunk_rows(rows, part), file)
    rows = rows.join(carried, part)
    follows = F.lead("cut").over(order)
    ends = F.coalesce(follows, F.col("cut_after"))
    data = F.col("data") + F.when(F.col("run") == 0, F.col("open_data")).otherwise(0) > 0
    closes = F.when(ends, F.when(F.col("eoe"), 0).when(data & follows.isNull() & F.col("last"), 2).when(data, 1)).cast("long")
    rows = rows.withColumn("closes", closes)
    back = W.partitionBy(*part).orderBy(F.desc("frame_idx")).rowsBetween(W.unboundedPreceding, W.currentRow)  # a frame to the end would be run through for each row
    reason = F.coalesce(F.last("closes", ignorenulls=True).over(back), F.col("next_reason"))
    before = F.count("closes").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumns({"reason": reason, "number": F.col("entries") + before})
    return rows.select(*frames.columns, F.when(F.col("reason").isNotNull(), F.col("number")).alias("entry"), "reason")


def _chunk_rows(rows: DataFrame, part: list[str]) -> DataFrame:
    """One row for each chunk: its ends, the data of its first and its last run of frames, and the closes of the runs between."""
    runs = rows.groupBy(*part, "run").agg(
        F.min("frame_idx").alias("at"), F.min_by("event_id", "frame_idx").alias("first_id"), F.max_by("event_id", "frame_idx").alias("last_id"),
        F.max_by("eoe", "frame_idx").alias("ended"), F.sum("n_data").alias("n"),
    )
    last = F.max("run").over(W.partitionBy(*part))
    runs = runs.withColumn("last_run", last)
    inner = (F.col("run") > 0) & (F.col("run") < F.col("last_run"))
    closes = F.when(inner, F.when(F.col("ended"), 0).when(F.col("n") > 0, 1))
    own = lambda c, cond: F.max(F.when(cond, F.col(c)))
    head, tail = F.col("run") == 0, F.col("run") == F.col("last_run")
    return runs.withColumn("closes", closes).groupBy(*part).agg(
        own("first_id", head).alias("first_id"), own("last_id", tail).alias("last_id"), own("n", head).alias("head_n"), own("n", tail).alias("tail_n"), own("ended", head).alias("head_ended"),
        own("ended", tail).alias("tail_ended"), (F.max("last_run") > 0).alias("parted"), F.count("closes").alias("inner"), F.min_by("closes", F.when(F.col("closes").isNotNull(), F.col("at"))).alias("inner_reason"),
    )


def _carry(chunks: DataFrame, file: list[str]) -> DataFrame:
    """What each chunk needs from its neighbours; the table has a row for each chunk of a file."""
    order = W.partitionBy(*file).orderBy("chunk")
    lag, lead = (lambda c: F.lag(c).over(order)), (lambda c: F.lead(c).over(order))
    c = chunks.withColumn("cut_before", F.coalesce(lag("tail_ended") | (lag("last_id") != F.col("first_id")), F.lit(True)))
    c = c.withColumns({"cut_after": F.coalesce(lead("cut_before"), F.lit(True)), "last": lead("chunk").isNull(), "reset": (F.col("parted") | F.col("cut_before")).cast("int")})
    c = c.withColumn("stretch", F.sum("reset").over(order))
    c = c.withColumn("left_data", F.sum(F.when(F.col("parted"), F.col("tail_n")).otherwise(F.col("head_n"))).over(W.partitionBy(*file, "stretch").orderBy("chunk")))
    c = c.withColumn("open_data", F.when(F.col("cut_before"), 0).otherwise(F.coalesce(lag("left_data"), F.lit(0))))
    head = F.when(F.col("parted"), F.when(F.col("head_ended"), 0).when(F.col("open_data") + F.col("head_n") > 0, 1))
    tail = F.when(F.col("cut_after"), F.when(F.col("tail_ended"), 0).when(F.col("left_data") > 0, F.when(F.col("last"), 2).otherwise(1)))
    c = c.withColumns({"head": head, "tail": tail})
    c = c.withColumns({"first": F.coalesce("head", "inner_reason", "tail"), "closed": F.col("inner") + F.col("head").isNotNull().cast("int") + F.col("tail").isNotNull().cast("int")})
    after = W.partitionBy(*file).orderBy(F.desc("chunk")).rowsBetween(W.unboundedPreceding, -1)
    entries_ = F.coalesce(F.sum("closed").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return c.select(*file, "chunk", "cut_after", "last", "open_data", F.last("first", ignorenulls=True).over(after).cast("long").alias("next_reason"), entries_.alias("entries"))


def entries(assembled: DataFrame, file: list[str]) -> DataFrame:
    """One row for each entry, and one with a null entry for the frames that belong to none.

    ``reason, event_id`` (of the last frame), ``n_frames``, the distinct sample ids ``seen``, ``any_zs`` and ``any_raw``.
    """
    return assembled.groupBy(*file, "entry").agg(
        F.max("reason").alias("reason"), F.max_by("event_id", "frame_idx").alias("event_id"), F.count("*").alias("n_frames"),
        F.collect_set(F.when(F.col("sample_id") < SAMPLE_IDS, F.col("sample_id"))).alias("seen"), F.bool_or("zs").alias("any_zs"), F.bool_or(~F.col("zs")).alias("any_raw"),
    )


def event_headers(assembled: DataFrame, file: list[str], fields: list[str]) -> DataFrame:
    """The header of each entry's last frame."""
    own = assembled.filter("entry is not null")
    return own.groupBy(*file, "entry").agg(*[F.max_by(f, "frame_idx").alias(f) for f in fields], F.max("reason").alias("reason"))


def accounting(found: DataFrame, file: list[str]) -> DataFrame:
    """One row for each file from its ``entries``: the loss figures, and whether the file counts as mixed or lossy.

    Frames that belong to no entry count as frames, and for the mode and the expected samples, but not as coverage.
    """
    there = F.col("entry").isNotNull()
    one = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = found.groupBy(*file).agg(
        F.count_if(there).alias("events"), *[F.count_if(F.col("reason") == k).alias(n) for k, n in enumerate(("closed_eoe", "closed_eventid", "closed_eof"))],
        F.sum("n_frames").alias("feu_frames"), one(F.min_by("event_id", F.when(there, F.col("entry")))).alias("first_eventid"), one(F.max_by("event_id", F.when(there, F.col("entry")))).alias("last_eventid"),
        one(F.sum(F.when(there, F.size("seen")).cast("long"))).alias("sum_distinct"), (F.coalesce(F.max(F.array_max("seen")), F.lit(0)) + 1).cast("int").alias("samples_expected"),
        F.bool_or("any_zs").alias("zs"), F.bool_or("any_raw").alias("raw"),
    )
    span = F.when((F.col("events") > 0) & (F.col("last_eventid") >= F.col("first_eventid")), F.col("last_eventid") - F.col("first_eventid") + 1).otherwise(F.col("events"))
    out = out.withColumn("events_missing", F.greatest(F.lit(0), span - F.col("events")))
    whole = F.col("events") * F.col("samples_expected")
    dense = F.col("raw") & ~F.col("zs")
    out = out.withColumns({"raw_mode": dense.cast("int"), "mixed": F.col("raw") & F.col("zs"), "sample_acceptance_mean": F.when(whole > 0, F.col("sum_distinct") / whole).otherwise(1.0)})
    return out.withColumn("lossy", (F.col("events_missing") > 0) | (dense & (1 - F.col("sample_acceptance_mean") > 0.001))).drop("zs", "raw")


#: The columns of the loss table that is written beside a file's events.
STATS = ["events", "events_missing", "closed_eoe", "closed_eventid", "closed_eof", "feu_frames", "first_eventid", "last_eventid", "samples_expected", "raw_mode", "sample_acceptance_mean"]


def decode_stats(found: DataFrame, file: list[str]) -> DataFrame:
    return accounting(found, file).select(*file, *STATS)


def sample_acceptance(found: DataFrame, file: list[str]) -> DataFrame:
    """``file, sample, acceptance``: the share of events with each sample, all indices up to the greatest of the file."""
    there = F.col("entry").isNotNull()
    files = found.groupBy(*file).agg(F.count_if(there).alias("events"), F.coalesce(F.max(F.array_max("seen")), F.lit(0)).alias("top"))
    every = files.select(*file, "events", F.explode(F.sequence(F.lit(0).cast("long"), F.col("top").cast("long"))).alias("sample"))
    seen = found.filter(there).select(*file, F.explode(F.col("seen").cast("array<bigint>")).alias("sample")).groupBy(*file, "sample").agg(F.count("*").alias("k"))
    share = F.when(F.col("events") > 0, F.coalesce("k", F.lit(0)) / F.col("events")).otherwise(0.0)
    return every.join(seen, [*file, "sample"], "left").select(*file, "sample", share.alias("acceptance"))


def corrected_means(samples: DataFrame, acceptance: DataFrame, file: list[str]) -> DataFrame:
    """Mean waveform of each channel over all events, divided by each sample's acceptance."""
    events = samples.groupBy(*file).agg(F.count_distinct("entry").alias("events"))
    sums = samples.groupBy(*file, "channel", "sample").agg(F.sum("amplitude").alias("total"))
    out = sums.join(events, file).join(acceptance, [*file, "sample"])
    return out.select(*file, "channel", "sample", (F.col("total") / F.col("events") / F.col("acceptance")).alias("mean"))
