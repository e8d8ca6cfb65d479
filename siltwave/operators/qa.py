"""Quality summaries: histograms, top lists, selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """``bin, n``: equal bins from least to greatest, the last one closed; only bins with rows."""
    v = F.col(value).cast("double")
    ends = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((v - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))).otherwise(0)
    return rows.filter(v.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(place.cast("long").alias("bin")).agg(F.count("*").alias("n"))  # one row


def hits_per_event(hits: DataFrame, keys: list[str]) -> DataFrame:
    return hits.groupBy(*keys).agg(F.count("*").alias("n_hits"))


def strong_events(hits: DataFrame, keys: list[str], least: float = 50.0) -> DataFrame:
    return hits.filter(F.col("amplitude") >= least).select(*keys).distinct()


def top_events(hits: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The events with the greatest total amplitude, ties by key."""
    return hits.groupBy(*keys).agg(F.sum("amplitude").alias("total")).orderBy(F.desc("total"), *keys).limit(k)


def listed(hits: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Hits of the wanted events, and the wanted events without any."""
    return hits.join(wanted, keys, "left_semi"), wanted.join(hits, keys, "left_anti")


def top_channels(hits: DataFrame, keys: list[str], least: float = 50.0, k: int = 24) -> DataFrame:
    """The channels with the greatest strong amplitude of each event, ties by channel."""
    best = hits.filter(F.col("amplitude") >= least).groupBy(*keys, "channel").agg(F.max("amplitude").alias("best"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("best"), "channel"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def with_waveforms(hits: DataFrame, events: DataFrame, peds: DataFrame, event: list[str], unit: list[str]) -> DataFrame:
    """Hits with ``wf``, the samples of their channel in their event, and the pedestal of their unit, by default mean 0 and rms 1.

    ``events`` has ``event, entry, ftst`` and the arrays ``channel, sample, amplitude``. Of entries that share an event id the first
    counts, also for channels that only a later one has. Hits of an event that isn't there are left out; a channel without
    samples has an empty ``wf``. ``peds`` has ``unit, channel, mean, rms``. Hits and events meet on ``event`` alone, so tables that are
    bucketed by it (``files.write_bucketed``) join without a shuffle.
    """
    lists = ("channel", "sample", "amplitude")
    first = events.groupBy(*event).agg(F.min_by(F.struct("entry", "ftst", *lists), "entry").alias("e"))
    rows = hits.join(first, event).join(peds.select(*unit, "channel", "mean", "rms"), [*unit, "channel"], "left")
    own = F.filter(F.arrays_zip(*[F.col("e").getField(c).alias(c) for c in lists]), lambda s: s.channel == F.col("channel"))
    wf = F.transform(own, lambda s: F.struct(s.sample.alias("sample"), s.amplitude.alias("amplitude")))
    return rows.select(*hits.columns, F.col("e.entry").alias("entry"), F.col("e.ftst").alias("ftst"), wf.alias("wf"), F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("rms", F.lit(1.0)).alias("rms"))


def display_sample(sample: Column, ftst: Column, most: Column) -> Column:
    """A sample's place with the fine timestamp of its event; ``most`` is the greatest one of its file."""
    return sample + F.when(most > 0, ftst / (most + 1)).otherwise(0.0)


def overlay_levels(hits: DataFrame) -> DataFrame:
    """The lines drawn over a waveform for each of its hits: its level, its peak, and the ends of both."""
    return hits.withColumns({
        "baseline_level": F.col("local_baseline"), "baseline_from": F.col("left_sample") - 5, "baseline_to": F.col("right_sample"),
        "peak_level": F.col("local_baseline") + F.col("amplitude"), "peak_from": F.col("max_sample") - 0.5, "peak_to": F.col("max_sample") + 0.5,
    })


def sample_period(events: DataFrame, file: list[str]) -> DataFrame:
    """``file, most_ftst, sample_ns``: the greatest fine timestamp of each file and the period that it implies; 10 ns without any."""
    most = F.coalesce(F.max("ftst"), F.lit(0))
    return events.groupBy(*file).agg(most.alias("most_ftst"), (10 * (most + 1)).cast("long").alias("sample_ns"))


def chosen_channels(spec: str):
    """A column of channels from "0-63" or "10,12,15"."""
    if "-" in spec:
        a, b = spec.split("-")
        return F.sequence(F.lit(int(a)), F.lit(int(b)))
    return F.transform(F.split(F.lit(spec), ","), lambda x: F.trim(x).cast("int"))


def default_selection(events: DataFrame, file: list[str]) -> DataFrame:
    """What is shown unless asked otherwise: each file's first entry and all channels that it has."""
    first = events.groupBy(*file).agg(F.min_by(F.struct("entry", F.array_distinct("channel").alias("channels")), "entry").alias("e"))
    return first.select(*file, "e.entry", F.explode(F.sort_array("e.channels")).alias("channel"))


def file_pairs(decoded: DataFrame, hits: DataFrame, feus: list[int] | None = None, files: list[int] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Decoded and hit files of the same number and unit (and ``keys``: a run's, where there are several)."""
    out = decoded.withColumnRenamed("path", "decoded_path").join(hits.withColumnRenamed("path", "hits_path"), [*(keys or []), "file_num", "feu"])
    if feus is not None:
        out = out.filter(F.col("feu").isin(feus))
    return out.filter(F.col("file_num").isin(files)) if files is not None else out
