"""Waveform operations on exploded rows: event keys, channel, sample, value ``v``.

The fused job in ``pulses`` does the same inside one event row, without a shuffle; these forms are for selections, for
diagnostics and for holding the fused job to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def explode_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each recorded sample, with its place ``ord`` in the event."""
    zipped = F.posexplode(F.arrays_zip("channel", "sample", "amplitude"))
    rows = events.select(*keys, zipped.alias("ord", "s"))
    return rows.select(*keys, "ord", "s.channel", "s.sample", "s.amplitude")


def densify(samples: DataFrame, keys: list[str], channels: int = 512, most: int = 2048, value: str = "amplitude") -> DataFrame:
    """``keys, channel, sample, v``: holes are 0 up to the channel's own last sample, the last of duplicates wins."""
    order = F.col("ord") if "ord" in samples.columns else F.lit(0)
    own = samples.filter((F.col("channel") >= 0) & (F.col("channel") < channels) & (F.col("sample") >= 0) & (F.col("sample") < most))
    last = own.groupBy(*keys, "channel", "sample").agg(F.max_by(value, order).alias("v"))
    whole = last.groupBy(*keys, "channel").agg(F.map_from_entries(F.collect_list(F.struct("sample", "v"))).alias("m"), F.max("sample").alias("n"))
    filled = whole.select(*keys, "channel", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long"))).alias("sample"))
    key_type = last.schema["sample"].dataType
    v = F.element_at("m", F.col("sample").cast(key_type))
    return filled.select(*keys, "channel", "sample", F.coalesce(v, F.lit(0).cast(last.schema["v"].dataType)).alias("v"))


def upper_middle(values: Column) -> Column:
    """The element at place n div 2 of the sorted values."""
    ordered = F.sort_array(values)
    return F.get(ordered, F.floor(F.size(values) / 2).cast("int"))


def subtract_common_noise(wf: DataFrame, keys: list[str], block: int = 64) -> DataFrame:
    """Take off, for each event, block of channels and sample, the upper-middle value over the channels present."""
    by = [*keys, "block", "sample"]
    rows = wf.withColumn("block", F.floor(F.col("channel") / block).cast("long"))
    median = upper_middle(F.collect_list("v").over(W.partitionBy(*by)))  # 64 values at most
    return rows.withColumn("v", F.col("v") - median).drop("block")


def boxcar(wf: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Mean over half a width to each side, cut at the ends; even widths count as the next odd one."""
    h = width // 2
    frame = W.partitionBy(*keys, "channel").orderBy("sample").rowsBetween(-h, h)
    return wf.withColumn("v", F.sum("v").over(frame) / F.count("v").over(frame))


def runs(wf: DataFrame, keys: list[str], limit: Column) -> DataFrame:
    """``keys, channel, start, stop``: maximal runs of samples above ``limit``, of waveforms of two samples or more."""
    by = W.partitionBy(*keys, "channel")
    n = F.count("*").over(by)
    above = wf.withColumn("n", n).filter((F.col("v") > limit) & (F.col("n") >= 2))
    island = F.col("sample") - F.row_number().over(by.orderBy("sample"))
    return above.withColumn("island", island).groupBy(*keys, "channel", "island").agg(F.min("sample").alias("start"), F.max("sample").alias("stop")).drop("island")


def bridge(found: DataFrame, keys: list[str], gap: int = 2) -> DataFrame:
    """Merge runs of one waveform that are at most ``gap`` samples apart."""
    ordered = W.partitionBy(*keys, "channel").orderBy("start")
    new = F.coalesce((F.col("start") - F.lag("stop").over(ordered) - 1 > gap).cast("int"), F.lit(1))
    rows = found.withColumn("new", new).withColumn("pulse", F.sum("new").over(ordered) - 1)
    return rows.groupBy(*keys, "channel", "pulse").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def bounds(pulses: DataFrame, keys: list[str]) -> DataFrame:
    """``lo`` and ``hi``: how far a pulse may reach without crossing a neighbour; needs the waveform's length ``n``."""
    ordered = W.partitionBy(*keys, "channel").orderBy("start")
    lo = F.coalesce(F.lag("stop").over(ordered) + 1, F.lit(0))
    hi = F.coalesce(F.lead("start").over(ordered) - 1, F.col("n") - 1)
    return pulses.withColumns({"lo": lo, "hi": hi})


def waveforms(wf: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, channel, wf, n``: each waveform as one array, for measures of a pulse by array functions."""
    pairs = F.sort_array(F.collect_list(F.struct("sample", "v")))  # 2048 samples at most
    return wf.groupBy(*keys, "channel").agg(F.transform(pairs, lambda x: x.v).alias("wf")).withColumn("n", F.size("wf").cast("long"))


def baseline(wf: Column, start: Column, lo: Column, window: int = 4, guard: int = 2) -> Column:
    """Median of up to ``window`` samples that end ``guard`` before the start; without any, those next to it; without
    those the sample at the start, or 0 at the very beginning."""

    def median(first: Column, stop: Column) -> Column:
        own = F.sort_array(F.slice(wf, (first + 1).cast("int"), (stop - first).cast("int")))
        n = F.size(own)
        return (F.get(own, F.floor((n - 1) / 2).cast("int")) + F.get(own, F.floor(n / 2).cast("int"))) / 2

    hi = F.greatest(lo, start - guard)
    first = F.greatest(lo, hi - window)
    near = F.greatest(lo, start - window)
    value_at_start = F.get(wf, start.cast("int"))
    return F.when(hi > first, median(first, hi)).when(start > near, median(near, start)).when(start > 0, value_at_start).otherwise(F.lit(0.0))


def measures(pulses: DataFrame) -> DataFrame:
    """Highest sample, its place, baseline, parabola vertex, truncation, saturation-free pulses' integral, by arrays.

    ``pulses`` has ``wf, n, start, stop, lo, hi``. A plateau counts at its middle, the first highest one wins, one that
    begins with the pulse stays at its start.
    """
    wf = F.col("wf")
    at = lambda i: F.get(wf, i.cast("int"))
    inside = F.slice(wf, (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start") + 1).cast("int"))
    top = F.array_max(inside)
    out = pulses.withColumns({"top": top, "first": F.col("start") + F.array_position(inside, top) - 1})
    after = F.slice(wf, (F.col("first") + 1).cast("int"), (F.col("stop") - F.col("first") + 1).cast("int"))
    flat = F.array_position(F.transform(after, lambda x: x != F.col("top")), True)
    length = F.when(flat > 0, flat - 1).otherwise(F.size(after).cast("long"))
    peak = F.when(F.col("first") == F.col("start"), F.col("first")).otherwise(F.floor((2 * F.col("first") + length - 1) / 2))
    out = out.withColumn("peak", peak).withColumn("baseline", baseline(wf, F.col("start"), F.col("lo")))
    y1, y2, y3 = (at(F.col("peak") + k) - F.col("baseline") for k in (-1, 0, 1))
    bend = y1 - 2 * y2 + y3
    curved = (F.col("peak") > 0) & (F.col("peak") < F.col("n") - 1) & (F.abs(bend) > 1e-9)
    shift = 0.5 * (y1 - y3) / bend
    amplitude = F.when(curved, y2 - 0.25 * (y1 - y3) * shift).otherwise(y2)
    left = F.reverse(F.slice(wf, (F.col("lo") + 1).cast("int"), (F.col("start") - F.col("lo")).cast("int")))
    right = F.slice(wf, (F.col("stop") + 2).cast("int"), (F.col("hi") - F.col("stop")).cast("int"))

    def reach(side: Column) -> Column:
        low = F.array_position(F.transform(side, lambda x: x - F.col("baseline") <= 0), True)
        return F.when(low > 0, low - 1).otherwise(F.size(side).cast("long"))

    out = out.withColumns({
        "amplitude": amplitude, "max_sample": F.col("peak") + F.when(curved, shift).otherwise(0.0), "width": F.col("stop") - F.col("start") + 1,
        "trunc_left": F.col("start") == 0, "trunc_right": F.col("stop") == F.col("n") - 1,
        "from": F.col("start") - reach(left), "upto": F.col("stop") + reach(right),
    })
    span = F.slice(wf, (F.col("from") + 1).cast("int"), (F.col("upto") - F.col("from") + 1).cast("int"))
    return out.withColumn("integral", F.aggregate(span, F.lit(0.0), lambda total, x: total + (x - F.col("baseline"))))


def zs_files(events: DataFrame, file: list[str], first: int = 200, channels: int = 512, dense: int = 256) -> DataFrame:
    """``file, is_zs``: sparse where the upper-middle number of channels in the first entries is below ``dense``.

    Works on event rows (``entry``, ``channel`` as an array), so that entries without samples count as 0. Packed events
    (``pulses.pack``) bring the number of their channels, taken below 512.
    """
    if "n_channels" in events.columns:
        per = events.filter(F.col("entry") < first).select(*file, F.col("n_channels").alias("k"))
        return per.groupBy(*file).agg((upper_middle(F.collect_list("k")) < dense).alias("is_zs"))
    own = F.array_distinct(F.filter(F.coalesce("channel", F.array().cast("array<int>")), lambda c: (c >= 0) & (c < channels)))
    per = events.filter(F.col("entry") < first).select(*file, F.size(own).alias("k"))
    return per.groupBy(*file).agg((upper_middle(F.collect_list("k")) < dense).alias("is_zs"))  # ``first`` values at most


def largest_only(hits: DataFrame, keys: list[str], order: str = "pulse_idx") -> DataFrame:
    """The largest pulse of each waveform, the first where tied."""
    best = W.partitionBy(*keys, "channel").orderBy(F.desc("amplitude"), order)
    return hits.withColumn("rank", F.row_number().over(best)).filter("rank = 1").drop("rank")


def gate_width(sample_ns: Column, boxcar_ns: float = 300.0) -> Column:
    """The automatic width of the gate: halves are rounded away from zero, 3 at least."""
    return F.greatest(F.lit(3), F.round(boxcar_ns / sample_ns).cast("int"))
