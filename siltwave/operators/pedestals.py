"""Pedestals: mean and noise of each channel.

``from_events`` works on event rows: a task adds up its events and gives one row for each unit and channel, so the
shuffle moves a few hundred rows a task. The forms on exploded samples are for selections and for holding it to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..params import Params
from . import pulses, waveform


def rms() -> Column:
    """Population spread; Spark merges count, mean and squared deviations pairwise, so a large offset costs no digits."""
    return F.coalesce(F.stddev_pop("v"), F.lit(0.0))


def means(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the recorded samples of a channel, duplicates and out-of-range channels counted."""
    return samples.groupBy(*keys, "channel").agg((F.sum("amplitude") / F.count("amplitude")).alias("mean"))


def noise(samples: DataFrame, keys: list[str], event: list[str], width: int = 0) -> DataFrame:
    """RMS after common-noise subtraction of the raw waveform with holes at zero; ``width`` > 0 smooths it first."""
    wf = waveform.subtract_common_noise(waveform.densify(samples, [*keys, *event]), [*keys, *event])
    if width:
        wf = waveform.boxcar(wf, [*keys, *event], width)
    return wf.groupBy(*keys, "channel").agg(rms().alias("rms"))


def pedestals(samples: DataFrame, keys: list[str], event: list[str], width: int = 0, flat_sigma: float = 0.0) -> DataFrame:
    """``keys, channel, mean, rms, rms_gate``; a positive ``flat_sigma`` takes the place of both noises."""
    plain = noise(samples, keys, event)
    out = means(samples, keys).join(plain, [*keys, "channel"], "left")
    gate = F.col("rms")
    if width:
        out = out.join(noise(samples, keys, event, width).withColumnRenamed("rms", "rms_gate"), [*keys, "channel"], "left")
        gate = F.col("rms_gate")
    zero = F.lit(0.0)
    out = out.select(*keys, "channel", "mean", F.coalesce("rms", zero).alias("rms"), F.coalesce(gate, zero).alias("rms_gate"))
    return out.withColumns({"rms": F.lit(flat_sigma), "rms_gate": F.lit(flat_sigma)}) if flat_sigma > 0 else out


def from_events(events: DataFrame, keys: list[str], p: Params, settings: DataFrame | None = None, flat_sigma: float = 0.0, file_keys: list[str] | None = None) -> DataFrame:
    """``pedestals`` from event rows, both noises in one pass over an event's matrix; ``settings`` as in ``find_hits``.

    Common noise is always taken off, whatever the job does with its data. A task keeps count, mean and squared deviations of
    each channel; those of all tasks are merged about one of their own means, so neither many samples nor a large offset cost digits.
    """
    arrays = ("channel", "sample", "amplitude")
    rows = pulses.with_settings(events, settings, file_keys or keys).select(*keys, *pulses.lists_of(events, arrays), *pulses.SETTINGS)
    sums = ("n", "total", "n_wf", "v", "vv", "g", "gg")  # v and g: means, vv and gg: squared deviations from them
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keys)]] + ["channel int"] + [f"{c} double" for c in sums])

    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        names: list = []
        for b in batches:
            names = [b.schema.field(c).type for c in keys]
            lists = pulses.Lists(b, list(arrays))
            units, plain = list(zip(*[b.column(c).to_pylist() for c in keys])), {c: b.column(c).to_pylist() for c in pulses.SETTINGS}
            zero = np.zeros(p.channels)
            for i in range(b.num_rows):
                channel, sample, amplitude = (lists(c, i) for c in arrays)
                most = max(p.channels, int(channel.max(initial=-1)) + 1)
                own = held.get(units[i])
                if own is None or own.shape[1] < most:
                    grown = np.zeros((len(sums), most))
                    if own is not None:
                        grown[:, : own.shape[1]] = own
                    own = held[units[i]] = grown
                there = channel >= 0
                own[0] += np.bincount(channel[there], minlength=own.shape[1])
                own[1] += np.bincount(channel[there], amplitude[there], own.shape[1])
                wf, length = pulses.dense(channel, sample, amplitude, zero, p)
                if not wf.size:
                    continue
                pulses.common_noise(wf, length)
                width = plain["gate_width"][i]
                gate = pulses.smoothed(wf, length, p.gate_width(sample_ns=plain["sample_ns"][i]) if width is None else width)
                inside = np.arange(wf.shape[1]) < length[:, None]
                for k, v in ((3, wf), (5, gate)):
                    merge_moments(own[2, : p.channels], own[k : k + 2, : p.channels], length, v, inside)
                own[2, : p.channels] += length
        for unit, own in held.items():
            at = np.flatnonzero(own[0])
            columns = [pa.array([x] * len(at), t) for x, t in zip(unit, names)] + [pa.array(at, pa.int32())] + [pa.array(own[k, at]) for k in range(len(sums))]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "channel", *sums])

    n, of = F.sum("n_wf"), W.partitionBy(*keys, "channel")
    parts = rows.mapInArrow(run, schema)
    parts = parts.withColumns({f"{c}0": F.min(F.when(F.col("n_wf") > 0, F.col(c))).over(of) for c in ("v", "g")})  # one row of a task and channel each

    def spread(mean: str, squares: str) -> Column:
        away = F.col(mean) - F.col(f"{mean}0")
        total = F.sum(squares) + F.sum(F.col("n_wf") * away * away) - F.pow(F.sum(F.col("n_wf") * away), 2) / n
        return F.coalesce(F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), total / n))), F.lit(0.0))

    out = parts.groupBy(*keys, "channel").agg((F.sum("total") / F.sum("n")).alias("mean"), spread("v", "vv").alias("rms"), spread("g", "gg").alias("rms_gate"))
    return out.withColumns({"rms": F.lit(flat_sigma), "rms_gate": F.lit(flat_sigma)}) if flat_sigma > 0 else out


def merge_moments(n: np.ndarray, held: np.ndarray, length: np.ndarray, v: np.ndarray, inside: np.ndarray) -> None:
    """Merge one event's waveforms into ``held`` (means, squared deviations) of ``n`` samples a channel, in place."""
    k = np.maximum(length, 1)
    mean = np.where(inside, v, 0.0).sum(1) / k
    away = np.where(inside, v - mean[:, None], 0.0)
    both, step = np.maximum(n + length, 1), mean - held[0]
    held[1] += (away * away).sum(1) + step * step * n * length / both
    held[0] += np.where(length > 0, step * length / both, 0.0)


def fallback(spark: SparkSession, channels: int = 512, mean: float = 256.0) -> DataFrame:
    """What is used without a pedestal file."""
    return spark.range(channels).select(F.col("id").cast("int").alias("channel"), F.lit(mean).alias("mean"), F.lit(1.0).alias("rms"), F.lit(1.0).alias("rms_gate"))


def look_up(samples: DataFrame, peds: DataFrame, keys: list[str], filtered: bool = True, zs_baseline: float | None = None) -> DataFrame:
    """Samples with ``mean, rms, rms_gate``; absent channels get 0, 3 and 3. ``zs_baseline`` forces all means."""
    out = samples.join(peds, [*keys, "channel"], "left")
    mean = F.coalesce("mean", F.lit(0.0)) if zs_baseline is None else F.lit(zs_baseline)
    noise_ = F.coalesce("rms", F.lit(3.0))
    gate = F.coalesce("rms_gate", F.lit(3.0)) if filtered else noise_
    return out.withColumns({"mean": mean, "rms": noise_, "rms_gate": gate})
