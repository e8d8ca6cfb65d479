"""The fused job: event rows to hits without a shuffle, in Arrow batches.

An event row holds all of its channels, so pedestals, common noise, smoothing and pulses stay inside it. Per batch the
work is one dense matrix for each event; per-pulse code runs only for channels that go above threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Params

NUMBERS = ["amplitude", "time", "time_of_max", "sample", "max_sample", "local_baseline", "local_max", "left_sample", "right_sample", "time_over_threshold", "integral", "significance"]
FLAGS = ["saturated", "trunc_left", "trunc_right"]


def dense(channel, sample, amplitude, mean, p: Params):
    """Matrix of channels by samples, and each channel's length; holes are 0 after subtraction, the last value wins."""
    if len(channel) and not (channel.min() >= 0 and channel.max() < p.channels and sample.min() >= 0 and sample.max() < p.samples):
        ok = (channel >= 0) & (channel < p.channels) & (sample >= 0) & (sample < p.samples)
        channel, sample, amplitude = channel[ok], sample[ok], amplitude[ok]
    n = int(sample.max(initial=-1)) + 1
    place = channel * np.int64(n) + sample
    if n and len(place) == p.channels * n and place[0] == 0 and (np.diff(place) == 1).all():  # a whole frame in order
        return amplitude.reshape(p.channels, n) - mean[:, None], np.full(p.channels, n)
    wf, there = np.zeros((p.channels, n)), np.zeros((p.channels, n), bool)
    wf.ravel()[place] = amplitude - mean[channel]
    there.ravel()[place] = True
    length = np.where(there.any(1), n - there[:, ::-1].argmax(1), 0) if n else np.zeros(p.channels, np.int64)
    return wf, length


def common_noise(wf: np.ndarray, length: np.ndarray, block: int = 64) -> None:
    """Subtract in place the upper-middle value of each block at each sample, over the channels that reach it."""
    n = wf.shape[1]
    for size, first in {(block, 0), (len(wf) % block, len(wf) - len(wf) % block)}:
        own = wf[first : first + len(wf) // block * block if size == block else len(wf)]
        if not size or not own.size:
            continue
        own = own.reshape(-1, size, n)
        reach = length[first : first + own.shape[0] * size].reshape(-1, size)
        if (reach == n).all():
            columns = np.ascontiguousarray(own.transpose(0, 2, 1))
            columns.partition(size // 2, axis=2)
            own -= columns[:, None, :, size // 2]
            continue
        there = np.arange(n) < reach[:, :, None]
        count = there.sum(1)
        ranked = np.sort(np.where(there, own, np.inf), axis=1)
        middle = np.take_along_axis(ranked, np.minimum(count // 2, size - 1)[:, None], 1)
        own -= np.where(there, middle, 0.0)


def smoothed(wf: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Boxcar of each channel over its own length, added in the order of samples and rounded at each step as in SQL.

    The order decides which of two equally deep valleys of the smoothed waveform comes out deeper in the last bit.
    """
    if width <= 0 or not wf.size:
        return wf
    n = wf.shape[1]
    h, i = min(width // 2, n), np.arange(n)
    around = np.zeros((len(wf), n + 2 * h))  # zeros beyond the ends change no sum
    np.copyto(around[:, h : h + n], wf, where=i < length[:, None])
    out = around[:, :n].copy()
    for k in range(1, 2 * h + 1):
        out += around[:, k : k + n]
    hi = np.minimum(i + h + 1, length[:, None])
    return out / np.maximum(1, hi - np.maximum(i - h, 0))


def above(mask: np.ndarray, gap: int) -> tuple[list, list, list]:
    """Runs of true places as (row, first, last), those of one row at most ``gap`` apart merged."""
    row, at = np.divmod(np.flatnonzero(mask), mask.shape[1])
    if not len(at):
        return [], [], []
    cut = np.flatnonzero((row[1:] != row[:-1]) | (at[1:] - at[:-1] - 1 > gap))
    first, last = np.append(0, cut + 1), np.append(cut, len(at) - 1)
    return row[first].tolist(), at[first].tolist(), at[last].tolist()


def deepest_valley(v: list[float], least: int) -> tuple[float, int]:
    """Depth and place of the first deepest valley of a run that leaves ``least`` samples to each side; (0, 0) without."""
    n = len(v)
    right, best, place = v[:], 0.0, 0
    for i in range(n - 2, -1, -1):
        if right[i + 1] > right[i]:
            right[i] = right[i + 1]
    left = v[0]
    for i in range(1, min(n - least, n - 2) + 1):
        if v[i] > left:
            left = v[i]
        deep = (left if left < right[i] else right[i]) - v[i]
        if i >= least and deep > best:
            best, place = deep, i
    return best, place


def split(gate: np.ndarray, first: int, last: int, depth: float, least: int) -> list[tuple[int, int]]:
    """Cut a run at its deepest valley, again and again; the valley opens the right part, each part has ``least``."""
    todo, out = [(first, last)], []
    while todo:
        a, b = todo.pop()
        best, place = deepest_valley(gate[a : b + 1].tolist(), least) if b - a + 1 >= 2 * least else (0.0, 0)
        if best > 0 and best >= depth:
            todo += [(a + place, b), (a, a + place - 1)]
        else:
            out.append((a, b))
    return out


def total(values) -> float:
    """The sum in order, rounded at each step as in the reference and in SQL; ``sum`` carries what rounding loses since Python 3.12."""
    out = 0.0
    for x in values:
        out += x
    return out


def line(wf: list[float], a: int, b: int):
    """Slope and intercept of the least-squares line over samples a to b; None for fewer than two."""
    n = b - a + 1
    if n < 2:
        return None
    middle, mean = (a + b) / 2, total(wf[a : b + 1]) / n
    slope = total((i - middle) * (wf[i] - mean) for i in range(a, b + 1)) / total((i - middle) ** 2 for i in range(a, b + 1))
    return slope, mean - slope * middle


def pedestal_level(wf: list[float], start: int, lo: int, p: Params) -> float:
    stop = max(lo, start - p.baseline_guard)
    first = max(lo, stop - p.baseline_window)
    if stop == first:
        stop, first = start, max(lo, start - p.baseline_window)
    if stop > first:
        own = sorted(wf[first:stop])
        return (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2
    return wf[start] if start > 0 else 0.0


def saturated_run(wf: list[float], a: int, b: int, level: float, least: int) -> tuple[int, int] | None:
    """The longest run at or above the level, the first of equals, if it has ``least`` samples."""
    best, since = None, None
    for i in range(a, b + 2):
        if i <= b and wf[i] >= level:
            since = i if since is None else since
        elif since is not None:
            if i - since >= least and (best is None or i - since > best[1] - best[0] + 1):
                best = (since, i - 1)
            since = None
    return best


def measured(wf: list[float], gate: list[float], a: int, b: int, lo: int, hi: int, rms: float, rms_gate: float, adc_max: float, filtered: bool, p: Params):
    """The values of NUMBERS (times in samples) and FLAGS for one region, or None where it isn't high enough."""
    n, limit = len(wf), p.threshold * rms_gate
    best = max(wf[a : b + 1])
    first = flat = wf.index(best, a, b + 1)
    while flat < b and wf[flat + 1] == best:
        flat += 1
    top = (first + flat) // 2 if first > a else a
    base = pedestal_level(wf, a, lo, p)
    height, place = best - base, float(top)
    full = saturated_run(wf, a, b, p.saturation * adc_max, p.saturated_samples) if best >= p.saturation * adc_max else None
    if full:
        s, e = full
        left, right = line(wf, max(0, s - p.slope_samples), s), line(wf, e, min(n - 1, e + p.slope_samples))
        if left is None or right is None or left[0] <= 0 or right[0] >= 0:
            place, height = float(s), wf[s] - base
        else:
            place = (right[1] - left[1]) / (left[0] - right[0])
            height = left[0] * place + left[1] - base
    elif 0 < top < n - 1:
        y1, y2, y3 = wf[top - 1] - base, wf[top] - base, wf[top + 1] - base
        bend = y1 - 2 * y2 + y3
        if abs(bend) > 1e-9:
            place = top + 0.5 * (y1 - y3) / bend
            height = y2 - 0.25 * (y1 - y3) * (place - top)  # by the place as it is given, so that both agree to the last digit
    if not filtered and height < p.threshold * rms:
        return None
    target = p.timing_fraction * min(height, adc_max) + base
    lead = top
    while lead > a and wf[lead] > target:
        lead -= 1
    if lead + 1 < n:
        rise = wf[lead + 1] - wf[lead]
        timing = lead + ((target - wf[lead]) / rise if abs(rise) > 1e-9 else 0.5)
    else:
        timing = float(top)
    left_at, right_at = float(a), float(b)
    if a > lo and gate[a - 1] <= limit and gate[a] - gate[a - 1] > 1e-9:
        left_at = a - 1 + (limit - gate[a - 1]) / (gate[a] - gate[a - 1])
    if b < hi and gate[b + 1] <= limit and gate[b] - gate[b + 1] > 1e-9:
        right_at = b + (gate[b] - limit) / (gate[b] - gate[b + 1])
    i, j = a, b
    while i > lo and wf[i - 1] - base > 0:
        i -= 1
    while j < hi and wf[j + 1] - base > 0:
        j += 1
    integral = total(x - base for x in wf[i : j + 1])
    strength = max(gate[a : b + 1]) / rms_gate if rms_gate > 0 else 0.0
    return height, timing, place, timing, place, base, best - base, left_at, right_at, right_at - left_at, integral, strength, bool(full), a == 0, b == n - 1


def event_pulses(wf: np.ndarray, gate: np.ndarray, length: np.ndarray, rms: np.ndarray, noise: np.ndarray, adc_max: np.ndarray, filtered: bool, p: Params) -> list[tuple]:
    """``(channel, pulse_idx, *measured)`` of all channels of one event."""
    over = gate > (p.threshold * noise)[:, None]
    if wf.shape[1] < 3 or not (length == wf.shape[1]).all():
        over &= (np.arange(wf.shape[1]) < length[:, None]) & (length >= 3)[:, None]
    out: list[tuple] = []
    regions: dict[int, list] = {}
    for c, a, b in zip(*above(over, p.gap)):
        regions.setdefault(c, []).extend([(a, b)] if b - a + 1 < 2 * p.min_width else split(gate[c], a, b, p.prominence * noise[c], p.min_width))
    for c, own in regions.items():
        n = int(length[c])
        w = wf[c, :n].tolist()
        g = w if gate is wf else gate[c, :n].tolist()
        found = []
        for k, (a, b) in enumerate(own):
            if b - a + 1 >= p.min_width:
                lo = own[k - 1][1] + 1 if k else 0
                hi = own[k + 1][0] - 1 if k + 1 < len(own) else n - 1
                got = measured(w, g, a, b, lo, hi, float(rms[c]), float(noise[c]), float(adc_max[c]), filtered, p)
                if got:
                    found.append(got)
        if not p.many_peaks and len(found) > 1:
            found = [max(found, key=lambda x: x[0])]
        out += [(c, k, *got) for k, got in enumerate(found)]
    return out


class Lists:
    """The list columns of an Arrow batch, or packed ones (see ``pack``), as views of its buffers; null as empty."""

    def __init__(self, batch: pa.RecordBatch, names: list[str]):
        self.columns = {}
        for n in names:
            c = batch.column(n)
            if pa.types.is_binary(c.type):
                at = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int32)
                data = c.buffers()[2] if len(c) else None
                self.columns[n] = (np.frombuffer(data, "<u2") if data is not None and data.size > 1 else np.zeros(0, np.uint16), at // 2)
                continue
            c = c.fill_null([]) if c.null_count else c
            self.columns[n] = (c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy())

    def __call__(self, name: str, i: int) -> np.ndarray:
        values, at = self.columns[name]
        own = values[at[i] : at[i + 1]]
        return own.astype(np.int32) if own.dtype == np.uint16 else own


def lists_of(events: DataFrame, names: tuple[str, ...]) -> list[Column]:
    """The sample columns of an event table as the tasks take them: packed ones as they are, others as lists of whole numbers."""
    return [F.col(c) if events.schema[c].dataType.typeName() == "binary" else F.col(c).cast("array<int>").alias(c) for c in names]


def pack(events: DataFrame, channels: int = 512) -> DataFrame:
    """Event rows with ``sample, channel, amplitude`` as little-endian 16-bit numbers in one binary value each, and ``n_channels``.

    Spark moves a list number by number from Parquet to rows to Arrow, a binary value as it is; the packed table is also half as
    large. ``n_channels`` counts the distinct channels below ``channels``, which tells sparse files. Numbers of samples and amplitudes
    fit by the word format; a channel beyond 65,535 (of a broken block) counts as 65,535. Null lists stay null.
    """
    names = ("sample", "channel", "amplitude")
    rest = [c for c in events.columns if c not in names]
    rows = events.select(*rest, *lists_of(events, names))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(rest)]] + ["sample binary, channel binary, amplitude binary, n_channels int"])

    def run(batches):
        for b in batches:
            packed, seen, lists = [], [], Lists(b, list(names))
            for name in names:
                empty = b.column(name).is_null().to_pylist()
                packed.append(pa.array([None if empty[i] else np.clip(lists(name, i), 0, 65_535).astype("<u2").tobytes() for i in range(b.num_rows)], pa.binary()))
            for i in range(b.num_rows):
                c = lists("channel", i)
                seen.append(len(np.unique(c[(c >= 0) & (c < channels)])))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], *packed, pa.array(seen, pa.int32())], [*rest, *names, "n_channels"])

    return rows.mapInArrow(run, schema)


#: What may differ from file to file, each null or absent where the job's parameters hold.
SETTINGS = {"sample_ns": "double", "gate_width": "int", "zs_baseline": "boolean"}


def with_settings(events: DataFrame, settings: DataFrame | None, keys: list[str]) -> DataFrame:
    """``events`` with the columns of SETTINGS for their files; ``settings`` has ``keys`` and any of them."""
    own = [c for c in SETTINGS if settings is not None and c in settings.columns]
    rows = events.join(settings.select(*keys, *own), keys, "left") if own else events
    return rows.withColumns({c: (F.col(c) if c in own else F.lit(None)).cast(t) for c, t in SETTINGS.items()})


def find_hits(events: DataFrame, peds: DataFrame, p: Params, keys: list[str], ped_keys: list[str], zs: DataFrame | None = None, settings: DataFrame | None = None, file_keys: list[str] | None = None, nested: bool = False) -> DataFrame:
    """One row for each pulse, or with ``nested`` one for each event with its pulses as the array ``hits``. ``peds`` has ``ped_keys, channel, mean, rms, rms_gate``.

    ``zs`` has ``file_keys`` (``ped_keys`` unless given) and ``is_zs``; ``settings`` has ``file_keys`` and what differs
    from file to file: sample_ns, gate_width, zs_baseline. A unit's pedestals become three arrays, at most ``channels``
    long, which join on a few keys; the events themselves are not moved where that side is small enough to broadcast.
    Sparse files go without common noise and smoothing; a unit without pedestals takes the fallback table, unsmoothed.
    """
    file_keys = file_keys or ped_keys
    filled = F.map_from_entries(F.collect_list(F.struct("channel", F.struct("mean", "rms", "rms_gate"))))
    arrays = peds.filter((F.col("channel") >= 0) & (F.col("channel") < p.channels)).groupBy(*ped_keys).agg(filled.alias("ped"))
    rows = with_settings(events.join(arrays, ped_keys, "left"), settings, file_keys)
    rows = rows.join(zs, file_keys, "left") if zs is not None and p.cns else rows.withColumn("is_zs", F.lit(False))
    kept = [c for c in [*keys, "eventId", "timestamp", "ftst"] if c in events.columns]
    arrays_ = ("channel", "sample", "amplitude")
    rows = rows.select(*kept, *lists_of(events, arrays_), F.map_keys("ped").cast("array<int>").alias("pc"), F.map_values("ped").alias("pv"), F.coalesce("is_zs", F.lit(False)).alias("is_zs"), *SETTINGS)
    rows = rows.withColumns({f"p_{c}": F.col("pv").getField(c) for c in ("mean", "rms", "rms_gate")}).drop("pv")
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(kept)]]
    measured = ["channel int", "pulse_idx int"] + [f"{n} double" for n in NUMBERS] + [f"{n} boolean" for n in FLAGS]
    schema = ", ".join(own + [f"hits array<struct<{', '.join(x.replace(' ', ':') for x in measured)}>>"] if nested else own + measured)

    def run(batches):
        for b in batches:
            source, found, shift, period = [], [], [], []
            lists = Lists(b, [*arrays_, "pc", "p_mean", "p_rms", "p_rms_gate"])
            plain = {c: b.column(c).to_pylist() for c in ("is_zs", *SETTINGS)}
            ftst = [x or 0 for x in b.column("ftst").to_pylist()] if "ftst" in kept else [0] * b.num_rows
            for i in range(b.num_rows):
                pc = lists("pc", i)
                mean, rms, gate_rms = np.zeros(p.channels), np.full(p.channels, 3.0), np.full(p.channels, 3.0)
                for name, into in (("p_mean", mean), ("p_rms", rms), ("p_rms_gate", gate_rms)):
                    into[pc] = lists(name, i)
                if not len(pc):  # a unit without pedestals: the fallback table
                    mean[:], rms[:], gate_rms[:] = p.zs_baseline, 1.0, 1.0
                sample_ns, sparse = plain["sample_ns"][i] or p.sample_ns, plain["is_zs"][i]
                if plain["zs_baseline"][i] or (plain["zs_baseline"][i] is None and p.force_zs_baseline):
                    mean[:] = p.zs_baseline
                width = plain["gate_width"][i]
                width = 0 if sparse else p.gate_width(len(pc) > 0, sample_ns) if width is None else width
                wf, length = dense(lists("channel", i), lists("sample", i), lists("amplitude", i), mean, p)
                if not wf.size:
                    continue
                if p.cns and not sparse:
                    common_noise(wf, length)
                got = event_pulses(wf, smoothed(wf, length, width), length, rms, gate_rms if width else rms, p.adc_max - mean, width > 0, p)
                found += got
                source += [i] * len(got)
                shift += [ftst[i] * p.ftst_ns / sample_ns] * len(got)
                period += [sample_ns] * len(got)
            at, table = pa.array(source, pa.int64()), list(zip(*found)) or [()] * (2 + len(NUMBERS) + len(FLAGS))
            late, ns = np.asarray(shift), np.asarray(period)
            values = {n: np.asarray(v, float) for n, v in zip(NUMBERS, table[2:])}
            for n in ("sample", "max_sample", "left_sample", "right_sample"):
                values[n] = values[n] + late
            values |= {"time": values["sample"] * ns, "time_of_max": values["max_sample"] * ns, "time_over_threshold": values["time_over_threshold"] * ns}
            columns = [pa.array(table[0], pa.int32()), pa.array(table[1], pa.int32())]
            columns += [pa.array(values[n], pa.float64()) for n in NUMBERS] + [pa.array(v, pa.bool_()) for v in table[2 + len(NUMBERS) :]]
            names = ["channel", "pulse_idx"] + NUMBERS + FLAGS
            if nested:
                stops = np.concatenate([[0], np.cumsum(np.bincount(np.asarray(source, np.int64), minlength=b.num_rows))]).astype(np.int32)
                hits = pa.ListArray.from_arrays(pa.array(stops), pa.StructArray.from_arrays(columns, names))
                yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [hits], kept + ["hits"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in kept] + columns, kept + names)

    out = rows.mapInArrow(run, schema)
    return out.withColumn("trigger_timestamp_ns", F.col("timestamp") * p.tick_ns).drop("timestamp") if "timestamp" in kept else out


def in_noise_units(wf: DataFrame, peds: DataFrame, keys: list[str]) -> DataFrame:
    """Exploded samples (``v``) in units of their channel's noise; 0 where that is 0."""
    rows = wf.join(peds.select(*keys, "channel", "rms"), [*keys, "channel"])
    return rows.withColumn("v", F.when(F.col("rms") > 0, F.col("v") / F.col("rms")).otherwise(0.0)).drop("rms")


def seed_regions(wf: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, channel, start, stop``: the seed regions of each waveform (``wf``, in units of noise); null and short ones have none."""
    schema = ", ".join([f"`{c}` {wf.schema[c].dataType.simpleString()}" for c in [*keys, "channel"]] + ["start bigint, stop bigint"])

    def run(batches):
        for b in batches:
            lists = Lists(b, ["wf"])
            found = [(i, *region) for i in range(b.num_rows) for region in derivative_seeds(lists("wf", i).astype(np.float64))]
            at, start, stop = (pa.array(x, pa.int64()) for x in (list(zip(*found)) or [()] * 3))
            yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in [*keys, "channel"]] + [start, stop], [*keys, "channel", "start", "stop"])

    return wf.select(*keys, "channel", F.col("wf").cast("array<double>").alias("wf")).mapInArrow(run, schema)


def find_seeds(events: DataFrame, peds: DataFrame, p: Params, keys: list[str], ped_keys: list[str]) -> DataFrame:
    """``seed_regions`` of event rows, whose waveforms are built, cleaned of common noise and scaled in the task: nothing is shuffled.

    ``peds`` as in ``find_hits``; channels without a pedestal have none of these regions, as their noise isn't known.
    """
    filled = F.map_from_entries(F.collect_list(F.struct("channel", F.struct("mean", "rms"))))
    arrays = peds.filter((F.col("channel") >= 0) & (F.col("channel") < p.channels)).groupBy(*ped_keys).agg(filled.alias("ped"))
    lists_ = ("channel", "sample", "amplitude")
    rows = events.join(arrays, ped_keys).select(*keys, *lists_of(events, lists_), F.map_keys("ped").cast("array<int>").alias("pc"), F.map_values("ped").getField("mean").alias("p_mean"), F.map_values("ped").getField("rms").alias("p_rms"))
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys] + ["channel int, start bigint, stop bigint"])

    def run(batches):
        for b in batches:
            lists, found = Lists(b, [*lists_, "pc", "p_mean", "p_rms"]), []
            for i in range(b.num_rows):
                mean, rms = np.zeros(p.channels), np.zeros(p.channels)
                mean[lists("pc", i)], rms[lists("pc", i)] = lists("p_mean", i), lists("p_rms", i)
                wf, length = dense(lists("channel", i), lists("sample", i), lists("amplitude", i), mean, p)
                if wf.size:
                    common_noise(wf, length)
                    high = np.flatnonzero((length > 0) & (rms > 0))
                    found += [(i, c, *region) for c in high.tolist() for region in derivative_seeds(wf[c, : length[c]] / rms[c])]
            at, channel, start, stop = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(at, pa.int64())) for c in keys] + [pa.array(channel, pa.int32()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())], [*keys, "channel", "start", "stop"])

    return rows.mapInArrow(run, schema)


def tightened(hits: DataFrame, significance: float) -> DataFrame:
    """Hits found with a low threshold, cut to a higher one afterwards."""
    return hits.filter(F.col("significance") >= significance)


def derivative_seeds(wf: np.ndarray, half: int = 3, slope_sigma: float = 3.0, merge: int = 4, amp_sigma: float = 5.0, width: int = 2) -> list[tuple[int, int]]:
    """Diagnostic regions in units of the noise: steepest rises of the smoothed waveform, walked out to the threshold."""
    n = len(wf)
    if n < 3:
        return []
    i = np.arange(n)
    sums = np.concatenate([[0.0], np.cumsum(wf)])
    lo, hi = np.maximum(0, i - half), np.minimum(n, i + half + 1)
    slope = np.gradient((sums[hi] - sums[lo]) / (hi - lo))
    peak = (slope[1:-1] > slope_sigma) & (slope[1:-1] >= slope[:-2]) & (slope[1:-1] >= slope[2:])
    seeds: list[int] = []
    for s in (np.flatnonzero(peak) + 1).tolist():
        if seeds and s - seeds[-1] <= merge:
            seeds[-1] = max(seeds[-1], s, key=lambda x: (slope[x], -x))
        else:
            seeds.append(s)
    low = np.flatnonzero(wf <= amp_sigma)

    def edges(s: int) -> tuple[int, int]:
        before, after = low[low < s], low[low > s]
        return (int(before[-1]) + 1 if len(before) else 0), (int(after[0]) - 1 if len(after) else n - 1)

    out = []
    for k, s in enumerate(seeds):
        a, b = edges(s)
        if k + 1 < len(seeds) and edges(seeds[k + 1])[0] <= b:
            b = s + int(wf[s : seeds[k + 1]].argmin())
        if b - a + 1 >= width:
            out.append((a, b))
    return out
