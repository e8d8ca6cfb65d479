"""Greedy clustering of an event's hits in space and time, in the order of the hits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .combine import event_groups, with_strips


def first_fit(axis: np.ndarray, x: np.ndarray, y: np.ndarray, t: np.ndarray, mm: float, ns: float) -> np.ndarray:
    """Cluster numbers in order of creation: a hit joins the earliest cluster of its axis that holds a hit near it.

    A hit that is near two clusters joins the first and leaves them apart. Places are hashed into cells within which any two
    are near, times into spans of ``ns``; a cell, and each place in it, keeps by span and cluster the first and last time. So
    a hit looks at its own cell and at the places of those around it that may hold an earlier cluster, not at all hits.
    """
    side = mm / 2**0.5 * (1 - 1e-9) or 1.0
    column, row = (np.floor(v / side).astype(np.int64).tolist() for v in (x, y))
    span = np.floor(t / (ns * (1 - 1e-9))).astype(np.int64).tolist() if ns > 0 else (2 * np.unique(t, return_inverse=True)[1]).tolist()
    around = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if i or j]
    kinds, xs, ys, ts = axis.tolist(), x.tolist(), y.tolist(), t.tolist()
    cells: dict[tuple, tuple[dict, dict]] = {}  # by axis and place: times of the cell, and of each place in it
    out, made = np.empty(len(kinds), np.int64), 0

    def least(times: dict, c: int, at: float, best: int) -> int:
        """The least cluster below ``best`` with a time near ``at``, which lies in span ``c``; else ``best``."""
        if c in times:
            best = min(best, min(times[c]))
        for label, (_, last) in times.get(c - 1, {}).items():
            if label < best and at - last <= ns:
                best = label
        for label, (first, _) in times.get(c + 1, {}).items():
            if label < best and first - at <= ns:
                best = label
        return best

    def add(times: dict, c: int, at: float, label: int) -> None:
        own = times.setdefault(c, {})
        first, last = own.get(label, (at, at))
        own[label] = (min(first, at), max(last, at))

    for i, (a, px, py, at, c) in enumerate(zip(kinds, xs, ys, ts, span)):
        u, v = column[i], row[i]
        own = cells.get((a, u, v))
        best = least(own[0], c, at, made) if own and mm > 0 else made
        for du, dv in around if mm > 0 else [(0, 0)]:
            near = cells.get((a, u + du, v + dv))
            if near and least(near[0], c, at, best) < best:
                for (qx, qy), times in near[1].items():
                    if (qx - px) ** 2 + (qy - py) ** 2 <= mm * mm:
                        best = least(times, c, at, best)
        made += best == made
        out[i] = best
        whole, places = cells.setdefault((a, u, v), ({}, {}))
        add(whole, c, at, best)
        add(places.setdefault((px, py), {}), c, at, best)
    return out


def clusters_of(source: int, axis, x, y, t, channel, mm: float, ns: float):
    """``(source, cluster, axis, channels)`` of one event's hits, which are in order."""
    label = first_fit(axis, x, y, t, mm, ns)
    order = np.argsort(label, kind="stable")
    stops = np.flatnonzero(np.diff(label[order], append=-1)) + 1
    for k, (i, j) in enumerate(zip([0, *stops[:-1].tolist()], stops.tolist())):
        yield source, k, str(axis[order[i]]), channel[order[i:j]].tolist()


def cluster_batch(b: pa.RecordBatch, keys: list[str], found: list) -> pa.RecordBatch:
    source, ids, axes, members = list(zip(*found)) or [()] * 4
    at = pa.array(source, pa.int64())
    columns = [pa.array(ids, pa.int64()), pa.array(axes, pa.string()), pa.array([len(m) for m in members], pa.int64()), pa.array(members, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([b.column(c).take(at) for c in keys] + columns, [*keys, "cluster_id", "axis", "n_hits", "channels"])


def cluster_schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys] + ["cluster_id long, axis string, n_hits long, channels array<bigint>"])


def cluster_hits(hits: DataFrame, keys: list[str], mm: float = 2.0, ns: float = 10.0) -> DataFrame:
    """``keys, cluster_id, axis, n_hits, channels`` from mapped hits with ``ord, channel, axis, x, y, time``.

    The one shuffle is by event; an event's hits are bounded by its channels and window. A batch of events goes through
    one call, and the helper gives finished clusters, so nothing is grouped again.
    """
    fields = ("ord", "channel", "axis", "x", "y", "time")
    member = F.struct(F.col("ord").cast("long").alias("ord"), F.col("channel").cast("long").alias("channel"), F.col("axis").cast("string").alias("axis"), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "time")])
    events = hits.groupBy(*keys).agg(F.sort_array(F.collect_list(member)).alias("h"))
    flat = events.select(*keys, *[F.col("h").getField(f).alias(f) for f in fields])

    def run(batches):
        for b in batches:
            found = []
            for i in range(b.num_rows):
                col = {f: np.array(b.column(f)[i].as_py()) for f in fields}
                found += clusters_of(i, col["axis"], col["x"], col["y"], col["time"], col["channel"], mm, ns)
            yield cluster_batch(b, keys, found)

    return flat.mapInArrow(run, cluster_schema(flat, keys))


def cluster_nested(events: DataFrame, strips: DataFrame, keys: list[str], mm: float = 2.0, ns: float = 10.0, most_strips: int = 1 << 18) -> DataFrame:
    """``cluster_hits`` of event rows with their ``hits`` as an array (``channel, pulse_idx, time`` of each): nothing is shuffled.

    The strip map of one detector (``channel, axis, x, y``, one row a channel) goes to the tasks; a map of over ``most_strips`` rows
    isn't sent, and the hits are joined to it and grouped instead. Hits without a strip are left out, null arrays are empty.
    """
    known = strips.select("channel", F.col("axis").cast("string").alias("axis"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("channel is not null")
    table = known.limit(most_strips + 1).toArrow()
    if len(table) > most_strips:
        hits = events.select(*keys, F.explode("hits").alias("h")).select(*keys, "h.*")
        return cluster_hits(event_groups(with_strips(hits, strips), keys, ["channel", "pulse_idx"]), keys, mm, ns)
    place = events.sparkSession.sparkContext.broadcast(table.sort_by("channel").to_pydict())
    picked = events.select(*keys, F.transform("hits", lambda h: F.struct(h.channel.cast("long").alias("channel"), h.pulse_idx.cast("long").alias("pulse_idx"), h.time.cast("double").alias("time"))).alias("hits"))

    def run(batches):
        strip = {c: np.array(v) for c, v in place.value.items()}
        for b in batches:
            lists, found = b.column("hits"), []
            stops, flat = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]), lists.flatten()
            channel, pulse, time = (f.to_numpy(zero_copy_only=False) for f in flat.flatten())
            at = np.minimum(np.searchsorted(strip["channel"], channel), max(0, len(strip["channel"]) - 1))
            there = strip["channel"][at] == channel if len(strip["channel"]) else np.zeros(len(channel), bool)
            for i, (j, k) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist())):
                own = np.flatnonzero(there[j:k]) + j
                own = own[np.lexsort((pulse[own], channel[own]))]
                if len(own):
                    s = at[own]
                    found += clusters_of(i, strip["axis"][s], strip["x"][s], strip["y"][s], time[own], channel[own], mm, ns)
            yield cluster_batch(b, keys, found)

    return picked.mapInArrow(run, cluster_schema(picked, keys))
