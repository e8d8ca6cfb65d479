"""The three workloads end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import catalog, cluster, combine, pedestals, pulses, waveform
from ..params import Params
from ..sources import files, inputs


def frames_to_events(frame_files: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event rows, loss figures and sample acceptance of frame files, written below ``path``; the files are read once."""
    return files.write_decoded(files.decode_events(frame_files), path, ["file_num", "feu"])


def events_to_hits(events: DataFrame, pedestal_events: DataFrame, p: Params, keys: list[str], file: list[str], unit: list[str], settings: DataFrame | None = None) -> DataFrame:
    """Pedestals of units from one set of events, hits of files from another, with what ``settings`` says of a file.

    ``settings`` has ``unit`` and any of sample_ns, gate_width and zs_baseline. Events are moved by no shuffle where the
    few rows of pedestals, settings and flags are small enough to broadcast.
    """
    peds = pedestals.from_events(pedestal_events, unit, p, settings)
    zs = waveform.zs_files(events, file) if p.cns else None
    flags = settings if zs is None else zs.join(settings, unit, "left") if settings is not None else None
    return pulses.find_hits(events, peds, p, keys, unit, zs, flags, file if zs is not None else unit)


def unit_settings(units: DataFrame, peaking: DataFrame, runs: DataFrame) -> DataFrame:
    """``run, feu, sample_ns, gate_width, zs_baseline`` of each unit from chip and run configurations."""
    own = units.join(runs, "run", "left").withColumn("sample_ns", F.coalesce("sample_period", F.lit(60.0)))
    own = catalog.gate_widths(own, peaking, F.col("sample_ns"))
    return own.select("run", "feu", "sample_ns", F.col("width").alias("gate_width"), catalog.zs_baseline(F.col("zero_suppress"), F.col("pedestal_subtraction")).alias("zs_baseline"))


def hits_to_clusters(parts: list[tuple[DataFrame, int]], strips: DataFrame, keys: list[str], mm: float = 2.0, ns: float = 10.0) -> DataFrame:
    """Union over units, strip lookup, then clusters; one shuffle, by event."""
    hits = combine.combine_hits(parts)
    mapped = combine.with_strips(hits, combine.last_by_channel(strips))
    return cluster.cluster_hits(combine.event_groups(mapped, keys, ["channel", "pulse_idx"]), keys, mm, ns)


def files_to_clusters(listed: DataFrame, strips: DataFrame, keys: list[str], mm: float = 2.0, ns: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Clusters of all usable files of ``listed`` (``path, feu``), read as one scan, and the health table of all of them."""
    found = files.written(inputs.health(listed, schemas.HITS))
    mapped = combine.with_strips(inputs.read_inputs(listed.sparkSession, found, schemas.HITS), combine.last_by_channel(strips))
    return cluster.cluster_hits(combine.event_groups(mapped, keys, ["channel", "pulse_idx"]), keys, mm, ns), found


def events_to_clusters(events: DataFrame, pedestal_events: DataFrame, strips: DataFrame, p: Params, keys: list[str], unit: list[str], mm: float = 2.0, ns: float = 10.0, settings: DataFrame | None = None) -> DataFrame:
    """From event rows to clusters with hits as an array in the event's row: the events are never shuffled."""
    peds = pedestals.from_events(pedestal_events, unit, p, settings)
    hits = pulses.find_hits(events, peds, p, keys, unit, settings=settings, nested=True)
    return cluster.cluster_nested(hits, combine.last_by_channel(strips), keys, mm, ns)
