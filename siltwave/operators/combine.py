"""Union of hits over readout units, strip map lookups and compatible pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def combine_hits(parts: list[tuple[DataFrame, int]]) -> DataFrame:
    """All hits with their unit; older tables without flags or significance get false, false and -1."""
    tagged = [hits.withColumn("feu", F.lit(feu)) for hits, feu in parts]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    defaults = {"trunc_left": F.lit(False), "trunc_right": F.lit(False), "significance": F.lit(-1.0)}
    return both.withColumns({c: F.coalesce(F.col(c), v) if c in both.columns else v for c, v in defaults.items()})


def last_by_channel(strips: DataFrame, line: str = "line_no") -> DataFrame:
    """One row for each ``connector * 64 + connectorChannel``, the later line winning."""
    keyed = strips.withColumn("channel", F.col("connector") * 64 + F.col("connectorChannel"))
    rest = [c for c in keyed.columns if c not in ("channel", line)]
    best = keyed.groupBy("channel").agg(F.max_by(F.struct(*rest), line).alias("s"))
    return best.select("channel", "s.*")


def with_strips(hits: DataFrame, strips: DataFrame) -> DataFrame:
    """Hits with axis and place; hits without a strip are dropped. Spark broadcasts the map where it is small enough."""
    return hits.join(strips.select("channel", "axis", "x", "y"), "channel")


def channels_of_axis(strips: DataFrame, axis: str) -> DataFrame:
    """Channels of the x axis, or of the y axis for any other name."""
    return strips.filter(F.col("axis") == ("x" if axis == "x" else "y")).select("channel")


def coverage(strips: DataFrame, channels: int = 256) -> DataFrame:
    """Whether each of the first channels has a strip."""
    every = strips.sparkSession.range(channels).select(F.col("id").alias("channel"))
    return every.join(strips.select("channel", "axis"), "channel", "left").select("channel", F.col("axis").isNotNull().alias("mapped"), "axis")


def compatible_pairs(hits: DataFrame, keys: list[str], mm: float = 2.0, ns: float = 10.0) -> DataFrame:
    """Pairs of hits of one event and axis that are near in space and time.

    Hits are put into cells of ``mm`` by ``mm`` by ``ns``; a hit meets only those of its own cell and of half the cells around it, so
    each pair of cells meets once and a noisy event doesn't pair everything with everything, on strips of either axis.
    ``ord`` orders the hits of an event.
    """
    pairs = pair_candidates(hits, keys, mm, ns)
    near = (F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2) <= mm * mm) & (F.abs(F.col("time") - F.col("time2")) <= ns)
    return pairs.filter(near).select(*keys, "axis", F.least("ord", "ord2").alias("ord"), F.greatest("ord", "ord2").alias("ord2"))


def pair_candidates(hits: DataFrame, keys: list[str], mm: float, ns: float) -> DataFrame:
    """The pairs of hits whose cells touch, each once, before their distance is looked at.

    Both sides grow with the hits and one of them has every hit 14 times, which Spark's estimate leaves out; so they are merged
    as sorted partitions and neither is ever sent whole to the driver and all tasks.
    """
    base = hits.select(*keys, "axis", "ord", "x", "y", "time")
    cell = {"cx": ("x", mm), "cy": ("y", mm), "ct": ("time", ns)}
    a = base.withColumns({c: F.floor(F.col(v) / size) for c, (v, size) in cell.items()})
    b = base.select(*keys, "axis", *[F.col(c).alias(f"{c}2") for c in ("ord", "x", "y", "time")])
    half = [(i, j, k) for i in (0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) >= (0, 0, 0)]
    b = b.withColumn("o", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(cell, o)]) for o in half])))
    b = b.withColumns({c: F.floor(F.col(f"{v}2") / size) + F.col("o").getField(c) for c, (v, size) in cell.items()}).drop("o")
    own = reduce(lambda x, y: x & y, [F.floor(F.col(f"{v}2") / size) == F.col(c) for c, (v, size) in cell.items()])
    return a.join(b.hint("merge"), [*keys, "axis", *cell]).filter(~own | (F.col("ord") < F.col("ord2")))


def event_groups(hits: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``ord``: a hit's place in its event, by channel and pulse."""
    return hits.withColumn("ord", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)
