"""Clusters and pairs of hits: the hashed forms against plain loops, and the form without a shuffle."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwave.operators import cluster, combine, pedestals, pulses
from siltwave.params import Params
from siltwave.plans import adapters, registry

SF = "/root/testdata/sf0.001"


def by_loop(axis, x, y, t, mm, ns):
    out, made = [], 0
    for i in range(len(x)):
        near = [out[j] for j in range(i) if axis[j] == axis[i] and (x[j] - x[i]) ** 2 + (y[j] - y[i]) ** 2 <= mm * mm and abs(t[j] - t[i]) <= ns]
        out.append(min(near) if near else made)
        made += not near
    return out


@pytest.mark.parametrize("seed", range(20))
def test_first_fit_equals_the_loop(seed):
    rng = np.random.default_rng(seed)
    n, wide, late = 250, rng.choice([3, 10, 40]), rng.choice([15, 80, 400])
    axis = rng.choice(["x", "y"], n)
    x, y, t = rng.uniform(-wide, wide, n), rng.uniform(-wide, wide, n), rng.uniform(0, late, n)
    if seed % 2:  # places and times on the limits
        x, y, t = np.round(x), np.round(y), np.round(t / 5) * 5
    mm, ns = (2.0, 10.0) if seed % 5 else (0.0, 10.0) if seed % 2 else (3.0, 0.0)
    assert cluster.first_fit(axis, x, y, t, mm, ns).tolist() == by_loop(axis, x, y, t, mm, ns)


@pytest.mark.parametrize("wide", [2.0, 60.0, 2000.0])
def test_an_event_of_50_000_hits_takes_seconds(wide):
    rng = np.random.default_rng(1)
    n = 50_000
    began = time.process_time()
    label = cluster.first_fit(np.full(n, "x"), rng.uniform(0, wide, n), np.zeros(n), rng.uniform(0, 500, n), 2.0, 10.0)
    assert time.process_time() - began < 20 and label.max() > 0


def test_pairs_are_those_of_the_loop_with_few_candidates(spark):
    rng = np.random.default_rng(2)
    rows = [(int(e), str(a), k, float(x), float(y), float(t)) for e in range(3) for k, (a, x, y, t) in enumerate(zip(rng.choice(["x", "y"], 150), rng.uniform(-9, 9, 150).round(), rng.uniform(-9, 9, 150).round(), rng.uniform(0, 90, 150).round()))]
    rows += [(9, "y", k, 0.0, float(k % 40), float(k)) for k in range(400)]  # one strip column: all at one x
    hits = spark.createDataFrame(rows, "event int, axis string, ord int, x double, y double, time double")
    got = sorted(map(tuple, combine.compatible_pairs(hits, ["event"]).collect()))
    want = sorted((a[0], a[1], a[2], b[2]) for a in rows for b in rows if a[:2] == b[:2] and a[2] < b[2] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 4 and abs(a[5] - b[5]) <= 10)
    assert got == want
    held = combine.pair_candidates(hits, ["event"], 2.0, 10.0).count()
    by_x = sum(1 for a in rows for b in rows if a[:2] == b[:2] and a[2] < b[2] and abs(a[3] // 2 - b[3] // 2) <= 1)
    assert held * 8 < by_x


def test_no_side_of_the_pairs_is_broadcast(spark):
    """Every hit stands 14 times on one side, which an estimate by columns leaves out: sent whole it fills the driver."""
    hits = spark.range(4000).selectExpr("id div 8 as event", "'x' as axis", "id % 8 as ord", "cast(id % 5 as double) as x", "cast(id % 7 as double) as y", "cast(id % 25 as double) as time")
    pairs = combine.compatible_pairs(hits, ["event"])
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Broadcast" not in plan


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]


def test_from_events_to_clusters_without_a_shuffle(spark, tmp_path):
    adapters.shaped_events(spark, SF).write.parquet(f"{tmp_path}/events")
    adapters.shaped_events(spark, SF, quiet=True).write.parquet(f"{tmp_path}/quiet")
    events, quiet, p = spark.read.parquet(f"{tmp_path}/events"), spark.read.parquet(f"{tmp_path}/quiet"), Params(boxcar_width=0, cns=False)
    pedestals.from_events(quiet, ["feu"], p).write.parquet(f"{tmp_path}/peds")
    strips = combine.last_by_channel(adapters.strips(spark, SF))
    hits = pulses.find_hits(events, spark.read.parquet(f"{tmp_path}/peds"), p, ["feu", "entry"], ["feu"], nested=True)
    clusters = cluster.cluster_nested(hits, strips, ["feu", "entry"])
    clusters.collect()
    scan = [x for x in exchanges(clusters) if "embedding" in x or "amplitude" in x]
    assert not scan and len(exchanges(clusters)) <= 2  # the pedestals' small ones
    flat = pulses.find_hits(events, spark.read.parquet(f"{tmp_path}/peds"), p, ["feu", "entry"], ["feu"])
    assert registry.rounded(hits.select(*[c for c in hits.columns if c != "hits"], F.explode("hits").alias("h")).select("*", "h.*").drop("h", "hits")).exceptAll(registry.rounded(flat)).count() == 0
    shuffled = cluster.cluster_hits(combine.event_groups(combine.with_strips(flat, strips), ["feu", "entry"], ["channel", "pulse_idx"]), ["feu", "entry"])
    want = sorted(map(tuple, shuffled.collect()))
    assert sorted(map(tuple, clusters.collect())) == want and len(want) > 5
    joined = cluster.cluster_nested(hits, strips, ["feu", "entry"], most_strips=3)  # too large a map: joined instead
    assert sorted(map(tuple, joined.collect())) == want


def test_events_without_hits_or_strips(spark):
    hits = "array<struct<channel:int,pulse_idx:int,time:double>>"
    events = spark.createDataFrame([(1, None), (2, []), (3, [(7, 0, 5.0), (2, 1, 6.0), (2, 0, 90.0)])], f"entry int, hits {hits}")
    strips = spark.createDataFrame([(2, "x", 0.0, 0.0), (5, "x", 0.0, 0.0)], "channel int, axis string, x double, y double")
    out = cluster.cluster_nested(events, strips, ["entry"])
    assert sorted((r.entry, r.cluster_id, r.channels) for r in out.collect()) == [(3, 0, [2]), (3, 1, [2])]
    assert cluster.cluster_nested(events, strips.limit(0), ["entry"]).count() == 0
