"""Event assembly by chunks equals a walk along each file."""

import random

import pytest

from siltwave.operators import loss
from siltwave.sources.files import closed_entries

SCHEMA = "file string, unit int, frame_idx long, event_id long, eoe boolean, n_data long, chunk string, run int, data string"


def table():
    rng, rows = random.Random(6), []
    for k in range(30):
        event, at = 0, rng.randrange(100)
        for _ in range(rng.choice([1, 2, 5, 40, 300])):
            event += rng.random() < (0.05 if k % 3 else 0.4)
            rows.append((f"f{k % 10}", k // 10, at, event, rng.random() < (0.02, 0.2, 0.0)[k % 3], rng.choice([0, 0, 0, 3]) if k % 4 else 0 if rng.random() < 0.97 else 1, "c", 1, "d"))
            at += rng.choice([1, 1, 1, 2, 40])
    return rows


def by_walk(rows):
    files, out = {}, set()
    for r in rows:
        files.setdefault(r[:2], []).append(r)
    for key, own in files.items():
        frames = [{"frame_idx": r[2], "event_id": r[3], "eoe": r[4], "channel": [0] * r[5]} for r in sorted(own, key=lambda r: r[2])]
        for k, (reason, held) in enumerate(closed_entries(frames)):
            out |= {(*key, f["frame_idx"], None if reason is None else k, reason) for f in held}
    return out


@pytest.mark.parametrize("chunk", [1, 3, 17, 1 << 16])
def test_chunks_of_any_size_equal_the_walk(spark, chunk):
    frames = spark.createDataFrame(table(), SCHEMA).repartition(4)
    out = loss.assemble(frames.drop("chunk", "run", "data"), ["file", "unit"], chunk)
    got = [(r.file, r.unit, r.frame_idx, r.entry, r.reason) for r in out.collect()]
    assert len(got) == len(table()) and set(got) == by_walk(table())


def test_one_long_file_spreads_over_all_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frames = spark.range(20_000).selectExpr("'one' file", "id frame_idx", "id div 40 event_id", "id % 7 = 0 eoe", "id % 5 n_data")
        out = loss.assemble(frames, ["file"], chunk=100)
        sizes = out.groupBy(loss.F.spark_partition_id()).count().collect()
        assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 6_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
