"""Noise keeps its digits beside large offsets; conditions on entries read few pages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwave.operators import pedestals, waveform
from siltwave.params import Params
from siltwave.sources import files


def test_noise_to_nine_digits_with_a_large_offset(spark):
    """A channel of which every block has only one: common noise would leave nothing, so pairs of channels are used."""
    rng, rows, own = np.random.default_rng(3), [], {0: [], 200: []}
    for e in range(60):
        samples = []
        for c in (0, 1, 200, 201):
            amplitude = np.round(1_000_000 * (c % 2) + rng.normal(0, 3, 16) + 500_000)
            samples += [(c, s, int(a)) for s, a in enumerate(amplitude)]
        rows.append((1, e, *[list(x) for x in zip(*samples)]))
    events = spark.createDataFrame(rows, "feu int, entry int, channel array<int>, sample array<int>, amplitude array<int>").repartition(7)
    p = Params(boxcar_width=0)
    got = {r.channel: (r.rms, r.rms_gate) for r in pedestals.from_events(events, ["feu"], p).collect()}
    for _, _, channel, _, amplitude in rows:
        wf = np.array(amplitude, float).reshape(4, 16)
        for k, c in ((0, 0), (2, 200)):
            own[c].append(wf[k] - np.maximum(wf[k], wf[k + 1]))  # the upper middle of two
    assert set(channel) == set(got)
    for c, parts in own.items():
        v = np.concatenate(parts)
        want = np.sqrt(((v - v.mean()) ** 2).mean())
        assert got[c] == pytest.approx((want, want), rel=1e-9) and abs(v.mean()) > 9e5 and want < 10
    exploded = events.select("feu", "entry", F.explode(F.arrays_zip("channel", "sample", "amplitude")).alias("s")).select("feu", "entry", "s.*")
    flat = {r.channel: r.rms for r in pedestals.noise(exploded, ["feu"], ["entry"]).collect()}
    assert all(flat[c] == pytest.approx(got[c][0], rel=1e-9) for c in got)


def test_merged_moments_equal_two_passes():
    rng = np.random.default_rng(1)
    n, held, seen = np.zeros(5), np.zeros((2, 5)), [[] for _ in range(5)]
    for _ in range(40):
        length = rng.integers(0, 9, 5)
        v = rng.normal(1e6, 1, (5, 9))
        pedestals.merge_moments(n, held, length, v, np.arange(9) < length[:, None])
        n += length
        for c in range(5):
            seen[c] += v[c, : length[c]].tolist()
    for c in range(5):
        assert held[0, c] == pytest.approx(np.mean(seen[c]), rel=1e-12) and held[1, c] / n[c] == pytest.approx(np.var(seen[c]), rel=1e-9)


def test_first_entries_read_few_pages(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = []
        for n in (1_000, 8_000):
            events = spark.range(n).selectExpr("'r' run", "'s' sub_run", "1 file_num", "cast(id % 2 as int) feu", "id div 2 entry", "sequence(0, 99) channel").repartition(5)
            files.write_table(events, f"{tmp_path}/{n}", page_rows=50)
            table = spark.read.parquet(f"{tmp_path}/{n}")
            out = waveform.zs_files(table, ["feu"])
            plan = out._jdf.queryExecution().executedPlan()
            assert sorted((r.feu, r.is_zs) for r in out.collect()) == [(0, True), (1, True)]
            scan = plan.collectLeaves().head()
            read.append(scan.metrics().apply("numOutputRows").value())
        assert read[0] == read[1] < 1_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
