"""Packed event rows give what lists give."""

from siltwave.operators import pedestals, pulses, waveform
from siltwave.params import Params
from siltwave.plans import adapters, jobs, registry

SF = "/root/testdata/sf0.001"


def test_packed_events_give_the_same_hits_and_pedestals(spark, tmp_path):
    p = Params(boxcar_width=5)
    events, quiet = adapters.shaped_events(spark, SF), adapters.shaped_events(spark, SF, quiet=True)
    pulses.pack(events.repartition(3)).write.parquet(f"{tmp_path}/events")
    packed, packed_quiet = spark.read.parquet(f"{tmp_path}/events"), pulses.pack(quiet)
    assert [packed.schema[c].dataType.typeName() for c in ("sample", "channel", "amplitude")] == ["binary"] * 3
    a, b = (pedestals.from_events(x, ["feu"], p) for x in (quiet, packed_quiet))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
    one, two = (registry.rounded(jobs.events_to_hits(x, y, p, ["feu", "entry"], ["feu"], ["feu"])) for x, y in ((events, quiet), (packed, packed_quiet)))
    assert one.exceptAll(two).count() == 0 and one.count() == two.count() > 20
    seeds = [pulses.find_seeds(x, a, p, ["feu", "entry"], ["feu"]) for x in (events, packed)]
    assert seeds[0].exceptAll(seeds[1]).count() == 0 and seeds[0].count() > 20


def test_null_empty_and_far_values(spark):
    rows = [("a", 0, None, None, None), ("a", 1, [], [], []), ("b", 0, [0, 767], [5, 70_000], [4095, 0]), ("b", 1, [1, 1], [511, 512], [7, 8])]
    events = spark.createDataFrame(rows, "file string, entry int, sample array<int>, channel array<int>, amplitude array<int>").coalesce(1)
    packed = pulses.pack(events)
    got = {(r.file, r.entry): (r.n_channels, r.channel and bytes(r.channel)) for r in packed.collect()}
    assert got == {("a", 0): (0, None), ("a", 1): (0, b""), ("b", 0): (1, b"\x05\x00\xff\xff"), ("b", 1): (1, b"\xff\x01\x00\x02")}
    for x in (events, packed):
        assert sorted(map(tuple, waveform.zs_files(x, ["file"], dense=1).collect())) == [("a", True), ("b", False)]
    peds = [sorted((r.file, r.channel, r.mean) for r in pedestals.from_events(x, ["file"], Params()).filter("channel < 600").collect()) for x in (events, packed)]
    assert peds[0] == peds[1] == [("b", 5, 4095.0), ("b", 511, 7.0), ("b", 512, 8.0)]
    assert pulses.pack(events.limit(0)).count() == 0
