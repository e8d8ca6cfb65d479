"""Edge rules that the tables don't reach, by hand-worked cases."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwave.operators import catalog, cluster, combine, loss, pedestals, pulses, waveform
from siltwave.params import Params
from siltwave.plans import adapters, jobs, registry
from siltwave.sources import files

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fused_job_agrees_with_composed_operators(spark):
    fused = {(r.feu, r.entry, r.channel, r.start): r for r in registry.fused_hits(spark, SF).withColumn("start", F.col("left_sample").cast("long") + 0).collect()}
    wf, peds, found = registry.found(spark, SF)
    own = found.join(waveform.waveforms(wf, registry.EVENT), [*registry.EVENT, "channel"])
    composed = waveform.measures(waveform.bounds(own, registry.EVENT)).filter("width >= 3").collect()
    assert len(composed) == len(fused) > 20
    by_place = {(r.feu, r.entry, r.channel): r for r in fused.values()}
    for r in composed:
        hit = by_place[(r.feu, r.entry, r.channel)]
        late = (r.entry % 6) * 10 / 60
        assert hit.amplitude == pytest.approx(r.amplitude) and hit.local_baseline == pytest.approx(r.baseline)
        assert hit.max_sample - late == pytest.approx(r.max_sample) and hit.integral == pytest.approx(r.integral)
        assert hit.trunc_left == r.trunc_left and hit.trunc_right == r.trunc_right
        assert hit.trigger_timestamp_ns == r.entry * 10_000


def find(wf, gate=None, rms=1.0, **kw):
    wf = np.array([wf], float)
    gate_, one = wf if gate is None else np.array([gate], float), np.array([rms])
    got = pulses.event_pulses(wf, gate_, np.array([wf.shape[1]]), one, one, np.array([4095.0]), gate is not None, Params(**kw))
    return [dict(zip(["channel", "pulse_idx", *pulses.NUMBERS, *pulses.FLAGS], x)) for x in got]


def runs(v, limit, gap):
    return list(zip(*pulses.above(np.array([v], float) > limit, gap)[1:]))


def test_bridging_and_width():
    assert len(find([0, 0, 6, 6, 6, 4, 4, 6, 6, 6, 0, 0])) == 1
    assert runs([0, 0, 6, 6, 6, 4, 4, 4, 6, 6, 6, 0.0], 5.0, 2) == [(2, 4), (8, 10)]
    two = find([0, 0, 9, 9, 9, 0, 0, 0, 9, 9, 9, 0])  # bridging doesn't undo a deep valley
    assert len(find([0, 0, 9, 9, 9, 0, 0, 9, 9, 9, 0, 0])) == 2
    assert [(p["left_sample"], p["local_max"]) for p in two] == [(1 + 5 / 9, 9.0), (7 + 5 / 9, 9.0)]
    assert find([0, 0, 9, 9, 0, 0]) == [] and find([9, 9]) == []


def test_valleys():
    assert pulses.split(np.array([0.0, 9, 20, 9, 6, 9, 20, 9, 0]), 1, 7, 4.0, 3) == [(1, 3), (4, 7)]
    assert pulses.split(np.array([0.0, 9, 20, 18, 17, 18, 20, 9, 0]), 1, 7, 4.0, 3) == [(1, 7)]
    three = np.array([9.0, 20, 9, 6, 9, 30, 9, 7, 9, 25, 9])
    assert pulses.split(three, 0, 10, 4.0, 3) == [(0, 2), (3, 6), (7, 10)]
    hit = find([0, 0, 0, 9, 20, 9, 6, 9, 20, 9, 0, 0])
    assert hit[1]["local_baseline"] == 6.0  # the valley is the level of the right half


def test_truncation_plateau_and_saturation():
    assert find([9, 9, 9, 0, 0])[0]["trunc_left"] and find([0, 0, 9, 9, 9])[0]["trunc_right"]
    assert find([0, 0, 0, 0, 6, 9, 9, 9, 6, 0])[0]["max_sample"] == 6.0
    assert find([0, 0, 0, 0, 9, 9, 9, 6, 6, 0], timing_fraction=0.3)[0]["local_max"] == 9.0
    up, down = np.linspace(500, 3500, 4), np.linspace(3500, 500, 4)
    hit = find([0, 0, 0, 0, *up, 4090, 4090, 4090, *down, 0, 0, 0])[0]
    assert hit["saturated"] and hit["amplitude"] > 4090 and hit["max_sample"] == pytest.approx(9.0)
    assert not find([0, 0, 0, 0, 2000, 4090, 2000, 0, 0])[0]["saturated"]
    edge = find([0, 0, 0, 0, 1000, 4090, 4090, 4090, 4090])[0]
    assert edge["saturated"] and edge["max_sample"] == 5.0  # no falling side: first saturated sample
    assert len(find([0, 0, 0, 0, 9, 20, 9, 6, 9, 30, 9, 0, 0], many_peaks=False)) == 1


def test_common_noise_takes_the_upper_middle():
    wf = np.array([[1.0, 5], [2, 7], [3, 6], [4, 0]])
    pulses.common_noise(wf, np.array([2, 2, 2, 1]))
    assert wf.tolist() == [[-2, -1], [-1, 1], [0, 0], [1, 0]]
    data = np.random.default_rng(1).integers(0, 99, (64, 7)).astype(float)
    pulses.common_noise(data, np.full(64, 7))
    assert (np.sort(data, axis=0)[32] == 0).all()


def test_dense_rules():
    p = Params(channels=4, samples=9)
    wf, length = pulses.dense(np.array([1, 1, 1, 9, 2]), np.array([0, 3, 3, 0, 20]), np.array([5.0, 6, 8, 1, 1]), np.full(4, 1.0), p)
    assert length.tolist() == [0, 4, 0, 0] and wf[1].tolist() == [4, 0, 0, 7]


def test_injected_pulses_are_recovered(spark):
    hits = registry.fused_hits(spark, SF).collect()
    assert len(hits) >= 30
    for h in hits:
        assert h.channel % 16 == h.entry % 16 and abs(h.max_sample - (h.entry % 6) / 6 - 20 - h.channel % 8) < 1
        assert 1700 < h.amplitude < 3000


def test_thresholds_are_monotone(spark):
    peds = pedestals.pedestals(adapters.samples(spark, SF), ["feu"], ["entry"])
    n = [pulses.find_hits(adapters.events(spark, SF), peds, Params(boxcar_width=0, threshold=t), ["feu", "entry"], ["feu"]).count() for t in (3.0, 5.0, 8.0)]
    assert n[0] >= n[1] >= n[2] > 0


def frame(event, sample, zs, data, eoe, ts=0, ftst=0):
    head = [0x6000 | (0x400 if zs else 0) | 7, 0x6000 | event & 0xFFF, 0x6000 | ts & 0xFFF, 0x6000 | sample << 3 | ftst, 0x6000 | event >> 12, 0x6000 | ts >> 12 & 0xFFF, 0x6000 | ts >> 24 & 0xFFF, 0x6000 | ts >> 36 & 0xFF]
    if zs:
        body = [w for c, a in data for w in (0x1000 | (c // 64) << 6 | c % 64, a)]
    else:
        body = [w for chip, block in data for w in [0x2000, 0x2000, 0x2000, 0x2000 | chip << 9, *block, 0x4000, 0x4000]]
    return head + body + [0x7000 | (0x800 if eoe else 0), 0x1234]


def test_decode_round_trip(spark, tmp_path):
    rng = random.Random(1)
    zs = frame(70_000, 3, True, [(5, 100), (130, 4095)], True, ts=1 << 40, ftst=5) + frame(70_001, 0, True, [], True)
    block = lambda n=64: [rng.randrange(4096) for _ in range(n)]
    b = [block(), block(), block(63), block()]
    raw = frame(1, 0, False, [(0, b[0])], False) + frame(1, 1, False, [(1, b[1])], False) + frame(2, 0, False, [(0, b[2])], False) + frame(3, 0, False, [(2, b[3])], False)
    for name, w in (("r_datrun_x_001_02.fdf", zs), ("r_datrun_x_002_03.fdf", raw), ("r_datrun_x_003_03.fdf", [])):
        (tmp_path / name).write_bytes(np.array(w, ">u2").tobytes())
    got = files.decode(files.read_frames(spark, [str(tmp_path)])).orderBy("file_num", "frame_idx").collect()
    assert len(got) == 6
    assert (got[0].event_id, got[0].timestamp, got[0].sample_id, got[0].ftst, got[0].eoe) == (70_000, 1 << 40, 3, 5, True)
    assert (got[0].channel, got[0].amplitude) == ([5, 130], [100, 4095]) and got[1].n_data == 0 and got[1].eoe
    assert got[3].channel == list(range(64, 128)) and got[3].amplitude == b[1] and got[4].bad_blocks == 1
    events, stats, acceptance = jobs.frames_to_events(files.read_frames(spark, [str(tmp_path)]), str(tmp_path / "out"))
    assert [(r.file_num, r.entry, r.eventId, len(r.amplitude)) for r in events.orderBy("file_num", "entry").collect()] == [(1, 0, 70_000, 2), (1, 1, 70_001, 0), (2, 0, 1, 128), (2, 1, 2, 63), (2, 2, 3, 64)]
    s = {r.file_num: r for r in stats.collect()}
    assert stats.columns == ["file_num", "feu", *loss.STATS]
    assert (s[1].closed_eoe, s[1].events, s[1].raw_mode, s[1].events_missing) == (2, 2, 0, 0)
    assert (s[2].closed_eventid, s[2].closed_eof, s[2].raw_mode, s[2].samples_expected, s[2].feu_frames) == (2, 1, 1, 2, 4)
    assert s[2].sample_acceptance_mean == pytest.approx(4 / 6)
    assert {(r.file_num, r.sample): r.acceptance for r in acceptance.collect()} == {(1, 0): 0.5, (1, 1): 0, (1, 2): 0, (1, 3): 0.5, (2, 0): 1, (2, 1): pytest.approx(1 / 3)}
    # the same from frames as a table
    own = loss.entries(loss.assemble(files.decode(files.read_frames(spark, [str(tmp_path)])), ["file_num", "feu"]), ["file_num", "feu"])
    assert rows(loss.decode_stats(own, ["file_num", "feu"])) == rows(stats)
    assert [r.lossy for r in loss.accounting(own, ["file_num", "feu"]).orderBy("file_num").collect()] == [False, True]


def test_greedy_clusters(spark):
    x = np.array([0.0, 3, 1.5, 9])
    same = np.zeros(4)
    assert cluster.first_fit(np.array(list("xxxx")), x, same, same, 2.0, 10.0).tolist() == [0, 1, 0, 2]  # the bridge joins the first
    assert cluster.first_fit(np.array(list("xyxx")), x * 0, same, np.array([0, 0, 5, 30.0]), 2.0, 10.0).tolist() == [0, 1, 0, 2]
    hits = registry.mapped(spark, SF).collect()
    events = {}
    for h in sorted(hits, key=lambda h: (h.event, h.ord)):
        made = events.setdefault(h.event, [])
        for c in made:
            if any(o.axis == h.axis and (o.x - h.x) ** 2 + (o.y - h.y) ** 2 <= 4 and abs(o.time - h.time) <= 10 for o in c):
                c.append(h)
                break
        else:
            made.append([h])
    want = sorted((e, k, c[0].axis, len(c), ",".join(str(o.channel) for o in c)) for e, cs in events.items() for k, c in enumerate(cs))
    assert rows(registry.j7_j9_clusters(spark, SF)) == sorted(want, key=repr)


def test_many_run_configs_are_read_by_many_tasks(spark, tmp_path):
    for k in range(0, 2500, 2):
        (tmp_path / f"r{k}").mkdir()
        (tmp_path / f"r{k}" / "run_config.json").write_text(json.dumps({"dream_daq_info": {"sample_period": k}}))
    runs = spark.range(2500).coalesce(1).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("run"))
    got = files.read_run_config(spark, runs.union(spark.createDataFrame([("r2",), (None,)], "run string")).coalesce(1), str(tmp_path))
    assert got.rdd.getNumPartitions() >= 3
    want = {f"r{k}": 60.0 if k % 2 else float(k) for k in range(2500)}
    assert sorted((r.run or "", r.sample_period) for r in got.collect()) == sorted([*want.items(), ("r2", 2.0), ("", 60.0)])
    with pytest.raises(FileNotFoundError):
        files.read_run_config(spark, runs, str(tmp_path / "none"))


def test_sources(spark, tmp_path):
    (tmp_path / "map.csv").write_text("\n c,cc,s,a,p,i,n,x,y\n\n0,5,1,x,1,1,2::3,0.5,1\nshort,line\n1,6,2,y,1,1,,1,2,extra\n0,5,9,y,1,1,4,7,8\n")
    strips = combine.last_by_channel(files.read_strip_map(spark, str(tmp_path / "map.csv")))
    assert {r.channel: (r.axis, r.x, r.neighbours) for r in strips.collect()} == {5: ("y", 7.0, [4]), 70: ("y", 1.0, [])}
    for run, text in (("r1", json.dumps({"dream_daq_info": {"sample_period": 40, "zero_suppress": True}})), ("r2", "{"), ("r4", "{}")):
        (tmp_path / "runs" / run).mkdir(parents=True)
        (tmp_path / "runs" / run / "run_config.json").write_text(text)
    named = spark.createDataFrame([("r1",), ("r2",), ("r3",), ("r4",)], "run string")
    got = rows(files.read_run_config(spark, named, str(tmp_path / "runs")))  # r3 has no file
    assert got == [("r1", 40.0, True, False, None)] + [(r, 60.0, False, False, None) for r in ("r2", "r3", "r4")]
    (tmp_path / "list.txt").write_text("a.root 3\nb.root 4\n")
    assert rows(files.read_combine_list(spark, str(tmp_path / "list.txt"))) == [("a.root", 3), ("b.root", 4)]
    lines = ["Feu * Dream * 1 0x0 0x0030", "Feu 4 Dream * 1 0x0 0x0080 # slow", "Feu 4 Dream * 1 0 0x00F0", "Feu 4 Dream * 1 0 zz", "# Feu 4 Dream * 1 0 0x0000", "Feu 5 Dream 1 2 0 0x0010", "Feu 6 Dream 1 1 0 10 more"]
    (tmp_path / "chip.cfg").write_text("\n".join(lines))
    peaking = catalog.peaking_times(files.read_config_lines(spark, str(tmp_path / "chip.cfg")))
    assert {r.feu_key: r.ns for r in peaking.collect()} == {"*": 228, "4": 578, "6": 123}
    units = spark.createDataFrame([(4,), (9,)], "feu int")
    assert rows(catalog.gate_widths(units, peaking, F.lit(60.0))) == [(4, 16), (9, 6)]
    assert files.list_files(spark, str(tmp_path)).count() == 6
    hits = registry.fused_hits(spark, SF).withColumn("run", F.lit("r"))
    files.write_table(hits, str(tmp_path / "hits"))
    assert files.read_table(spark, str(tmp_path / "hits"), "channel int, amplitude double, run string").count() == hits.count()


def test_small_rules(spark):
    assert Params().gate_width() == 5 and Params(sample_ns=200).gate_width() == 3 and Params(boxcar_width=0).gate_width() == 0 and Params().gate_width(False) == 0
    flags = spark.createDataFrame([(True, True), (True, None), (False, True)], "z boolean, p boolean")
    assert [r[0] for r in flags.select(catalog.zs_baseline(F.col("z"), F.col("p"))).collect()] == [True, False, False]
    frames = spark.createDataFrame([(0, 1, 0, False, 0, True), (1, 2, 0, False, 3, True), (2, 3, 0, True, 0, True)], "frame_idx long, event_id long, sample_id long, eoe boolean, n_data long, zs boolean").withColumn("file", F.lit("f"))
    assembled = loss.assemble(frames, ["file"])
    assert rows(loss.event_headers(assembled, ["file"], ["event_id"])) == [("f", 0, 2, 1), ("f", 1, 3, 0)]
    # a frame without data before a new id runs on into the next entry
    assert rows(loss.entries(assembled, ["file"]).select("entry", "n_frames")) == [(0, 2), (1, 1)]


def test_frames_that_belong_to_no_entry(spark):
    """Ids 5 5 | 6 | 7 7: data only with the first id; the rest close nothing, but count as frames and for the mode."""
    data = [(0, 5, 0, False, 2, True), (1, 5, 1, False, 0, True), (2, 6, 9, False, 0, False), (3, 7, 2, False, 0, True)]
    frames = spark.createDataFrame(data, "frame_idx long, event_id long, sample_id long, eoe boolean, n_data long, zs boolean").withColumn("file", F.lit("f"))
    found = loss.entries(loss.assemble(frames, ["file"]), ["file"])
    assert rows(found.select("entry", "reason", "n_frames")) == [(0, 1, 2), (None, None, 2)]
    r = loss.accounting(found, ["file"]).first()
    assert (r.events, r.feu_frames, r.samples_expected, r.sum_distinct, r.mixed, r.raw_mode, r.sample_acceptance_mean) == (1, 4, 10, 2, True, 0, 0.2)
    assert [x.acceptance for x in loss.sample_acceptance(found, ["file"]).orderBy("sample").collect()] == [1, 1] + [0] * 8
    none = loss.accounting(loss.entries(loss.assemble(frames.filter("frame_idx > 0"), ["file"]), ["file"]), ["file"]).first()
    assert (none.events, none.feu_frames, none.first_eventid, none.last_eventid, none.events_missing, none.sample_acceptance_mean) == (0, 3, 0, 0, 0, 1.0)


def test_every_column_of_a_hit(spark):
    """One hand-worked pulse: pedestal 100, 60 ns a sample, ftst 3."""
    wf = [100] * 4 + [100, 110, 140, 130, 120, 110, 100, 100]
    events = spark.createDataFrame([(1, 0, 77, 5, 3, list(range(12)), [2] * 12, wf)], "feu int, entry long, eventId long, timestamp long, ftst int, sample array<int>, channel array<int>, amplitude array<int>")
    peds = spark.createDataFrame([(1, 2, 100.0, 1.0, 1.0)], "feu int, channel int, mean double, rms double, rms_gate double")
    h = pulses.find_hits(events, peds, Params(boxcar_width=0, cns=False), ["feu", "entry"], ["feu"]).first().asDict()
    late = 3 * 10 / 60
    # samples 5..9 are above 5; y = 10, 40, 30 around the top at 6
    amplitude, vertex = 40 - 0.25 * (10 - 30) * 0.5 * (10 - 30) / (10 - 80 + 30), 6 + 0.5 * (10 - 30) / (10 - 80 + 30)
    timing = 5 + (0.3 * amplitude - 10) / 30
    want = {
        "feu": 1, "entry": 0, "eventId": 77, "ftst": 3, "channel": 2, "pulse_idx": 0, "amplitude": amplitude, "time": (timing + late) * 60, "time_of_max": (vertex + late) * 60,
        "sample": timing + late, "max_sample": vertex + late, "local_baseline": 0.0, "local_max": 40.0, "left_sample": 4.5 + late, "right_sample": 9.5 + late,
        "time_over_threshold": 300.0, "integral": 110.0, "significance": 40.0, "saturated": False, "trunc_left": False, "trunc_right": False, "trigger_timestamp_ns": 50,
    }
    assert h == pytest.approx(want)
    assert pulses.tightened(spark.createDataFrame([(3.0,), (5.0,), (8.0,)], "significance double"), 5.0).count() == 2


def test_event_rows_give_the_pedestals_of_exploded_rows(spark):
    events = adapters.events(spark, SF, inject=False)
    for width in (0, 5):
        p = Params(boxcar_width=width)
        got = {(r.feu, r.channel): (r.mean, r.rms, r.rms_gate) for r in pedestals.from_events(events, ["feu"], p).collect()}
        want = {(r.feu, r.channel): (r.mean, r.rms, r.rms_gate) for r in pedestals.pedestals(adapters.samples(spark, SF), ["feu"], ["entry"], width).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    uneven = spark.createDataFrame([(1, [0, 0, 1, 600, 0], [0, 2, 0, 0, 2], [5, 7, 9, 4, 8])], "feu int, channel array<int>, sample array<int>, amplitude array<int>")
    long = waveform.explode_events(uneven.withColumn("entry", F.lit(0)), ["feu", "entry"])
    got = {r.channel: (r.mean, r.rms, r.rms_gate) for r in pedestals.from_events(uneven, ["feu"], Params(boxcar_width=3)).collect()}
    want = {r.channel: (r.mean, r.rms, r.rms_gate) for r in pedestals.pedestals(long, ["feu"], ["entry"], 3).collect()}
    assert got.keys() == want.keys() == {0, 1, 600} and all(got[k] == pytest.approx(want[k]) for k in got)


def test_settings_by_unit(spark):
    """Units with different periods, widths and baselines in one job give what each gives alone."""
    events = adapters.events(spark, SF)
    peds = pedestals.from_events(events, ["feu"], Params(boxcar_width=0))
    settings = spark.createDataFrame([(0, 60.0, 0, False), (1, 40.0, 5, True)], "feu long, sample_ns double, gate_width int, zs_baseline boolean")
    both = pulses.find_hits(events, peds, Params(threshold=3.0), ["feu", "entry"], ["feu"], settings=settings)
    for feu, p in ((0, Params(threshold=3.0, boxcar_width=0)), (1, Params(threshold=3.0, boxcar_width=5, sample_ns=40.0, force_zs_baseline=True))):
        alone = pulses.find_hits(events.filter(f"feu = {feu}"), peds, p, ["feu", "entry"], ["feu"])
        assert rows(both.filter(f"feu = {feu}")) == rows(alone) != []
    runs_ = spark.createDataFrame([("r", 40.0, True, True)], "run string, sample_period double, zero_suppress boolean, pedestal_subtraction boolean")
    peaking = spark.createDataFrame([("1", 228)], "feu_key string, ns int")
    units = spark.createDataFrame([("r", 1), ("r", 2)], "run string, feu int")
    assert rows(jobs.unit_settings(units, peaking, runs_)) == [("r", 1, 40.0, 10, True), ("r", 2, 40.0, None, True)]


def test_main_chain_with_settings_and_sparse_files(spark):
    """128 channels of 512 count as sparse: no common noise and no smoothing, but the unit's period and baseline hold."""
    keys = {"run": F.lit("r"), "file_num": (F.col("entry") % 2).cast("int")}
    events, quiet = (adapters.shaped_events(spark, SF, quiet=q).withColumns(keys) for q in (False, True))
    settings = spark.createDataFrame([("r", 0, 40.0, 7, True)], "run string, feu long, sample_ns double, gate_width int, zs_baseline boolean")
    got = jobs.events_to_hits(events, quiet, Params(), ["run", "file_num", "feu", "entry"], ["run", "file_num", "feu"], ["run", "feu"], settings)
    for feu, p in ((0, Params(cns=False, boxcar_width=0, sample_ns=40.0, force_zs_baseline=True)), (1, Params(cns=False, boxcar_width=0))):
        peds = pedestals.from_events(quiet, ["run", "feu"], p)
        want = pulses.find_hits(events.filter(f"feu = {feu}"), peds, p, ["run", "file_num", "feu", "entry"], ["run", "feu"])
        assert rows(got.filter(f"feu = {feu}")) == rows(want) != []


def test_common_noise_with_uneven_lengths_is_that_of_each_block():
    rng = np.random.default_rng(3)
    for c in (64, 100, 130):
        wf, length = rng.integers(0, 50, (c, 9)).astype(float), rng.integers(0, 10, c)
        want = wf.copy()
        for b in range(0, c, 64):
            for s in range(9):
                own = [k for k in range(b, min(c, b + 64)) if length[k] > s]
                if own:
                    want[own, s] -= np.sort(wf[own, s])[len(own) // 2]
        pulses.common_noise(wf, length)
        assert (wf == want).all()


def test_sparse_files_by_their_first_entries(spark):
    events = spark.createDataFrame([("a", k, list(range(300)) if k >= 3 else []) for k in range(6)] + [("b", k, [1, 1, 600, -1]) for k in range(3)] + [("c", 0, None)], "file string, entry long, channel array<int>")
    assert rows(waveform.zs_files(events, ["file"])) == [("a", False), ("b", True), ("c", True)]
    assert rows(waveform.zs_files(events, ["file"], first=5)) == [("a", True), ("b", True), ("c", True)]


def test_seeds_of_registered_query_are_those_of_a_plain_loop(spark):
    got = rows(registry.w26_derivative_seeds(spark, SF))
    assert len(got) > 50 and len({(r[1] + r[2]) % 16 for r in got}) >= 6
    assert all(r[4] - r[3] + 1 >= 2 for r in got)


def test_derivative_seeds():
    wf = np.zeros(40)
    wf[10:20] = [4, 10, 20, 30, 30, 20, 15, 10, 8, 6]
    assert pulses.derivative_seeds(wf) == [(10, 19)]  # the rise is steepest at sample 10
    assert pulses.derivative_seeds(np.zeros(2)) == []
