"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..functions import bits
from ..operators import catalog, cluster, combine, loss, pedestals, pulses, qa, waveform
from ..params import Params
from ..sources import files, frames, inputs
from . import adapters as A
from . import jobs
from .pulse_sql import INJECTED, hits_sql, seeds_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


BASE = """with raw as (select vec_id // 128 as entry, vec_id % 128 as channel, unnest(embedding) as e, generate_subscripts(embedding, 1) - 1 as sample from embeddings),
samples as (select entry % 2 as feu, entry, channel, sample, cast(floor(256 + 1000 * cast(e as double)) as bigint) as amplitude from raw),
injected as (select feu, entry, channel, sample, case when channel % 16 = entry % 16 then least(4095, amplitude + greatest(0, 2400 - 300 * abs(sample - 20 - channel % 8))) else amplitude end as amplitude from samples),
means as (select feu, channel, sum(amplitude) / count(*) as mean from samples group by all),
praw as (select *, channel // 64 as block from samples),
pcns as (select feu, entry, channel, sample, amplitude - list_sort(list(amplitude) over (partition by feu, entry, block, sample))[count(*) over (partition by feu, entry, block, sample) // 2 + 1] as v from praw),
noise as (select feu, channel, sqrt(greatest(0, sum(v * v) / count(*) - (sum(v) / count(*)) * (sum(v) / count(*)))) as rms from pcns group by all),
sub as (select i.feu, entry, i.channel, sample, i.channel // 64 as block, amplitude - mean as v from injected i join means m on i.feu = m.feu and i.channel = m.channel),
wf as (select feu, entry, channel, sample, v - list_sort(list(v) over (partition by feu, entry, block, sample))[count(*) over (partition by feu, entry, block, sample) // 2 + 1] as v from sub),
above as (select w.*, sample - row_number() over (partition by w.feu, entry, w.channel order by sample) as island from wf w join noise n on w.feu = n.feu and w.channel = n.channel where v > 5 * rms),
runs as (select feu, entry, channel, min(sample) as start, max(sample) as stop from above group by feu, entry, channel, island),
flagged as (select *, case when start - lag(stop) over (partition by feu, entry, channel order by start) - 1 <= 2 then 0 else 1 end as fresh from runs),
numbered as (select *, sum(fresh) over (partition by feu, entry, channel order by start) - 1 as pulse from flagged),
bridged as (select feu, entry, channel, cast(pulse as bigint) as pulse, min(start) as start, max(stop) as stop from numbered group by feu, entry, channel, pulse),
bounded as (select *, coalesce(lag(stop) over (partition by feu, entry, channel order by start) + 1, 0) as lo, coalesce(lead(start) over (partition by feu, entry, channel order by start) - 1, 63) as hi from bridged)
"""
EVENT = ["feu", "entry"]


def subtracted(spark, sf_dir):
    """Injected samples after pedestal and common noise, and the noise of each channel."""
    quiet = A.samples(spark, sf_dir)
    peds = pedestals.pedestals(quiet, ["feu"], ["entry"])
    rows = A.samples(spark, sf_dir, inject=True).join(peds, ["feu", "channel"])
    rows = rows.withColumn("v", F.col("amplitude") - F.col("mean"))
    wf = waveform.subtract_common_noise(rows.select(*EVENT, "channel", "sample", "v"), EVENT)
    return wf, peds


def found(spark, sf_dir):
    wf, peds = subtracted(spark, sf_dir)
    rows = wf.join(peds.select("feu", "channel", "rms"), ["feu", "channel"])
    return wf, peds, waveform.bridge(waveform.runs(rows, EVENT, 5 * F.col("rms")), EVENT)


@query(BASE + "select feu, channel, round(mean, 6) as mean from means")
def p1_channel_means(spark, sf_dir):
    return pedestals.means(A.samples(spark, sf_dir), ["feu"]).select("feu", "channel", F.round("mean", 6).alias("mean"))


@query(BASE + "select feu, channel, round(rms, 6) as rms from noise")
def p2_noise_after_common_noise(spark, sf_dir):
    return pedestals.noise(A.samples(spark, sf_dir), ["feu"], ["entry"]).select("feu", "channel", F.round("rms", 6).alias("rms"))


@query(BASE + """, smooth as (select feu, entry, channel, cast(sum(v) over f as double) / count(*) over f as v from pcns window f as (partition by feu, entry, channel order by sample rows between 2 preceding and 2 following))
select feu, channel, round(sqrt(greatest(0, sum(v * v) / count(*) - (sum(v) / count(*)) * (sum(v) / count(*)))), 4) as rms_gate from smooth group by all""")
def p3_gate_noise(spark, sf_dir):
    return pedestals.noise(A.samples(spark, sf_dir), ["feu"], ["entry"], 5).select("feu", "channel", F.round("rms", 4).alias("rms_gate"))


@query(BASE + """select f.feu, f.channel, coalesce(m.mean, 0) as mean, case when m.channel is null then 3.0 else 1.0 end as rms, case when m.channel is null then 3.0 else 1.0 end as rms_gate, n
from (select feu, channel, count(*) as n from samples group by all) f left join (select channel, 256.0 as mean from range(90) t(channel)) m on m.channel = f.channel""")
def p4_p6_fallback_and_lookup(spark, sf_dir):
    """All samples against a fallback of fewer channels than the data have."""
    counts = A.samples(spark, sf_dir).groupBy("feu", "channel").agg(F.count("*").alias("n"))
    return pedestals.look_up(counts, pedestals.fallback(spark, 90), []).select("feu", "channel", "mean", "rms", "rms_gate", "n")


@query(BASE + "select feu, channel, 256.0 as mean, 1.0 as rms, 1.0 as rms_gate, count(*) as n from samples group by all")
def p4_p6_all_units(spark, sf_dir):
    """All samples of all units against the whole fallback."""
    counts = A.samples(spark, sf_dir).groupBy("feu", "channel").agg(F.count("*").alias("n"))
    return pedestals.look_up(counts, pedestals.fallback(spark), []).select("feu", "channel", "mean", "rms", "rms_gate", "n")


@query("select l_suppkey % 8 as feu, l_partkey % 512 as channel, cast(sum(cast(l_quantity as bigint)) as double) / count(*) as mean, 2.5 as rms, 2.5 as rms_gate from lineitem group by all")
def p5_flat_sigma(spark, sf_dir):
    return pedestals.pedestals(A.large_samples(spark, sf_dir), ["feu"], ["entry"], flat_sigma=2.5)


@query("""with s as (select l_suppkey % 8 as feu, l_orderkey as entry, l_partkey % 512 as channel, l_linenumber as sample, arg_max(cast(l_quantity as bigint), cast(l_extendedprice * 100 as bigint)) as v from lineitem group by all),
w as (select feu, entry, channel, max(sample) as n from s group by all), f as (select feu, entry, channel, unnest(range(0, n + 1)) as sample from w)
select f.feu, f.entry, f.channel, f.sample, coalesce(v, 0) as v from f left join s using (feu, entry, channel, sample)""")
def w1_densify(spark, sf_dir):
    return waveform.densify(A.large_samples(spark, sf_dir), EVENT)


@query("""select feu, entry, channel, sample, round(sum(amplitude) over f / count(*) over f, 6) as v from (select vec_id // 128 % 2 as feu, vec_id // 128 as entry, vec_id % 128 as channel, sample, cast(floor(256 + 1000 * cast(e as double)) as bigint) as amplitude
from (select vec_id, unnest(embedding) as e, generate_subscripts(embedding, 1) - 1 as sample from embeddings)) window f as (partition by feu, entry, channel order by sample rows between 4 preceding and 4 following)""")
def w3_boxcar(spark, sf_dir):
    wf = A.samples(spark, sf_dir).withColumnRenamed("amplitude", "v")
    return waveform.boxcar(wf, EVENT, 8).withColumn("v", F.round("v", 6))


@query(BASE + "select feu, entry, channel, sample, round(v, 6) as v from wf")
def w2_w4_subtract_pedestal_and_common_noise(spark, sf_dir):
    return subtracted(spark, sf_dir)[0].withColumn("v", F.round("v", 6))


@query("""with k as (select o_custkey % 8 as feu, o_orderkey as entry, count(distinct l_partkey % 1024) filter (l_partkey % 1024 < 512) as k from orders left join lineitem on l_orderkey = o_orderkey where o_orderkey < 200 group by all)
select feu, list_sort(list(k))[count(*) // 2 + 1] < 2 as is_zs from k group by feu""")
def w5_zs_files(spark, sf_dir):
    """Orders as entries, parts of their lines as channels, some out of range; orders without lines count as 0."""
    lines = A.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("entry")).agg(F.collect_list((F.col("l_partkey") % 1024).cast("int")).alias("channel"))
    events = A.read(spark, sf_dir, "orders").select((F.col("o_custkey") % 8).alias("feu"), F.col("o_orderkey").alias("entry")).join(lines, "entry", "left")
    return waveform.zs_files(events, ["feu"], dense=2)


@query(BASE + "select feu, entry, channel, start, stop from runs")
def w7_runs(spark, sf_dir):
    wf, peds = subtracted(spark, sf_dir)
    return waveform.runs(wf.join(peds.select("feu", "channel", "rms"), ["feu", "channel"]), EVENT, 5 * F.col("rms"))


@query(BASE + "select * from bounded")
def w8_w10_pulses_and_bounds(spark, sf_dir):
    pulses_ = found(spark, sf_dir)[2].withColumn("n", F.lit(64))
    return waveform.bounds(pulses_, EVENT).drop("n")


@query(BASE + """, arrays as (select feu, entry, channel, list(v order by sample) as wf from wf group by all),
tops as (select b.*, wf, list_max(wf[start + 1 : stop + 1]) as top from bounded b join arrays using (feu, entry, channel)),
peaks as (select *, start + list_position(wf[start + 1 : stop + 1], top) - 1 as first from tops),
based as (select *, greatest(lo, start - 2) as bh, greatest(lo, greatest(lo, start - 2) - 4) as bl from peaks),
levels as (select *, case when bh > bl then list_median(wf[bl + 1 : bh]) when start > greatest(lo, start - 4) then list_median(wf[greatest(lo, start - 4) + 1 : start]) when start > 0 then wf[start + 1] else 0 end as base from based)
select feu, entry, channel, start, stop, stop - start + 1 as width, round(top - base, 6) as local_max, round(base, 6) as local_baseline, start = 0 as trunc_left, stop = 63 as trunc_right, first as peak,
round(case when first between 1 and 62 and abs(wf[first] - 2 * wf[first + 1] + wf[first + 2]) > 1e-9 then wf[first + 1] - base - 0.125 * (wf[first] - wf[first + 2]) * (wf[first] - wf[first + 2]) / (wf[first] - 2 * wf[first + 1] + wf[first + 2]) else wf[first + 1] - base end, 4) as amplitude
from levels where stop - start + 1 >= 3""")
def w11_w16_pulse_measures(spark, sf_dir):
    wf, _, pulses_ = found(spark, sf_dir)
    rows = pulses_.join(waveform.waveforms(wf, EVENT), [*EVENT, "channel"])
    out = waveform.measures(waveform.bounds(rows, EVENT)).filter("width >= 3")
    return out.select(*EVENT, "channel", "start", "stop", "width", F.round(F.col("top") - F.col("baseline"), 6).alias("local_max"), F.round("baseline", 6).alias("local_baseline"), "trunc_left", "trunc_right", "peak", F.round("amplitude", 4).alias("amplitude"))


@query(BASE + """select b.feu, b.entry, b.channel, b.start, round(max(v) / max(rms), 6) as significance from bridged b join wf w on w.feu = b.feu and w.entry = b.entry and w.channel = b.channel and sample between start and stop
join noise n on n.feu = b.feu and n.channel = b.channel group by all""")
def w20_significance(spark, sf_dir):
    wf, peds, pulses_ = found(spark, sf_dir)
    rows = pulses_.join(wf, [*EVENT, "channel"]).filter("sample between start and stop").join(peds.select("feu", "channel", "rms"), ["feu", "channel"])
    return rows.groupBy(*EVENT, "channel", "start").agg(F.round(F.max("v") / F.max("rms"), 6).alias("significance"))


@query(BASE + """select channel, count(*) as pulses, round(max(top), 6) as highest, sum(stop - start + 1) as width from (select b.feu, b.entry, b.channel, b.start, b.stop, max(v) as top from bridged b
join wf w on w.feu = b.feu and w.entry = b.entry and w.channel = b.channel and sample between start and stop where stop - start + 1 >= 3 group by all) group by channel""")
def flagship_pulses_by_channel(spark, sf_dir):
    wf, _, pulses_ = found(spark, sf_dir)
    rows = pulses_.filter(F.col("stop") - F.col("start") + 1 >= 3).join(wf, [*EVENT, "channel"]).filter("sample between start and stop")
    tops = rows.groupBy(*EVENT, "channel", "start", "stop").agg(F.max("v").alias("top"))
    return tops.groupBy("channel").agg(F.count("*").alias("pulses"), F.round(F.max("top"), 6).alias("highest"), F.sum(F.col("stop") - F.col("start") + 1).alias("width"))


HIT_COLUMNS = ["feu", "entry", "eventId", "trigger_timestamp_ns", "channel", "pulse_idx", *pulses.NUMBERS, *pulses.FLAGS]
ROUNDED = ", ".join(["feu", "entry", "eventId", "trigger_timestamp_ns", "channel", "pulse_idx", *[f"floor({c} * 10000 + 0.5) / 10000 as {c}" for c in pulses.NUMBERS], *pulses.FLAGS])


def rounded(hits):
    """Four digits by a rule that both engines share: their ``round`` differs on ties."""
    shown = [(F.floor(F.col(c) * 10000 + 0.5) / 10000).alias(c) if c in pulses.NUMBERS else F.col(c).cast("long").alias(c) if c in ("channel", "pulse_idx") else F.col(c) for c in HIT_COLUMNS]
    return hits.select(*shown)


def shaped_hits(spark, sf_dir, p: Params, settings=None):
    peds = pedestals.from_events(A.shaped_events(spark, sf_dir, quiet=True), ["feu"], p, settings)
    return pulses.find_hits(A.shaped_events(spark, sf_dir), peds, p, ["feu", "entry"], ["feu"], settings=settings)


RAW_GATE, SMOOTHED = Params(boxcar_width=0, cns=False), Params(boxcar_width=5)


@query(hits_sql(False, 0) + f" select {ROUNDED} from hits")
def w9_w24_hits_raw_gate(spark, sf_dir):
    """Every kind of pulse and every column of a hit, without common noise and smoothing."""
    return rounded(shaped_hits(spark, sf_dir, RAW_GATE))


@query(hits_sql(True, 5) + f" select {ROUNDED} from hits")
def w9_w24_hits_smoothed(spark, sf_dir):
    """The same after common noise, with a smoothed gate."""
    return rounded(shaped_hits(spark, sf_dir, SMOOTHED))


@query(hits_sql(True, 5, "case feu when 0 then 60 else 40 end", "feu = 1") + f" select {ROUNDED} from hits")
def w24_p7_hits_by_unit(spark, sf_dir):
    """Two units with different sample periods, one of them with the baseline of zero suppression."""
    settings = spark.createDataFrame([(0, 60.0, 5, False), (1, 40.0, 5, True)], "feu long, sample_ns double, gate_width int, zs_baseline boolean")
    return rounded(shaped_hits(spark, sf_dir, Params(), settings))


@query(hits_sql(False, 0) + f" select {ROUNDED} from (select *, row_number() over (partition by feu, entry, channel order by amplitude desc, pulse_idx) as rank from hits) where rank = 1")
def w22_largest_only(spark, sf_dir):
    return rounded(waveform.largest_only(shaped_hits(spark, sf_dir, RAW_GATE), EVENT))


@query(hits_sql(False, 0) + " select channel, count(*) as hits, round(min(significance), 4) as least from hits where significance >= 60 group by 1")
def w25_tightened(spark, sf_dir):
    kept = pulses.tightened(shaped_hits(spark, sf_dir, RAW_GATE), 60.0)
    return kept.groupBy(F.col("channel").cast("long").alias("channel")).agg(F.count("*").alias("hits"), F.round(F.min("significance"), 4).alias("least"))


@query(hits_sql(False, 0) + " select feu, entry, channel, pulse_idx, round(local_baseline, 4) as baseline_level, round(left_sample - 5, 4) as baseline_from, round(right_sample, 4) as baseline_to, round(local_baseline + amplitude, 4) as peak_level, round(max_sample - 0.5, 4) as peak_from, round(max_sample + 0.5, 4) as peak_to from hits")
def q10_overlay_levels(spark, sf_dir):
    out = qa.overlay_levels(shaped_hits(spark, sf_dir, RAW_GATE))
    names = ("baseline_level", "baseline_from", "baseline_to", "peak_level", "peak_from", "peak_to")
    return out.select("feu", "entry", F.col("channel").cast("long").alias("channel"), F.col("pulse_idx").cast("long").alias("pulse_idx"), *[F.round(c, 4).alias(c) for c in names])


@query(hits_sql(False, 0) + " select feu, channel, count(*) as hits, round(sum(integral), 3) as integral, cast(count_if(saturated) as bigint) as saturated from hits group by 1, 2")
def s3_hits_table(spark, sf_dir):
    """Hits written as a table and read back by its schema."""
    path = f"{files.scratch_dir(spark)}/hits-{uuid.uuid4().hex}"
    hits = shaped_hits(spark, sf_dir, RAW_GATE).withColumns({"run": F.lit("r"), "sub_run": F.lit("s"), "file_num": F.lit(1), "feu": F.col("feu").cast("int")})
    files.write_table(hits, path)
    back = files.read_table(spark, path, schemas.HITS)
    return back.groupBy(F.col("feu").cast("long").alias("feu"), F.col("channel").cast("long").alias("channel")).agg(F.count("*").alias("hits"), F.round(F.sum("integral"), 3).alias("integral"), F.count_if("saturated").alias("saturated"))


@query(BASE + "select feu, channel, round(mean, 6) as mean, round(rms, 6) as rms from means join noise using (feu, channel)")
def s2_s4_events_and_pedestals(spark, sf_dir):
    """Event rows written and read back, pedestals taken from them, written and read back."""
    base = f"{files.scratch_dir(spark)}/tables-{uuid.uuid4().hex}"
    run = {"run": F.lit("r"), "sub_run": F.lit("s"), "file_num": F.lit(1), "feu": F.col("feu").cast("int")}
    lists = {c: F.col(c).cast("array<int>") for c in ("sample", "channel", "amplitude")}
    files.write_table(A.events(spark, sf_dir, inject=False).withColumns(run | lists), f"{base}/nt")
    events = files.read_table(spark, f"{base}/nt", schemas.EVENTS)
    files.write_table(pedestals.from_events(events, ["run", "sub_run", "feu"], Params()), f"{base}/pedestals", ("run", "sub_run"))
    back = files.read_table(spark, f"{base}/pedestals", schemas.PEDESTALS)
    return back.select(F.col("feu").cast("long").alias("feu"), F.col("channel").cast("long").alias("channel"), F.round("mean", 6).alias("mean"), F.round("rms", 6).alias("rms"))


@query("select c_custkey as k, cast(greatest(3, round(300.0 / (10 + c_custkey % 200))) as int) as width from customer")
def w6_gate_width(spark, sf_dir):
    c = A.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return c.select("k", waveform.gate_width(10 + F.col("k") % 200).alias("width"))


@query(BASE + "select feu, channel, 256.0 as mean, round(rms, 6) as rms, round(rms, 6) as rms_gate, n from noise join (select feu, channel, count(*) as n from samples group by all) using (feu, channel)")
def p7_zs_baseline(spark, sf_dir):
    """All means forced to the baseline of zero suppression, the noise kept."""
    counts = A.samples(spark, sf_dir).groupBy("feu", "channel").agg(F.count("*").alias("n"))
    peds = pedestals.from_events(A.events(spark, sf_dir, inject=False), ["feu"], Params(boxcar_width=0))
    out = pedestals.look_up(counts, peds, ["feu"], zs_baseline=256.0)
    return out.select("feu", "channel", "mean", F.round("rms", 6).alias("rms"), F.round("rms_gate", 6).alias("rms_gate"), "n")


def fused_hits(spark, sf_dir):
    p = Params(boxcar_width=0)
    peds = pedestals.from_events(A.events(spark, sf_dir, inject=False), ["feu"], p)
    return pulses.find_hits(A.events(spark, sf_dir), peds, p, ["feu", "entry"], ["feu"])


@query(hits_sql(True, 0, tables=INJECTED) + f" select {ROUNDED} from hits")
def w24_fused_hits(spark, sf_dir):
    """W1 to W23 in one pass over event rows, one pulse in every 16th channel."""
    return rounded(fused_hits(spark, sf_dir))


@query(hits_sql(True, 5) + f" select {ROUNDED} from hits")
def w24_hits_of_packed_events(spark, sf_dir):
    """The same hits as ``w9_w24_hits_smoothed`` from events and pedestal events whose samples are packed, written and read back."""
    base = f"{files.scratch_dir(spark)}/packed-{uuid.uuid4().hex}"
    for name, quiet in (("events", False), ("quiet", True)):
        pulses.pack(A.shaped_events(spark, sf_dir, quiet=quiet)).write.parquet(f"{base}/{name}")
    events, quiet = (spark.read.parquet(f"{base}/{name}") for name in ("events", "quiet"))
    return rounded(pulses.find_hits(events, pedestals.from_events(quiet, ["feu"], SMOOTHED), SMOOTHED, ["feu", "entry"], ["feu"]))


@query(seeds_sql())
def w26_derivative_seeds(spark, sf_dir):
    """Diagnostic seed regions of each injected waveform, in units of its noise."""
    peds = pedestals.pedestals(A.shaped_samples(spark, sf_dir, quiet=True), ["feu"], ["entry"])
    rows = A.shaped_samples(spark, sf_dir).join(peds, ["feu", "channel"])
    wf = waveform.subtract_common_noise(rows.select(*EVENT, "channel", "sample", (F.col("amplitude") - F.col("mean")).alias("v")), EVENT)
    scaled = pulses.in_noise_units(wf, peds, ["feu"])
    return pulses.seed_regions(waveform.waveforms(scaled, EVENT), EVENT)


@query(seeds_sql())
def w26_seeds_from_events(spark, sf_dir):
    """The same regions from event rows, without exploded samples."""
    p = Params(boxcar_width=0)
    peds = pedestals.from_events(A.shaped_events(spark, sf_dir, quiet=True), ["feu"], p)
    out = pulses.find_seeds(A.shaped_events(spark, sf_dir), peds, p, EVENT, ["feu"])
    return out.select(*EVENT, *[F.col(c).cast("long").alias(c) for c in ("channel", "start", "stop")])


HITS = """with hits as (select event_id // 8 as event, event_id * 37 % 128 as channel, event_id as pulse_idx, cast(floor(value * 100) as bigint) as amplitude, cast(event_id * 7 % 25 as double) as time from events),
lines as (select p_partkey as line_no, p_partkey % 2 * 64 + p_size as channel, case when p_partkey // 2 % 2 = 0 then 'x' else 'y' end as axis, cast(p_partkey % 10 as double) as x, cast(p_partkey % 7 as double) as y from part),
strips as (select channel, arg_max(axis, line_no) as axis, arg_max(x, line_no) as x, arg_max(y, line_no) as y from lines group by 1),
mapped as (select h.*, axis, x, y, row_number() over (partition by event order by h.channel, pulse_idx) - 1 as ord from hits h join strips s on h.channel = s.channel)
"""


def mapped(spark, sf_dir):
    strips = combine.last_by_channel(A.strips(spark, sf_dir))
    return combine.event_groups(combine.with_strips(A.hits(spark, sf_dir), strips), ["event"], ["channel", "pulse_idx"])


@query("""select event_id, value, 1 as feu, event_id % 2 = 0 as trunc_left, false as trunc_right, -1.0 as significance from events where event_type = 'error'
union all select event_id, value, 2, false, false, cast(-1.0 as double) from events where event_type <> 'error'""")
def u1_u2_combine_with_old_schema(spark, sf_dir):
    e = A.read(spark, sf_dir, "events").select("event_id", "value", "event_type")
    new = e.filter("event_type = 'error'").select("event_id", "value", (F.col("event_id") % 2 == 0).alias("trunc_left"))
    old = e.filter("event_type <> 'error'").select("event_id", "value")
    return combine.combine_hits([(new, 1), (old, 2)]).select("event_id", "value", "feu", "trunc_left", "trunc_right", "significance")


#: A file for 500 events; by its number it is a current table, an old one, one of something else, or broken.
INPUTS = """with e as (select *, event_id // 500 as k from events), kinds as (select k, case when k % 7 = 3 then 'broken' when k % 7 = 5 then 'foreign' when k % 7 in (1, 4) then 'old' else 'current' end as kind, count(*) as n from e group by 1)
"""


def input_files(spark, sf_dir):
    """``path, feu`` of the files above, which are written here from the events table."""
    base = f"{files.scratch_dir(spark)}/inputs-{uuid.uuid4().hex}"
    k = F.floor(F.col("event_id") / 500)
    e = A.read(spark, sf_dir, "events").withColumn("k", k)
    hit = [F.col("event_id").alias("eventId"), (F.col("event_id") * 37 % 128).cast("int").alias("channel"), F.col("value").alias("amplitude")]
    later = [(F.col("event_id") % 2 == 0).alias("trunc_left"), (F.col("event_id") % 3 == 0).alias("trunc_right"), F.when(F.col("event_id") % 5 > 0, F.col("value") / 2).alias("significance")]
    kinds = {"broken": (k % 7 == 3, [F.col("event_type").alias("value")]), "foreign": (k % 7 == 5, ["event_id", "value"]), "old": ((k % 7).isin(1, 4), hit), "current": ((k % 7).isin(0, 2, 6), hit + later)}
    for kind, (of, columns) in kinds.items():
        out = e.filter(of).select("k", *columns).repartition("k").write.partitionBy("k")
        out.text(f"{base}/{kind}") if kind == "broken" else out.parquet(f"{base}/{kind}")
    listed = files.list_files(spark, base, "part-*").withColumn("k", F.regexp_extract("path", "k=([0-9]+)", 1).cast("long"))
    return listed.select("path", (F.col("k") % 8).cast("int").alias("feu"), "k")


INPUT_HITS = "eventId bigint, channel int, amplitude double, trunc_left boolean, trunc_right boolean, significance double"


@query(INPUTS + "select k, cast(k % 8 as int) as feu, kind <> 'broken' as readable, kind in ('old', 'current') as usable, case when kind <> 'broken' then n end as rows, case when kind in ('old', 'current') then kind = 'old' end as old from kinds")
def u3_input_health(spark, sf_dir):
    """What each of many input files is good for, by footers that are read in tasks."""
    listed = input_files(spark, sf_dir)
    out = inputs.health(listed, INPUT_HITS)
    return out.select(F.regexp_extract("path", "k=([0-9]+)", 1).cast("long").alias("k"), "feu", "readable", "usable", "rows", "old")


@query(INPUTS + """select cast(k % 8 as int) as feu, event_id as eventId, event_id * 37 % 128 as channel, value as amplitude, kind = 'current' and event_id % 2 = 0 as trunc_left, kind = 'current' and event_id % 3 = 0 as trunc_right,
case when kind = 'old' then -1.0 when event_id % 5 > 0 then value / 2 end as significance from e join kinds using (k) where kind in ('old', 'current')""")
def u1_u2_u3_combined_inputs(spark, sf_dir):
    """The usable files as one scan, old ones filled, each row with the unit of its file."""
    found = files.written(inputs.health(input_files(spark, sf_dir), INPUT_HITS))
    rows = inputs.read_inputs(spark, found, INPUT_HITS)
    return rows.select("feu", "eventId", F.col("channel").cast("long").alias("channel"), "amplitude", "trunc_left", "trunc_right", "significance")


@query(HITS + "select event, channel, pulse_idx, amplitude, axis, x, y, ord from mapped")
def j1_j2_hits_with_strips(spark, sf_dir):
    return mapped(spark, sf_dir).select("event", "channel", "pulse_idx", "amplitude", "axis", "x", "y", F.col("ord").cast("long").alias("ord"))


@query(HITS + "select axis, count(*) as n, sum(channel) as total from strips where axis = 'y' group by axis")
def j3_channels_by_axis(spark, sf_dir):
    strips = combine.last_by_channel(A.strips(spark, sf_dir))
    return combine.channels_of_axis(strips, "other").groupBy(F.lit("y").alias("axis")).agg(F.count("*").alias("n"), F.sum("channel").alias("total"))


@query(HITS + "select c.channel, s.channel is not null as mapped, axis from range(256) c(channel) left join strips s on s.channel = c.channel")
def j5_strip_coverage(spark, sf_dir):
    return combine.coverage(combine.last_by_channel(A.strips(spark, sf_dir)))


@query(HITS + "select a.event, a.axis, a.ord, b.ord as ord2 from mapped a join mapped b on a.event = b.event and a.axis = b.axis and a.ord < b.ord where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 4 and abs(a.time - b.time) <= 10")
def j6_compatible_pairs(spark, sf_dir):
    pairs = combine.compatible_pairs(mapped(spark, sf_dir), ["event"])
    return pairs.select("event", "axis", F.col("ord").cast("long").alias("ord"), F.col("ord2").cast("long").alias("ord2"))


@query("with recursive" + HITS.removeprefix("with") + """, evs as (select event, list({'c': channel, 'a': axis, 'x': x, 'y': y, 't': time} order by ord) as h from mapped group by event),
steps as (select event, h, 0 as k, cast([] as bigint[]) as lab, cast(0 as bigint) as made from evs
union all select event, h, k + 1, list_append(lab, coalesce(joins, made)), made + case when joins is null then 1 else 0 end from (select *, list_min([lab[j] for j in range(1, k + 1)
if h[j].a = h[k + 1].a and (h[j].x - h[k + 1].x) * (h[j].x - h[k + 1].x) + (h[j].y - h[k + 1].y) * (h[j].y - h[k + 1].y) <= 4 and abs(h[j].t - h[k + 1].t) <= 10]) as joins from steps where k < len(h)))
select event, cluster_id, any_value(s.a) as axis, count(*) as n_hits, array_to_string(list(s.c order by i), ',') as channels from (select event, unnest(lab) as cluster_id, unnest(h) as s, unnest(range(0, k)) as i from steps where k = len(h)) group by 1, 2""")
def j7_j9_clusters(spark, sf_dir):
    """Greedy first-fit in hit order."""
    return cluster.cluster_hits(mapped(spark, sf_dir), ["event"]).withColumn("channels", F.array_join("channels", ","))


STRIP_SQL = HITS[HITS.index("lines as"):HITS.index("mapped as")]


@query(hits_sql(False, 0) + ", " + STRIP_SQL + """mapped as (select h.feu, h.entry, h.channel, axis, x, y, time, row_number() over (partition by h.feu, h.entry order by h.channel, pulse_idx) - 1 as ord from hits h join strips s on h.channel = s.channel),
evs as (select feu, entry, list({'c': channel, 'a': axis, 'x': x, 'y': y, 't': time} order by ord) as h from mapped group by 1, 2),
steps as (select feu, entry, h, 0 as k, cast([] as bigint[]) as lab, cast(0 as bigint) as made from evs
union all select feu, entry, h, k + 1, list_append(lab, coalesce(joins, made)), made + case when joins is null then 1 else 0 end from (select *, list_min([lab[j] for j in range(1, k + 1)
if h[j].a = h[k + 1].a and (h[j].x - h[k + 1].x) * (h[j].x - h[k + 1].x) + (h[j].y - h[k + 1].y) * (h[j].y - h[k + 1].y) <= 4 and abs(h[j].t - h[k + 1].t) <= 150]) as joins from steps where k < len(h)))
select feu, entry, cluster_id, any_value(s.a) as axis, count(*) as n_hits, array_to_string(list(s.c order by i), ',') as channels from (select feu, entry, unnest(lab) as cluster_id, unnest(h) as s, unnest(range(0, k)) as i from steps where k = len(h)) group by 1, 2, 3""")
def w24_j7_events_to_clusters(spark, sf_dir):
    """From event rows to clusters with the hits as an array in the event's row, without a shuffle of events or hits."""
    out = jobs.events_to_clusters(A.shaped_events(spark, sf_dir), A.shaped_events(spark, sf_dir, quiet=True), A.strips(spark, sf_dir), RAW_GATE, ["feu", "entry"], ["feu"], ns=150.0)
    return out.withColumn("channels", F.array_join("channels", ","))


@query(HITS + """, ends as (select min(cast(amplitude as double)) as lo, max(cast(amplitude as double)) as hi from hits)
select cast(least(floor((amplitude - lo) * 100 / (hi - lo)), 99) as bigint) as bin, count(*) as n from hits, ends group by 1""")
def q1_amplitude_histogram(spark, sf_dir):
    return qa.histogram(A.hits(spark, sf_dir), "amplitude", 100)


@query(HITS + """, ends as (select min(cast(channel as double)) as lo, max(cast(channel as double)) as hi from hits)
select cast(least(floor((channel - lo) * 64 / (hi - lo)), 63) as bigint) as bin, count(*) as n from hits, ends group by 1""")
def q2_channel_occupancy(spark, sf_dir):
    return qa.histogram(A.hits(spark, sf_dir), "channel", 64)


@query(HITS + """, per as (select event, count(*) as k from hits group by 1), ends as (select min(cast(k as double)) as lo, max(cast(k as double)) as hi from per)
select case when hi > lo then cast(least(floor((k - lo) * 40 / (hi - lo)), 39) as bigint) else 0 end as bin, count(*) as n from per, ends group by 1""")
def q3_hits_per_event(spark, sf_dir):
    return qa.histogram(qa.hits_per_event(A.hits(spark, sf_dir), ["event"]), "n_hits", 40)


@query("""with per as (select user_id as event, count(*) as k from events group by 1), ends as (select min(cast(k as double)) as lo, max(cast(k as double)) as hi from per)
select cast(least(floor((k - lo) * 40 / (hi - lo)), 39) as bigint) as bin, count(*) as n from per, ends group by 1""")
def q3_hits_per_user(spark, sf_dir):
    """All rows, with the user as the event."""
    rows = A.read(spark, sf_dir, "events").select(F.col("user_id").alias("event"))
    return qa.histogram(qa.hits_per_event(rows, ["event"]), "n_hits", 40)


@query(HITS + "select distinct event from hits where amplitude >= 5000")
def q4_strong_events(spark, sf_dir):
    return qa.strong_events(A.hits(spark, sf_dir), ["event"], 5000)


@query(HITS + "select event, cast(sum(amplitude) as bigint) as total from hits group by 1 order by 2 desc, 1 limit 10")
def q5_top_events(spark, sf_dir):
    return qa.top_events(A.hits(spark, sf_dir), ["event"])


@query(HITS + ", wanted as (select range * 97 as event from range(60)) select w.event, count(h.event) as n, count(h.event) = 0 as missing from wanted w left join hits h on h.event = w.event group by 1")
def q6_listed_events(spark, sf_dir):
    wanted = spark.range(60).select((F.col("id") * 97).alias("event"))
    there, missing = qa.listed(A.hits(spark, sf_dir), wanted, ["event"])
    return there.groupBy("event").agg(F.count("*").alias("n")).withColumn("missing", F.lit(False)).unionByName(missing.select("event", F.lit(0).cast("long").alias("n"), F.lit(True).alias("missing")))


@query(HITS + "select event, channel, best from (select event, channel, max(amplitude) as best, row_number() over (partition by event order by max(amplitude) desc, channel) as r from hits where amplitude >= 500 group by 1, 2) where r <= 3")
def q7_top_channels(spark, sf_dir):
    return qa.top_channels(A.hits(spark, sf_dir), ["event"], 500, 3)


Q8 = """with s as (select l_suppkey % 8 as feu, l_orderkey // 8 as event, l_orderkey as entry, l_partkey % 8 as channel, cast(l_quantity as bigint) as amplitude from lineitem),
firsts as (select feu, event, min(entry) as entry from s group by 1, 2), own as (select feu, entry, channel, count(*) as n, sum(amplitude) as total from s group by 1, 2, 3),
peds as (select c_custkey % 6 as feu, c_custkey % 5 as channel, floor(avg(c_custkey)) as mean from customer group by 1, 2), h as (select event_id as hit, event_id % 8 as feu, event_id // 8 as event, event_id * 37 % 8 as channel from events)
select hit, h.feu, h.event, h.channel, f.entry, coalesce(n, 0) as n, cast(coalesce(total, 0) as bigint) as total, coalesce(mean, 0) as mean, case when mean is null then 1.0 else 2.0 end as rms
from h join firsts f on f.feu = h.feu and f.event = h.event left join own o on o.feu = h.feu and o.entry = f.entry and o.channel = h.channel left join peds p on p.feu = h.feu and p.channel = h.channel"""


def q8_tables(spark, sf_dir):
    """Hits, event rows of which several share an event id, and pedestals of some units and channels."""
    rows = A.large_samples(spark, sf_dir).withColumn("channel", F.col("channel") % 8)
    lists = F.sort_array(F.collect_list(F.struct("sample", "channel", "amplitude")))
    events = rows.groupBy("feu", "entry").agg(lists.alias("s")).select("feu", F.floor(F.col("entry") / 8).alias("event"), "entry", F.lit(0).alias("ftst"), *[F.col("s").getField(c).alias(c) for c in ("channel", "sample", "amplitude")])
    k, e = F.col("c_custkey"), F.col("event_id")
    peds = A.read(spark, sf_dir, "customer").groupBy((k % 6).alias("feu"), (k % 5).alias("channel")).agg(F.floor(F.avg(k)).cast("double").alias("mean"), F.lit(2.0).alias("rms"))
    hits = A.read(spark, sf_dir, "events").select(e.alias("hit"), (e % 8).alias("feu"), F.floor(e / 8).alias("event"), (e * 37 % 8).alias("channel"))
    return hits, events, peds


def q8_rows(out):
    total = F.aggregate("wf", F.lit(0).cast("long"), lambda t, x: t + x.amplitude)
    return out.select("hit", "feu", "event", "channel", "entry", F.size("wf").cast("long").alias("n"), total.alias("total"), "mean", "rms")


@query(Q8)
def q8_hits_with_waveforms(spark, sf_dir):
    return q8_rows(qa.with_waveforms(*q8_tables(spark, sf_dir), ["feu", "event"], ["feu"]))


@query(Q8)
def s2_s3_q8_bucketed_tables(spark, sf_dir):
    """The same from tables that are bucketed by unit and event: hits and events meet without a shuffle."""
    hits, events, peds = q8_tables(spark, sf_dir)
    hits, events = files.write_bucketed(hits, ["feu", "event"], 16), files.write_bucketed(events, ["feu", "event"], 16, ("entry",))
    return q8_rows(qa.with_waveforms(hits, events, peds, ["feu", "event"], ["feu"]))


@query("""with e as (select event_id, event_type as file, event_id % (3 + length(event_type)) as ftst from events), m as (select file, max(ftst) as most from e group by 1)
select event_id, e.file, round(event_id % 64 + case when most > 0 then ftst / (most + 1.0) else 0 end, 9) as shown, cast(10 * (most + 1) as bigint) as sample_ns from e join m using (file)""")
def q9_q12_display(spark, sf_dir):
    """Files whose periods differ; the greatest fine timestamp is that of each file."""
    e = A.read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("file"), (F.col("event_id") % (3 + F.length("event_type"))).alias("ftst"))
    rows = e.join(qa.sample_period(e, ["file"]), "file")
    return rows.select("event_id", "file", F.round(qa.display_sample(F.col("event_id") % 64, F.col("ftst"), F.col("most_ftst")), 9).alias("shown"), "sample_ns")


@query(BASE + """, tall as (select entry, channel, max(amplitude) as top from injected group by all) select entry, count(*) as channels, coalesce(max(top), 0) as top from tall
where channel between 10 and 73 and top >= 500 group by 1""")
def q11_q13_q14_selection(spark, sf_dir):
    rows = A.samples(spark, sf_dir, inject=True)
    chosen = spark.range(1).select(F.explode(qa.chosen_channels("10-73")).alias("channel")).select(F.col("channel").cast("long"))
    tops = rows.join(chosen, "channel", "left_semi").groupBy("entry", "channel").agg(F.max("amplitude").alias("top")).filter("top >= 500")
    return tops.groupBy("entry").agg(F.count("*").alias("channels"), F.coalesce(F.max("top"), F.lit(0)).alias("top"))


@query(HITS + """select channel, neighbours from (select p_partkey // 64 % 2 * 64 + p_partkey % 64 as channel, arg_max(p_size || ',' || p_partkey % 9, p_partkey) as neighbours from part group by 1)""")
def s6_j4_strip_map(spark, sf_dir):
    """A strip map written as text with blank and short lines, read back; the later line of a channel wins."""
    p, k = A.read(spark, sf_dir, "part"), F.col("p_partkey")
    line = F.concat_ws(",", F.floor(k / 64) % 2, k % 64, k, F.lit("x"), F.lit(1), F.lit(1), F.concat(F.lit(":"), "p_size", F.lit("::"), k % 9), F.lit(0.5), F.lit(1))
    head = spark.createDataFrame([(-2, " "), (-1, "connector,channel,strip,axis,p,i,n,x,y"), (0, "0,5,short")], "k long, value string")
    path = f"{files.scratch_dir(spark)}/strips-{uuid.uuid4().hex}"
    head.unionByName(p.select(k.alias("k"), line.alias("value"))).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)  # one detector's map
    strips = combine.last_by_channel(files.read_strip_map(spark, path))
    return strips.select(F.col("channel").cast("long").alias("channel"), F.array_join("neighbours", ",").alias("neighbours"))


@query("select cast(n_nationkey as bigint) as n_nationkey, n_name || chr(10) as content, cast(length(n_name) + 1 as bigint) as bytes from nation")
def s1_s9_files(spark, sf_dir):
    """A folder with a file for each nation, listed without and read with its contents."""
    path = f"{files.scratch_dir(spark)}/files-{uuid.uuid4().hex}"
    A.read(spark, sf_dir, "nation").select("n_nationkey", "n_name").repartition(1).write.partitionBy("n_nationkey").text(path)
    key = F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("long").alias("n_nationkey")
    listed = files.list_files(spark, path, "*.txt").select(key, F.col("length").alias("bytes"))
    read = files.read_frames(spark, [path], "*.txt").select(key, F.col("content").cast("string").alias("content"))
    return listed.join(read, "n_nationkey").select("n_nationkey", "content", "bytes")


@query("""select 'run=' || s_suppkey as run, case when s_nationkey < 5 or s_suppkey % 4 = 3 or s_suppkey % 3 = 0 then 60.0 else cast(20 + s_suppkey % 9 as double) end as sample_period, s_nationkey >= 5 and s_suppkey % 4 <> 3 and s_suppkey % 2 = 0 as zero_suppress,
s_nationkey >= 5 and s_suppkey % 4 <> 3 and s_suppkey % 5 = 0 as pedestal_subtraction, case when s_nationkey >= 5 and s_suppkey % 4 <> 3 then '/x/' || s_name end as daq_config_template_path from supplier""")
def s7_run_config(spark, sf_dir):
    """A configuration for each supplier; some have none, some no JSON, some lack a key."""
    s, k = A.read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    period = F.when(k % 3 == 0, "").otherwise(F.format_string('"sample_period": %d, ', 20 + k % 9))
    text = F.concat(F.lit('{"dream_daq_info": {'), period, F.format_string('"zero_suppress": %s, "pedestal_subtraction": %s, "daq_config_template_path": "/x/%s"}}', k % 2 == 0, k % 5 == 0, "s_name"))
    path = f"{files.scratch_dir(spark)}/configs-{uuid.uuid4().hex}"
    configs = s.filter("s_nationkey >= 5").select(F.format_string("run=%d/run_config.json", k).alias("path"), F.when(k % 4 == 3, "{").otherwise(text).cast("binary").alias("content"))
    frames.write_frame_files(files.spread(configs, "path"), path).write.format("noop").mode("overwrite").save()
    return files.read_run_config(spark, s.select(F.concat(F.lit("run="), k.cast("string")).alias("run")), path)


@query("select '/hits/' || n_name || '.parquet' as path, cast(n_nationkey as int) as feu from nation")
def s10_combine_list(spark, sf_dir):
    n = A.read(spark, sf_dir, "nation")
    path = f"{files.scratch_dir(spark)}/inputs-{uuid.uuid4().hex}"
    n.select(F.concat(F.lit('"/hits/'), "n_name", F.lit('.parquet" '), F.col("n_nationkey").cast("string"))).write.text(path)
    return files.read_combine_list(spark, path)


CHIP = """with lines as (select s_suppkey as k, case when s_suppkey % 5 = 0 then '*' else cast(s_suppkey % 7 as varchar) end as unit, s_suppkey * 29 % 256 // 16 as code from supplier where s_suppkey % 3 = 1 and s_suppkey % 13 <> 0 and s_suppkey % 17 <> 0),
peaking as (select unit as feu_key, arg_max([76, 123, 180, 228, 283, 328, 388, 433, 578][code + 1], k) as ns from lines where code <= 8 group by 1)
"""


@query(CHIP + "select feu_key, cast(ns as int) as ns from peaking")
def s8_c7_peaking_times(spark, sf_dir):
    path = f"{files.scratch_dir(spark)}/chip-{uuid.uuid4().hex}"
    A.chip_lines(spark, sf_dir).coalesce(1).sortWithinPartitions("line_no").select("value").write.text(path)  # one run's file
    return catalog.peaking_times(files.read_config_lines(spark, path))


@query(CHIP + """select u.run, u.feu, u.tps as sample_ns, case when coalesce(p.ns, (select ns from peaking where feu_key = '*')) is not null then cast(greatest(3, round_even(1.7 * coalesce(p.ns, (select ns from peaking where feu_key = '*')) / u.tps, 0)) as int) end as gate_width, zs and ped as zs_baseline
from (select distinct 'run_' || o_orderkey % 50 as run, cast(o_custkey % 12 as int) as feu, 20.0 + o_orderkey % 50 as tps, o_orderkey % 50 % 2 = 0 as zs, o_orderkey % 50 % 3 = 0 as ped from orders) u left join peaking p on p.feu_key = cast(u.feu as varchar)""")
def c8_c9_unit_settings(spark, sf_dir):
    """Sample period, gate width and baseline flag of each unit of each run, from run and chip configurations."""
    o, run = A.read(spark, sf_dir, "orders"), F.col("o_orderkey") % 50
    runs = o.select(F.concat(F.lit("run_"), run.cast("string")).alias("run"), (20 + run).cast("double").alias("sample_period"), (run % 2 == 0).alias("zero_suppress"), (run % 3 == 0).alias("pedestal_subtraction")).distinct()
    units = o.select(F.concat(F.lit("run_"), run.cast("string")).alias("run"), (F.col("o_custkey") % 12).cast("int").alias("feu")).distinct()
    return jobs.unit_settings(units, catalog.peaking_times(A.chip_lines(spark, sf_dir)), runs)


@query("""select * from (select o_orderkey as k, case o_orderkey % 4 when 0 then '/d/' || o_custkey when 1 then '/peds' else case when o_orderkey % 4 = 3 then '/peds' || case when o_custkey % 9 = 0 then '' else '/' || o_orderpriority end || '/pedestals' end end as folder from orders) where folder is not null""")
def c5_pedestal_folders(spark, sf_dir):
    """Beside the data, one folder for all, or that of a named run; runs that should name one and don't are skipped."""
    o, k = A.read(spark, sf_dir, "orders"), F.col("o_orderkey")
    same = F.concat(F.lit("/d/"), F.col("o_custkey").cast("string"))
    choice = F.when(k % 4 == 0, "same").when(k % 4 == 1, "abs").otherwise("find")
    named = F.when(k % 4 == 3, F.when(F.col("o_custkey") % 9 == 0, " \n").otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit("\n"))))
    return o.select(k.alias("k"), catalog.pedestal_folder(choice, same, F.lit("/peds"), named).alias("folder")).filter("folder is not null")


NAMES = """with names as (select 'run_' || (o_orderkey % 50) as run, o_orderkey as length, '/data/run_' || (o_orderkey % 50) || '/det_123_45_' || case when o_orderkey % 10 = 0 then 'pedthr' else 'datrun' end || '_x_' || lpad(cast(o_orderkey // 50 % 1000 as varchar), 3, '0') || '_' || lpad(cast(o_custkey % 12 as varchar), 2, '0') || '.fdf' as path from orders),
cat as (select *, cast(regexp_extract(path, '_(\\d{3})_(\\d{2})\\.', 1) as int) as file_num, cast(regexp_extract(path, '_(\\d{3})_(\\d{2})\\.', 2) as int) as feu, case when contains(path, '_datrun_') then 'data' when contains(path, '_pedthr_') then 'pedestal' else 'other' end as kind from names)
"""


@query(NAMES + "select path, file_num, feu, kind from cat")
def c1_c2_catalogue(spark, sf_dir):
    return catalog.catalogue(A.file_names(spark, sf_dir)).select("path", "file_num", "feu", "kind")


@query(NAMES + "select path, 123 as file_num, 45 as feu from cat where feu <> 1")
def c1_c3_first_match_and_excluded(spark, sf_dir):
    last = catalog.without_units(catalog.catalogue(A.file_names(spark, sf_dir)))
    return catalog.catalogue(last.select("path"), greedy=False).select("path", "file_num", "feu")


@query(NAMES + """, peds as (select run, feu, count(*) as found, min(path) as pedestal_path from cat where kind = 'pedestal' group by 1, 2)
select d.path, coalesce(p.found, 0) as found, p.pedestal_path from cat d left join peds p on p.run = d.run and p.feu = d.feu where d.kind = 'data' and coalesce(p.found, 0) <= 1""")
def c4_pedestal_resolution(spark, sf_dir):
    files = catalog.catalogue(A.file_names(spark, sf_dir))
    return catalog.resolve_pedestals(files.filter("kind = 'data'"), files.filter("kind = 'pedestal'"), ["run", "feu"]).select("path", "found", "pedestal_path")


@query(NAMES + """, one as (select '/data/' || run as folder, file_num, feu, max(path) as path from cat where kind = 'data' and feu <> 1 group by 1, 2, 3)
select folder, file_num, count(*) as n, regexp_replace(string_split(min(path), '/')[-1], '_(\\d{3})_(\\d{2})\\.', '_\\1_feu-combined.') as combined from one group by 1, 2""")
def c6_combined_names(spark, sf_dir):
    """Files of one number in one folder; unit 1 is left out."""
    files = catalog.catalogue(A.file_names(spark, sf_dir)).filter("kind = 'data'")
    return catalog.combined_groups(files).select("folder", "file_num", F.size("paths").cast("long").alias("n"), "combined")


@query(NAMES + "select run, path from (select run, path, row_number() over (partition by run order by case when contains(path, 'datrun') then 0 else 1 end, path) as r from cat) where r = 1")
def c10_config_choice(spark, sf_dir):
    files = A.file_names(spark, sf_dir).withColumn("path", F.concat("path", F.lit(".cfg_cpy")))
    return catalog.choose_config(files, ["run"]).select("run", F.regexp_replace("path", r"\.cfg_cpy$", "").alias("path"))


@query(NAMES + "select run, path from cat where contains(run, '_1') or contains(kind, 'zz')")
def c11_run_filter(spark, sf_dir):
    return catalog.only_runs(A.file_names(spark, sf_dir).withColumn("sub_run", F.lit("s")), "_1").select("run", "path")


LEDGER = "with ledger as (select o_orderpriority || ':' || o_orderkey as key, case o_orderstatus when 'F' then 'failed' when 'O' then 'ok' else 'running' end as status, floor(o_totalprice) as secs, cast(floor(o_totalprice / 10) as bigint) as bytes, o_custkey % 3 as rc from orders)\n"


@query(NAMES + """, runs as (select distinct run, '/x/t' || (length % 50 % 7) || '.cfg' as wanted from names), copies as (select run, min(path) as path from cat where kind = 'data' and run < 'run_3' group by 1)
select run, coalesce(c.path || '.cfg_cpy', case when length % 7 = 0 then '/x/t0.cfg' when length % 7 < 5 then '/a/t' || (length % 7) || '.cfg' end) as path from (select run, any_value(length % 50) as length from names group by 1) r left join copies c using (run)
where c.path is not null or length % 7 < 5""")
def c10_config_or_template(spark, sf_dir):
    """Runs with a copy of their configuration; the others take the template that they name, if some folder has it."""
    o = A.file_names(spark, sf_dir).withColumn("k", F.col("length") % 50)
    copies = o.filter("run < 'run_3' and path like '%datrun%'").select("run", F.concat("path", F.lit(".cfg_cpy")).alias("path"))
    runs = o.select("run", F.concat(F.lit("/x/t"), (F.col("k") % 7).cast("string"), F.lit(".cfg")).alias("daq_config_template_path")).distinct()
    templates = spark.range(5).select(F.concat(F.lit("/a/t"), F.col("id").cast("string"), F.lit(".cfg")).alias("path"), F.lit(0).alias("rank"))
    templates = templates.unionByName(templates.select(F.regexp_replace("path", "^/a", "/b").alias("path"), F.lit(1).alias("rank"))).unionByName(spark.range(1).select(F.lit("/x/t0.cfg").alias("path"), F.lit(2).alias("rank")))
    return catalog.choose_config(copies, ["run"], runs, templates)


@query(NAMES + "select path from cat where kind = 'pedestal' and feu >= 6")
def c12_undecoded_pedestals(spark, sf_dir):
    o = A.file_names(spark, sf_dir)
    made = catalog.catalogue(o).filter("feu < 6").select(*o.columns).withColumn("path", F.regexp_replace("path", r"\.fdf$", ".root"))
    return catalog.undecoded_pedestals(o.unionByName(made)).select("path")


@query(NAMES + """, d as (select run, file_num, feu, path from cat where kind = 'data' and feu <> 4), h as (select run, file_num, feu, path from cat where kind = 'data' and feu <> 5)
select d.run, d.file_num, d.feu, d.path as decoded_path, h.path || '_hits' as hits_path from d join h on d.run = h.run and d.file_num = h.file_num and d.feu = h.feu where d.feu in (2, 3, 4, 5)""")
def q15_file_pairs(spark, sf_dir):
    own = catalog.catalogue(A.file_names(spark, sf_dir)).filter("kind = 'data'")
    decoded = own.filter("feu <> 4").select("run", "file_num", "feu", "path")  # unit 4 isn't decoded, unit 5 has no hits
    hits = own.filter("feu <> 5").select("run", "file_num", "feu", F.concat("path", F.lit("_hits")).alias("path"))
    return qa.file_pairs(decoded, hits, feus=[2, 3, 4, 5], keys=["run"]).select("run", "file_num", "feu", "decoded_path", "hits_path")


@query(BASE + "select feu, min(entry) as entry, channel from samples where entry in (select min(entry) from samples group by feu) group by feu, channel")
def q13_default_selection(spark, sf_dir):
    return qa.default_selection(A.events(spark, sf_dir), ["feu"]).select("feu", "entry", F.col("channel").cast("long").alias("channel"))


@query(LEDGER + "select key from ledger where status <> 'ok'")
def c12_pending(spark, sf_dir):
    led = A.ledger(spark, sf_dir)
    return catalog.pending(led.select("key"), led)


@query(LEDGER + "select split_part(key, ':', 1) as stage, status, count(*) as n, sum(secs) as secs from ledger group by 1, 2")
def c13_ledger_summary(spark, sf_dir):
    return catalog.ledger_summary(A.ledger(spark, sf_dir))


@query(LEDGER + "select key, secs from ledger where status = 'failed' order by key limit 40")
def c13_first_failures(spark, sf_dir):
    return catalog.first_failures(A.ledger(spark, sf_dir)).select("key", "secs")


@query(LEDGER + "select key, case when rc <> 0 or bytes < 10240 then 'failed' else 'ok' end as status, case when rc <> 0 then 'nonzero exit' when bytes < 10240 then 'output ' || bytes || ' bytes' end as reason from ledger")
def c14_validation(spark, sf_dir):
    return catalog.validated(A.ledger(spark, sf_dir)).select("key", "status", "reason")


@query(NAMES + "select '/data/' || run as folder, count(*) as files, cast(sum(length) as bigint) as bytes from cat group by 1")
def c15_folder_sizes(spark, sf_dir):
    return catalog.folder_sizes(A.file_names(spark, sf_dir))


@query("""with w as (select cast(l_partkey * 31 % 65536 as int) as w, l_orderkey * 7 + l_linenumber as k from lineitem)
select k, w, (w & 28672) >> 12 = 7 as final_trailer, (w & 28672) >> 12 = 6 as header, (w & 24576) >> 13 = 1 as data_header, (w & 24576) >> 13 = 0 as data, (w & 4088) >> 3 as sample_id, (w & 4095) as adc, (w & 448) >> 6 as chip_zs, (w & 448) >> 6 << 6 | (w & 63) as channel from w""")
def d2_d3_d5_words(spark, sf_dir):
    w = F.col("w")
    return A.words(spark, sf_dir).select(
        "k", "w", *[bits.is_class(w, c).alias(c) for c in ("final_trailer", "header", "data_header", "data")], bits.field(w, "sample_id").alias("sample_id"), bits.field(w, "adc").alias("adc"),
        bits.field(w, "chip_zs").alias("chip_zs"), (bits.field(w, "chip_zs") * 64 + bits.field(w, "channel")).alias("channel"),
    )


@query("with w as (select cast(l_partkey * 31 % 65536 as int) as w, l_orderkey * 7 + l_linenumber as k from lineitem) select k, w, " + ", ".join([f"(w & {m}) >> {k} = {v} as is_{n}" for n, (m, k, v) in bits.CLASSES.items()] + [f"(w & {m}) >> {k} as {n}" for n, (m, k) in bits.FIELDS.items()]) + " from w")
def d2_d3_all_classes_and_fields(spark, sf_dir):
    w = F.col("w")
    return A.words(spark, sf_dir).select("k", "w", *[bits.is_class(w, c).alias(f"is_{c}") for c in bits.CLASSES], *[bits.field(w, f).alias(f) for f in bits.FIELDS])


@query("""with w as (select l_orderkey as k, list(cast(l_partkey * 31 % 65536 as bigint) order by l_linenumber, l_extendedprice, l_partkey) as h from lineitem group by 1 having count(*) >= 8)
select k, (h[2] & 4095) + ((h[5] & 4095) << 12) as event_id, (h[3] & 4095) + ((h[6] & 4095) << 12) + ((h[7] & 4095) << 24) + ((h[8] & 255) << 36) as timestamp, ((h[1] & 2048) >> 3) + ((h[4] & 4088) >> 3) as sample_id, h[4] & 7 as ftst from w""")
def d4_headers(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    pair = F.struct("l_linenumber", "l_extendedprice", "l_partkey", (F.col("l_partkey") * 31 % 65536).cast("int").alias("w"))
    heads = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(pair)).getField("w").alias("h")).filter(F.size("h") >= 8)
    return heads.select("k", *[v.alias(c) for c, v in bits.header_fields(lambda i: F.col("h")[i]).items()])


DECODED = """with frames as (select cast(event_id // 500 as int) as file, cast(event_id // 500 % 4 as int) as feu, row_number() over (partition by event_id // 500 order by event_id) - 1 as frame_idx, event_id as k, user_id % 5 as few, event_id // 40 as event_id, event_id % 4096 as timestamp,
user_id % 32 as sample_id, cast(event_id % 8 as int) as ftst, event_id % 7 = 0 as eoe, case when event_id % 33 = 0 then 63 when event_id % 11 = 0 then 64 else user_id % 5 end as n_data, event_id % 11 <> 0 as zs from events)
"""


FRAME_ROWS = DECODED + """select file as file_num, feu, frame_idx, event_id, timestamp, sample_id, ftst, zs, eoe, cast(case when n_data = 63 then 1 else 0 end as int) as bad_blocks, n_data,
cast(coalesce(case when zs then list_sum([(k * 7 + j) % 512 for j in range(1, few + 1)]) else n_data * (k % 8 * 64) + n_data * (n_data - 1) // 2 end, 0) as bigint) as channels,
cast(coalesce(case when zs then list_sum([(k * 13 + j * 101) % 4096 for j in range(1, few + 1)]) else list_sum([(k * 3 + j * 17) % 4096 for j in range(1, n_data + 1)]) end, 0) as bigint) as amplitudes from frames"""


@query(FRAME_ROWS)
def d1_d6_d7_decoded_frames(spark, sf_dir):
    """Frames out of the binary words that are built from the events."""
    return frame_rows(files.decode(A.encoded_frames(spark, sf_dir)))


def frame_rows(out):
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda t, x: t + x)
    return out.select("file_num", "feu", "frame_idx", "event_id", "timestamp", "sample_id", "ftst", "zs", "eoe", "bad_blocks", "n_data", total("channel").alias("channels"), total("amplitude").alias("amplitudes"))


def frame_folder(spark, sf_dir):
    """The frame files as files: ``path`` of the folder that they are written to. Numbers have three digits, so a run has 1,000 files."""
    base = f"{files.scratch_dir(spark)}/frames-{uuid.uuid4().hex}"
    run, own = F.floor(F.col("file_num") / 1000), F.col("file_num") % 1000
    named = A.encoded_frames(spark, sf_dir).withColumn("path", F.format_string("run_%d/x_%03d_%02d.fdf", run, own, F.col("feu")))
    frames.write_frame_files(named, base).write.format("noop").mode("overwrite").save()
    return base


def over_runs(rows):
    """``rows`` of those files with their number over all runs."""
    run = F.regexp_extract("path", "run_([0-9]+)/[^/]*$", 1).cast("int")
    return rows.withColumn("file_num", (1000 * run + F.col("file_num")).cast("int"))


@query(FRAME_ROWS)
def d7_frames_by_ranges(spark, sf_dir):
    """The same frames from files that are cut into ranges of 4,096 bytes, each decoded by itself."""
    return frame_rows(over_runs(frames.decode_files(spark, frame_folder(spark, sf_dir), 4096)))


@query("""with w as (select cast(event_id // 500 as int) as file_num, cast(event_id // 500 % 4 as int) as feu, cast(2 * sum(10 + case when event_id % 33 = 0 then 68 when event_id % 11 = 0 then 69 else 2 * (user_id % 5) end) as bigint) as size from events group by 1, 2)
select file_num, feu, size, cast(ceil(size / 4096.0) as bigint) as ranges, size as bytes from w where feu in (1, 3)""")
def s1_frame_source(spark, sf_dir):
    """Ranges of the frame files of two units; files of other units aren't opened."""
    chunks = frames.read_chunks(spark, frame_folder(spark, sf_dir), 4096, content=True).filter("feu in (1, 3)")
    return over_runs(chunks).groupBy("file_num", "feu", "size").agg(F.count("*").alias("ranges"), F.sum(F.octet_length("content")).cast("long").alias("bytes"))


@query("select cast(event_id // 500 as int) as file_num, cast(sum(10 + case when event_id % 33 = 0 then 68 when event_id % 11 = 0 then 69 else 2 * (user_id % 5) end) as bigint) as words from events group by 1")
def d1_words(spark, sf_dir):
    out = A.encoded_frames(spark, sf_dir).select("file_num", bits.words(F.col("content")).alias("w"))
    return out.select("file_num", F.size("w").cast("long").alias("words"))


FRAMES_TAIL = """,

f1 as (select *, case when lag(eoe) over o is null or lag(eoe) over o or lag(event_id) over o <> event_id then 1 else 0 end as fresh from frames window o as (partition by file order by frame_idx)),
f2 as (select *, sum(fresh) over (partition by file order by frame_idx) as grp from f1),
g as (select file, grp, bool_or(eoe) as ended, sum(n_data) > 0 as data from f2 group by 1, 2),
g2 as (select *, max(grp) over (partition by file) as last from g),
closing as (select file, grp, case when ended then 0 when grp < last then 1 else 2 end as reason, row_number() over (partition by file order by grp) - 1 as entry from g2 where ended or data),
owned as (select f.*, c.entry, c.reason from f2 f asof left join closing c on c.file = f.file and c.grp >= f.grp),
entries as (select file, entry, max(reason) as reason, arg_max(event_id, frame_idx) as event_id, count(*) as frames, count(distinct sample_id) as seen from owned where entry is not null group by 1, 2)
"""
FRAMES = """with frames as (select event_type as file, event_id as frame_idx, event_id // 40 as event_id, user_id % 32 as sample_id, event_id % 7 = 0 as eoe, user_id % 5 as n_data, event_id % 3 = 0 as zs from events)""" + FRAMES_TAIL
LOSSES = """, t as (select file, count(*) as events, cast(count_if(reason = 0) as bigint) as closed_eoe, cast(count_if(reason = 1) as bigint) as closed_eventid, cast(count_if(reason = 2) as bigint) as closed_eof, arg_min(event_id, entry) as first_eventid,
arg_max(event_id, entry) as last_eventid, cast(sum(seen) as bigint) as sum_distinct from entries group by 1),
w as (select file, count(*) as feu_frames, cast(max(sample_id) + 1 as int) as samples_expected, bool_or(zs) as zs, bool_or(not zs) as raw from frames group by 1),
u as (select *, greatest(0, case when last_eventid >= first_eventid then last_eventid - first_eventid + 1 else events end - events) as events_missing, cast(sum_distinct as double) / (events * samples_expected) as a, raw and not zs as dense from t join w using (file))
"""


@query(FRAMES + "select file, entry, event_id, reason from entries")
def d8_d9_event_assembly(spark, sf_dir):
    own = loss.assemble(A.frames(spark, sf_dir), ["file"])
    return loss.event_headers(own, ["file"], ["event_id"])


@query(FRAMES + LOSSES + """select file, events, closed_eoe, closed_eventid, closed_eof, feu_frames, first_eventid, last_eventid, sum_distinct, samples_expected, events_missing, cast(dense as int) as raw_mode, raw and zs as mixed, round(a, 9) as sample_acceptance_mean, events_missing > 0 or (dense and 1 - a > 0.001) as lossy from u""")
def l1_l7_loss_accounting(spark, sf_dir):
    out = loss.accounting(loss.entries(loss.assemble(A.frames(spark, sf_dir), ["file"]), ["file"]), ["file"])
    return out.withColumn("sample_acceptance_mean", F.round("sample_acceptance_mean", 9))


@query(DECODED.rstrip() + FRAMES_TAIL + LOSSES + "select file as file_num, " + ", ".join(f"round(a, 9) as {c}" if c == "sample_acceptance_mean" else f"cast(dense as int) as {c}" if c == "raw_mode" else c for c in loss.STATS) + " from u")
def s5_l1_l7_decode_stats(spark, sf_dir):
    """Files decoded once; the loss table written beside the events and read back."""
    path = f"{files.scratch_dir(spark)}/decoded-{uuid.uuid4().hex}"
    stats = jobs.frames_to_events(A.encoded_frames(spark, sf_dir), path)[1]
    return stats.drop("feu").withColumn("sample_acceptance_mean", F.round("sample_acceptance_mean", 9))


@query(FRAMES + """, k as (select file, sample_id as sample, count(distinct entry) as k from owned where entry is not null group by 1, 2), n as (select file, count(*) as events from entries group by 1),
every as (select file, unnest(range(0, max(sample_id) + 1)) as sample from frames group by file) select v.file, v.sample, round(coalesce(k, 0) / events, 9) as acceptance from every v join n on n.file = v.file left join k on k.file = v.file and k.sample = v.sample""")
def l8_sample_acceptance(spark, sf_dir):
    out = loss.sample_acceptance(loss.entries(loss.assemble(A.frames(spark, sf_dir), ["file"]), ["file"]), ["file"])
    return out.withColumn("acceptance", F.round("acceptance", 9))


@query("""with s as (select l_suppkey % 8 as feu, l_orderkey as entry, l_partkey % 512 as channel, l_linenumber as sample, cast(l_quantity as bigint) as amplitude from lineitem), e as (select feu, count(distinct entry) as events from s group by 1),
a as (select s.feu, sample, count(distinct entry) as k from s group by 1, 2) select s.feu, channel, s.sample, round(sum(amplitude) / max(events) / (max(k) / max(events)), 6) as mean from s join e on e.feu = s.feu join a on a.feu = s.feu and a.sample = s.sample group by 1, 2, 3""")
def l9_corrected_means(spark, sf_dir):
    rows = A.large_samples(spark, sf_dir)
    seen = rows.groupBy("feu", "entry").agg(F.collect_set("sample").alias("seen"))
    acceptance = loss.sample_acceptance(seen, ["feu"])
    return loss.corrected_means(rows, acceptance, ["feu"]).withColumn("mean", F.round("mean", 6))
