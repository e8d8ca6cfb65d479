"""SQL for hits of the shaped waveforms: pedestals, gate, runs, valleys and every measure, by lists and a recursion."""

from __future__ import annotations

SHAPED = """raw as (select vec_id // 128 as entry, vec_id % 128 as channel, unnest(embedding) as e, generate_subscripts(embedding, 1) - 1 as t from embeddings),
quiet as (select entry % 2 as feu, entry, channel, t as sample, cast(floor(256 + 100 * cast(e as double)) as bigint) as amplitude from raw),
shaped as (select feu, entry, channel, sample, least(4095, case (channel + entry) % 16
when 0 then amplitude + greatest(0, 1600 - 300 * abs(sample - 20 - channel % 8))
when 1 then amplitude + greatest(0, 1200 - 200 * abs(sample - 20)) + greatest(0, 1000 - 200 * abs(sample - 30))
when 2 then amplitude + greatest(0, 6000 - 900 * abs(sample - 30))
when 3 then case when abs(sample - 25) < 8 then 256 + least(1000, 1600 - 200 * abs(sample - 25)) else amplitude end
when 4 then amplitude + greatest(0, 900 - 150 * sample)
when 5 then amplitude + greatest(0, 900 - 150 * (63 - sample))
when 6 then amplitude + greatest(0, 800 - 200 * abs(sample - 15)) + greatest(0, 1200 - 200 * abs(sample - 24)) + greatest(0, 900 - 200 * abs(sample - 33))
when 7 then amplitude + 500 * greatest(0, sample - 52)
when 8 then case when sample between 40 and 43 then 956 when sample between 44 and 46 then 556 else amplitude end
else amplitude end) as amplitude from quiet)"""


INJECTED = """raw as (select vec_id // 128 as entry, vec_id % 128 as channel, unnest(embedding) as e, generate_subscripts(embedding, 1) - 1 as t from embeddings),
quiet as (select entry % 2 as feu, entry, channel, t as sample, cast(floor(256 + 1000 * cast(e as double)) as bigint) as amplitude from raw),
shaped as (select feu, entry, channel, sample, case when channel % 16 = entry % 16 then least(4095, amplitude + greatest(0, 2400 - 300 * abs(sample - 20 - channel % 8))) else amplitude end as amplitude from quiet)"""


def hits_sql(cns: bool, width: int, sample_ns: str = "60.0", forced: str = "false", tables: str = SHAPED) -> str:
    """CTEs up to ``hits`` from ``quiet`` and ``shaped`` samples; ``sample_ns`` and ``forced`` (baseline 256) are expressions of ``feu``."""
    h = width // 2
    frame = f"partition by feu, entry, channel order by sample rows between {h} preceding and {h} following"
    noise = "sqrt(greatest(0, sum(v * v) / count(*) - (sum(v) / count(*)) * (sum(v) / count(*))))"
    block = "partition by feu, entry, channel // 64, sample"
    v = f"v - list_sort(list(v) over ({block}))[count(*) over ({block}) // 2 + 1]" if cns else "v"
    sat = "0.94 * (4095 - mean)"

    def fit(p: str, q: str, what: str) -> str:
        middle, mean = f"(({p}) + ({q})) / 2.0", f"list_avg(w[({p}) + 1 : ({q}) + 1])"
        slope = f"list_sum([(i - {middle}) * (w[i + 1] - {mean}) for i in range({p}, ({q}) + 1)]) / list_sum([(i - {middle}) * (i - {middle}) for i in range({p}, ({q}) + 1)])"
        return f"case when ({q}) > ({p}) then {slope if what == 'slope' else f'{mean} - ({slope}) * {middle}'} end"

    left, right = ("greatest(0, ss - 3)", "ss"), ("se", "least(n - 1, se + 3)")
    deep = "[least(list_max(g[a + 1 : i + 1]), list_max(g[i + 1 : b + 1])) - g[i + 1] for i in range(a + 3, a + least(b - a + 1 - 3, b - a - 1) + 1)]"
    cut = f"(select case when list_max(d) >= 4 * sigma and list_max(d) > 0 then a + 3 + list_position(d, list_max(d)) - 1 end from (select case when b - a + 1 >= 6 then {deep} else [] end as d))"
    return f"""with recursive {tables},
means as (select feu, channel, sum(amplitude) / count(*) as mean from quiet group by all),
qv as (select feu, entry, channel, sample, amplitude - list_sort(list(amplitude) over ({block}))[count(*) over ({block}) // 2 + 1] as v from quiet),
noise as (select feu, channel, {noise} as rms from qv group by all),
qg as (select feu, entry, channel, cast(sum(v) over f as double) / count(*) over f as v from qv window f as ({frame})),
gnoise as (select feu, channel, {noise} as rms_gate from qg group by all),
units as (select feu, cast({sample_ns} as double) as ns, {forced} as forced from (select distinct feu from quiet)),
peds as (select m.feu, m.channel, case when forced then 256.0 else mean end as mean, rms, rms_gate, ns from means m join noise using (feu, channel) join gnoise using (feu, channel) join units using (feu)),
sub as (select feu, entry, channel, sample, amplitude - mean as v from shaped join peds using (feu, channel)),
wf as (select feu, entry, channel, sample, {v} as v from sub),
gate as (select *, cast(sum(v) over f as double) / count(*) over f as g from wf window f as ({frame})),
waves as (select feu, entry, channel, list(v order by sample) as w, list({"g" if width else "v"} order by sample) as g, count(*) as n from gate group by all),
full_ as (select *, {"rms_gate" if width else "rms"} as sigma from waves join peds using (feu, channel)),
over_ as (select feu, entry, channel, sample from (select feu, entry, channel, unnest(range(0, n)) as sample, unnest(g) as g, sigma from full_) where g > 5 * sigma),
islands as (select *, sample - row_number() over (partition by feu, entry, channel order by sample) as island from over_),
runs as (select feu, entry, channel, min(sample) as start, max(sample) as stop from islands group by feu, entry, channel, island),
flagged as (select *, case when start - lag(stop) over o - 1 <= 2 then 0 else 1 end as fresh from runs window o as (partition by feu, entry, channel order by start)),
numbered as (select *, sum(fresh) over (partition by feu, entry, channel order by start) as pulse from flagged),
bridged as (select feu, entry, channel, min(start) as a, max(stop) as b from numbered group by feu, entry, channel, pulse),
parts as (select feu, entry, channel, a, b, g, sigma, {cut} as cut from bridged join full_ using (feu, entry, channel)
union all select feu, entry, channel, a, b, g, sigma, {cut} as cut from (
select feu, entry, channel, g, sigma, unnest([a, cut]) as a, unnest([cut - 1, b]) as b from parts where cut is not null)),
regions as (select feu, entry, channel, a, b, coalesce(lag(b) over o + 1, 0) as lo, lead(a) over o - 1 as nxt from parts where cut is null window o as (partition by feu, entry, channel order by a)),
r1 as (select r.*, coalesce(nxt, n - 1) as hi, w, g, n, mean, rms, sigma, ns, {sat} as level, 4095 - mean as most, list_max(w[a + 1 : b + 1]) as best from regions r join full_ using (feu, entry, channel) where b - a + 1 >= 3),
r2 as (select *, a + list_position(w[a + 1 : b + 1], best) - 1 as first, greatest(lo, a - 2) as bh, greatest(lo, greatest(lo, a - 2) - 4) as bl, greatest(lo, a - 4) as near,
[i for i in range(a, b + 1) if w[i + 1] >= level and (i = a or w[i] < level)] as starts from r1),
r3 as (select *, coalesce(nullif(list_position([x <> best for x in w[first + 1 : b + 1]], true), 0) - 1, b - first + 1) as same,
case when bh > bl then list_median(w[bl + 1 : bh]) when a > near then list_median(w[near + 1 : a]) when a > 0 then w[a + 1] else 0 end as base,
[coalesce(nullif(list_position([x < level for x in w[i + 1 : b + 1]], true), 0) - 1, b - i + 1) for i in starts] as lens from r2),
r4 as (select *, case when first > a then (first + first + same - 1) // 2 else a end as top, coalesce(list_max(lens) >= 2, false) as saturated, starts[list_position(lens, list_max(lens))] as ss, list_max(lens) as longest from r3),
r5 as (select *, ss + longest - 1 as se from r4),
r6 as (select *, {fit(*left, "slope")} as ls, {fit(*left, "at")} as li, {fit(*right, "slope")} as rs, {fit(*right, "at")} as ri,
w[top] - base as y1, w[top + 1] - base as y2, w[top + 2] - base as y3 from r5),
r7 as (select *, case when saturated and (ls is null or rs is null or ls <= 0 or rs >= 0) then ss when saturated then (ri - li) / (ls - rs)
when top > 0 and top < n - 1 and abs(y1 - 2 * y2 + y3) > 1e-9 then top + 0.5 * (y1 - y3) / (y1 - 2 * y2 + y3) else top end as place from r6),
r8 as (select *, case when saturated and (ls is null or rs is null or ls <= 0 or rs >= 0) then w[ss + 1] - base when saturated then ls * place + li - base
when top > 0 and top < n - 1 and abs(y1 - 2 * y2 + y3) > 1e-9 then y2 - 0.25 * (y1 - y3) * (place - top) else best - base end as height from r7),
r9 as (select *, 0.3 * least(height, most) + base as target from r8 {"" if width else "where height >= 5 * rms"}),
r10 as (select *, coalesce(list_max([i for i in range(a, top + 1) if w[i + 1] <= target]), a) as lead_,
coalesce(list_max([i for i in range(lo, a) if w[i + 1] - base <= 0]) + 1, lo) as i0, coalesce(list_min([i for i in range(b + 1, hi + 1) if w[i + 1] - base <= 0]) - 1, hi) as j0, 5 * sigma as lim from r9),
r11 as (select *, case when lead_ + 1 >= n then top when abs(w[lead_ + 2] - w[lead_ + 1]) > 1e-9 then lead_ + (target - w[lead_ + 1]) / (w[lead_ + 2] - w[lead_ + 1]) else lead_ + 0.5 end as timing,
case when a > lo and g[a] <= lim and g[a + 1] - g[a] > 1e-9 then a - 1 + (lim - g[a]) / (g[a + 1] - g[a]) else a end as l,
case when b < hi and g[b + 2] <= lim and g[b + 1] - g[b + 2] > 1e-9 then b + (g[b + 1] - lim) / (g[b + 1] - g[b + 2]) else b end as r, entry % 6 * 10 / ns as late from r10),
hits as (select feu, entry, entry as eventId, entry * 10000 as trigger_timestamp_ns, channel, row_number() over (partition by feu, entry, channel order by a) - 1 as pulse_idx, height as amplitude, (timing + late) * ns as time,
(place + late) * ns as time_of_max, timing + late as sample, place + late as max_sample, base as local_baseline, best - base as local_max, l + late as left_sample, r + late as right_sample, (r - l) * ns as time_over_threshold,
list_sum([x - base for x in w[i0 + 1 : j0 + 1]]) as integral, case when sigma > 0 then list_max(g[a + 1 : b + 1]) / sigma else 0 end as significance, saturated, a = 0 as trunc_left, b = n - 1 as trunc_right from r11)
"""


def seeds_sql() -> str:
    """Derivative seeds of the shaped waveforms after common noise, in units of each channel's noise."""
    block = "partition by feu, entry, channel // 64, sample"
    before, after = "coalesce(list_max([i for i in range(0, {0}) if w[i + 1] <= 5]) + 1, 0)", "coalesce(list_min([i for i in range({0} + 1, n) if w[i + 1] <= 5]) - 1, n - 1)"
    return f"""with recursive {SHAPED},
means as (select feu, channel, sum(amplitude) / count(*) as mean from quiet group by all),
qv as (select feu, channel, amplitude - list_sort(list(amplitude) over ({block}))[count(*) over ({block}) // 2 + 1] as v from quiet),
noise as (select feu, channel, sqrt(greatest(0, sum(v * v) / count(*) - (sum(v) / count(*)) * (sum(v) / count(*)))) as rms from qv group by all),
sub as (select feu, entry, channel, sample, amplitude - mean as v from shaped join means using (feu, channel)),
wf as (select feu, entry, channel, sample, v - list_sort(list(v) over ({block}))[count(*) over ({block}) // 2 + 1] as v from sub),
waves as (select feu, entry, channel, list(case when rms > 0 then v / rms else 0 end order by sample) as w, count(*) as n from wf join noise using (feu, channel) group by all),
smooth as (select *, [list_sum(w[greatest(i - 3, 0) + 1 : least(i + 3, n - 1) + 1]) / (least(i + 3, n - 1) - greatest(i - 3, 0) + 1) for i in range(0, n)] as sm from waves),
slopes as (select *, [case when i = 0 then sm[2] - sm[1] when i = n - 1 then sm[n] - sm[n - 1] else (sm[i + 2] - sm[i]) / 2 end for i in range(0, n)] as sl from smooth),
tops as (select feu, entry, channel, w, n, sl, [i for i in range(1, n - 1) if sl[i + 1] > 3 and sl[i + 1] >= sl[i] and sl[i + 1] >= sl[i + 2]] as tops from slopes),
merged as (select *, 0 as k, cast([] as bigint[]) as seeds from tops
union all select feu, entry, channel, w, n, sl, tops, k + 1, case when len(seeds) > 0 and tops[k + 1] - seeds[len(seeds)] <= 4
then list_append(seeds[1 : len(seeds) - 1], case when sl[tops[k + 1] + 1] > sl[seeds[len(seeds)] + 1] then tops[k + 1] else seeds[len(seeds)] end) else list_append(seeds, tops[k + 1]) end from merged where k < len(tops)),
each as (select feu, entry, channel, w, n, unnest(seeds) as s, unnest(list_append(seeds[2:], null)) as nxt from merged where k = len(tops) and len(seeds) > 0),
ends as (select *, {before.format("s")} as a, {after.format("s")} as b0, case when nxt is not null then {before.format("nxt")} end as na from each),
cut as (select feu, entry, channel, a, case when na <= b0 then s + list_position(w[s + 1 : nxt], list_min(w[s + 1 : nxt])) - 1 else b0 end as b from ends)
select feu, entry, channel, a as start, b as stop from cut where b - a + 1 >= 2"""
