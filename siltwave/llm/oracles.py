"""DuckDB SQL for the operators of this package that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_BUCKET = "case when v < 64 then v else (length(bin(v)) - 1) * 32 + ((v >> greatest(length(bin(v)) - 6, 0)) & 31) end"


def _top(b: str) -> str:
    return f"case when {b} < 64 then {b} else ((33 + {b} % 32) << greatest({b} // 32 - 5, 0)) - 1 end"


_RATES = """case when word_chars > 0 then n_symbols * 1000000 // word_chars else 0 end as v_symbols,
n_dup_lines * 1000000 // (n_lines + 4) as v_dup_lines,
case when n_words > 0 then n_repeat_words * 1000000 // n_words else 0 end as v_repeats,
case when n_words > 0 then word_chars * 1000 // n_words else 0 end as v_long_words"""

_MEASURES = ("symbols", "dup_lines", "repeats", "long_words")
_UNITS = {"symbols": (1, "s_chars"), "dup_lines": (1, "(s_words * 1000 / s_line_words + 4)"), "repeats": (16, "s_words")}
_READ = ", ".join([f"max({c}) filter (measure = '{m}')::double as {c}_{m}" for m in _MEASURES for c in ("q50", "q90", "s10", "s25", "s75")] + [f"greatest(max(q50) filter (measure = '{m}')::double, 1.0) as s_{m}" for m in ("chars", "words", "line_words")])
_ONE = {m: f"({n}000000.0::double / {size})" for m, (n, size) in _UNITS.items()}
_LIMITS = ", ".join([f"coalesce(floor({_ONE[m]} * (s75_{m} + (s75_{m} - s25_{m}) * 3) / greatest(s10_{m}, {_ONE[m]})), 0)::bigint as limit_{m}" for m in _UNITS] + ["(q90_long_words + (q90_long_words - q50_long_words) * 8)::bigint as limit_long_words"])

OP2 = rf"""with split as (select doc_id, lang, source, text, {_WORDS} as words,
list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
places as (select doc_id, unnest(words) as w, generate_subscripts(words, 1) as i from split),
windows as (select doc_id, i, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o || ' ' || lead(w, 4) over o || ' ' || lead(w, 5) over o || ' ' || lead(w, 6) over o || ' ' || lead(w, 7) over o as win
from places window o as (partition by doc_id order by i)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as k from windows where win is not null) where k > 1),
gaps as (select doc_id, least(8, coalesce(lead(i) over (partition by doc_id order by i) - i, 8)) as gap from twice),
repeated as (select doc_id, sum(gap)::bigint as n_repeat_words from gaps group by 1),
counted as (select s.doc_id, lang, source, len(words)::bigint as n_words, length(coalesce(array_to_string(words, ''), ''))::bigint as word_chars,
length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
(len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
from split s left join repeated r on r.doc_id = s.doc_id),
rated as (select *, n_words < 20 or n_repeat_words * 100 > n_words * 30 as base_failed, {_RATES} from counted),
measured as (select lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'long_words', 'chars', 'words', 'line_words']) as measure, unnest([v_symbols, v_dup_lines, v_repeats, v_long_words, word_chars, n_words, n_words * 1000 // greatest(n_lines, 1)]) as v from rated where not base_failed),
sketch as (select lang, source, measure, {_BUCKET} as bucket, count(*) as n from measured group by all),
by_lang as (select lang, measure, bucket, sum(n) as l_n from sketch group by all), everything as (select measure, bucket, sum(n) as e_n from sketch group by all),
sizes as (select lang, measure, sum(l_n) as l_all from by_lang group by all), total as (select measure, sum(e_n) as e_all from everything group by all),
blended as (select g.lang, g.source, g.measure, e.bucket, (coalesce(n, 0) * 1048576 + floor((coalesce(l_n, 0)::double + e_n::double * 100 / e_all::double) * 100 / (l_all + 100)::double * 1048576))::bigint as w
from (select distinct lang, source, measure from sketch) g join everything e using (measure) join total t using (measure) join sizes z on z.lang is not distinct from g.lang and z.measure = g.measure
left join by_lang l on l.lang is not distinct from g.lang and l.measure = g.measure and l.bucket = e.bucket
left join sketch o on o.lang is not distinct from g.lang and o.source is not distinct from g.source and o.measure = g.measure and o.bucket = e.bucket),
ranked as (select *, sum(w) over (partition by lang, source, measure order by bucket) as upto, sum(w) over (partition by lang, source, measure) as total,
sum(case when bucket > 0 then w else 0 end) over (partition by lang, source, measure order by bucket) as s_upto, sum(case when bucket > 0 then w else 0 end) over (partition by lang, source, measure) as s_total from blended),
quantiles as (select lang, source, measure, min(bucket) filter (upto * 100 >= total * 50) as b50, min(bucket) filter (upto * 100 >= total * 90) as b90, min(bucket) filter (bucket > 0 and s_total > 0 and s_upto * 100 >= s_total * 10) as b10,
min(bucket) filter (bucket > 0 and s_total > 0 and s_upto * 100 >= s_total * 25) as b25, min(bucket) filter (bucket > 0 and s_total > 0 and s_upto * 100 >= s_total * 75) as b75 from ranked group by all),
tops as (select *, {_top("b50")} as q50, {_top("b90")} as q90, {_top("b10")} as s10, {_top("b25")} as s25, {_top("b75")} as s75 from quantiles),
read as (select lang, source, {_READ} from tops group by all),
limits as (select lang, source, {_LIMITS} from read),
joined as (select r.*, limit_symbols, limit_dup_lines, limit_repeats, limit_long_words from rated r left join limits m on m.lang is not distinct from r.lang and m.source is not distinct from r.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
not base_failed and coalesce(v_symbols <= limit_symbols and v_dup_lines <= limit_dup_lines and v_repeats <= limit_repeats and v_long_words <= limit_long_words, true) as kept,
limit_symbols, limit_dup_lines, limit_repeats, limit_long_words from joined"""

#: Repetition limit 2, a budget of all words, blocks of 2^20 words; 30 halvings reach the grid of six steps of 32 parts.
OP6 = rf"""with recursive own as (select doc_id, source, len({_WORDS})::bigint as n_tokens from documents),
sources as (select source, sum(n_tokens)::bigint as tokens from own group by 1),
whole as (select coalesce(sum(tokens), 0)::double as total, count(*) as n from sources),
even as (select coalesce(max(total) * max(1 / tokens::double) / count(*) <= 2, false) as fine from sources, whole where tokens > 0),
halved as (select 0 as step, 0.0::double as lo, 1.0::double as hi
union all select step + 1, case when fine then lo else (lo + hi) / 2 end, case when fine then (lo + hi) / 2 else hi end from (
select step, lo, hi, max(total) * max(pow(tokens / total, (lo + hi) / 2) / tokens) / sum(pow(tokens / total, (lo + hi) / 2)) <= 2 as fine
from halved, sources, whole where step < 30 and tokens > 0 group by step, lo, hi)),
exponent as (select case when total <= 0 or n < 2 then 1.0::double when fine then 0.0::double else hi end as t from whole, even, (select hi from halved order by step desc limit 1)),
raw as (select source, tokens, total, case when tokens > 0 then pow(tokens / total, t) else 0 end as raw from sources, whole, exponent),
weights as (select *, raw / (sum(raw) over ()) as weight, ceil((tokens + 1) / 1048576.0)::bigint as blocks from raw),
wanted as (select *, round(weight * total)::bigint as wanted from weights),
plan as (select *, case when tokens > 0 then wanted // tokens else 1 end as passes, wanted - case when tokens > 0 then wanted // tokens else 1 end * tokens as part from wanted),
placed as (select o.doc_id, o.source, n_tokens, weight, passes, part, ('0x' || substr(md5(concat_ws(':', '7', o.doc_id::varchar, o.source)), 1, 15))::bigint as spot, blocks from own o join plan p on p.source is not distinct from o.source),
blocked as (select *, spot % blocks as block from placed),
sums as (select source, block, part, sum(n_tokens) as block_sum from blocked group by all),
running as (select *, sum(block_sum) over (partition by source order by ('0x' || substr(md5(concat_ws(':', '8', block::varchar)), 1, 15))::bigint, block rows unbounded preceding) as upto from sums),
fates as (select source, block, case when upto <= part then 1 when upto - block_sum >= part then 0 else 2 end as fate, part - upto + block_sum as room from running),
chosen as (select b.*, fate, room, sum(n_tokens) over (partition by b.source, b.block order by spot) as used from blocked b join fates f on f.source is not distinct from b.source and f.block = b.block)
select doc_id, source, n_tokens, round(weight, 9) as weight,
(case when n_tokens > 0 then passes + case when fate = 1 or fate = 2 and used <= room then 1 else 0 end else greatest(passes, 1) end)::bigint as copies from chosen"""

ORACLES = {"op2_quality_rules": OP2, "op6_source_mixing": OP6}

_FLAGS = r"""with raw as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as x from documents),
worded as (select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as w from raw),
masked as (select doc_id, part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x))::int
+ 8 * regexp_matches(x, '[#$%&*|]')::int + 16 * coalesce(doc_id > min(doc_id) over (partition by x), false)::int as mask from worded),
good as (select doc_id, bool_or(coalesce(quality, 0) = 1) as good, bool_or(coalesce(toxic, 0) = 1) as toxic from labels group by 1),
counts as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masked left join good using (doc_id) group by 1, 2),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as b),
o as (select a.l || b.l || c.l || d.l || e.l as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits from f a, f b, f c, f d, f e
where b.l <> a.l and c.l not in (a.l, b.l) and d.l not in (a.l, b.l, c.l) and e.l not in (a.l, b.l, c.l, d.l)),
steps as (select filter_order, s.step::int as step, bits[s.step] as own, coalesce(list_sum(bits[1:s.step - 1]), 0)::int as before from o, range(1, 6) s(step)),
"""

OP13 = _FLAGS + """rows as (select part, filter_order, step, own, (sum(n) filter (mask & (before | own) = 0))::bigint as kept, (sum(n) filter (mask & own > 0 and mask & before = 0))::bigint as removed,
(sum(n) filter (mask & own > 0 and mask & before > 0))::bigint as redundant, (sum(n) filter (mask = own))::bigint as unique_fails,
(sum(good) filter (mask & own > 0 and mask & before = 0))::bigint as good_lost, (sum(toxic) filter (mask & own > 0 and mask & before = 0))::bigint as toxic_lost from counts, steps group by 1, 2, 3, 4)
select part, filter_order, step, coalesce(kept, 0) as kept, coalesce(removed, 0) as removed, coalesce(redundant, 0) as redundant, coalesce(unique_fails, 0) as unique_fails, coalesce(good_lost, 0) as good_lost, coalesce(toxic_lost, 0) as toxic_lost,
coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley from rows"""

ORACLES["op13_filter_interactions"] = OP13

#: CRC-32 of the decimal id, bit by bit: shift, and add the (reversed) polynomial 0xEDB88320 where a one falls out.
_CRC = "xor(list_reduce([ord(c) for c in string_split(conv_id::varchar, '')], lambda crc, byte: list_reduce(range(0, 8), lambda r, k: xor(r >> 1, (r & 1) * 3988292384), xor(crc, byte)), 4294967295), 4294967295)"

OP11 = f"""with turns as (select conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as t, row_number() over (partition by conv_id order by turn nulls first) as k from conversations where conv_id is not null),
own as (select conv_id, list(t order by k) as ts from turns group by 1), cuts as (select conv_id, ts, {_CRC} % 6 as h from own),
rebuilt as (select c.conv_id, list_concat(coalesce(b.ts[1:c.h], []), c.ts[c.h + 1:]) as ts from cuts c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
prefixes as (select conv_id, d, ts[1:d] as p, len(ts) = d as ends from (select conv_id, ts, unnest(range(0, len(ts) + 1)) as d from rebuilt)),
nodes as (select p, d, min(conv_id) as conv_id, count(*) as n, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256, case when d > 0 then p[1:d - 1] end as above,
case when d > 0 then length(p[-1].text) else 0 end as chars from prefixes group by p, d),
kids as (select above as p, count(*) as n_children from nodes where d > 0 group by 1),
whole as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids using (p)),
up as (select p[1:e] as p, (n - 1) * chars as saved, (n_children = 0)::int as leaf from (select *, unnest(range(0, d + 1)) as e from whole)),
below as (select p, sum(saved)::bigint as saved_tokens, sum(leaf)::bigint as n_leaves from up group by 1)
select w.conv_id, w.d::bigint as depth, a.conv_id as parent_conv_id, w.n as n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256 from whole w join below using (p) left join whole a on a.p = w.above"""

ORACLES["op11_conversation_prefix_trie"] = OP11

OP12 = rf"""with recursive worded as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
sets as (select doc_id, case when len(w) > 2 then list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from worded),
tokens as (select doc_id, unnest(s) as t from sets), sizes as (select doc_id, len(s)::bigint as n from sets),
common as (select a.doc_id as x, b.doc_id as y, count(*) as k from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * k >= 90 * (a.n + b.n - k)),
both_ways as (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as y from sizes union select r.x, b.y from reach r join both_ways b on b.x = r.y)
select doc_id, n as n_shingles, (select min(y) from reach where x = doc_id) as component_id from sizes"""

ORACLES["op12_ngram_jaccard_join"] = OP12
