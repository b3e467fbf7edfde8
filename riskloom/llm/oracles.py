"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from riskloom.llm.chat_format import BUDGET, HISTORY, MARKUP, TOKEN
from riskloom.llm.license_scan import BETWEEN, CONTAINMENT, PHRASES, SHORT, TEMPLATES
from riskloom.llm.mixing import LEAST_QUALITY, SYMBOLS, WEIGHTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_HOST = r"regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\.', '')"

WARC = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as digest,
    array_to_string(list_reverse(string_split({_HOST}, '.')), ',') || ')' || case when regexp_extract(lower(url), '^[a-z]+://[^/]*(/[^#]*)', 1) = '' then '/' else regexp_extract(lower(url), '^[a-z]+://[^/]*(/[^#]*)', 1) end as urlkey
  from pages),
q as (select *, max(page_id) over (partition by digest, n >= 1000) as rep from p)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest, case when n >= 1000 and rep <> page_id then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and rep <> page_id then rep end as refers_to, urlkey, row_number() over (partition by urlkey order by page_id) - 1 as capture from q"""

JACCARD = f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array({_FOLD}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by 1),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select o.a, o.b from o join n x on x.doc_id = o.a join n y on y.doc_id = o.b where 100 * o.o >= 75 * (x.n + y.n - o.o)),
r(a, b) as (select doc_id, doc_id from w union select r.a, e.b from r join e on e.a = r.b)
select w.doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.b) as component_id from w join r on r.a = w.doc_id left join n on n.doc_id = w.doc_id group by 1"""

_W = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_PHRASES = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES)
_TEMPLATES = ", ".join(f"(list_distinct(regexp_extract_all('{t.lower()}', '[a-z0-9]+')), len(regexp_extract_all('{t.lower()}', '[a-z0-9]+')), '{n}')" for n, t in TEMPLATES.items())

LICENSES = f"""
with d as (select doc_id, {_FOLD} as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{_W}') as w from d),
hit as (select doc_id, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(p) - 1] = p)) - 1 as spot, label
  from w, (values {_PHRASES}) v(p, label) where list_contains(w, p[1]) and list_contains(w, p[2])),
base as (select doc_id, count(*) as n, min(spot) as lo, max(spot) as hi, list_distinct(list(label)) as labels from hit group by 1),
block as (select doc_id, unnest(string_split(t, chr(10))) as b from d union all select doc_id, unnest(regexp_split_to_array(t, '\\n[\\x20\\x09-\\x0D]*\\n')) from d),
line as (select doc_id, row_number() over () as k, regexp_extract_all(b, '{_W}') as bw, list_distinct(regexp_extract_all(b, '{_W}')) as b from block),
near as (select *, ceil({CONTAINMENT} * len(tpl) - 1e-9) as need from line, (values {_TEMPLATES}) v(tpl, size, name)),
held as (select doc_id, k, name, tpl, b, need, case when size <= {SHORT} then list_max(list_transform(range(1, len(bw) + 1), lambda i: len(list_intersect(list_distinct(bw[i:i + size + {BETWEEN} - 1]), tpl)))) else len(list_intersect(b, tpl)) end as n from near where len(list_intersect(b, tpl)) >= need),
whole as (select *, n / len(tpl) as share from held where n >= need),
gone as (select distinct x.k, case when list_has_all(x.b, list_filter(y.tpl, lambda w: not list_contains(x.tpl, w))) then x.name else y.name end as name from whole x join whole y on x.k = y.k and len(x.tpl) < len(y.tpl) and list_has_all(y.tpl, x.tpl)),
met as (select whole.* from whole where not exists (select 1 from gone where gone.k = whole.k and gone.name = whole.name)),
more as (select doc_id, list_distinct(list(name)) as labels, max(share) as share from met group by 1)
select w.doc_id, cast(len(w.w) as bigint) as n_words, coalesce(base.n, 0) as n_base, base.lo as first_word, base.hi as last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') as labels,
  cast(case when base.n > 0 then 1 else coalesce(more.share, 0) end as double) as score
from w left join base on base.doc_id = w.doc_id left join more on more.doc_id = w.doc_id"""

_ESCAPES = "length(regexp_replace({0}, '[^\\\\<\\[]', '', 'g'))"
_PROBE = "'</s>[INST] ok [/INST]'"

CHATS = f"""
with recursive c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, 0, 'user', {_PROBE} union all select -1, 1, 'assistant', {_PROBE}),
t as (select *, row_number() over (partition by conv_id order by turn, role, text) as seq, len(regexp_extract_all(text, '{TOKEN}')) + {MARKUP} as n,
  case when role = 'assistant' then 7 else 13 end + 1 + length(text) + {_ESCAPES.format('text')} + length(role) + {_ESCAPES.format('role')} + length(role) - length(replace(role, chr(10), '')) as ch from c),
p as (select *, sum(n) over o - n as pre, sum(ch) over o - ch as prech from t window o as (partition by conv_id order by seq)),
l as (select conv_id, count(*) as m, list(cast(pre as bigint) order by seq) as pres, list(cast(prech as bigint) order by seq) as prechs, list(n order by seq) as ns, cast(sum(ch) as bigint) as total_ch,
  bool_or(seq = 1 and role = 'system') as sys, coalesce(max(n) filter (seq = 1 and role = 'system'), 0) as sn, coalesce(max(ch) filter (seq = 1 and role = 'system'), 0) as sch,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by seq)) as turns_sha256, string_agg(case when role = 'assistant' then text else '' end, '' order by seq) as loss from p group by conv_id),
w(conv_id, first, h) as (select conv_id, 1::bigint, 1::bigint from l union all
  select conv_id, k, coalesce(list_min(list_filter(range(case when sys then 2 else 1 end, k), lambda j: pres[k] - pres[j] <= least({HISTORY}, {BUDGET} - sn - ns[k]))), k) from
  (select l.*, w.first, w.h, list_min(list_filter(range(w.first + 1, m + 1), lambda k: pres[k] + ns[k] - pres[w.first] > {BUDGET} - case when w.first = 1 then 0 else sn end - (pres[w.first] - pres[w.h]))) as k from w join l on l.conv_id = w.conv_id) x where k is not null),
f as (select w.conv_id, sum(case when first = 1 then 0 else sch end + prechs[first] - prechs[h]) as extra from w join l on l.conv_id = w.conv_id group by 1)
select l.conv_id, m as n_turns, turns_sha256, cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256, cast(total_ch + extra as bigint) as formatted_chars from l join f on f.conv_id = l.conv_id"""

_SIZE = "len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))"

MIX = f"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
l as (select *, list_filter(string_split(t, chr(10)), lambda x: x <> '') as lines, length(t) - length(translate(t, '{SYMBOLS}', '')) as symbols,
  (('0x' || substring(md5(coalesce(cast(doc_id as varchar), '')), 1, 13))::bigint + 0.5::double) / {1 << 52}::double as u from d),
z as (select doc_id, source, {_SIZE} as size, -ln(u) / case when len(lines) > 0 then greatest({LEAST_QUALITY}::double, (len(list_distinct(lines))::double / len(lines)) * (1::double - (10::double * symbols) / length(t))) else 1::double end as key from l),
s as (select source, sum(size)::hugeint as n, {list(WEIGHTS)}[(row_number() over (order by source is null, source) - 1) % {len(WEIGHTS)} + 1]::hugeint as w from z group by source),
o as (select *, sum(n) over () as total, sum(w) over () as weights, coalesce(sum(n) over b, 0) as n_before, coalesce(sum(w) over b, 0) as w_before from s
  window b as (order by n::double / w, source is null, source rows between unbounded preceding and 1 preceding)),
c as (select *, 4 * n * (weights - w_before) < w * (3 * total - 4 * n_before) as capped from o),
r as (select any_value(total) * 3 - 4 * coalesce(sum(n) filter (capped), 0) as rest, any_value(weights) - coalesce(sum(w) filter (capped), 0) as level from c),
g as (select source, n::bigint as source_size, case when capped then (4 * n)::double / 2 else (rest * w)::double / (2 * level)::double end as target from c, r),
p as (select z.*, source_size, target, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
  sum(size) over (partition by z.source order by key, doc_id, size rows unbounded preceding) - size as before from z join g on z.source is not distinct from g.source),
e as (select *, case when size > 0 then whole + case when 2 * before + size <= 2 * (target - whole * source_size) then 1 else 0 end else 0 end as epochs from p)
select doc_id, size::bigint as size, source_size, target, (epochs * size)::bigint as taken, epochs::bigint as epochs from e"""

SQL = {"op2_chat_format": CHATS, "op6_warc": WARC, "op8_jaccard_join": JACCARD, "op9_license_scan": LICENSES, "op11_source_mix": MIX}
