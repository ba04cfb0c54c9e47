"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from recordferry.llm import urls

WORDS = r"'[^\x20\x09-\x0D]+'"

OP4 = rf"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '') || '/mix') as mark
  from documents),
s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by encode(source) nulls last) - 1 as place
  from d group by source),
w as (select source, source_size, place % 3 + 1 as weight, 3.0::double * source_size / (place % 3 + 1) as ceiling from s),
ordered as (
  select a.*, coalesce(sum(b.source_size) filter (where b.ceiling < a.ceiling), 0) as below_size,
         coalesce(sum(b.weight) filter (where b.ceiling < a.ceiling), 0) as below_weight,
         sum(b.source_size) as total, sum(b.weight) as all_weight
  from w a cross join w b group by all),
level as (
  select arg_min((total - 3 * below_size)::double / (all_weight - below_weight)::double, ceiling) filter (
    where (total - 3 * below_size)::double / (all_weight - below_weight)::double <= ceiling) as level from ordered),
goal as (
  select source, source_size, least(coalesce(level, 0) * weight, (3 * source_size)::double) as target,
         case when source_size > 0 then least(coalesce(level, 0) * weight, (3 * source_size)::double) / source_size else 0 end as rate
  from w, level),
r as (
  select d.*, source_size, target, rate, row_number() over (partition by d.source order by mark, doc_id nulls first, size) - 1 as rank
  from d join goal g on d.source is not distinct from g.source),
t as (
  select source, target, try, off, sum(least(floor((rank + 1) * rate + off) - floor(rank * rate + off), 3)::bigint * size) as taken
  from (select r.*, try, ('0x' || substr(md5(coalesce(source, '') || '/mix/' || try::varchar), 1, 8))::bigint::double
                         / 4294967296.0::double as off from r cross join range(32) k(try)) group by all),
b as (select source, arg_min(off, struct_pack(e := abs(taken - round(target)::bigint), t := try)) as off from t group by source)
select doc_id, size, source_size, target,
       least(floor((rank + 1) * rate + off) - floor(rank * rate + off), 3)::bigint * size as taken
from r join b on r.source is not distinct from b.source
"""

OP5 = rf"""
with w as (select doc_id, text, regexp_extract_all(coalesce(text, ''), {WORDS}) as words from documents),
lines as (select doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {WORDS})) as ls from w),
tri as (
  select doc_id, unnest(range(1, len(words) - 1)) as pos, words from w where len(words) > 2),
g as (select doc_id, pos, count(*) over (partition by doc_id, words[pos], words[pos + 1], words[pos + 2]) as n from tri),
rep as (
  select doc_id, count(distinct pos + k) as n_repeat from g cross join range(3) r(k) where n > 1 group by doc_id),
m as (
  select w.doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat, 0)::bigint as n_repeat_words,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Z]', '', 'g')))::bigint as n_upper,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Za-z]', '', 'g')))::bigint as n_letters
  from w join lines using (doc_id) left join rep using (doc_id)),
f as (
  select *, ((n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint + 4 * (5 * n_symbols > n_words)::bigint
    + 8 * (2 * n_dup_lines > n_lines)::bigint + 16 * (2 * n_upper > n_letters)::bigint
    + 32 * (word_chars < 2 * n_words or word_chars > 15 * n_words)::bigint)::bigint as failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed, failed & 31 = 0 as kept, failed
from f
"""

def _strength(table: str, bad: str, n: str, parent: str) -> str:
    """The strength of a level's beta prior, by the method of moments, between 0.5 and 1000."""
    noise = f"{parent} * (1 - {parent})"
    return f"""(select case when excess <= 0 or room <= 0 then 1000.0 else least(greatest(room / excess - 1, 0.5), 1000.0) end from (
  select coalesce(sum({n} * ({bad}::double / {n} - {parent}) * ({bad}::double / {n} - {parent})), 0) - coalesce(sum({noise}), 0) as excess,
         coalesce(sum(({n} - 1) * {noise}), 0) as room from {table} where {n} > 0))"""


def _fits(rule: str) -> str:
    on, _, under = rule.partition("/")
    return f"(host = '{on}' or ends_with(host, '.{on}')) and starts_with(path, '/{under}')"


_RULES = sorted(urls.RULES, key=lambda r: -len(r[0]))
_CAPITALS = urls.CAPITALS
OP8 = rf"""
with u as (
  select page_id, instr(url, '://') > 0 as whole, substr(url, instr(url, '://') + 3) as rest from pages),
p as (
  select page_id, case when whole then translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_CAPITALS}', '{_CAPITALS.lower()}') else '' end as host,
         case when whole then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path from u),
o as (
  select doc_id as page_id, max(((quality = 0) or (toxic = 1))::int) as bad from labels
  where doc_id is not null and ((quality = 0) or (toxic = 1)) is not null group by doc_id),
h as (
  select host, coalesce(sum(bad), 0)::bigint as bad, count(bad) as n, regexp_replace(host, ':[0-9]*$', '') as bare
  from p left join o using (page_id) group by host),
l as (
  select host, bad, n, bare, regexp_matches(bare, '^([0-9]+(\.[0-9]+){{3}}|\[.*\])$') as address,
         array_to_string(string_split(bare, '.')[-2:], '.') as two, array_to_string(string_split(bare, '.')[-3:], '.') as three,
         string_split(bare, '.')[-1] as one from h),
named as (
  select host, bad, n, case when address then 'address' when two in {urls.SUFFIXES} then two else one end as suffix,
         case when address then bare when two in {urls.SUFFIXES} then three else two end as domain from l),
d as (select domain, suffix, sum(bad) as d_bad, sum(n) as d_n from named group by all),
s as (
  select suffix, sum(d_bad) as s_bad, sum(d_n) as s_n,
         (select case when sum(n) > 0 then (sum(bad) + 0.5) / (sum(n) + 1.0) else 0 end from named)::double as all_mean from d group by suffix),
sm as (select suffix, (s_bad + k * all_mean) / (s_n + k) as s_mean from s, (select {_strength('s', 's_bad', 's_n', 'all_mean')} as k)),
ds as (select d.*, s_mean from d join sm using (suffix)),
dm as (select domain, (d_bad + k * s_mean) / (d_n + k) as d_mean from ds, (select {_strength('ds', 'd_bad', 'd_n', 's_mean')} as k)),
hd as (select named.*, d_mean from named join dm using (domain)),
ab as (select host, k * d_mean + bad as a, k * (1 - d_mean) + n - bad as b from hd, (select {_strength('hd', 'bad', 'n', 'd_mean')} as k)),
low as (select host, a / (a + b) - {urls.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as low from ab),
r as (select page_id, host, path, case {" ".join(f"when {_fits(rule)} then '{rule}'" for rule, _ in _RULES)} end as rule from p)
select page_id, host, path, rule,
       case {" ".join(f"when rule = '{rule}' then '{says}'" for rule, says in _RULES)} when low > {urls.LIMIT} then 'block' else 'allow' end as verdict
from r join low using (host)
"""

OP9 = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '|', '&bar;') as safe_role,
         replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '|', '&bar;') as safe,
         lag(role) over (partition by conv_id order by turn nulls first, role, text) as before,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from t),
p as (
  select *, case when before = role then '<+>' else (case when pos = 1 then '' else '<|end|>' end) || '<|' || safe_role || '|>' end || safe as piece from e)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       length(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), ''))::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
       (length(string_agg(piece, '' order by pos)) + 7)::bigint as formatted_chars
from p group by conv_id
"""

OP11 = r"""
with e as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank,
       s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""

# crc32 of the decimal digits: for each byte one exclusive or, then eight steps of a shift register
OP12 = r"""
with t as (
  select conv_id::bigint as conv_id, row_number() over (partition by conv_id order by turn nulls first, mark) as pos, mark, bytes
  from (select conv_id, turn, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as mark,
               strlen(coalesce(text, ''))::bigint as bytes from conversations where conv_id is not null)),
c as (
  select conv_id, conv_id - conv_id % 5 as family,
         xor(list_reduce(flatten(list_transform(string_split(conv_id::varchar, ''), lambda ch:
               list_concat([ascii(ch)::bigint], list_transform(range(8), lambda i: -1::bigint)))),
             lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384::bigint * (a & 1)) end,
             4294967295::bigint), 4294967295::bigint) % 9 as head
  from (select distinct conv_id from t)),
r as (
  select c.conv_id, 0 as part, pos, mark, bytes from c join t on t.conv_id = c.family and pos <= head
  union all select c.conv_id, 1, pos, mark, bytes from c join t on t.conv_id = c.conv_id and pos > head),
o as (select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, mark, bytes from r),
p as (select conv_id, depth, bytes, string_agg(mark, '/') over (partition by conv_id order by depth) as key from o),
m as (
  select conv_id, 0::bigint as depth, 0::bigint as bytes, '' as key, null::varchar as parent from c
  union all select conv_id, depth, bytes, key, coalesce(lag(key) over (partition by conv_id order by depth), '') from p),
ended as (
  select key, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(key, depth) as key from m group by conv_id) group by key),
n as (select key, min(conv_id) as conv_id, any_value(depth) as depth, any_value(parent) as parent, any_value(bytes) as bytes, count(*) as n_convs
      from m group by key),
k as (select parent as key, count(*) as n_children from n where parent is not null group by parent),
s as (
  select m.key, sum((u.n_convs - 1) * u.bytes)::bigint as saved_tokens, count(*) filter (where k.key is null) as n_leaves
  from n u left join k on k.key = u.key join m on m.conv_id = u.conv_id and m.depth <= u.depth group by m.key)
select n.conv_id, n.depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(ended.ids, '')) as ends_sha256
from n join s on s.key = n.key left join k on k.key = n.key left join ended on ended.key = n.key left join n up on up.key = n.parent
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": OP4, "op5_rules": OP5, "op8_urls": OP8, "op9_chat": OP9, "op11_negatives": OP11, "op12_trie": OP12}
