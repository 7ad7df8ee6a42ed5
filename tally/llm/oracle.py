"""DuckDB SQL for the corpus queries that SQL can express.

Written from the contracts, without the operators' methods: plain window
sums, plain grouping by the normalised text, all pairs of query and
candidate.  Queries without SQL here are tested against brute force.
"""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"

OP3 = rf"""
with s as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5(concat_ws(':', 'mix-1', cast(doc_id as varchar), text)) as digest
  from documents),
src as (
  select source, cast(sum(size) as hugeint) as n,
         cast([5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as hugeint) as w,
         row_number() over (order by source nulls last) as turn
  from s group by source),
run as (
  select *, sum(2 * n) over o - 2 * n as cap_before, sum(w) over o - w as w_before,
         sum(w) over () as w_all, sum(n) over () as total
  from src window o as (order by cast(2 * n as double) / w, turn)),
flag as (
  select *, 2 * (2 * n) * (w_all - w_before) <= w * (3 * total - 2 * cap_before) as is_full from run),
lev as (
  select *, coalesce(sum(2 * n) filter (is_full) over (), 0) as cap_full,
         sum(w) filter (not is_full) over () as w_rest from flag),
goal as (
  select source, n, case when is_full then cast(2 * n as double)
    else cast(w as double) * (cast(3 * total - 2 * cap_full as double) / (2.0::double * cast(w_rest as double)))
    end as target from lev),
part as (
  select *, case when n > 0 then floor(target / n) else 0 end as times from goal),
want as (select *, target - times * n as rest from part),
k0 as (select source, rest as missing, '' as upto from want where rest > 0)"""


def _op3() -> str:
    """A first cut and three refills written out, then the nearest fill."""
    steps = [OP3]
    for i in range(4):
        fits = "true" if i == 0 else "s.size <= k.missing"
        steps.append(f"""
r{i} as (
  select s.source, s.digest, k.missing, sum(s.size) over (partition by s.source order by s.digest) as run
  from s join k{i} k on s.source is not distinct from k.source where s.digest > k.upto and {fits}),
e{i} as (select source, max(run) as got, max(digest) as upto from r{i} where run <= missing group by source),
k{i + 1} as (
  select k.source, k.missing - coalesce(e.got, 0) as missing, coalesce(e.upto, k.upto) as upto
  from k{i} k left join e{i} e on e.source is not distinct from k.source)""")
    steps.append("""
fill as (
  select s.source, min(struct_pack(a := abs(s.size - k.missing), b := s.digest)).b as digest
  from s join k4 k on s.source is not distinct from k.source
  where s.digest > k.upto and abs(s.size - k.missing) < k.missing group by s.source),
more as (""" + " union ".join(f"select source, digest from r{i} where run <= missing" for i in range(4))
                 + " union select source, digest from fill)")
    return ",".join(steps) + """
select s.doc_id, cast(s.size as bigint) as size, cast(w.n as bigint) as source_size, w.target,
       cast(s.size * least(2, w.times + if(m.digest is null, 0, 1)) as bigint) as taken
from s join want w on s.source is not distinct from w.source
left join more m on m.digest = s.digest and m.source is not distinct from s.source
"""


OP4 = r"""
with c as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first,
                            text nulls first) as n from c),
e as (
  select *, length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '<(?:<SYS>>|</SYS>>|/?s>)|\[(?:/?INST\]|/?ROLE\]|TEXT\])')) as body,
    length(role) + length(role) - length(replace(role, '\', ''))
    + len(regexp_extract_all(role, '<(?:<SYS>>|</SYS>>|/?s>)|\[(?:/?INST\]|/?ROLE\]|TEXT\])')) as name
  from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(body + case role when 'system' then length('<<SYS>>  <</SYS>>') + 1
                when 'user' then length('[INST]  [/INST]') + 1
                when 'assistant' then length('<s>  </s>') + 1
                else name + length('[ROLE]  [TEXT]  [/ROLE]') + 1 end) as bigint) as formatted_chars
from e group by conv_id
"""

OP8 = rf"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') as norm from documents),
r as (
  select doc_id, norm, count(*) over (partition by norm) as n,
         row_number() over (partition by norm order by chars desc, doc_id nulls last) as place,
         first_value(doc_id) over (partition by norm order by chars desc, doc_id nulls last) as keep_id
  from d)
select doc_id, keep_id, n as group_size, place = 1 as kept, sha256(norm) as text_sha256 from r
"""

OP10 = r"""
with u as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
h as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from u),
k(rule_host, rule_path, rule_verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f as (
  select h.page_id, h.host, h.path, k.*,
         row_number() over (partition by h.page_id, h.host, h.path
                            order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from (select distinct page_id, host, path from h) h
  join k on (h.host = rule_host or ends_with(h.host, '.' || rule_host)) and starts_with(h.path, rule_path))
select h.page_id, h.host, h.path, f.rule_host || f.rule_path as rule,
       coalesce(f.rule_verdict, 'allow') as verdict
from h left join f on f.place = 1 and f.page_id is not distinct from h.page_id
  and f.host = h.host and f.path = h.path
"""


OP6 = r"""
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.w) + 1),
         lambda i: q.w[i] * c.w[i])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.w) = len(c.w) where q.vec_id % 100 = 0),
r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""

OP9 = r"""
with recursive k as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
t as (
  select array_to_string(w, ' ') as key, any_value(w) as w, count(*) as n, min(doc_id) as id
  from k where len(w) > 0 group by 1),
g as (
  select distinct id, unnest(case when len(w) < 5 then [key] else list_transform(range(1, len(w) - 3),
         lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle from t),
z as (select id, count(*) as size from g group by id),
p as (
  select a.id as a, b.id as b, count(*) as same from g a join g b on a.shingle = b.shingle and a.id <> b.id
  group by 1, 2),
l as (
  select p.a, p.b from p join z x on x.id = p.a join z y on y.id = p.b
  where 5 * same >= 4 * (x.size + y.size - same)),
reach(a, b) as (
  select id, id from t union select r.a, l.b from reach r join l on l.a = r.b),
c as (select a, min(b) as class_id from reach group by a),
m as (select l.a, sum(t.n) as n from l join t on t.id = l.b group by l.a)
select k.doc_id, coalesce(c.class_id, k.doc_id) as class_id,
       cast(case when t.id is null then 0 else t.n - 1 + coalesce(m.n, 0) end as bigint) as n_links
from k left join t on t.key = array_to_string(k.w, ' ') and len(k.w) > 0
left join c on c.a = t.id left join m on m.a = t.id
"""


def _op2() -> str:
    """Every run of a template's number of words, without anchors or stretches."""
    from .license_scan import TEMPLATES, THRESHOLD, bigram_set, plain_words
    rows = ", ".join(f"({i}, '{name}', {len(plain_words(text)) - 1}, ['" + "', '".join(bigram_set(plain_words(text))) + "'])"
                     for i, (name, text) in enumerate(TEMPLATES))
    return rf"""
with w as (
  select row_number() over () as r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') as w
  from documents),
g as (
  select r, doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as g from w),
l(n, name, places, b) as (values {rows}),
c as (
  select r, n, count(distinct gram) as same from (select r, unnest(g) as gram from g) x
  join (select n, unnest(b) as gram from l) y using (gram) group by r, n),
k as (
  select r, n, name, b, g, least(places, len(g)) as long from c join l using (n) join g using (r)
  where 2.0::double * same / (same + len(b)) >= {THRESHOLD}),
s as (
  select r, n, name, pos, pos + long as after, g[pos:pos + long - 1] as run, b
  from (select *, unnest(range(1, len(g) - long + 2)) as pos from k)),
d as (
  select r, n, name, pos, after, 2.0::double * len(list_intersect(run, b)) / (len(list_distinct(run)) + len(b)) as dice from s),
h as (
  select * from d where dice >= {THRESHOLD} qualify row_number() over (partition by r, n order by dice desc, pos) = 1),
m as (
  select * from h where not exists (
    select 1 from h o where o.r = h.r and o.name <> h.name and o.pos < h.after and h.pos < o.after
      and (o.dice > h.dice or (o.dice = h.dice and o.name < h.name)))),
z as (select r, first(name order by dice desc, name) as license, max(dice) as dice,
             string_agg(distinct name, ',' order by name) as licenses from m group by r)
select doc_id, license, dice, coalesce(licenses, '') as licenses from w left join z using (r)
"""


OP11 = r"""
with recursive d as (
  select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by text) as first from d),
f as (
  select doc_id, part, len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) as c,
         regexp_matches(text, '[#$%&*|]') as d, coalesce(doc_id > first, false) as e from w),
m as (
  select part, [a, b, c, d, e] as fails, coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good,
         coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic, count(*) as n
  from f group by all),
o(filter_order) as (
  select '' union all
  select filter_order || l from o, (values ('A'), ('B'), ('C'), ('D'), ('E')) t(l)
  where strpos(filter_order, l) = 0 and length(filter_order) < 5),
s as (
  select part, filter_order, step, substr(filter_order, step, 1) as letter, good, toxic, n,
         fails[strpos('ABCDE', substr(filter_order, step, 1))] as failing, len(list_filter(fails, lambda x: x)) as n_fails,
         len(list_filter(range(1, step), lambda i: fails[strpos('ABCDE', substr(filter_order, i, 1))])) as earlier
  from m, o, range(1, 6) t(step) where length(filter_order) = 5),
g as (
  select part, filter_order, cast(step as integer) as step, letter,
         cast(sum(if(earlier = 0 and not failing, n, 0)) as bigint) as kept,
         cast(sum(if(earlier = 0 and failing, n, 0)) as bigint) as removed,
         cast(sum(if(earlier > 0 and failing, n, 0)) as bigint) as redundant,
         cast(sum(if(failing and n_fails = 1, n, 0)) as bigint) as unique_fails,
         cast(sum(if(earlier = 0 and failing and good, n, 0)) as bigint) as good_lost,
         cast(sum(if(earlier = 0 and failing and toxic, n, 0)) as bigint) as toxic_lost
  from s group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from g
"""

_OP13_KEPT = r"""
k as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as w
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(embedding) > 0 and len(embedding) % 4 = 0),
v as (
  select *, row_number() over (order by vec_id nulls last, w) as r from k
  where len(w) = (select len(w) from k group by 1 order by count(*) desc, 1 desc limit 1)),
x as (select r, p, w[p * len(w) // 4 + 1:(p + 1) * len(w) // 4] as x from v, range(4) t(p)),
c0 as (select p, r - 1 as e, x as c from x where r <= 256)"""


def _op13() -> str:
    """Four rounds written out: nearest entries, then floors of the means."""
    steps = [_OP13_KEPT]
    for i in range(5):
        steps.append(f"""
a{i} as (
  select r, p, min(struct_pack(d := list_sum(list_transform(range(1, len(x) + 1),
         lambda i: (x[i] - c[i]) * (x[i] - c[i]))), e := e)) as m from x join c{i} using (p) group by r, p)""")
        if i < 4:
            steps.append(f"""
u{i} as (
  select p, e, pos, sum(val) as s, cast(count(*) as hugeint) as n from (
    select p, m.e as e, unnest(x) as val, unnest(range(len(x))) as pos from a{i} join x using (r, p)) group by all),
n{i} as (
  select p, e, list(cast((s - (s % n + n) % n) // n as bigint) order by pos) as c from u{i} group by p, e),
c{i + 1} as (select p, e, coalesce(n.c, o.c) as c from c{i} o left join n{i} n using (p, e))""")
    return "with " + ",".join(steps).strip() + r""",
h as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from c4),
g as (
  select vec_id, label, string_agg(format('{:02x}', m.e), '' order by p) as code, cast(sum(m.d) as bigint) as error
  from a4 join v using (r) group by r, vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from g, h
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": _op2(), "op3_source_mix": _op3(), "op4_chat_format": OP4, "op6_topk_search": OP6,
            "op8_exact_dedup": OP8, "op9_jaccard_join": OP9,
            "op10_url_filter": OP10, "op11_filter_audit": OP11, "op13_vector_codes": _op13()}
