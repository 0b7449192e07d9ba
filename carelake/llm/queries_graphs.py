"""Queries over a whole table at once: the divergence audit, the url filter and the manifest."""

from __future__ import annotations

from carelake.llm import divergence, merkle, url_filter
from carelake.llm.registry import query, table

OP11_SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
c as (select lang, source, term, count(*) as n from w group by all),
k as (select lang, term, count(*) as n from w group by lang, term having count(distinct r) >= 30),
g as (select distinct lang, source from d),
v as (select g.lang, count(k.term) as terms, coalesce(sum(k.n), 0) as n from (select distinct lang from g) g left join k using (lang) group by g.lang),
t as (select g.lang, g.source, v.terms, v.n as lang_n, coalesce((select sum(c.n) from c join k using (lang, term)
    where c.lang = g.lang and c.source = g.source), 0) as n from g join v on g.lang = v.lang),
m as (select t.lang, t.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (t.n + 5 * t.terms) as p, 1 + 1000000000::hugeint * (k.n + 5) // (t.lang_n + 5 * t.terms) as q
  from t join k on t.lang = k.lang left join c on c.lang = t.lang and c.source = t.source and c.term = k.term),
s as (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from m x join m y on x.lang = y.lang and x.term = y.term
    and x.source <> y.source group by all),
f as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
    left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all select lang, source, 'term', term, p - q from m where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from (select *, row_number() over (
  partition by lang, source, part order by value desc, item) as rank from f) where part = 'pair' or rank <= 50
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
with recursive u as (select page_id, html, case when strpos(url, '://') > 0 then
    split_part(split_part(substr(url, strpos(url, '://') + 3), '#', 1), '?', 1) else '' end as rest from pages),
h as (select page_id, html, split_part(rest, '/', 1) as name, rest from u),
p as (select page_id, html, translate(name, '{url_filter.CAPITALS}', '{url_filter.SMALL}') as host, substr(rest, length(name) + 1) as path from h),
r as (select *, case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'allow www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'block example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'block net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'block net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'allow com/' end as hit from p),
e as (select distinct host as a, b from (select host, translate(unnest(regexp_extract_all(html,
    '{url_filter.LINK.replace("'", "''")}', 1)), '{url_filter.CAPITALS}', '{url_filter.SMALL}') as b from p) where host <> '' and b <> '' and host <> b),
k as (select 'trust' as kind, a as f, b as t from e union all select 'distrust', b, a from e),
w as (select *, count(*) over (partition by kind, f) as fan from k),
s as (select host, {url_filter.UNIT} * count(*) filter (where starts_with(hit, 'allow')) // count(*) as trust,
    {url_filter.UNIT} * count(*) filter (where starts_with(hit, 'block')) // count(*) as distrust from r where host <> '' group by host),
m as (select 0 as round, 'trust' as kind, host, cast(trust as bigint) as mass from s union all select 0, 'distrust', host, cast(distrust as bigint) from s
  union all select round + 1, w.kind, w.t, cast(sum(mass * {url_filter.DAMPING} // (100 * fan)) as bigint) from m join w on m.kind = w.kind and m.host = w.f
  where round < {url_filter.ROUNDS} and mass > 0 group by round, w.kind, w.t),
b as (select host from m group by host having coalesce(sum(mass) filter (where kind = 'distrust'), 0) * 100 > {url_filter.THRESHOLD * url_filter.UNIT}
    and coalesce(sum(mass) filter (where kind = 'distrust'), 0) > coalesce(sum(mass) filter (where kind = 'trust'), 0))
select page_id, host, path, substr(hit, 7) as rule,
  case when hit is not null then substr(hit, 1, 5) when host in (select host from b) then 'block' else 'allow' end as verdict
from r
"""


@query("op12_url_filter", OP12_SQL)
def op12(spark, sf_dir):
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


OP13_SQL = """
with recursive d as (select doc_id, coalesce('=' || lang, '-') as key, text,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
    list_reduce([ord(x) for x in string_split(cast(doc_id as varchar), '')], lambda c, b: xor(c >> 8, list_reduce(range(8),
      lambda t, i: case when t & 1 = 1 then xor(t >> 1, 3988292384) else t >> 1 end, xor(c, b) & 255)), 4294967295) as crc
  from documents),
l as (select doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(text) || ':' || case when xor(crc, 4294967295) % 3 = 0 then
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as changed from d),
p as (select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by key) as n from l),
u as (select 0 as level, key, pos, n, leaf as digest from p
  union all select level + 1, key, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by pos)) from u
  where n > 1 group by level, key, pos // 8, n),
h as (select 0 as level, row_number() over (order by key) - 1 as pos, count(*) over () as n, digest from u where n = 1
  union all select level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by pos)) from h
  where n > 1 group by level, pos // 8, n),
t as (select level, key, pos, n, digest from u union all select level, '*', pos, n, digest from h),
s as (select a.level, a.key, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as before,
    coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as after
  from t a join t b on a.level = b.level and a.key = b.key and a.pos // 8 = b.pos // 8 where a.n > 1 group by a.level, a.key, a.pos),
f as (select 0 as level, key, pos as leaf_pos, pos, changed as acc, '' as proof from p
  union all select f.level + 1, key, leaf_pos, pos // 8, sha256(before || acc || after), proof || before || after
  from f join s using (level, key, pos)),
g as (select key, leaf_pos, acc, proof from (select *, max(level) over (partition by key, leaf_pos) as last from f) where level = last),
k as (select key, digest, row_number() over (order by key) - 1 as pos from u where n = 1),
e as (select 0 as level, g.key, leaf_pos, k.pos, acc, proof from g join k using (key)
  union all select e.level + 1, e.key, leaf_pos, e.pos // 8, sha256(before || acc || after), proof || before || after
  from e join s on s.key = '*' and s.level = e.level and s.pos = e.pos),
x as (select key, leaf_pos, acc, proof from (select *, max(level) over (partition by key, leaf_pos) as last from e) where level = last)
select p.doc_id, p.leaf, k.digest as subroot, r.digest as root, sha256(x.proof) as proof_sha256, x.acc as folded_root,
  x.acc = r.digest as verified
from p join x on p.key = x.key and p.pos = x.leaf_pos join k on p.key = k.key, (select digest from h where n = 1) r
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
