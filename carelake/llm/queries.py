"""One query per operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from carelake.llm import fingerprints, mixing, packing, page_text, parity_join, quality_rules, substring_dedup, suffix_dedup, token_frames, warc
from carelake.llm.registry import query, table

OP1_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as payload_bytes, sha1(html) as hex from p),
h as (select *, max(page_id) over (partition by hex) as head from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     1 + cast((cast('0x' || substr(hex, 1 + 10 * g, 10) as bigint) >> (35 - 5 * i)) & 31 as integer), 1), '' order by g, i)
   from range(4) a(g), range(8) b(i)) as payload_digest,
  case when page_id = head then 'response' else 'revisit' end as record_type,
  case when page_id <> head then head end as refers_to
from h
"""


@query("op1_warc", OP1_SQL)
def op1(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op2_token_frames")
def op2(spark, sf_dir):
    return token_frames.token_index(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_page_text")
def op3(spark, sf_dir):
    return page_text.main_text(table(spark, sf_dir, "pages"))


OP4_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix|' || coalesce(cast(doc_id as varchar), '')) as shuffle from documents),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank
  from d group by source),
w as (select *, (rank - 1) % 3 + 1 as weight, source_size * 3 as lim from s),
a as (select *, (select sum(source_size) from w) - coalesce(sum(lim) over ahead, 0) as left_size,
    (select sum(weight) from w) - coalesce(sum(weight) over ahead, 0) as left_weight from w
  window ahead as (order by lim / weight, rank rows between unbounded preceding and 1 preceding)),
f as (select *, left_size * weight > lim * left_weight as stops from a),
t as (select source, rank, source_size, case when stops then cast(lim as double) else
    cast(((select sum(source_size) from f) - (select coalesce(sum(lim), 0) from f where stops)) * weight as double)
    / cast((select sum(weight) from f where not stops) as double) end as target from f),
c as (select d.doc_id, d.size, t.rank, t.source_size, t.target,
    sum(d.size) over (partition by t.rank order by d.shuffle, d.doc_id rows unbounded preceding) as upto
  from d join t on d.source is not distinct from t.source),
i as (select doc_id, size, rank, e, cast(e * source_size + upto as double) / target as finish, upto
  from c, range(3) r(e) where size > 0 and e < ceil(target / source_size)),
q as (select *, sum(size) over (order by finish, rank, e, upto rows unbounded preceding) as run from i)
select c.doc_id, cast(c.size as bigint) as size, cast(c.source_size as bigint) as source_size, c.target,
  cast(coalesce(k.taken, 0) as bigint) as taken
from c left join (select doc_id, sum(size) as taken from q where run <= (select sum(size) from d) group by doc_id) k
  using (doc_id)
"""


@query("op4_mixing", OP4_SQL)
def op4(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_suffix_dedup")
def op5(spark, sf_dir):
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_packing")
def op6(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP7_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
g as (select doc_id, unnest(range(1, len(words) - 48)) as pos, words from d),
h as (select doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) as hash from g),
r as (select * from (select doc_id, pos, min(doc_id) over (partition by hash) as least from h) where doc_id > least),
c as (select distinct doc_id, unnest(range(pos, pos + 50)) as word from r),
l as (select doc_id, list(word) as gone from c group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(array_to_string(case when gone is null then words else
    list_filter(words, lambda w, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from d left join l using (doc_id)
"""


@query("op7_substring_dedup", OP7_SQL)
def op7(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP8_SQL = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from d),
g as (select doc_id, unnest(range(1, len(words) - 6)) as pos, words from w),
h as (select doc_id, pos, md5(array_to_string(words[pos:pos + 7], ' ')) as hash from g),
r as (select doc_id, pos, lead(pos) over (partition by doc_id order by pos) as after from
  (select *, count(*) over (partition by doc_id, hash) as n from h) where n > 1),
c as (select doc_id, sum(least(8, coalesce(after - pos, 8))) as n_repeat_words from r group by doc_id),
m as (select w.doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(c.n_repeat_words, 0) as bigint) as n_repeat_words,
    len(lines) as n_lines, len(list_filter(words, lambda x: lower(x) in ({", ".join(f"'{x}'" for x in quality_rules.STOP_WORDS)}))) as n_stop
  from w left join c using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * word_chars >= 200 * n_words and 100 * word_chars <= 2000 * n_words
  and 100 * n_symbols <= 20 * n_words and 100 * (n_stop + 3) >= 3 * n_words and 100 * n_dup_lines <= 50 * n_lines as kept
from b
"""


@query("op8_quality_rules", OP8_SQL)
def op8(spark, sf_dir):
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query("op9_fingerprints")
def op9(spark, sf_dir):
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
g as (select distinct doc_id, array_to_string(words[pos:pos + 3], ' ') as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) as pos from d where len(words) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
s as (select doc_id, g.shingle from g join (select shingle from g group by shingle having count(*) > 1) using (shingle)),
p as (select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id
  group by 1, 2),
l as (select a, b from p join n u on u.doc_id = a join n v on v.doc_id = b where 100 * shared >= 85 * (u.n + v.n - shared)),
r as (select doc_id as node, doc_id as reached from documents union select r.node, l.b from r join l on l.a = r.reached),
c as (select node, min(reached) as component_id from r group by node)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id
from d left join n using (doc_id) join c on c.node = d.doc_id
"""


@query("op10_parity_join", OP10_SQL)
def op10(spark, sf_dir):
    return parity_join.link_components(table(spark, sf_dir, "documents")).drop("n_links")
