"""SQL equivalents of chunking and embedding, as lists of common table expressions."""

from __future__ import annotations

from carelake.functions.privacy import LEAK_PATTERN
from carelake.plans.knowledge import TERM, WIDTH
from carelake.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS

# What Python's strip() takes away.
_BLANKS = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


def _split(level: int) -> str:
    """The pieces of all texts that are too long for the level above, each with its separator ahead and its place in the document."""
    source = "select doc_id, 0 as parent, 0 as place, text from documents where text is not null" if level == 0 else (
        f"select doc_id, place as parent, place, piece as text from atoms{level - 1} where length(piece) >= {CHUNK_SIZE}")
    separator = SEPARATORS[level]
    literal = " || ".join(f"chr({ord(c)})" for c in separator) or "''"
    piece = f"case when i = 1 then part else {literal} || part end" if separator else "part"
    return f"""
atoms{level} as (
    select doc_id, {level} as level, parent, i, piece,
           place + coalesce(sum(length(piece)) over (partition by doc_id, parent order by i rows between unbounded preceding and 1 preceding), 0) as place
    from (select doc_id, parent, place, i, {piece} as piece from (
        select doc_id, parent, place, unnest(parts) as part, generate_subscripts(parts, 1) as i
        from (select *, string_split(text, {literal}) as parts from ({source}))))
    where piece <> '')"""


# Pieces shorter than a chunk, in runs that longer ones part; from a piece's place alone follow the chunk's end
# (as far as it may go) and the piece that the next chunk begins with. The chain is followed from each run's first.
CHUNKS = ",".join(_split(level) for level in range(len(SEPARATORS))) + f""",
atoms as ({' union all '.join(f'select * from atoms{level}' for level in range(len(SEPARATORS)))}),
parted as (
    select *, length(piece) as len, place + length(piece) as fin, count(*) filter (where length(piece) >= {CHUNK_SIZE}) over (
        partition by doc_id, level, parent order by i) as run from atoms),
pieces as materialized (select * from parted where len < {CHUNK_SIZE}),
spans as (
    select *, max(fin) over (partition by doc_id, level, parent, run order by fin range between current row and ({CHUNK_SIZE} - len) following) as till
    from pieces),
turns as (
    select s.doc_id, s.level, s.parent, s.run, s.place, s.till, case when n.len is not null then s.till - least({CHUNK_OVERLAP}, {CHUNK_SIZE} - n.len) end as back
    from spans s left join pieces n on n.doc_id = s.doc_id and n.level = s.level and n.parent = s.parent and n.run = s.run and n.place = s.till),
steps as materialized (
    select t.*, p.place as after from turns t asof left join pieces p
    on t.doc_id = p.doc_id and t.level = p.level and t.parent = p.parent and t.run = p.run and t.back <= p.place),
numbered as materialized (
    select *, row_number() over (order by doc_id, level, parent, run, place) as id from steps),
linked as materialized (
    select a.id, b.id as next from numbered a join numbered b on a.doc_id = b.doc_id and a.level = b.level and a.parent = b.parent
        and a.run = b.run and a.after = b.place),
chain as (
    select min(id) as id from numbered group by doc_id, level, parent, run
    union all
    select l.next from chain c join linked l on l.id = c.id),
cut as (
    select n.doc_id, n.place, trim(substr(d.text, cast(n.place as bigint) + 1, cast(n.till - n.place as bigint)), {_BLANKS}) as chunk
    from chain join numbered n using (id) join documents d on d.doc_id = n.doc_id),
chunks as (
    select doc_id, row_number() over (partition by doc_id order by place) - 1 as chunk_no, chunk from cut where chunk <> '')
"""

_DIMS = f"list_transform(regexp_extract_all(lower(chunk), '{TERM}'), lambda t: cast('0x' || left(md5(t), 8) as bigint) % {WIDTH})"
# Chunks and questions alike: ``texts`` has (kind, id, chunk), and rarity is that of the chunks.
EMBEDDINGS = f"""
dims as materialized (select kind, id, {_DIMS} as dims from texts),
seen as (select dim, count(*) as n from (select unnest(list_distinct(dims)) as dim from dims where kind = 'chunk') group by dim),
rare as (select d as dim, ln((total + 1) / (coalesce(n, 0) + 1)) as rarity from range({WIDTH}) t(d) left join seen on dim = d,
    (select count(*) as total from dims where kind = 'chunk')),
weights as materialized (select kind, id, dim, n * rarity as weight from (
    select kind, id, dim, count(*) as n from (select kind, id, unnest(dims) as dim from dims) group by all) join rare using (dim)),
norms as (select kind, id, sqrt(sum(weight * weight order by dim)) as norm from weights group by all),
embedded as materialized (
    select x.kind, x.id, list(case when norm > 0 then coalesce(weight, 0) / norm else 0 end order by d) as vec
    from (select kind, id, d from dims, range({WIDTH}) t(d)) x left join norms n on n.kind = x.kind and n.id = x.id
    left join weights w on w.kind = x.kind and w.id = x.id and w.dim = x.d group by x.kind, x.id)
"""
LEAKS = f"regexp_matches(text, '{LEAK_PATTERN}')"
