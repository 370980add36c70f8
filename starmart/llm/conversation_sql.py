"""SQL for DuckDB that the two conversation operators are checked against; it shares no step with them."""

from __future__ import annotations

#: DuckDB has no CRC: the table of the reflected polynomial, and the checksum of an ASCII string by a fold.
CRC_TABLE = """crc_table as (
    select list(list_reduce(list_prepend(i, range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1))) order by i) as t
    from (select unnest(range(256)) as i)
)"""


def crc32(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint)), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


PREFIX_TRIE = f"""
with {CRC_TABLE}, rows as (
    select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as place
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
), lengths as (
    select conv_id, count(*) as n from rows group by conv_id
), plans as (
    select conv_id, conv_id - conv_id % 5 as base, {crc32('conv_id::varchar')} % 9 as h from lengths, crc_table
), planned as (
    select p.conv_id, base, h, least(h, coalesce(n, 0)) as shared from plans p left join lengths l on l.conv_id = base
), rebuilt as (
    select p.conv_id, place + 1 as depth, role, text from planned p join rows r on r.conv_id = base where place < h
    union all
    select p.conv_id, place - h + shared + 1, role, text from planned p join rows r on r.conv_id = p.conv_id where place >= h
), paths as (
    select conv_id, depth, octet_length(encode(text)) as bytes,
        sha256(string_agg(sha256(length(role)::varchar || ':' || role || text), '') over (partition by conv_id order by depth)) as key
    from rebuilt
    union all
    select conv_id, 0, 0, '' from lengths
), linked as (
    select *, lag(key) over doc as parent, lead(key) over doc is null as last
    from paths window doc as (partition by conv_id order by depth)
), nodes as (
    select depth, key, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * max(bytes) as saved,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '') as ends
    from linked group by depth, key
), children as (
    select depth - 1 as depth, parent as key, count(*) as n from nodes where depth > 0 group by all
), grown as (
    select nodes.*, coalesce(n, 0) as n_children from nodes left join children using (depth, key)
), subtrees as (
    select p.depth, p.key, sum((g.n_children = 0)::bigint) as n_leaves, sum(g.saved) as saved_tokens
    from grown g join paths p on p.conv_id = g.conv_id and p.depth <= g.depth group by all
)
select g.conv_id, g.depth::bigint as depth, up.conv_id as parent_conv_id, g.n_convs, g.n_children, n_leaves::bigint as n_leaves,
    saved_tokens::bigint as saved_tokens, sha256(g.ends) as ends_sha256
from grown g join subtrees using (depth, key) left join nodes up on up.depth = g.depth - 1 and up.key = g.parent
"""

REPAIR = rf"""
with recursive {CRC_TABLE}, given as (
    select conv_id, coalesce(conv_id::varchar, ' ') as cid, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as harm
    from conversations, crc_table
), harmed as (
    select cid, turn, case when harm = 4 then 'user' else role end as role,
        case when harm = 1 then '' when harm = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when harm = 3 then [0, 1] else [0] end) as copy
    from given where harm <> 0
), placed as (
    select *, row_number() over doc as n, lag(role) over doc as before, left(role, 1) as initial
    from harmed window doc as (partition by cid order by turn nulls first, role, text)
), judged as (
    select *, case when not regexp_matches(text, '[^ \t-\r]') then 'blank'
        when n > min(n) over (partition by cid, role, text) then 'duplicate'
        when not regexp_matches(text, '[.!?][ \t-\r]*$') then 'truncated' else '' end as fault
    from placed
), delta(q, initial, p) as (
    values ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), inserts(q, p, made, lines) as (
    select d, d, '', []::varchar[] from unnest(['', 's', 'u', 'a']) as x(d)
    union all select q, p, 'I', [case p when 'u' then 'user:' else 'assistant:' end] from delta where p <> 's'
    union all select a.q, b.p, 'II', [case a.p when 'u' then 'user:' else 'assistant:' end, case b.p when 'u' then 'user:' else 'assistant:' end]
    from delta a join delta b on b.q = a.p where a.p <> 's' and b.p <> 's'
), edits(q, letter, role, p, cost) as (
    select d, 'D', null, d, 2 from unnest(['', 's', 'u', 'a']) as x(d)
    union all select q, 'K', initial, p, 0 from delta
    union all select q, 'R', case p when 'u' then 'user' else 'assistant' end, p, 1 from delta where p <> 's'
), best as (
    select distinct cid, 0::bigint as n, '' as q, {{'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]}} as way from given
    union all
    select cid, n, p, min(way) from (
        select b.cid, j.n, e.p, {{
            'cost': b.way.cost + 5 * length(i.made) + e.cost + case when e.letter <> 'D' and j.fault = 'truncated' then 5 else 0 end,
            'audit': b.way.audit || i.made || e.letter,
            'lines': b.way.lines || i.lines || case when e.letter = 'D' then []::varchar[]
                when e.letter = 'K' then [j.role || ':' || j.text] else [e.role || ':' || j.text] end}} as way
        from best b join judged j on j.cid = b.cid and j.n = b.n + 1 join inserts i on i.q = b.q
        join edits e on e.q = i.p and (e.letter = 'D' or j.fault not in ('blank', 'duplicate')) and (e.letter <> 'K' or e.role = j.initial)
    ) group by cid, n, p
), counted as (
    select cid, count(*) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (n > 1 and left(before, 1) || initial not in ('su', 'ua', 'au')) as illegal
    from judged group by cid
), ended as (
    select b.cid, min({{'cost': b.way.cost + 5 * length(i.made), 'audit': b.way.audit || i.made, 'lines': b.way.lines || i.lines}}) as way
    from best b left join counted c using (cid) join inserts i on i.q = b.q and i.p in ('', 'a')
    where b.n = coalesce(c.rows, 0) group by b.cid
)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, way.cost::bigint as cost, way.audit as audit,
    sha256(array_to_string(way.lines, chr(10))) as repaired_sha256
from (select distinct conv_id, cid from given) g join ended using (cid) left join counted using (cid)
"""
