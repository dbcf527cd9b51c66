"""SQL of the queries on conversations, for DuckDB."""

from __future__ import annotations

# CRC-32 of an ASCII string: its 256-entry table by rule, and the sum over the bytes.
_CRC_TABLE = """
    crc_bits(n, v, k) as (
        select n, n, 0 from range(256) r(n)
        union all
        select n, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1
        from crc_bits where k < 8
    ), crc_table as (
        select list(v order by n) as crc from crc_bits where k = 8
    )"""


def _crc(text: str) -> str:
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ord(c)::bigint), "
        "lambda h, b: xor(h >> 8, crc[1 + (xor(h, b) & 255)]), 4294967295::bigint), 4294967295)"
    )


PREFIX_TRIE = f"""
    with recursive {_CRC_TABLE}, turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn asc nulls first,
                md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
        from conversations where conv_id is not null
    ), ids as (
        select conv_id, {_crc("conv_id::varchar")} % 6 as head
        from (select distinct conv_id from turns), crc_table
    ), rebuilt as (
        select i.conv_id, 0 as part, t.pos, t.role, t.text
        from ids i join turns t on t.conv_id = i.conv_id - i.conv_id % 100 and t.pos <= i.head
        union all
        select i.conv_id, 1, t.pos, t.role, t.text
        from ids i join turns t on t.conv_id = i.conv_id and t.pos > i.head
    ), numbered as (
        select conv_id, row_number() over (partition by conv_id order by part, pos) as depth,
            md5(length(role)::varchar || ':' || role || text) as turn, length(text) as n_chars
        from rebuilt
    ), prefixes as (
        select conv_id, depth, n_chars,
            string_agg(turn, '') over (partition by conv_id order by depth) as prefix
        from numbered
        union all
        select conv_id, 0, 0, '' from ids
    ), nodes as (
        select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, max(n_chars) as n_chars
        from prefixes group by prefix, depth
    ), children as (
        select prefix[:32 * (depth - 1)] as prefix, count(*) as n_children
        from nodes where depth > 0 group by 1
    ), counted as (
        select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (prefix)
    ), below as (
        select prefix[:32 * above] as prefix, sum((n_children = 0)::int)::bigint as n_leaves,
            sum((n_convs - 1) * n_chars)::bigint as saved_tokens
        from (select *, unnest(range(depth + 1)) as above from counted) group by 1
    ), last_prefixes as (
        select conv_id, max_by(prefix, depth) as prefix from prefixes group by conv_id
    ), ends as (
        select prefix, string_agg(conv_id::varchar, ',' order by conv_id) as ids
        from last_prefixes group by prefix
    )
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
        b.saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
    from counted n
    join below b on b.prefix = n.prefix
    left join nodes p on n.depth > 0 and p.prefix = n.prefix[:32 * (n.depth - 1)]
    left join ends e on e.prefix = n.prefix
"""


def _edit(cost: str, letter: str, rest: str) -> str:
    """A plan is its cost in seven digits and its letters, so the least string is the best plan."""
    return f"printf('%07d', {rest}[:7]::int + {cost}) || '{letter}' || {rest}[8:]"


def _row(keep: str, reroled: str, state: str, system: str = "") -> str:
    """The best plan whose first step deals with the row: kept as ``keep``, reroled or deleted."""
    options = [
        _edit("4", "D", state),
        f"case when not must then {_edit('3 + extra', 'R', reroled)} end",
        f"case when not must and initial = '{keep}' then {_edit('extra', 'K', reroled)} end",
    ]
    if system:
        options.append(f"case when not must and initial = 's' then {_edit('extra', 'K', system)} end")
    return "least(" + ", ".join(options) + ")"


CONVERSATION_REPAIR = f"""
    with recursive {_CRC_TABLE}, dealt as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            {_crc("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as fault
        from conversations, crc_table
    ), damaged as (
        select conv_id, turn, case when fault = 4 then 'user' else role end as role,
            case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g')
                else text end as text
        from (select *, unnest(case when fault = 3 then [0, 1] else [0] end) from dealt where fault <> 0)
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn asc nulls first, role,
            md5(length(role)::varchar || ':' || role || text)) as pos
        from damaged
    ), judged as (
        select *, role[:1] as initial, lag(role[:1]) over (partition by conv_id order by pos) as before,
            not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
            row_number() over (partition by conv_id, role, text order by pos) > 1 as again,
            regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) not in ('.', '!', '?') as cut
        from placed
    ), symbols as (
        select conv_id, pos, role, text, initial, before, blank, not blank and again as duplicate,
            not blank and not again and cut as truncated, blank or again as must,
            case when not blank and not again and cut then 3 else 0 end as extra
        from judged
    ), counts as (
        select c.conv_id, count(s.pos) as n,
            coalesce(sum(s.blank::int), 0)::bigint as blank,
            coalesce(sum(s.duplicate::int), 0)::bigint as duplicate,
            coalesce(sum(s.truncated::int), 0)::bigint as truncated,
            coalesce(sum((s.before is not null and s.before || s.initial not in ('su', 'ua', 'au'))::int), 0)::bigint
                as illegal
        from (select distinct conv_id from conversations) c
        left join symbols s on s.conv_id is not distinct from c.conv_id
        group by c.conv_id
    ), spans as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps
        from damaged group by conv_id
    ), plans(conv_id, k, s, t, u, a) as (
        select conv_id, n, '0000000', '0000006II', '0000003I', '0000000' from counts
        union all
        select conv_id, k, least(s, {_edit("3", "I", "u")}), least(t, {_edit("3", "I", "u")}), u, a
        from (
            select conv_id, k, s, t, least(u, {_edit("3", "I", "a")}) as u, least(a, {_edit("3", "I", "u")}) as a
            from (
                select p.conv_id, p.k - 1 as k, {_row("u", "u", "s", "t")} as s, {_row("u", "u", "t")} as t,
                    {_row("a", "a", "u")} as u, {_row("u", "u", "a")} as a
                from plans p join symbols y on y.conv_id is not distinct from p.conv_id and y.pos = p.k
            )
        )
    ), solved as (
        select conv_id, s[:7]::bigint as cost, s[8:] as audit from plans where k = 0
    ), edits as (
        select conv_id, i, edit,
            sum((edit <> 'I')::int) over (partition by conv_id order by i) as pos,
            sum((edit <> 'D')::int) over (partition by conv_id order by i) as nth
        from (
            select conv_id, unnest(range(1, length(audit) + 1)) as i, unnest(string_split(audit, '')) as edit
            from solved where audit <> ''
        )
    ), turned as (
        select e.conv_id, e.i, e.edit, e.nth, y.role, y.text,
            max((e.nth = 1 and e.edit = 'K' and y.initial = 's')::int) over (partition by e.conv_id) as led
        from edits e left join symbols y
            on e.edit <> 'I' and y.conv_id is not distinct from e.conv_id and y.pos = e.pos
    ), repaired as (
        select conv_id, string_agg(
            case when edit = 'K' then role when (nth - led) % 2 = 1 then 'user' else 'assistant' end
                || ':' || case when edit = 'I' then '' else text end, chr(10) order by i) as whole
        from turned where edit <> 'D' group by conv_id
    )
    select c.conv_id, coalesce(g.gaps, 0) as gaps, c.blank, c.duplicate, c.truncated, c.illegal,
        p.cost, p.audit, sha256(coalesce(r.whole, '')) as repaired_sha256
    from counts c
    join solved p on p.conv_id is not distinct from c.conv_id
    left join spans g on g.conv_id is not distinct from c.conv_id
    left join repaired r on r.conv_id is not distinct from c.conv_id
"""
