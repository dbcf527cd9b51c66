"""DuckDB SQL for the results of the document operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x20\x09-\x0D]+"

# Five-word windows as strings: words hold no space, so joined words are unique.
QUALITY_RULES = rf"""
    with d as (
        select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
    ), w as (
        select r, doc_id, text, regexp_extract_all(text, '{_WORD}') as words,
            [x for x in string_split(text, chr(10)) if regexp_matches(x, '{_WORD}')] as lines
        from d
    ), p as (
        select r, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5
    ), v as (
        select r, i, array_to_string(words[i:i + 4], ' ') as window_text from p
    ), again as (
        select r, i from (select r, i, count(*) over (partition by r, window_text) as n from v) where n > 1
    ), covered as (
        select r, count(distinct i + j)::bigint as n from again, range(5) t(j) group by r
    ), m as (
        select w.r, doc_id, len(words)::bigint as n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
            (length(text) - length(replace(text, '!', '')))::bigint as n_exclaims,
            (length(text) - length(regexp_replace(text, '\p{{Lu}}+', '', 'g')))::bigint as n_upper,
            len(lines)::bigint as n_lines,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
            coalesce(covered.n, 0)::bigint as n_repeat_words
        from w left join covered on w.r = covered.r
    ), f as (
        select *, (
            (n_words < 10)::int
            + 2 * (100 * n_repeat_words > 20 * n_words)::int
            + 4 * (100 * n_symbols > 5 * word_chars)::int
            + 8 * (2 * n_dup_lines > n_lines)::int
            + 16 * (word_chars < 2 * n_words or word_chars > 25 * n_words)::int
            + 32 * (2 * n_upper > word_chars)::int
            + 64 * (10 * n_exclaims > 3 * n_words)::int
        )::int as failures
        from m
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        (failures & 3) <> 0 as base_failed, failures = 0 as kept, failures
    from f"""

NEAR_DUPLICATES = rf"""
    with recursive d as (
        select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') as words
        from documents
    ), p as (
        select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from d where len(words) > 0
    ), s as (
        select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle from p
    ), n as (
        select doc_id, count(*)::bigint as n from s group by doc_id
    ), c as (
        select a.doc_id as a, b.doc_id as b, count(*)::bigint as common
        from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
    ), l as (
        select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b
        where 100 * common >= 85 * (x.n + y.n - common)
    ), e as (
        select a, b from l union all select b, a from l
    ), r(doc_id, reached) as (
        select doc_id, doc_id from d union select r.doc_id, e.b from r join e on e.a = r.reached
    ), m as (
        select doc_id, min(reached) as component_id from r group by doc_id
    )
    select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, d.doc_id = m.component_id as kept
    from d join m using (doc_id) left join n using (doc_id)"""
