"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from changefeed.llm.licenses import TEMPLATES

_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format(t='text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
with item as (
    select item_id, {_WORDS} as w from benchmark where item_id is not null and text is not null
), win as (
    select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
    from item, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as t(i) where len(w) > 0
), lengths as (select distinct n from win),
doc as (select doc_id, coalesce({_WORDS}, []) as w from documents),
hit as (
    select d.doc_id, d.i, d.n, win.item_id
    from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
          from doc, lengths, unnest(range(1, greatest(len(w) - n + 2, 1))) as t(i)) d
    join win on win.n = d.n and win.g = d.g
), words as (
    select doc_id, count(distinct p) as n_hit from hit, unnest(range(i, i + n)) as t(p) group by 1
), items as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join words using (doc_id) left join items using (doc_id)
"""

# Frequent words of English, German, French and Spanish.
_STOPS = (
    "the be to of and that have with is in a der die das und ist von zu mit den nicht "
    "le la les de des et un une en que el los las y por con para est il du se"
).split()
_STOP_LIST = ", ".join(f"'{w}', '{w.capitalize()}'" for w in _STOPS)

OP8 = rf"""
with cut as (
    select doc_id, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
           case when text is null then [] else string_split(text, chr(10)) end as lines
    from documents
), win as (
    select doc_id, i, array_to_string(words[i:i + 2], ' ') as g
    from cut, unnest(range(1, len(words) - 1)) as t(i)
), twice as (select doc_id, g from win group by 1, 2 having count(*) > 1),
covered as (
    select doc_id, count(distinct i + d) as n from win semi join twice using (doc_id, g), unnest([0, 1, 2]) as t(d)
    group by 1
), base as (
    select cut.*, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
           (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
           list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as wordy,
           coalesce(covered.n, 0)::bigint as n_repeat_words
    from cut left join covered using (doc_id)
), judged as (
    select *, (len(wordy) - len(list_distinct(wordy)))::bigint as n_dup_lines,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
    from base
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed
            or word_chars < 2 * n_words or word_chars > 12 * n_words
            or 10 * n_symbols > n_words
            or 10 * n_dup_lines > 3 * len(lines)
            or 10 * len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) > 3 * len(lines)
            or 10 * len(list_filter(lines, lambda l: regexp_matches(l, '^\s*[-*•]'))) > 9 * len(lines)
            or 10 * length(regexp_replace(array_to_string(words, ''), '\p{{L}}+', '', 'g')) > 4 * word_chars
            or len(list_intersect(words, [{_STOP_LIST}])) < 2) as kept
from judged
"""



def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
    grams = (
        "list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    )
    return rf"""
with template as (
    select row_number() over () as t, name, {grams.format(w='w')} as grams
    from (select name, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') as w from (values {rows}) v(name, body))
), unit as (
    select doc_id, u, {grams.format(w='w')} as grams
    from (select doc_id, u, regexp_extract_all(body, '[\p{{L}}\p{{N}}]+') as w
          from (select doc_id, row_number() over () as u, body from (
                select doc_id, lower(coalesce(text, '')) as body from documents
                union all select doc_id, unnest(regexp_split_to_array(lower(text), '\n\n+')) from documents where contains(text, chr(10) || chr(10))
                union all select doc_id, unnest(string_split(lower(text), chr(10))) from documents where contains(text, chr(10)))))
    where len(w) > 1
), pair as (
    select doc_id, u, name, len(unit.grams) as a, len(template.grams) as b,
           2.0::double * len(list_intersect(unit.grams, template.grams)) / (len(unit.grams) + len(template.grams)) as dice
    from unit join template on len(unit.grams) between ceil(len(template.grams) * 0.8 / 1.2 - 1e-9) and floor(len(template.grams) * 1.2 / 0.8 + 1e-9)
), per as (
    select doc_id, count(distinct u) as n_units, count(*) filter (where dice >= 0.8) as n_matches,
           string_agg(distinct name, ',' order by name) filter (where dice >= 0.8) as licenses,
           max(dice) filter (where dice >= 0.8) as best
    from pair group by 1
)
select doc_id, coalesce(n_units, 0) as n_units, coalesce(n_matches, 0) as n_matches, coalesce(licenses, '') as licenses,
       round(coalesce(best, 0.0), 9) as best_dice
from documents left join per using (doc_id)
"""


OP2 = r"""
with line as (
    select doc_id, i, lines[i] as line, len(lines) as n_lines, ('0x' || substr(md5(lines[i]), 1, 8))::bigint as h
    from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null),
         unnest(range(1, len(lines) + 1)) as t(i)
), ended as (
    select *, i = n_lines or (i >= 2 and (h + 31 * lag(h) over (partition by doc_id order by i)) % 1000003 % 3 = 0) as ends from line
), numbered as (
    select *, coalesce(sum(ends::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as idx
    from ended
), chunk as (
    select doc_id, idx, count(*) as n, string_agg(line, chr(10) order by i) as body from numbered group by 1, 2
), judged as (
    select *, n >= 2 and row_number() over (partition by body order by doc_id, idx) > 1 as gone from chunk
), kept as (
    select doc_id, sum(n) as n_lines, count(*) as n_chunks, count(*) filter (where gone) as removed,
           coalesce(sum(n) filter (where gone), 0) as removed_lines,
           md5(coalesce(string_agg(body, chr(10) order by idx) filter (where not gone), '')) as kept_md5
    from judged group by 1
)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_chunks, 0) as n_chunks, coalesce(removed, 0) as removed,
       coalesce(removed_lines, 0)::bigint as removed_lines, kept_md5
from documents left join kept using (doc_id)
"""


def _crc_table() -> list[int]:
    table = [0] * 256
    for i in range(256):
        c = i
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table[i] = c
    return table


def _kd_sql(levels: int = 3) -> str:
    """``levels`` cuts in two, each at the weighted median of every node's widest dimension."""
    name = "('0x' || substr(md5({x}), 1, 8))::bigint"
    steps = [
        f"""crc_table as (select {_crc_table()}::bigint[] as t),
crc as (
    select distinct text, case when text is null or text = '' then 0 else xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(0, strlen(text)), lambda i: ('0x' || hex(encode(text))[2 * i + 1:2 * i + 2])::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) end as crc
    from documents, crc_table
), row0 as (
    select doc_id, strlen(coalesce(d.text, '')) + 1 as size, crc, {name.format(x='doc_id::varchar')} as tie,
           (strlen(coalesce(d.text, '')) + 1)::double as a, {name.format(x='lang')}::double as b, {name.format(x='source')}::double as c
    from documents d join crc on crc.text is not distinct from d.text
), span as (select min(a) la, max(a) ha, min(b) lb, max(b) hb, min(c) lc, max(c) hc from row0
), level0 as (
    select doc_id, size, crc, tie, 0 as leaf, {2 ** levels} as holds,
           """
        + ", ".join(
            f"coalesce(({x} - l{x}) / (case when h{x} > l{x} then h{x} - l{x} else 1.0::double end), -1.0::double) as {x}" for x in "abc"
        )
        + " from row0, span)"
    ]
    for k in range(levels):
        steps.append(
            f"""wide{k} as (
    select leaf, sum(size) as total, max(a) - min(a) as wa, max(b) - min(b) as wb, max(c) - min(c) as wc from level{k} group by 1
), run{k} as (
    select l.*, total, sum(size) over (partition by leaf order by
        case when wa >= wb and wa >= wc then a when wb >= wc then b else c end, tie, doc_id, crc) as upto
    from level{k} l join wide{k} using (leaf)
), level{k + 1} as (
    select doc_id, size, crc, tie, a, b, c, holds // 2 as holds,
           case when (upto - size / 2) * holds <= total * (holds // 2) then leaf else leaf + holds // 2 end as leaf
    from run{k})"""
        )
    return (
        "with " + ", ".join(steps)
        + f""" select doc_id, size::bigint as size, crc::bigint as text_crc32, 'bytes' as law, leaf::int as shard,
       row_number() over (partition by leaf order by tie, doc_id, crc) - 1 as slot, null::int as grown_shard from level{levels}"""
    )


OP13 = rf"""
with crc_table as (select {_crc_table()}::bigint[] as t),
turn as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first) as i
    from conversations where conv_id is not null
), conv as (
    select conv_id, conv_id - conv_id % 100 as family, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(1, strlen(conv_id::varchar) + 1), lambda p: ascii(substr(conv_id::varchar, p, 1))::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 6 as h
    from (select distinct conv_id from turn), crc_table
), mixed as (
    select c.conv_id, 0 as own, t.i, t.role, t.text from conv c join turn t on t.conv_id = c.family and t.i <= c.h
    union all
    select c.conv_id, 1, t.i, t.role, t.text from conv c join turn t on t.conv_id = c.conv_id and t.i > c.h
), said as (
    select conv_id, list(md5(role || chr(0) || text) order by own, i) as seq, list(length(text) order by own, i) as size
    from mixed group by 1
), whole as (
    select conv_id, coalesce(seq, []) as seq, coalesce(size, []) as size from conv left join said using (conv_id)
), prefix as (
    select conv_id, d, array_to_string(seq[1:d], ' ') as key, d = len(seq) as ends, case when d = 0 then 0 else size[d] end as size
    from whole, unnest(range(0, len(seq) + 1)) as t(d)
), node as (
    select key, d, min(conv_id) as conv_id, count(*) as n_convs, min(size) as size,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from prefix group by 1, 2
), parent as (
    select n.key, u.conv_id as parent_conv_id, u.key as up
    from node n join whole w on w.conv_id = n.conv_id join node u on u.d = n.d - 1 and u.key = array_to_string(w.seq[1:n.d - 1], ' ')
), child as (select up as key, count(*) as n_children from parent group by 1),
below as (
    select array_to_string(w.seq[1:k], ' ') as key, sum((n.n_convs - 1) * n.size) as saved_tokens, count(*) filter (where c.key is null) as n_leaves
    from node n join whole w on w.conv_id = n.conv_id left join child c on c.key = n.key, unnest(range(0, n.d + 1)) as t(k)
    group by 1
)
select n.conv_id, n.d as depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves,
       saved_tokens::bigint as saved_tokens, ends_sha256
from node n left join parent using (key) left join child using (key) join below using (key)
"""

def _cluster_sql(rounds: int = 5, centroids: int = 40, width: int = 64) -> str:
    steps = [
        f"""kept as (
    select row_number() over (order by sha256('2:' || vec_id), vec_id) - 1 as r, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings where len(embedding) = {width} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {width}
), cell as materialized (select r, j, v[j] as x from kept, unnest(range(1, {width + 1})) as t(j)),
mid0 as (select r as c, j, x from cell where r < {centroids})"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""far{k} as materialized (
    select r, c, sum((cell.x - m.x) * (cell.x - m.x))::bigint as d from cell join mid{k} m using (j) group by 1, 2
), near{k} as materialized (select r, arg_min(c, (d, c)) as c, min(d) as d from far{k} group by 1)"""
        )
        if k < rounds:
            steps.append(
                f"""mid{k + 1} as materialized (
    select m.c, j, coalesce(n.x, m.x) as x from mid{k} m left join (
        select c, j, ((s - ((s % n) + n) % n) // n)::bigint as x
        from (select c, j, sum(x)::bigint as s, count(*) as n from near{k} join cell using (r) group by 1, 2)) n using (c, j))"""
            )
    return (
        "with " + ", ".join(steps)
        + f""", sha as (select c, sha256(string_agg(x::varchar, ',' order by j)) as centroid_sha256 from mid{rounds} group by 1)
select vec_id, c::int as cluster, d as distance, sum(d) over (partition by c)::bigint as cluster_inertia,
       sum(d) over ()::bigint as inertia, centroid_sha256
from near{rounds} join kept using (r) join sha using (c)"""
    )


ORACLE = {
    "op1_license_scan": _license_sql(), "op2_line_chunks": OP2, "op9_kd_shards": _kd_sql(), "op3_decontaminate": OP3,
    "op8_rule_cascade": OP8, "op12_va_clusters": _cluster_sql(), "op13_prefix_trie": OP13,
}
