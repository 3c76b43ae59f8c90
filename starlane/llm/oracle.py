"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = rf"""
with sized as (
  select doc_id, source, len({_WORDS})::bigint as size from documents
), totals as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w,
    source_size::double * 3 as cap from totals
), levels as (
  select *, cap / w as level,
    (sum(source_size::double) over () - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as share
  from weighed
), water as (select arg_min(share, level) as water from levels where level >= share),
targets as (select source, source_size, round(least(cap, water * w), 6) as target from levels, water),
placed as (
  select s.doc_id, s.size, s.source, t.source_size, t.target, round(t.target)::bigint as budget,
    coalesce(sum(s.size) over (partition by s.source order by md5(concat_ws('-', 'mix', s.doc_id::varchar, s.source)), s.doc_id, s.size
      rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target, source,
  (case when source_size > 0 then budget // source_size * size + greatest(0, least(size, budget % source_size - before)) else 0 end)::bigint as taken
from placed
"""

OP10 = rf"""
with d as (
  select doc_id, source, coalesce(text, '') as t, {_WORDS} as words, string_split(coalesce(text, ''), chr(10)) as lines from documents
), grams as (
  select doc_id, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from grams) where n > 1
), repeats as (
  select doc_id, count(distinct i + j)::bigint as n from twice, range(3) r(j) group by doc_id
), lines as (
  select doc_id, source, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n,
    lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) as norm
  from (select doc_id, source, t, unnest(lines) as line from d)
), held as (
  select source, norm, count(distinct t) as texts from lines where n > 0 group by source, norm
), boiler as (
  select source, norm from held where texts > 20
), lost as (
  select doc_id, sum(n)::bigint as n from lines l join boiler b on l.source is not distinct from b.source and l.norm = b.norm where l.n > 0 group by doc_id
), dups as (
  select doc_id, (count(*) - count(distinct line))::bigint as n from lines where n > 0 group by doc_id
), counts as (
  select d.doc_id, len(words)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, coalesce(dups.n, 0) as n_dup_lines,
    coalesce(repeats.n, 0) as n_repeat_words, coalesce(lost.n, 0) as n_words_lost
  from d left join repeats using (doc_id) left join dups using (doc_id) left join lost using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not n_words_lost > 0.5 * n_words as kept
from counts
"""

# crc32 of the decimal conv_id: eight shift steps a byte (0xEDB88320 is the
# polynomial). Sequences of turns are compared as lists of (role, text).
OP12 = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} as turn
  from conversations where conv_id is not null
), own as (
  select conv_id, list(turn order by i) as turns from turns group by conv_id
), summed as (
  select conv_id, turns, conv_id - conv_id % 20 as base_id,
    xor(list_reduce(list_prepend(4294967295::bigint, flatten([[ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(conv_id::varchar, '')])),
      lambda crc, b: case when b >= 0 then xor(crc, b) when crc % 2 = 1 then xor(crc >> 1, 3988292384::bigint) else crc >> 1 end), 4294967295::bigint) % 4 as h
  from own
), built as (
  select s.conv_id, coalesce(b.turns, [])[1:s.h] || s.turns[s.h + 1:] as turns
  from summed s left join own b on b.conv_id = s.base_id
), members as (
  select conv_id, d as depth, turns[1:d] as path, len(turns) = d as ends
  from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from built)
), nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
    (count(*) - 1) * coalesce(len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')), 0) as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by path, depth
), named as (
  select m.conv_id as member, m.depth, n.conv_id, n.n_convs, n.saved, n.ends_sha256 from members m join nodes n on m.path = n.path and m.depth = n.depth
), parents as (
  select n.conv_id, n.depth, p.conv_id as parent_conv_id from nodes n left join named p on p.member = n.conv_id and p.depth = n.depth - 1
), children as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n from parents where depth > 0 group by all
), below as (
  select up.conv_id, up.depth, sum(n.saved)::bigint as saved, count(*) filter (where c.n is null) as leaves
  from nodes n join named up on up.member = n.conv_id and up.depth <= n.depth
    left join children c on c.conv_id = n.conv_id and c.depth = n.depth
  group by up.conv_id, up.depth
)
select n.conv_id, n.depth::bigint as depth, p.parent_conv_id, n.n_convs::bigint as n_convs, coalesce(c.n, 0)::bigint as n_children,
  b.leaves::bigint as n_leaves, b.saved as saved_tokens, n.ends_sha256
from nodes n join parents p on p.conv_id = n.conv_id and p.depth = n.depth
  join below b on b.conv_id = n.conv_id and b.depth = n.depth
  left join children c on c.conv_id = n.conv_id and c.depth = n.depth
"""

ORACLE = {"op8_source_mixing": OP8, "op10_quality_rules": OP10, "op12_conversation_trie": OP12}
