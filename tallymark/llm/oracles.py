"""SQL twins of the queries that SQL can express, over the same tables."""

from __future__ import annotations

# License phrases and notices, held apart from the operator's own.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD = 0.9

ORACLES: dict[str, str] = {}

ORACLES["op1_rule_ledger"] = r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
m as (
  select doc_id, text,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l
  from d
),
t as (
  select doc_id, text, w, l,
         list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]]) as tri
  from m
),
places as (select doc_id, unnest(tri) as tri, unnest(range(1, len(tri) + 1)) as pos from t),
twice as (select doc_id, tri from places group by doc_id, tri having count(*) > 1),
covered as (
  select doc_id, count(distinct place) as n
  from (select p.doc_id, unnest([p.pos, p.pos + 1, p.pos + 2]) as place from places p join twice using (doc_id, tri))
  group by doc_id
),
f as (
  select t.doc_id, len(w) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(l) - len(list_distinct(l)) as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words,
         len(l) as n_lines,
         len(list_distinct(w)) as n_distinct_words,
         length(regexp_replace(text, '[^!]', '', 'g')) as n_bangs,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) as n_caps,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) as n_letters
  from t left join covered c on c.doc_id = t.doc_id
),
b as (
  select *, (n_words < 50)::bigint * 1 + (100 * n_repeat_words > 50 * n_words)::bigint * 2
       + (10 * n_symbols > n_words)::bigint * 4 + (word_chars < 2 * n_words)::bigint * 8
       + (word_chars > 20 * n_words)::bigint * 16 + (100 * n_dup_lines > 60 * n_lines)::bigint * 32
       + (2 * n_caps > n_letters)::bigint * 64 + (20 * n_distinct_words < n_words)::bigint * 128
       + (2 * n_bangs > n_words)::bigint * 256 as fail_bits
  from f
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 as base_failed, fail_bits = 0 as kept, fail_bits
from b
"""

ORACLES["op3_line_dedup"] = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents
),
k as (
  select *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
),
c as (
  select key, max(doc_id) as last_doc from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
),
j as (select k.*, c.key is not null and k.doc_id <> c.last_doc as gone from k left join c using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from j group by doc_id
"""


def _words(text: str) -> str:
    lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license_sql() -> str:
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({n}, '{label}', {list(dict.fromkeys(text.split()))!r})" for n, (label, text) in enumerate(TEMPLATES))
    return f"""
with phrase(words, label) as (values {phrases}),
template(n, label, words) as (values {templates}),
w as (select doc_id, coalesce(text, '') as text, {_words("coalesce(text, '')")} as w from documents),
p as (
  select doc_id, phrase.label, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(phrase.words)] = phrase.words)) as pos
  from w, phrase
),
base as (
  select doc_id, count(*) as n, min(pos) as lo, max(pos) as hi, list(distinct label) as labels
  from p group by doc_id
),
line as (select doc_id, unnest(string_split(text, chr(10))) as line from w),
hit as (
  select doc_id, template.label,
         len(list_intersect(template.words, {_words("line")})) / len(template.words) as share
  from line, template
  where len(list_intersect(template.words, {_words("line")})) >= ceil({THRESHOLD} * len(template.words) - 1e-9)
),
own as (select doc_id, list(distinct label) as labels, max(share) as best from hit group by doc_id)
select w.doc_id, len(w) as n_words, coalesce(base.n, 0) as n_base, lo as first_word, hi as last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') as labels,
       case when base.n > 0 then 1.0::double else coalesce(best, 0.0)::double end as score
from w left join base using (doc_id) left join own using (doc_id)
"""


ORACLES["op9_license_scan"] = _license_sql()

ORACLES["op4_substring_dedup"] = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select doc_id, unnest(range(1, greatest(len(w) - 11, 1))) as pos,
         unnest(list_transform(range(1, greatest(len(w) - 11, 1)), lambda i: array_to_string(w[i : i + 12], ' '))) as key
  from w
),
own as (select key, min(doc_id) as first_doc from win group by key having min(doc_id) <> max(doc_id)),
gone as (
  select distinct doc_id, unnest(range(pos, pos + 13)) as pos
  from win join own using (key) where doc_id > first_doc
),
each as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from w),
kept as (
  select e.doc_id, count(g.pos) as n_removed,
         string_agg(word, ' ' order by e.pos) filter (where g.pos is null) as kept
  from each e left join gone g on g.doc_id = e.doc_id and g.pos = e.pos group by e.doc_id
)
select w.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join kept using (doc_id)
"""

ORACLES["op2_jaccard_join"] = r"""
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select distinct doc_id,
         unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                     when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as gram
  from w
),
n as (select doc_id, count(*) as n from g group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
),
link as (
  select x, y from common join n nx on nx.doc_id = x join n ny on ny.doc_id = y
  where c >= 0.8 * (nx.n + ny.n - c) - 1e-9
),
reach(node, other) as (select doc_id, doc_id from documents union select r.node, l.y from reach r join link l on r.other = l.x),
class as (select node, min(other) as class_id from reach group by node),
degree as (select x, count(*) as d from link group by x)
select d.doc_id, class_id, coalesce(degree.d, 0) as n_links
from documents d join class on class.node = d.doc_id left join degree on degree.x = d.doc_id
"""

ORACLES["op8_exact_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""

ORACLES["op13_filter_audit"] = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by text) as least from d),
l as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels group by doc_id
),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > least, false)] as fails
  from w left join l on l.doc_id = w.doc_id
),
masks as (
  select part, fails, count(*) as n, count(*) filter (where good) as n_good, count(*) filter (where toxic) as n_toxic
  from f group by part, fails
),
letter as (select unnest(range(1, 6)) as k),
orders as (
  select [a.k, b.k, c.k, d.k, e.k] as o from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
),
each as (
  select part, o, step, n, n_good, n_toxic,
         fails[o[step]] as now,
         len(list_filter(o[1 : step - 1], lambda k: fails[k])) > 0 as gone,
         len(list_filter(fails, lambda x: x)) as n_fails
  from masks, orders, (select unnest(range(1, 6)) as step)
)
select part, array_to_string(list_transform(o, lambda k: 'ABCDE'[k]), '') as filter_order, step::int as step,
       coalesce(sum(n) filter (where not gone and not now), 0)::bigint as kept,
       coalesce(sum(n) filter (where not gone and now), 0)::bigint as removed,
       coalesce(sum(n) filter (where gone and now), 0)::bigint as redundant,
       coalesce(sum(n) filter (where now and n_fails = 1), 0)::bigint as unique_fails,
       coalesce(sum(n_good) filter (where not gone and now), 0)::bigint as good_lost,
       coalesce(sum(n_toxic) filter (where not gone and now), 0)::bigint as toxic_lost,
       coalesce(sum(n * (120 // greatest(n_fails, 1))) filter (where now), 0)::bigint as shapley
from each group by part, o, step
"""

ORACLES["op11_conversation_repair"] = r"""
with recursive crc_table(b, c) as (
  select i, list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7], lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)::bigint
  from (select unnest(range(256))::bigint as i)
),
tab as (select list(c order by b) as t from crc_table),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations
),
hashed as (
  select g.*, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda x: ascii(x)::bigint)),
         lambda r, x: xor(r // 256, t[xor(r % 256, x) + 1])), 4294967295) % 20 as kind
  from given g, tab
),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select * from hashed union all select * from hashed where kind = 3) where kind <> 0
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from damaged
),
nth as (select *, row_number() over (partition by conv_id, role, text order by pos) as nth from placed),
rows_of as (
  select conv_id, turn, role, text, pos,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
              when nth > 1 then 'duplicate'
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
         left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by pos) as before
  from nth
),
-- States: 0 start, 1 after system, 2 after user, 3 after assistant. What one empty turn leads to.
follow(state, role, next) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
ahead as (
  select state, state as at, '' as letters, ''::varchar as lines, 0 as cost from follow
  union all select state, next, 'I', role || ':' || chr(10), 2 from follow
  union all select a.state, b.next, 'II', a.role || ':' || chr(10) || b.role || ':' || chr(10), 4
  from follow a join follow b on b.state = a.next
),
walk(conv_id, pos, state, cost, audit, lines) as (
  select conv_id, 0::bigint, 0, 0::bigint, ''::varchar, ''::varchar from (select distinct conv_id from rows_of)
  union all
  select conv_id, pos, state, best.cost, best.audit, best.lines
  from (
    select conv_id, pos, state, min({'cost': cost, 'audit': audit, 'lines': lines}) as best
    from (
      select r.conv_id, r.pos, e.state,
             w.cost + a.cost + e.cost + case when r.fault = 'truncated' and e.letter <> 'D' then 1 else 0 end as cost,
             w.audit || a.letters || e.letter as audit, w.lines || a.lines || e.line as lines
      from walk w
      join rows_of r on r.conv_id is not distinct from w.conv_id and r.pos = w.pos + 1
      join ahead a on a.state = w.state
      join follow f on f.state = a.at,
      lateral (
        select 'D' as letter, a.at as state, 3 as cost, '' as line
        union all select 'K', 1, 0, r.role || ':' || r.text || chr(10)
          where r.initial = 's' and a.at = 0 and r.fault not in ('blank', 'duplicate')
        union all select 'K', f.next, 0, r.role || ':' || r.text || chr(10)
          where r.initial = left(f.role, 1) and r.fault not in ('blank', 'duplicate')
        union all select 'R', f.next, 2, f.role || ':' || r.text || chr(10)
          where r.fault not in ('blank', 'duplicate')
      ) e
    ) group by conv_id, pos, state
  )
),
ends as (
  select w.conv_id, min({'cost': w.cost + a.cost, 'audit': w.audit || a.letters, 'lines': w.lines || a.lines}) as best
  from walk w join ahead a on a.state = w.state
  where a.at in (0, 3) and w.pos = (select max(pos) from rows_of r where r.conv_id is not distinct from w.conv_id)
  group by w.conv_id
),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
         count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where pos > 1 and (before || initial) not in ('su', 'ua', 'au')) as illegal
  from rows_of group by conv_id
)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(left(best.lines, length(best.lines) - 1), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counts on counts.conv_id is not distinct from c.conv_id
left join ends on ends.conv_id is not distinct from c.conv_id
"""
