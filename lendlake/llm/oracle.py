"""SQL counterparts of the numbered queries that SQL can express, written for DuckDB on the test tables."""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

WORD = r"[^\x20\x09-\x0D]+"

# Windows and words are numbered from 1; covered words are counted by a running sum over starts and ends.
SUBSTRING_DEDUP = f"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as words
  from (select *, unnest(generate_series(1, len(w) - 12)) as i from docs)),
firsts as (select words, min(doc_id) as first_id from windows group by words having min(doc_id) < max(doc_id)),
later as (select doc_id, i from windows join firsts using (words) where doc_id > first_id),
gone as (select distinct doc_id, unnest(generate_series(i, i + 12)) as i from later),
placed as (select doc_id, i, w[i] as word from (select *, unnest(generate_series(1, len(w))) as i from docs)),
kept as (
  select p.doc_id, count(*) as n_kept, string_agg(word, ' ' order by p.i) as words
  from placed p anti join gone g on p.doc_id = g.doc_id and p.i = g.i group by 1)
select doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(words, '')) as kept_sha256
from docs left join kept using (doc_id)
"""

JACCARD_JOIN = f"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '{WORD}') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as shingle
  from (select *, unnest(generate_series(1, greatest(len(w) - 2, least(len(w), 1)))) as i from docs)),
sizes as (select doc_id, count(*) as n from shingles group by 1),
classes as (select doc_id, n, md5(string_agg(shingle, chr(10) order by shingle)) as class from shingles join sizes using (doc_id) group by 1, 2),
one as (select class, min(doc_id) as doc_id, any_value(n) as n from classes group by 1),
own as (select s.doc_id, o.n, s.shingle from shingles s join one o using (doc_id)),
links as (
  select a.doc_id as x, b.doc_id as y from own a join own b on a.shingle = b.shingle and a.doc_id < b.doc_id and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways as (select x, y from links union all select y, x from links),
reached as (
  select doc_id as x, doc_id as y from one
  union
  select r.x, l.y from reached r join both_ways l on r.y = l.x),
roots as (select x, min(y) as root from reached group by 1)
select d.doc_id, coalesce(c.n, 0) as n_shingles, coalesce(o.doc_id, d.doc_id) as class_id, coalesce(root, d.doc_id) as component_id
from docs d left join classes c using (doc_id) left join one o on c.class = o.class left join roots r on r.x = o.doc_id
"""

HARD_NEGATIVES = """
with rows as (
  select vec_id as id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as int) as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.id as anchor, b.id as other, a.label = b.label as same,
         cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score
  from rows a join rows b on a.id <> b.id and len(a.v) = len(b.v) where a.id % 100 = 0),
positives as (
  select * from scored where same qualify row_number() over (partition by anchor order by score desc, other) <= 5),
met as (
  select p.anchor as anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score, n.score as negative_score,
         cast(row_number() over (partition by p.anchor, p.other order by n.score desc, n.other) as int) as rank
  from positives p join scored n on p.anchor = n.anchor and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from met where rank <= 5
"""

LINE_DEDUP = f"""
with lines as (
  select doc_id, i, string_split(coalesce(text, ''), chr(10))[i] as line
  from (select *, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as i from documents)),
keyed as (select *, translate(trim(line, {BLANKS}), {UPPER}, {LOWER}) as key from lines),
repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3)
select doc_id, count(*) as n_lines, cast(count_if(gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from (select k.*, coalesce(r.keeper <> k.doc_id, false) as gone from keyed k left join repeated r using (key))
group by doc_id
"""

# The checksum's table: eight steps of its polynomial for each byte.
CRC_STEP = "case when {0} % 2 = 1 then xor({0} >> 1, 3988292384) else {0} >> 1 end"
CRC_TABLE = """
crc_table as (
  select list(list_reduce(range(1, 9), lambda x, step: case when x % 2 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end, b)
              order by b) as steps
  from range(256) t(b))"""

SPELLING = f"""
with recursive {CRC_TABLE.strip()},
runs as (
  select doc_id, translate(run, {UPPER}, {LOWER}) as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents) group by 1, 2),
summed as (
  select run, n, xor(list_reduce(
           list_transform(string_split(concat(doc_id, ':', run), ''), lambda c: unicode(c)::bigint), lambda h, c:
             case when c < 128 then xor(h >> 8, steps[xor(h & 255, c) + 1])
                  else xor(xor(h >> 8, steps[xor(h & 255, 192 | (c >> 6)) + 1]) >> 8,
                           steps[xor(xor(h >> 8, steps[xor(h & 255, 192 | (c >> 6)) + 1]) & 255, 128 | (c & 63)) + 1]) end,
           4294967295::bigint), 4294967295::bigint) as h
  from runs, crc_table),
words as (
  select word, cast(sum(n) as bigint) as n
  from (select n, case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word from summed)
  where length(word) >= 7 group by word having sum(n) >= 2),
places as (select word, n, unnest(generate_series(1, length(word))) as i from words),
shorter as (select distinct word, n, i, word[:i - 1] as x, word[i + 1:] as y from places),
near as (
  select a.word, b.word as other, b.n from shorter a join shorter b on a.i = b.i and a.x = b.x and a.y = b.y and a.word <> b.word
  union
  select s.word, w.word, w.n from shorter s join words w on s.x || s.y = w.word
  union
  select w.word, s.word, s.n from shorter s join words w on s.x || s.y = w.word),
best as (
  select word, count(*) as n_near, arg_min(other, (-n, other)) as form, max(n) as form_n from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * w.n then form end as form,
         case when form_n >= 10 * w.n then form_n end as form_n
  from words w left join best using (word)),
chain as (
  select word, word as root, 0 as steps from forms
  union all
  select c.word, f.form, c.steps + 1 from chain c join forms f on c.root = f.word where f.form is not null),
roots as (select word, arg_max(root, steps) as root from chain group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""

ORACLE = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op2_jaccard_join": JACCARD_JOIN,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_line_dedup": LINE_DEDUP,
    "op13_spelling_variants": SPELLING,
}
