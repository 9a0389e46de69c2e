"""DuckDB SQL for the text queries that SQL can express, each written from its contract."""
from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = """
with texts as (
  select row_number() over () as row, doc_id, hex(encode(coalesce(text, ''))) as data
  from documents),
bytes as (
  select row, doc_id, unnest(regexp_extract_all(data, '..')) as byte,
    generate_subscripts(regexp_extract_all(data, '..'), 1) as place
  from texts),
strings as (
  select *, case when count(*) over string = 50 then string_agg(byte, '') over string end as string
  from bytes
  window string as (partition by row order by place rows between current row and 49 following)),
judged as (
  select row, place, byte, coalesce(
    string is not null and min(doc_id) over (partition by string) < doc_id, false) as again
  from strings),
covered as (
  select row, place, byte, bool_or(again) over (
    partition by row order by place rows between 49 preceding and current row) as gone
  from judged),
edges as (
  select *, gone and not lag(gone, 1, false) over (partition by row order by place) as edge
  from covered),
cut as (
  select row, count(*) filter (gone) as n_removed, count(*) filter (edge) as n_spans,
    string_agg(byte, '' order by place) filter (not gone) as kept
  from edges group by row)
select doc_id, cast(length(data) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed,
  coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from texts left join cut using (row)
"""

OP11 = rf"""
with texts as (select row_number() over () as row, doc_id, {_WORDS} as words from documents),
placed as (
  select row, unnest(words) as word, generate_subscripts(words, 1) as place from texts),
windows as (
  select *, case when count(*) over near = 35 then string_agg(word, ' ') over near end as sequence
  from placed
  window near as (partition by row order by place rows between current row and 34 following)),
judged as (
  select row, place, word,
    sequence is not null and count(*) over (partition by sequence) > 1 as again
  from windows),
covered as (
  select row, place, word, bool_or(again) over (
    partition by row order by place rows between 34 preceding and current row) as gone
  from judged),
cut as (
  select row, count(*) filter (gone) as n_removed,
    string_agg(word, ' ' order by place) filter (not gone) as kept
  from covered group by row)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from texts left join cut using (row)
"""

OP12 = r"""
with texts as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents),
drawn as (
  select *, len(units) as n, cast('0x' || h[1:8] as ubigint) as h1,
    cast('0x' || h[9:16] as ubigint) as h2, cast('0x' || h[17:24] as ubigint) as h3,
    cast('0x' || h[25:32] as ubigint) as h4
  from texts),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>')
      or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from drawn),
parts as (
  select *, coalesce(array_to_string(units[1:a], ''), '') as prefix,
    coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
    coalesce(array_to_string(units[b + 1:], ''), '') as suffix
  from cut)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""

# The checksum is that of zlib, by its table of remainders. Words lie in ASCII and the
# letters from U+00C0 to U+00FF, whose UTF-8 is byte 195 and the code point less 64.
OP13 = r"""
with recursive remainders as (
  select list(x order by i) as remainder from (
    select i, list_reduce(list_prepend(cast(i as bigint), [cast(0 as bigint) for k in range(8)]),
      lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) as x
    from range(256) t(i))),
runs as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run
  from documents),
counted as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
    count(*) as times
  from runs where length(run) >= 6 group by all),
summed as (
  select run, times, xor(4294967295, list_reduce(
    list_prepend(cast(4294967295 as bigint), flatten([
      case when unicode(c) < 128 then [cast(unicode(c) as bigint)]
        else [cast(195 as bigint), cast(unicode(c) - 64 as bigint)] end
      for c in string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, '')])),
    lambda c, b: xor(c >> 8, remainder[1 + (xor(c, b) & 255)]))) as h
  from counted, remainders),
spelt as (
  select times, case when h % 199 = 0
    then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from summed),
words as (
  select word, cast(sum(times) as bigint) as n from spelt
  where length(word) >= 6 group by word having sum(times) >= 5),
shorter as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
  from (select *, unnest(generate_series(1, length(word))) as i from words)),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n
  from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select s.word, s.n, w.word, w.n from shorter s join words w on s.rest = w.word
  union select w.word, w.n, s.word, s.n from shorter s join words w on s.rest = w.word),
best as (
  select word, count(*) as n_near, max(near_n) as most from pairs group by word),
forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
    min(p.near) filter (b.most >= 5 * w.n) as form,
    case when b.most >= 5 * w.n then b.most end as form_n
  from words w left join best b using (word)
    left join pairs p on p.word = w.word and p.near_n = b.most
  group by all),
chains as (
  select word, word as reached, 0 as hops from forms
  union all
  select c.word, f.form, c.hops + 1 from chains c join forms f on f.word = c.reached
  where f.form is not null)
select f.word, f.form, arg_max(c.reached, c.hops) as root, f.n, cast(f.n_near as bigint) as n_near,
  f.form_n
from forms f join chains c using (word) group by all
"""

# Similarity counts shared shingles of a window and an item, each as often as it occurs.
OP9 = r"""
with docs as (
  select row_number() over () as row, doc_id, words, len(words) as n_words from (
    select distinct doc_id, text, regexp_extract_all(
      lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents)),
items as (
  select row_number() over () as item, item_id, words, len(words) as n, least(5, len(words)) as k
  from (select distinct item_id, regexp_extract_all(
      lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark)
  where len(words) > 0),
theirs as (
  select item, k, shingle, count(*) as times from (
    select item, k, unnest([array_to_string(words[j:j + k - 1], ' ')
      for j in range(1, n - k + 2)]) as shingle from items)
  group by all),
ours as (
  select row, k, place, array_to_string(words[place + 1:place + k], ' ') as shingle from (
    select row, words, k, unnest(range(0, n_words - k + 1)) as place
    from docs, (select distinct k from items) where n_words >= k)),
hits as (
  select row, item, n, k, n_words, shingle, times, place, greatest(0, n_words - n) as last
  from ours join theirs using (k, shingle) join items using (item, k) join docs using (row)),
held as (
  select row, item, n, k, n_words, start, shingle, least(count(*), times) as shared from (
    select *, unnest(range(greatest(0, place + k - n), least(place, last) + 1)) as start from hits)
  group by row, item, n, k, n_words, start, shingle, times),
windows as (
  select row, item, n, start, sum(shared) as shared,
    (n - k + 1) + (least(n, n_words) - k + 1) as had
  from held group by row, item, n, k, n_words, start)
select doc_id, item_id, max(cast(shared as double) / (had - shared)) as similarity,
  cast(min(start) as bigint) as first_word, cast(max(w.n) as bigint) as n_words,
  count(*) as windows
from windows w join docs using (row) join items using (item)
where cast(shared as double) / (had - shared) >= 0.8 - 1e-9
group by doc_id, item_id
"""

OP10 = r"""
with recursive docs as (
  select row_number() over () as row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents),
sets as (
  select row, doc_id, list_distinct(case when len(words) = 0 then []
    when len(words) < 4 then [array_to_string(words, ' ')]
    else [array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)] end) as shingles
  from docs),
members as (select row, unnest(shingles) as shingle from sets),
pairs as (
  select a.row as one, b.row as two, count(*) as shared
  from members a join members b on a.shingle = b.shingle and a.row < b.row group by all),
links as (
  select one, two from pairs join sets a on a.row = one join sets b on b.row = two
  where 100 * shared >= 80 * (len(a.shingles) + len(b.shingles) - shared)),
either as (select one, two from links union all select two, one from links),
reached as (
  select row, row as other from sets
  union select r.row, e.two from reached r join either e on e.one = r.other),
components as (
  select r.row, min(s.doc_id) as component_id
  from reached r join sets s on s.row = r.other group by r.row)
select doc_id, cast(len(shingles) as bigint) as n_shingles, component_id,
  doc_id = component_id as kept
from sets join components using (row)
"""

ORACLES: dict[str, str] = {
    "op5_suffix_array": OP5,
    "op9_decontamination": OP9,
    "op10_hyperminhash": OP10,
    "op11_recompression": OP11,
    "op12_wavelet": OP12,
    "op13_spelling": OP13,
}
