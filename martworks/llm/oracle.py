"""SQL answers of the corpus queries, where SQL can express them."""

from __future__ import annotations

import string

from martworks.llm import merkle_sql

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

_REACH = """reach(id, other) as (
  select id, other from edges
  union
  select r.id, e.other from reach r join edges e on r.other = e.id),
least_id as (select id, min(other) as least_other from reach group by id)"""

ORACLE = {
    "op2_host_quality": rf"""
with texts as (
  select doc_id, source, coalesce(text, '') as t, {WORDS.format(text="coalesce(text, '')")} as w
  from documents),
windows as (
  select doc_id, i, w[i] || chr(9) || w[i + 1] || chr(9) || w[i + 2] as x
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from texts) u),
repeated as (select doc_id, i, count(*) over (partition by doc_id, x) as n from windows),
covered as (
  select doc_id, count(distinct p) as c
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from repeated where n > 1) u group by doc_id),
measured as (
  select doc_id, source, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum([length(x) for x in w]), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from texts),
judged as (
  select m.*, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    coalesce(c, 0) as n_repeat_words,
    n_words < 50 or 100 * coalesce(c, 0) > 50 * n_words as base_failed
  from measured m left join covered v using (doc_id)),
hosts as (
  select source, count(*) as host_documents, count(*) filter (base_failed) as host_failures
  from judged group by source),
moments as (
  select greatest(least(sum(host_failures) / sum(host_documents), 1 - 1e-6), 1e-6) as mean,
    var_pop(host_failures / host_documents) as spread, avg(1 / host_documents) as inverse, count(*) as n
  from hosts),
prior as (
  select mean, case when n > 1 and spread - mean * (1 - mean) * inverse > 0
    then least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * inverse) - 1, 2.0), 1000.0)
    else 2.0 end as strength from moments)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  host_documents, host_failures,
  not base_failed and (host_failures + mean * strength) / (host_documents + strength) <= 0.5 as kept
from judged j join hosts h on j.source is not distinct from h.source, prior
""",
    "op4_near_duplicates": f"""
with recursive texts as (
  select doc_id, {WORDS.format(
      text=f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
  )} as w from documents where text is not null),
shingles as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ')
    else array_to_string(w[i : i + 4], ' ') end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from texts where len(w) > 0) u),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from shared p join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * p.n >= 85 * (x.n + y.n - p.n)),
edges(id, other) as (select a, b from links union select b, a from links),
{_REACH}
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(least_other, doc_id)) as component_id,
  doc_id <= coalesce(least_other, doc_id) as kept
from documents left join sizes using (doc_id) left join least_id on id = doc_id
""",
    "op5_cover_tree": f"""
with recursive vectors as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where label is not null and embedding is not null and len(embedding) = len([x for x in embedding if isfinite(x)])),
usable as (select * from vectors where list_sum([abs(x) for x in v]) > 0),
edges(id, other) as (
  select a.vec_id, b.vec_id from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93),
{_REACH},
degrees as (select id, count(*) as n from edges group by id)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(least_other, vec_id)) as component_id,
  vec_id <= coalesce(least_other, vec_id) as kept
from embeddings e left join degrees d on d.id = vec_id left join least_id l on l.id = vec_id
""",
    "op11_merkle": merkle_sql.manifest(),
    "op12_suffix_repeats": """
with texts as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
strings as (
  select r, doc_id, i, substring(x, 2 * i + 1, 100) as s
  from (select *, unnest(range(0, len(x) // 2 - 49)) as i from texts where doc_id is not null) u),
least as (select s, min(doc_id) as m from strings group by s having min(doc_id) < max(doc_id)),
hits as (select r, i from strings join least using (s) where doc_id > m),
islands as (
  select r, i, sum(new) over (partition by r order by i) as island
  from (select r, i, case when i - lag(i) over (partition by r order by i) <= 50 then 0 else 1 end as new from hits) u),
runs as (select r, min(i) as a, max(i) + 50 as b from islands group by r, island),
kept as (
  select r, a, b, substring(x, 2 * before + 1, 2 * (a - before)) as piece
  from (select *, lag(b, 1, 0) over (partition by r order by a) as before from runs) u join texts using (r)),
summed as (
  select r, sum(b - a) as n_removed, count(*) as n_spans, string_agg(piece, '' order by a) as head, max(b) as last
  from kept group by r)
select doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(head, '') || substring(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
from texts left join summed using (r)
""",
    "op9_content_chunks": r"""
with texts as (select row_number() over () as r, doc_id, text from documents where doc_id is not null and text is not null),
parts as (
  select r, doc_id, unnest(regexp_extract_all(text, '[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+')) as part,
    generate_subscripts(regexp_extract_all(text, '[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+'), 1) as i from texts),
placed as (select *, sum(length(part)) over (partition by r order by i) as stop from parts),
words as (
  select r, doc_id, stop - length(part) as start, stop, row_number() over (partition by r order by i) as k
  from placed where regexp_matches(part, '[^\x20\x09-\x0D]')),
windows as (
  select a.r, a.doc_id, a.k, a.start, b.stop, substring(text, cast(a.start as int) + 1, cast(b.stop - a.start as int)) as s
  from words a join words b on a.r = b.r and b.k = a.k + 50 join texts t on t.r = a.r),
least as (select s, min(doc_id) as least from windows group by s having min(doc_id) < max(doc_id)),
held as (select w.*, least from windows w join least using (s)),
islands as (
  select *, sum(new) over (partition by r order by k) as island
  from (select *, case when k - lag(k) over (partition by r order by k) < 51 then 0 else 1 end as new from held) u)
select doc_id, cast(min(start) as bigint) as start, cast(max(stop) as bigint) as "end",
  cast(max(k) - min(k) + 51 as bigint) as n_words, min(least) as first_doc_id, min(least) = doc_id as first
from islands group by r, doc_id, island
""",
}
