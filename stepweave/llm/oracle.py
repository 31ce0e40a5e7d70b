"""ANSI SQL with the same results as the queries, where SQL can give them."""

from __future__ import annotations

_INSTRUCTION = r"""
first_text as (
  select episode_key, min_by(language_instruction, (step_index, language_instruction)) as text
  from steps where regexp_matches(language_instruction, '[\p{L}\p{N}]') and step_index is not null and episode_key is not null
  group by episode_key)"""

_SESSION = r"""
paths as (
  select distinct episode_key,
    regexp_extract(regexp_replace(regexp_replace(lower(replace(episode_metadata.file_path, '\', '/')), '\s+', '', 'g'), '/+', '/', 'g'),
                   '(?:^|/)([^/]+/[^/]+/s[0-9]+)(?:/|$)', 1) as session,
    episode_metadata.episode_id as known_id
  from episodes where episode_key is not null)"""

P2_FOUND = f"""
with recursive {_SESSION},
ties as (
  select distinct a.episode_key as x, b.episode_key as y from paths a join paths b
  on (a.session = b.session and a.session <> '') or (a.known_id = b.known_id and a.known_id <> -1)),
reach(x, y) as (
  select x, y from ties
  union
  select reach.x, ties.y from reach join ties on reach.y = ties.x)
select min(y) as head_key, x as member_key from reach group by x having min(y) <> x"""

# levenshtein() counts bytes here, so that each word of a pair becomes one byte; pairs have far fewer than 94 different words.
P3_FOUND = rf"""
with {_INSTRUCTION},
words as (
  select episode_key, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') as w from first_text),
sides as (
  select distinct words.episode_key, split = 'train' as train, w,
    array_to_string(list_transform(w, lambda t: t), ' ') as flat
  from words join episodes using (episode_key) where split in ('train', 'val', 'test')),
pairs as (
  select t.episode_key as a, e.episode_key as b, list_distinct(list_concat(t.w, e.w)) as voc, t.w as tw, e.w as ew
  from sides t join sides e on t.train and not e.train and abs(len(t.w) - len(e.w)) <= 3
  where len(list_intersect(t.w, e.w)) + 3 >= least(len(list_distinct(t.w)), len(list_distinct(e.w))))
select least(a, b) as key_a, greatest(a, b) as key_b from pairs
where levenshtein(array_to_string(list_transform(tw, lambda x: chr(32 + list_position(voc, x)::int)), ''),
                  array_to_string(list_transform(ew, lambda x: chr(32 + list_position(voc, x)::int)), '')) <= 3"""

P3_REPORT = (
    P3_FOUND.split("select least(a, b)")[0].rstrip()
    + rf""",
near as (
  select distinct b as episode_key from pairs
  where levenshtein(array_to_string(list_transform(tw, lambda x: chr(32 + list_position(voc, x)::int)), ''),
                    array_to_string(list_transform(ew, lambda x: chr(32 + list_position(voc, x)::int)), '')) <= 3),
exact as (select distinct e.episode_key from sides t join sides e on t.train and not e.train and t.flat = e.flat),
ev as (
  select episode_key, min(split) as split, min(episode_metadata.file_path) as path from episodes where split in ('train', 'val', 'test') group by episode_key having min(split) <> 'train'),
src as (
  select episode_key, split,
    regexp_extract(regexp_replace(regexp_replace(lower(replace(path, '\', '/')), '\s+', '', 'g'), '/+', '/', 'g'), '(?:^|/)([^/]+)/[^/]+/s[0-9]+(?:/|$)', 1) as source
  from ev where episode_key in (select episode_key from first_text))
select split, source, count(*) as records, count(*) filter (episode_key in (select episode_key from exact)) as exact,
  count(*) filter (episode_key in (select episode_key from near)) as near_or_exact
from src group by split, source"""
)

_P4 = rf"""
with {_INSTRUCTION},
canon as (
  select 'steps' as origin, episode_key as id, lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]+', '', 'g')) as c from first_text
  union
  select 'metadata', record_id,
    array_to_string(list_sort(list_transform(json_keys(metadata), lambda k:
      k || '=' || lower(regexp_replace(coalesce(json_extract_string(metadata, '$."' || k || '"'), ''), '[^\p{{L}}\p{{N}}]+', '', 'g')))), '|')
  from metadata_records where record_id is not null and metadata is not null),
grouped as (select origin, id, min(id) over (partition by origin, c) as keep_id from canon)"""

P4_FOUND = _P4 + " select origin, keep_id, id as copy_id from grouped where id <> keep_id"
P4_COLLAPSED = _P4 + " select origin, keep_id, count(*) as copies from grouped group by all"

_RUNS = r"""
with raw as (
  select distinct episode_key, step_index, recorded_at,
    list_sort(list_filter(regexp_split_to_array(lower(ecot_features.move_primitive), '[^\p{L}\p{N}]+'), lambda w: w <> '')) as words
  from steps where episode_key is not null and step_index is not null),
named as (select *, case when len(words) > 0 then array_to_string(words, ' ') end as form from raw),
forms as (select form, any_value(words) as words, count(*) as n
          from (select list_sort(list_filter(regexp_split_to_array(lower(ecot_features.move_primitive), '[^\p{L}\p{N}]+'), lambda w: w <> '')) as words,
                       array_to_string(words, ' ') as form from steps where episode_key is not null and step_index is not null) where form <> '' group by form),
near as (
  select a.form, max((b.n, b.form)) as best, max(a.n) as n from forms a join forms b on len(a.words) = len(b.words) and a.form <> b.form
  where len(list_filter(a.words, lambda w: not list_contains(b.words, w))) = 1
    and len(list_filter(b.words, lambda w: not list_contains(a.words, w))) = 1
    and levenshtein(list_filter(a.words, lambda w: not list_contains(b.words, w))[1],
                    list_filter(b.words, lambda w: not list_contains(a.words, w))[1]) = 1
  group by a.form),
moved as (select form, best[2] as canon from near where best > (n, form)),
one as (
  select episode_key, step_index, coalesce(canon, named.form) as label, recorded_at from named left join moved using (form)
  qualify row_number() over (partition by episode_key, step_index order by named.form is null, coalesce(canon, named.form), recorded_at) = 1),
marked as (
  select *, step_index - row_number() over (partition by episode_key, label order by step_index) as island from one where label is not null),
runs as (
  select episode_key, min(step_index) as start_step, max(step_index) as end_step, label, count(*) as n_steps,
    round((epoch_us(max_by(recorded_at, step_index)) - epoch_us(min_by(recorded_at, step_index))) / 1e6, 6) as duration_s
  from marked group by episode_key, label, island)"""

P6_FOUND = _RUNS + " select episode_key, start_step, end_step from runs where n_steps > 1"
P6_COLLAPSED = _RUNS + " select episode_key, start_step, label, n_steps, duration_s from runs"


P8_OVER = "select kind, pack_name, 0::bigint as over from pack_sizes, (values ('documents'), ('pairs')) k(kind) where pack_name is not null and capacity_tokens > 0"


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": P2_FOUND, "p3_found": P3_FOUND, "p3_report": P3_REPORT, "p4_found": P4_FOUND, "p4_collapsed": P4_COLLAPSED, "p6_found": P6_FOUND, "p6_collapsed": P6_COLLAPSED, "p8_over": P8_OVER, "p2_apart": "select 0::bigint as apart",
    }
