"""DuckDB SQL for the queries of the curation operators."""

from __future__ import annotations

_EV = """
with s as (
  select user_id, (row_number() over (partition by user_id order by ts) - 1)::bigint as step_index, event_id, event_type, value, ts,
         case when event_type = 'purchase' then json_extract_string(props, '$.k') end as d from events)"""
_SEEN = "last_value(d ignore nulls) over (partition by user_id order by step_index rows between unbounded preceding and current row)"
_FIRST = "first_value(d ignore nulls) over (partition by user_id order by step_index rows between unbounded preceding and unbounded following)"
_HAS = "count(d) over (partition by user_id) > 0"
_NEAREST = f"""
{_EV},
a as (select user_id, step_index, coalesce({_SEEN}, {_FIRST}) as task, (case when d is not null then 1.0 when {_HAS} then 0.7 else 0.0 end)::double as alignment_confidence from s)"""

# Delivered episodes and steps, each once.
_DEMO = r"""
demo as (
  select distinct episode_key, episode_metadata.file_path as file_path, episode_metadata.episode_id as episode_id, split, n_steps, schema_version,
    regexp_replace(replace(episode_metadata.file_path, '\', '/'), '^/+', '') as path_key from episodes),
demos as (
  select *, case when episode_id <> -1 then path_key || '_' || episode_id::varchar end as join_key from demo)"""
_NOTE = r"""
docs as (select distinct raw_id, file_path, body from embodied_features_bridge where json_valid(body)),
eps as (select raw_id, file_path, body, unnest(json_keys(body)) as eid from docs where json_type(body) = 'OBJECT'),
ent as (select raw_id, file_path, eid, json_extract(body, '$."' || eid || '"') as e from eps),
notes as (
  select raw_id, file_path, eid, regexp_replace(replace(file_path, '\', '/'), '^/+', '') as path_key,
    regexp_replace(replace(file_path, '\', '/'), '^/+', '') || '_' || eid as join_key, e from ent where json_type(e) = 'OBJECT')"""
_STEPS = """
st as (
  select distinct episode_key, step_index, action, observation.state as state, language_instruction, is_first, is_last, ecot_features.state_3d as state_3d,
    ecot_features.gripper_position as gripper_position, ecot_features.move_primitive as move_primitive, ecot_features.caption as caption from steps)"""


def _finite(x: str, places: int = 6) -> str:
    return f"round(case when not isnan({x}::double) and abs({x}::double) < 1e30 then {x}::double end, {places})"


def _overlap(left: str, right: str) -> str:
    return f"""l as (select distinct {left}), r as (select distinct {right}), j as (
  select l.key as lk, r.key as rk from (select * from l where key is not null) l full join (select * from r where key is not null) r on l.key = r.key)
select count(lk) as left_keys, count(rk) as right_keys, count(*) filter (lk is not null and rk is not null) as both,
  count(lk) - count(*) filter (lk is not null and rk is not null) as only_left, count(rk) - count(*) filter (lk is not null and rk is not null) as only_right,
  count(*) as either, coalesce(round((count(lk) - count(*) filter (lk is not null and rk is not null)) * 100.0::double / nullif(count(lk), 0), 1), 0.0) as share_only_left from j"""


def _validation(episodes: str, steps: str, order: str, min_coverage: float) -> str:
    """The rules over CTEs ep(key, episode_id, schema_version, task_description, strategy, declared_steps) and st0(key, ...)."""
    return f"""
ep as ({episodes}),
st0 as ({steps}),
sp as (select *, (row_number() over (partition by key order by {order}) - 1)::int as pos from st0),
per as (
  select key, count(*) as n_steps,
    list('step_index mismatch at position ' || pos || ': expected ' || pos || ', got ' || coalesce(step_index::varchar, 'None') || '.' order by pos)
      filter (step_index is distinct from pos) as idx,
    list('Step ' || pos || ': action shape is (' || coalesce(len(action), 0) || ',), expected (7,).' order by pos) filter (coalesce(len(action), 0) <> 7) as shp,
    count(*) filter (is_first) as n_first, count(*) filter (is_last) as n_last, min(pos) filter (is_first) as first_at, max(step_index) filter (is_last) as last_at,
    avg(case when coalesce(len(list_filter(action, lambda x: not coalesce(abs(x) <= 1e-8 and not isnan(x), false))) = 0, false) then 1.0 else 0.0 end) as zero_share,
    avg(case when has_trace then 1.0 else 0.0 end) as coverage
  from sp group by key),
j as (select ep.*, coalesce(n_steps, 0) as ns, idx, shp, n_first, n_last, first_at, last_at, zero_share, coalesce(coverage, 0) as coverage from ep left join per using (key)),
msg as (
  select *,
    list_concat(list_concat(list_concat(
      list_filter([case when coalesce(episode_id, '') = '' then 'episode_id is empty.' end, case when ns < 1 then 'Episode has ' || ns || ' steps; minimum is 1.' end], lambda m: m is not null),
      coalesce(idx, [])),
      list_filter([
        case when ns > 0 and n_first <> 1 then 'Expected exactly 1 is_first step, found ' || n_first || '.' when ns > 0 and first_at <> 0 then 'is_first is not on step 0.' end,
        case when ns > 0 and n_last <> 1 then 'Expected exactly 1 is_last step, found ' || n_last || '.' when ns > 0 and last_at <> ns - 1 then 'is_last is not on the last step.' end], lambda m: m is not null)),
      coalesce(shp, [])) as errs,
    list_filter([
      case when coalesce(schema_version, '') = '' then 'schema_version is not set.' end,
      case when ns > 0 and zero_share > 0.5 then round_even(zero_share * 100, 0)::int || '% of actions are all-zeros — possible data issue.' end,
      case when declared_steps > 0 and declared_steps <> ns then 'Step count ' || ns || ' differs from the declared ' || declared_steps || '.' end,
      case when coalesce(strategy not in ('exact', 'nearest', 'broadcast'), true) then 'Unknown alignment strategy: ' || coalesce(strategy, 'None') || '.' end,
      case when coalesce(task_description, '') = '' then 'task_description is empty.' end,
      case when coverage < {min_coverage} then 'Reasoning coverage is below {min_coverage}.' end], lambda m: m is not null) as warns
  from j)"""


_ORDERS = "with " + _validation(
    """select o_orderkey as key, o_orderkey::varchar as episode_id, case when o_orderstatus <> 'P' then '1.0' end as schema_version,
       case when o_orderpriority <> '5-LOW' then o_orderpriority else '' end as task_description,
       case o_orderstatus when 'O' then 'nearest' when 'F' then 'exact' else 'other' end as strategy, 4 as declared_steps from orders""",
    """select l_orderkey as key, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_linenumber - 1 as step_index, l_linenumber = 1 as is_first, l_returnflag = 'N' as is_last,
       list_transform(range(case when l_quantity > 5 then 7 else 3 end), lambda i: l_discount::float) as action, l_tax > 0.02 as has_trace from lineitem""",
    "l_linenumber, l_partkey, l_suppkey, l_shipdate",
    0.25,
)
_DEMOS = f"with {_DEMO}, {_STEPS}," + _validation(
    "select episode_key as key, file_path as episode_id, schema_version, split as task_description, 'nearest' as strategy, n_steps as declared_steps from demos",
    "select episode_key as key, step_index, action, is_first, is_last, coalesce(move_primitive <> '', false) as has_trace from st",
    "step_index",
    0.0,
)

_CURATED = (
    f"with {_DEMO}, {_NOTE}, {_STEPS},"
    + r"""
parts as (
  select join_key, e,
    case when json_type(e -> 'reasoning') = 'OBJECT' then e -> 'reasoning' end as r,
    case when json_type(e -> 'features') = 'OBJECT' then e -> 'features' end as f from notes),
sized as (
  select *, coalesce(nullif(try_cast(e -> 'metadata' ->> 'n_steps' as int), 0), nullif(len(json_keys(r)), 0), 1)::int as n from parts),
dense as (select join_key, unnest(range(n))::int as step_index, r, f from sized),
picked as (
  select join_key, step_index, json_extract(r, '$."' || step_index || '"') as t, f ->> ('$.move_primitive[' || step_index || ']') as note_move from dense),
typed as (
  select join_key, step_index, note_move,
    t ->> 'task' as task, t ->> 'plan' as plan, t ->> 'subtask' as subtask, t ->> 'subtask_reason' as subtask_reason, t ->> 'move' as move, t ->> 'move_reason' as move_reason,
    json_type(t) = 'OBJECT' as obj from picked),
traces as (
  select join_key, step_index, note_move,
    case when obj and (task is not null or plan is not null or subtask is not null or subtask_reason is not null or move is not null or move_reason is not null)
      then {'task': coalesce(task, ''), 'plan': coalesce(plan, ''), 'subtask': coalesce(subtask, ''), 'subtask_reason': coalesce(subtask_reason, ''), 'move': coalesce(move, ''), 'move_reason': coalesce(move_reason, '')} end as trace
  from typed),
ranked as (
  select * from traces qualify row_number() over (partition by join_key, step_index order by trace is null, trace.task desc, trace.plan desc, trace.subtask desc, trace.subtask_reason desc, trace.move desc, trace.move_reason desc, note_move desc nulls last) = 1),
base as (
  select st.episode_key, st.step_index, k.trace, coalesce(k.note_move, '') as note_move
  from st join demos using (episode_key) left join ranked k on k.join_key = demos.join_key and k.step_index = st.step_index
  where demos.join_key in (select join_key from ranked)),
cur as (
  select episode_key, step_index, note_move, trace is not null as direct,
    coalesce(last_value(trace ignore nulls) over (partition by episode_key order by step_index rows between unbounded preceding and current row),
             first_value(trace ignore nulls) over (partition by episode_key order by step_index rows between unbounded preceding and unbounded following)) as tr, trace
  from base),
conf as (select *, (case when direct then 1.0 when tr is not null then 0.7 else 0.0 end)::double as c from cur)"""
)
_FIRST_TEXT = "own as (select episode_key, min_by(language_instruction, step_index) filter (coalesce(language_instruction, '') <> '') as instruction from st group by episode_key)"


def _spread(kind: str, n: int) -> str:
    spread = f"list_transform(range({n}), lambda i: {kind}(i * ((n - 1) / {n - 1}.0)))"
    return f"array_to_string(list_transform({spread}, lambda x: x::int::varchar), ',')"


_KEYFRAME = f"""
with {_STEPS},
lagged as (
  select episode_key, step_index, action as a, lag(action) over w as b, row_number() over w - 1 as pos, lead(1) over w is null as fin from st
  window w as (partition by episode_key order by step_index)),
d as (
  select *, abs(a[7] - b[7])::double as g,
    sqrt(pow((a[1] - b[1])::double, 2) + pow((a[2] - b[2])::double, 2) + pow((a[3] - b[3])::double, 2)) as m from lagged),
k as (
  select episode_key, count(*) as n_steps,
    list(pos order by pos) filter (fin or pos = 0 or coalesce(g > 0.05 and not isnan(g), false) or coalesce(m > 0.05 and not isnan(m), false)) as frames from d group by episode_key)"""


def oracle_sql() -> dict[str, str]:
    out = {
        "align_nearest": f"{_NEAREST} select * from a",
        "align_exact": f"{_EV} select user_id, step_index, d as task, (case when d is not null then 1.0 else 0.0 end)::double as alignment_confidence from s",
        "align_broadcast": f"{_EV} select user_id, step_index, {_FIRST} as task, (case when d is not null then 1.0 when {_HAS} then 0.7 else 0.0 end)::double as alignment_confidence from s",
        "confidence_hist": f"{_NEAREST} select case when alignment_confidence >= 0.95 then 'direct' when alignment_confidence >= 0.4 then 'propagated' else 'none' end as band, count(*) as steps from a group by 1",
        "dedupe_last_wins": "select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
        "coverage_by_user": f"{_EV} select user_id, count(*) as steps, count(d) as annotated, count(d) / count(*)::double as coverage from s group by user_id",
        "trace_quality": """select count(*) as total, count(*) as annotated, 1.0::double as coverage,
            count(*) filter (coalesce(title, '') <> '' and coalesce(editor, '') <> '' and coalesce(edit_note, '') <> '') as complete,
            count(*) filter (coalesce(title, '') <> '' and coalesce(editor, '') <> '' and coalesce(edit_note, '') <> '') / count(*)::double as completeness_rate from documents""",
        "phase_segments": f"""{_EV}, b as (select user_id, step_index, coalesce(value > 20, false) as above from s),
            f as (select *, coalesce((lag(above) over (partition by user_id order by step_index) <> above)::int, 0) as flip from b),
            p as (select *, sum(flip) over (partition by user_id order by step_index)::bigint as phase from f)
            select user_id, phase, above, min(step_index) as start_pos, max(step_index) + 1 as end_pos, count(*) as n from p group by user_id, phase, above""",
        "context3": f"{_EV} select user_id, step_index, coalesce(array_to_string(list(event_type) over (partition by user_id order by step_index rows between 3 preceding and 1 preceding), ','), '') as context from s",
        "limit_after_filter": f"{_EV} select user_id, count(*) as steps from s group by user_id having count(d) > 0 order by user_id limit 20",
        "resume_anti": "select user_id, count(*) as events from events where user_id not in (select user_id from events where event_type = 'purchase' and value > 200) group by user_id",
        "json_props": "select event_id, json_extract_string(props, '$.k')::int as k from events",
        "match_inner": "select o_orderkey, o_custkey as join_key, c_name from orders join customer on o_custkey = c_custkey",
        "match_left_full": "select c_custkey as join_key, c_name, count(o_orderkey) as n_orders from customer left join orders on o_custkey = c_custkey group by all",
        "unmatched_anti": "select c_custkey as join_key, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P' and o_orderpriority like '1%')",
        "match_counts": """select count(*) as demonstrations, count(o.k) as matched, count(*) - count(o.k) as unmatched, round_even(count(o.k) / count(*)::double, 4) as match_rate
            from customer left join (select distinct o_custkey as k from orders) o on c_custkey = o.k""",
        "key_overlap": "with " + _overlap("user_id as key from events", "c_custkey as key from customer"),
        "keys_union": "select distinct o_custkey as key from orders where o_orderstatus in ('F', 'P')",
        "keys_common": "select o_custkey as key from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'P'",
        "keys_except": "select o_custkey as key from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'P'",
        "match_demo_annotations": f"with {_DEMO}, {_NOTE} select episode_key, join_key, notes from demos join (select join_key, count(*) as notes from notes group by join_key) n using (join_key)",
        "match_key_or_path": f"""with {_DEMO}, {_NOTE}, k as (select join_key, max(episode_key) as ke from demos where join_key is not null group by join_key), p as (select path_key, max(episode_key) as pe from demos group by path_key)
            select n.join_key, coalesce(ke, pe) as episode_key, case when ke is not null then 'key' else 'path' end as matched_by
            from notes n left join k on n.join_key = k.join_key left join p on n.path_key = p.path_key where coalesce(ke, pe) is not null""",
        "demo_key_overlap": f"with {_DEMO}, {_NOTE}, " + _overlap("join_key as key from notes", "join_key as key from demos"),
        "composite_key": f"with {_DEMO} select episode_key, path_key, join_key from demos",
        "split_counts": f"""with {_DEMO}, {_NOTE}, x as (select coalesce(split, 'none') as split, coalesce(join_key in (select join_key from notes), false) as noted from demos)
            select case when grouping(split) = 1 then 'Total' else split end as split, count(*) as written, count(*) filter (noted) as with_reasoning, count(*) filter (not noted) as without_reasoning from x group by rollup(split)""",
        "curated_steps": f"{_CURATED} select episode_key, step_index, tr.subtask as subtask, tr.move as move, note_move, c as alignment_confidence from conf",
        "curated_coverage": f"""{_CURATED} select episode_key, count(*) as steps, count(tr) as with_trace, count(*) filter (direct) as direct,
            count(*) filter (tr.task <> '' or tr.plan <> '' or tr.subtask <> '' or tr.subtask_reason <> '' or tr.move <> '' or tr.move_reason <> '') as with_text, round(avg(c), 6) as mean_confidence from conf group by episode_key""",
        "coverage_matrix": f"""{_CURATED} select episode_key, count(*) filter (trim(trace.task) <> '') as n_task_reasoning, count(*) filter (trim(trace.subtask) <> '') as n_subtask_reasoning,
            count(*) filter (trim(trace.move) <> '') as n_move_reasoning from conf group by episode_key""",
        "first_instruction": f"with {_STEPS}, {_FIRST_TEXT} select episode_key, instruction from own",
        "task_texts": f"""with {_DEMO}, {_NOTE}, {_STEPS}, {_FIRST_TEXT}, nt as (select join_key, min(coalesce(e -> 'metadata' ->> 'language_instruction', '')) as note from notes group by join_key)
            select d.episode_key, coalesce(nullif(instruction, ''), nullif(note, ''), '') as task from demos d left join own on own.episode_key = d.episode_key left join nt on nt.join_key = d.join_key""",
        "export_projection": f"with {_STEPS} select episode_key, step_index, "
        + ", ".join(_finite(f"(case when action is null or {i + 1} > len(action) then 0::float else action[{i + 1}] end)") + f" as a{i}" for i in range(7))
        + ", "
        + ", ".join(_finite(f"(case when state_3d is null or {i + 1} > len(state_3d) then 0::float else state_3d[{i + 1}] end)") + f" as p{i}" for i in range(3))
        + ", least(2, coalesce(len(gripper_position), 0))::int as n_grip, coalesce(move_primitive, '') as move, coalesce(caption, '') as caption, '' as task from st",
        "sample_uniform": f"""with c as (select l_orderkey, count(*)::int as n from lineitem group by 1)
            select l_orderkey, case when n <= 5 then array_to_string(list_transform(range(n), lambda x: x::varchar), ',') else {_spread("round_even0", 5)} end as frames from c""".replace("round_even0(i * ((n - 1) / 4.0))", "round_even(i * ((n - 1) / 4.0::double), 0)"),
        "sample_linspace": f"with c as (select l_orderkey, count(*)::int as n from lineitem group by 1) select l_orderkey, {_spread('floor', 4)} as frames from c".replace("/ 3.0)", "/ 3.0::double)"),
        "sample_keyframe": f"{_KEYFRAME} select episode_key, n_steps, array_to_string(list_transform(frames, lambda x: x::varchar), ',') as frames from k",
        "sample_keyframe8": f"""{_KEYFRAME} select episode_key, n_steps, array_to_string(list_transform(case when len(frames) > 8 then
            list_filter(list_transform(range(8), lambda i: frames[(round_even(i * (len(frames) / 8.0::double), 0)::int) + 1]), lambda x: x is not null) else frames end, lambda x: x::varchar), ',') as frames from k""",
        "phase_transitions": f"""with {_STEPS}, g as (select episode_key, step_index, coalesce(case when not isnan(state[7]) then state[7]::double > 0.5 end, false) as closed from st),
            l as (select *, lag(closed) over (partition by episode_key order by step_index) as was from g) select episode_key, step_index, closed from l where was <> closed""",
        "cumulative_path": f"with {_STEPS} select episode_key, step_index, "
        + ", ".join(f"round(sum(coalesce({_finite(f'action[{k + 1}]')}, 0)) over (partition by episode_key order by step_index rows unbounded preceding), 6) as p{k}" for k in range(3))
        + " from st",
        "action_components": f"with {_STEPS} select episode_key, step_index, "
        + ", ".join(_finite(f"action[{k + 1}]") + f" as {n}" for k, n in enumerate(("x", "y", "z", "roll", "pitch", "yaw")))
        + f", case when {_finite('action[7]')} > 0.5 then 'CLOSE' when {_finite('action[7]')} is not null then 'OPEN' end as gripper from st",
        "nested_order": "select l_orderkey, array_to_string(list(l_partkey::varchar order by l_linenumber, l_partkey, l_suppkey, l_shipdate), ',') as parts from lineitem group by 1",
        "split_rollup": """select case when grouping(l_linestatus) = 1 then 'Total' else l_linestatus end as l_linestatus, count(*) as written, count(*) filter (l_returnflag = 'R') as with_reasoning,
            count(*) filter (l_returnflag <> 'R') as without_reasoning from lineitem group by rollup(l_linestatus)""",
        "validate_orders": f"{_ORDERS} select key, array_to_string(errs, '|') as errors, array_to_string(warns, '|') as warnings, len(errs) = 0 as passed, round(zero_share, 6) as zero_action_fraction, round(coverage, 6)::double as reasoning_coverage from msg",
        "validation_report": f"""{_ORDERS} select count(*) as total, count(*) filter (len(errs) = 0) as passed, count(*) filter (len(errs) > 0) as failed, count(*) filter (len(warns) > 0) as with_warnings,
            round(count(*) filter (len(errs) = 0) / count(*)::double, 6) as pass_rate,
            count(*) filter (len(errs) = 0) || '/' || count(*) || ' episodes passed (' || round_even(count(*) filter (len(errs) = 0) / count(*)::double * 100, 0)::int || '%)' as summary from msg""",
        "failed_first10": f"{_ORDERS} select key, len(errs)::int as n_errors from msg where len(errs) > 0 order by key limit 10",
        "passed_lines": f"{_ORDERS} select l_orderkey as key, count(*) as lines from lineitem where l_orderkey in (select key from msg where len(errs) = 0) group by 1",
        "validate_demos": f"{_DEMOS} select key, array_to_string(errs, '|') as errors, array_to_string(warns, '|') as warnings, len(errs) = 0 as passed, round(coverage, 6)::double as reasoning_coverage from msg",
        "clean_field": r"""with c as (select doc_id, trim(edit_note, e' \t\n\r') as n, trim(lang, e' \t\n\r') as l from documents),
            p as (select *, '^(n/a|na|unknown|none|not applicable|no information|not enough information|unclear|unspecified|[.]+|-)$' as pat from c)
            select doc_id, case when n <> '' and not regexp_matches(lower(n), pat) then n end as note, coalesce(regexp_matches(lower(n), pat), false) as placeholder,
              case when l <> '' and not regexp_matches(lower(l), pat) then l end as lang from p""",
        "filled_fields": """with f as (select doc_id, list_filter([case when title <> '' then 'title' end, case when editor <> '' then 'editor' end, case when edit_note <> '' then 'edit_note' end, case when lang <> '' then 'lang' end], lambda x: x is not null) as l from documents)
            select doc_id, array_to_string(l, ',') as filled, len(l) = 4 as complete, len(l) = 0 as empty from f""",
        "safe_path": rf"with {_DEMO} select episode_key, trim(translate(file_path, '/\:', '___'), '_') as folder, 'step_00007.png' as image from demos",
        "previews": """select doc_id, case when length(title) > 12 then left(title, 12) || '...' else title end as start, case when length(title) > 12 then '...' || right(title, 12) else title end as rest,
            nullif(concat_ws(e'\\n', case when title <> '' then 'Subtask: ' || title end, case when edit_note <> '' then 'Move: ' || edit_note end, case when editor <> '' then 'Gripper: ' || editor end), '') as lines from documents""",
        "pad7": "select vec_id, " + ", ".join(f"round((case when {i} < 5 then embedding[{i + 1}] else 0 end)::double, 6) as v{i}" for i in range(7)) + ", round(embedding[3]::double, 6) as s2, 1 as n_g, 3 as n_s from embeddings",
        "pad512": "select vec_id, 512 as n, round(list_sum(list_transform(embedding, lambda x: x::double)), 4) as total, 0.0::double as last from embeddings",
        "embedding_norm": "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 5) as norm, len(list_filter(embedding, lambda x: abs(x) > 1e-8)) = 0 as zero from embeddings",
        "usage_totals": """with g as (select distinct result_id, model, usage, finish_reason from generation_results)
            select model as by_model, count(*) as results, sum(coalesce(usage.prompt_tokens, 0))::bigint as prompt_tokens, sum(coalesce(usage.completion_tokens, 0))::bigint as completion_tokens,
              sum(coalesce(usage.total_tokens, coalesce(usage.prompt_tokens, 0) + coalesce(usage.completion_tokens, 0)))::bigint as total_tokens, count(*) filter (finish_reason = 'stop') as complete from g group by model""",
        "missing_frames": r"""with p as (select distinct prompt_id, list_transform(string_split(regexp_extract(text, '\(frames \[([0-9, ]+)\]\)', 1), ', '), lambda x: try_cast(x as int)) as f from prompts where regexp_matches(text, '\(frames \[([0-9, ]+)\]\)')),
            g as (select distinct result_id, prompt_id, text from generation_results where text is not null),
            m as (select result_id, list_filter(f, lambda x: not list_contains(list_transform(regexp_extract_all(text, '"frame_index": ([0-9]+)', 1), lambda y: try_cast(y as int)), x)) as missing from g join p using (prompt_id))
            select result_id, array_to_string(list_transform(missing, lambda x: x::varchar), ',') as missing, len(missing)::int as n_missing from m""",
        "parse_strict": r"""with p as (select distinct prompt_id, list_transform(string_split(regexp_extract(text, '\(frames \[([0-9, ]+)\]\)', 1), ', '), lambda x: try_cast(x as int)) as f from prompts where regexp_matches(text, '\(frames \[([0-9, ]+)\]\)')),
            g as (select distinct result_id, prompt_id, text::json as j from generation_results where text is not null and json_valid(text)),
            a as (select result_id, f, j, list_transform(range(json_array_length(j)::bigint), lambda i: try_cast(json_extract_string(j, '$[' || i || '].frame_index') as int)) as named from g join p using (prompt_id) where json_type(j) = 'ARRAY' and json_array_length(j) > 0),
            ok as (select * from a where len(list_filter(named, lambda x: x is null or not list_contains(f, x))) = 0 and len(list_distinct(named)) = len(named)),
            st as (select result_id, unnest(f) as step_index, j, named from ok),
            it as (select result_id, step_index, json_extract(j, '$[' || (list_position(named, step_index) - 1) || ']') as e from st)
            select result_id, step_index, nullif(trim(coalesce(nullif(trim(e ->> 'task_reasoning'), ''), e ->> 'task', '')), '') as task_reasoning, nullif(trim(coalesce(nullif(trim(e ->> 'move_reasoning'), ''), e ->> 'movement', '')), '') as move_reasoning,
              nullif(trim(coalesce(nullif(trim(e ->> 'gripper_reasoning'), ''), e ->> 'gripper', '')), '') as gripper_reasoning from it""",
        "mock_generate": f"""with {_STEPS}, {_FIRST_TEXT}, c as (select episode_key, count(*) as n from st group by 1),
            f as (select episode_key, n, case when n <= 4 then range(n) else list_transform(range(4), lambda i: round_even(i * ((n - 1) / 3.0::double), 0)::bigint) end as fr from c),
            q as (select episode_key, fr, 'Task: "' || coalesce(instruction, '') || e'"\\n\\nThe episode has ' || n || ' steps. You see ' || len(fr) || ' of them (frames [' || array_to_string(list_transform(fr, lambda x: x::varchar), ', ') ||
              e']).\\n\\nDescribe each frame as the system prompt asks.' as text from f join own using (episode_key))
            select episode_key, step_index, 'task ' || sha256(text)[1:8] as task_reasoning, case when list_contains(fr, step_index) then 1.0::double else 0.7::double end as alignment_confidence from st join q using (episode_key)""",
        "prompt_text": f"""with {_STEPS}, {_FIRST_TEXT}, c as (select episode_key, count(*) as n from st group by 1),
            f as (select episode_key, n, list_transform(case when n <= 4 then range(n) else list_transform(range(4), lambda i: round_even(i * ((n - 1) / 3.0::double), 0)::bigint) end, lambda x: x::varchar) as fr from c)
            select episode_key, 'Task: "' || coalesce(instruction, '') || e'"\\n\\nThe episode has ' || n || ' steps. You see ' || len(fr) || ' of them (frames [' || array_to_string(fr, ', ') ||
              e']).\\n\\nDescribe each frame as the system prompt asks.' as text, n as n_steps from f join own using (episode_key)""",
    }
    return out
