"""Queries of the general curation operators over whole tables: nested bodies, implausible readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.operators import shred, spikes
from stepweave.session import ship, stored

#: In a body, the entries of the top object are episodes, those of ``reasoning`` steps.
BODY_MAPS = {"$", "$.{}.reasoning"}
_CHILD_OF = {
    "$.{}.features.state_3d.[]": "state_3d",
    "$.{}.features.move_primitive.[]": "move_primitive",
    "$.{}.features.gripper_position.[]": "gripper",
    "$.{}.features.gripper_positions.[]": "gripper",
    "$.{}.features.bboxes.[]": "bboxes",
    "$.{}.reasoning.{}": "reasoning",
}
_EPISODE_FIELDS = ("episode_id", "file_path", "n_steps", "language_instruction", "caption")
_REASONING_FIELDS = ("task", "plan", "subtask", "subtask_reason", "move", "move_reason")
#: What the queries look for, by path.
BODY_KNOWN = {*_CHILD_OF, *(f"$.{{}}.metadata.{c}" for c in _EPISODE_FIELDS), *(f"$.{{}}.reasoning.{{}}.{c}" for c in _REASONING_FIELDS)}


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/embodied_features_bridge.parquet")


def _body_rows(spark: SparkSession, sf: str) -> DataFrame:
    return shred.written(_bodies(spark, sf), "raw_id", "body", BODY_MAPS, BODY_KNOWN)[0]


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the child tables, with the keys that lead to them: that of the episode first, their own last."""
    rows = _body_rows(spark, sf).where(F.col("table").isin(*_CHILD_OF))
    child = F.create_map(*[F.lit(x) for kv in _CHILD_OF.items() for x in kv])[F.col("table")]
    whole = F.when(F.col("table").endswith("{}"), (F.col("kind") == "object") & (F.col("size") > 0)).otherwise(F.col("kind") != "null")
    step = F.element_at("keys", -1).try_cast("int").alias("step_index")
    return rows.where(whole).select("raw_id", F.get("keys", F.lit(0)).alias("episode_id"), child.alias("child"), step).where("step_index is not null").distinct()


def p5_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """The flat table of episodes with their inlined metadata."""
    rows = _body_rows(spark, sf).where("table = '$.{}' and kind = 'object'")
    return rows.select("raw_id", "row_id", F.get("keys", F.lit(0)).alias("episode_key"), *[F.try_element_at("columns", F.lit(f"metadata.{c}")).alias(c) for c in _EPISODE_FIELDS])


def p5_reasoning(spark: SparkSession, sf: str) -> DataFrame:
    """The flat table of reasoning steps, child rows of p5_episodes by (raw_id, parent_id)."""
    rows = _body_rows(spark, sf).where("table = '$.{}.reasoning.{}' and kind = 'object' and size > 0")
    return rows.select("raw_id", "parent_id", F.element_at("keys", -1).alias("step"), *[F.try_element_at("columns", F.lit(c)).alias(c) for c in _REASONING_FIELDS])


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    steps = spark.read.parquet(f"{sf}/steps.parquet").select(
        "episode_key", "step_index", "lab_id", "action", F.col("observation.state").alias("state"), F.col("ecot_features.state_3d").alias("state_3d")
    )
    pose = ("reach",) * 3 + ("max_angle",) * 3 + (None,)
    specs = [
        spikes.Readings("action", "action", 7, pose, (6,)),
        spikes.Readings("state", "state", 7, pose, (6,)),
        spikes.Readings("state_3d", "state_3d", 3, pose[:3]),
    ]
    labs = spark.read.parquet(f"{sf}/labs.parquet")
    return spikes.implausible_readings(steps, "episode_key", "step_index", "lab_id", specs, labs)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).select(
        F.col("entity").alias("episode_key"), F.col("pos").cast("int").alias("step_index"), "field", "dim", "kind"
    )


def p7_impossible(spark: SparkSession, sf: str) -> DataFrame:
    """The listing's readings that cannot be real, which SQL can find too."""
    return p7_found(spark, sf).where("kind = 'impossible'")


def p7_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Flagged readings per lab, field and kind, with all rows of the lab."""
    labs = spark.read.parquet(f"{sf}/steps.parquet").select("episode_key", "step_index", "lab_id").distinct()
    total = labs.groupBy("lab_id").agg(F.count("*").alias("steps"))
    of = stored(_flagged(spark, sf), "flagged").join(labs, (F.col("entity") == labs.episode_key) & (F.col("pos") == labs.step_index))
    return of.groupBy("lab_id", "field", "kind").agg(F.count("*").alias("flagged")).join(total, "lab_id")


def queries() -> dict:
    return {f.__name__: f for f in (p5_found, p5_episodes, p5_reasoning, p7_found, p7_impossible, p7_rates)}


_BODY = r"""
with docs as (select distinct raw_id, body from embodied_features_bridge where json_valid(body)),
eps as (
  select raw_id, unnest(json_keys(body)) as episode_id, body from docs where json_type(body) = 'OBJECT'),
ep as (
  select raw_id, episode_id, json_extract(body, '$."' || episode_id || '"') as e from eps),
obj as (
  select raw_id, episode_id,
    case when json_type(e -> 'features') = 'VARCHAR' and json_valid(e ->> 'features') then (e ->> 'features')::json else e -> 'features' end as f,
    case when json_type(e -> 'reasoning') = 'VARCHAR' and json_valid(e ->> 'reasoning') then (e ->> 'reasoning')::json else e -> 'reasoning' end as r,
    e -> 'metadata' as m
  from ep where json_type(e) = 'OBJECT')"""

P5_FOUND = (
    _BODY
    + r""",
feat as (
  select raw_id, episode_id, child, f -> name as a from obj,
    (values ('state_3d', 'state_3d'), ('move_primitive', 'move_primitive'), ('gripper', 'gripper_position'), ('gripper', 'gripper_positions'), ('bboxes', 'bboxes')) v(child, name)
  where json_type(f -> name) = 'ARRAY'),
items as (
  select raw_id, episode_id, child, unnest(range(json_array_length(a)::bigint)) as i, a from feat),
keys as (
  select raw_id, episode_id, unnest(json_keys(r)) as k, r from obj where json_type(r) = 'OBJECT')
select distinct raw_id, episode_id, child, i::int as step_index from items where json_type(a -> i) <> 'NULL'
union
select raw_id, episode_id, 'reasoning', k::int from keys
where json_type(json_extract(r, '$."' || k || '"')) = 'OBJECT' and len(json_keys(json_extract(r, '$."' || k || '"'))) > 0"""
)

P5_REASONING = (
    _BODY
    + r""",
keys as (
  select raw_id, episode_id, unnest(json_keys(r)) as k, r from obj where json_type(r) = 'OBJECT'),
steps as (select raw_id, episode_id, k, json_extract(r, '$."' || k || '"') as s from keys)
select raw_id, '/{' || episode_id || '}' as parent_id, k as step,
  s ->> 'task' as task, s ->> 'plan' as plan, s ->> 'subtask' as subtask, s ->> 'subtask_reason' as subtask_reason, s ->> 'move' as move, s ->> 'move_reason' as move_reason
from steps where json_type(s) = 'OBJECT' and len(json_keys(s)) > 0"""
)

P5_EPISODES = (
    _BODY
    + r"""
select raw_id, '/{' || episode_id || '}' as row_id, episode_id as episode_key, m ->> 'episode_id' as episode_id, m ->> 'file_path' as file_path,
  m ->> 'n_steps' as n_steps, m ->> 'language_instruction' as language_instruction, m ->> 'caption' as caption from obj"""
)


P7_IMPOSSIBLE = """
with st as (select distinct episode_key, step_index, lab_id, action, observation.state as state, ecot_features.state_3d as s3 from steps where episode_key is not null and step_index is not null),
u as (
  select episode_key, step_index, lab_id, 'action' as field, unnest(range(7))::int as dim, action as v from st where len(action) >= 7
  union all select episode_key, step_index, lab_id, 'state', unnest(range(7))::int, state from st where len(state) >= 7
  union all select episode_key, step_index, lab_id, 'state_3d', unnest(range(3))::int, s3 from st where len(s3) >= 3),
r as (select episode_key, step_index, field, dim, v[dim + 1]::double as x, reach, max_angle from u left join labs using (lab_id))
select episode_key, step_index, field, dim, 'impossible' as kind from r
where isnan(x) or isinf(x) or (dim < 3 and abs(x) > reach) or (dim between 3 and 5 and abs(x) > max_angle) or (dim = 6 and (x < 0 or x > 1))"""


# The median of all rows, every jump that comes back, and every run; what shows only once a spike is taken out would need another pass.
P7_FOUND = """
with st as (select distinct episode_key, step_index, lab_id, action, observation.state as state, ecot_features.state_3d as s3 from steps where episode_key is not null and step_index is not null),
u as (
  select episode_key, step_index, lab_id, 'action' as field, unnest(range(7))::int as dim, action as v from st where len(action) >= 7
  union all select episode_key, step_index, lab_id, 'state', unnest(range(7))::int, state from st where len(state) >= 7
  union all select episode_key, step_index, lab_id, 'state_3d', unnest(range(3))::int, s3 from st where len(s3) >= 3),
r as (
  select episode_key, step_index, lab_id, field, dim, v[dim + 1]::double as x, reach, max_angle, lag(v[dim + 1]::double) over w as px, row_number() over w > 1 as later
  from u left join labs using (lab_id) window w as (partition by episode_key, lab_id, field, dim order by step_index)),
m as (
  select *, isnan(x) or isinf(x) or (dim < 3 and abs(x) > reach) or (dim between 3 and 5 and abs(x) > max_angle) or (dim = 6 and (x < 0 or x > 1)) as bad,
    (later and coalesce(x <> px or isnan(x) or isnan(px), true))::int as moved,
    sum(case when dim < 6 then (later and coalesce(x <> px or isnan(x) or isnan(px), true))::int else 0 end) over (partition by episode_key, lab_id, field, step_index) as total from r),
ok as (
  select *, total > moved as others, lag(x, 2) over w as b2, lag(x) over w as b, lead(x) over w as a, lead(x, 2) over w as a2, abs(x - lag(x) over w) as d
  from m where dim < 6 and x is not null and not coalesce(bad, false) window w as (partition by episode_key, lab_id, field, dim order by step_index)),
usual as (
  select lab_id, field, dim, 10 * case when median(d) > 0 then median(d) else median(d) filter (d > 0) end as t from ok group by all),
j as (
  select ok.*, coalesce(abs(x - b) > t and abs(x - a) > t and (x - b) * (x - a) > 0 and abs(a - b) <= t, false) as one,
    coalesce(abs(x - b) > t and abs(a - a2) > t and (x - b) * (a - a2) > 0 and abs(x - a2) > t and abs(a - b) > t and (x - b) * (x - a2) > 0 and abs(a2 - b) <= t, false) as pair
  from ok join usual on ok.lab_id is not distinct from usual.lab_id and ok.field = usual.field and ok.dim = usual.dim),
f as (
  select *, pair and not one and not coalesce(lead(one) over w, false) as first, (b is null or x <> b)::int as fresh from j window w as (partition by episode_key, lab_id, field, dim order by step_index)),
g as (
  select *, one or first or coalesce(lag(first) over w, false) as spike, sum(fresh) over w as run from f window w as (partition by episode_key, lab_id, field, dim order by step_index)),
h as (
  select *, count(*) over k as n, sum(case when fresh = 0 and others then 1 else 0 end) over k as steps from g window k as (partition by episode_key, lab_id, field, dim, run))
select episode_key, step_index, field, dim, 'impossible' as kind from m where bad
union all select episode_key, step_index, field, dim, 'spike' from h where spike
union all select episode_key, step_index, field, dim, 'stuck' from h where not spike and n >= 8 and 2 * steps >= n - 1"""


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND, "p5_reasoning": P5_REASONING, "p5_episodes": P5_EPISODES, "p7_found": P7_FOUND, "p7_impossible": P7_IMPOSSIBLE}
