"""SQL that gives the same rows as a query of this subpackage, for DuckDB."""

_PROFILES = r"""with recursive named as (
  select distinct profile_id, upper(x[1:1]) || regexp_extract(x, '(\d+)$', 1) s from (
    select profile_id, unnest(regexp_extract_all(lower(source_records), '(?:tm|apif)[\s:#_=]*(?:apif[\s_]*)?\d+')) x from profile_players_staging where profile_id is not null)
  union select profile_id, 'T' || regexp_extract(tm_id, '(\d+)', 1) from profile_players_staging where profile_id is not null and regexp_matches(tm_id, '\d')
  union select profile_id, 'A' || regexp_extract(apif_id, '(\d+)', 1) from profile_players_staging where profile_id is not null and regexp_matches(apif_id, '\d')),
near as (select distinct a.profile_id a, b.profile_id b from named a join named b on a.s = b.s),
reach(a, b) as (select a, a from near union select r.a, n.b from reach r join near n on r.b = n.a),
grouped as (select a profile_id, min(b) group_id from reach group by a having count(*) > 1),
ranked as (select g.group_id, p.*, coalesce(list_position(['VERIFIED', 'PROJECTED', 'PARTIAL', 'ORPHAN'], upper(trim(data_confidence))), 9) c from grouped g join profile_players_staging p on p.profile_id = g.profile_id),
clubs_of as (select group_id, 'current_club' field, profile_id, row_number() over (partition by group_id order by c, updated_at desc nulls last, profile_id) n from ranked where lower(trim(current_club)) not in ('', '-', 'none', 'null', 'n/a', 'unknown', 'nil', 'na')),
values_of as (select group_id, 'market_value_eur' field, profile_id, row_number() over (partition by group_id order by c, updated_at desc nulls last, profile_id) n from ranked where market_value_eur > 0)
"""

ORACLES: dict[str, str] = {
    "p1_found": _PROFILES + "select group_id, field, profile_id from clubs_of where n = 1 union all select group_id, field, profile_id from values_of where n = 1",
    "p4_found": """with recursive pairs as (select nullif(lower(trim(tm_id)), '') t, nullif(lower(trim(apif_id)), '') a from dedup_pairs_ambiguous),
      edges as (select t x, coalesce(a, t) y from pairs where t is not null union select a, coalesce(t, a) from pairs where a is not null),
      reach(x, y) as (select x, x from edges union select r.x, e.y from reach r join edges e on r.y = e.x)
      select x record_id, min(y) group_id from reach group by x""",
}
