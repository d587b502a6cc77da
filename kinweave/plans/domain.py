"""Queries over the player tables: exact and fuzzy linkage, staging, curation, coverage; each with SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions import nulls, text
from kinweave.operators import dml, exact, fuzzy, quality, ranking, readonly, reconcile, records
from kinweave.plans.relational import table
from kinweave.sources import literals, sinks
from kinweave.storage import shared_root
from kinweave.streaming import live

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _plain_lower(c):
    """Lower case with İ as i: Java leaves a combining dot."""
    return F.translate(F.lower(c), "\u0307", "")


_STRIP = f"lower(translate(list_extract(string_split(name, ' '), -1), '{text.REF_FROM}', '{text.REF_TO}'))"
_RICH = f"with p as (select distinct id, name, date_of_birth, nationality, position, market_value_eur, current_club_name, case when id like 'apif_%' then 'APIF' else 'TM' end source, {_STRIP} k from pipeline_players where name is not null and date_of_birth is not null and nationality is not null), ids as (select distinct id, source, k, date_of_birth, lower(nationality) n, max(nationality) over (partition by id) nationality from p), pairs as (select distinct t.id tm_id, a.id apif_id from ids t join ids a on t.k = a.k and t.date_of_birth = a.date_of_birth and t.n = a.n where t.source = 'TM' and a.source = 'APIF')"
_MULTI = ", mt as (select tm_id from pairs group by 1 having count(*) > 1), ma as (select apif_id from pairs group by 1 having count(*) > 1), good as (select * from pairs where tm_id not in (select tm_id from mt) and apif_id not in (select apif_id from ma))"


def _pairs(s, d) -> DataFrame:
    """Pairs of the two sources that agree in the last word of the name, the birth date and the nationality."""
    p = table(s, d, "pipeline_players").where("name is not null and date_of_birth is not null and nationality is not null")
    keyed = p.select("id", F.lower(text.strip_accents_ref(text.last_token(F.col("name")))).alias("k"), "date_of_birth", F.lower("nationality").alias("n")).distinct()
    second = F.col("id").like("apif_%")
    tm, apif = keyed.where(~second).withColumnRenamed("id", "tm_id"), keyed.where(second).withColumnRenamed("id", "apif_id")
    return exact.equi_pairs(tm, apif, ["k", "date_of_birth", "n"]).select("tm_id", "apif_id").distinct()


@query(_RICH + " select * from pairs")
def tier2_pairs(s, d):
    return _pairs(s, d)


@query(_RICH + _MULTI + " select * from pairs where tm_id in (select tm_id from mt) or apif_id in (select apif_id from ma)")
def tier2_ambiguous(s, d):
    return exact.quarantined(_pairs(s, d), "tm_id", "apif_id")


@query(_RICH + _MULTI + " select * from good")
def tier2_clean(s, d):
    return exact.clean(_pairs(s, d), "tm_id", "apif_id")


@query(_RICH + _MULTI + ' select \'tm\' "check", tm_id "key", count(*) n from good group by 2 having count(*) > 1 union all select \'apif\', apif_id, count(*) from good group by 2 having count(*) > 1 union all select \'checked\', \'pairs\', count(*) from good')
def kill_switch(s, d):
    good = exact.clean(_pairs(s, d), "tm_id", "apif_id")
    return exact.duplicates(good, "tm_id", "tm").unionAll(exact.duplicates(good, "apif_id", "apif")).unionAll(good.agg(F.count("*").alias("n")).select(F.lit("checked"), F.lit("pairs"), "n"))


_STAGED = _RICH + _MULTI + """, one as (select id, club, mv from (select id, current_club_name club, market_value_eur mv, row_number() over (partition by id order by updated_at desc nulls last, current_club_name desc nulls last, market_value_eur desc nulls last) r from pipeline_players) where r = 1),
staged as (select 'TM:' || tm_id || ' + APIF:' || apif_id source_records, coalesce(a.club, t.club) club, coalesce(t.mv, a.mv) mv, 'Tier 2' tier from good join one t on t.id = tm_id join one a on a.id = apif_id
union all select 'TM:' || id, club, mv, null from one where id not like 'apif_%' and id not in (select tm_id from good) union all select 'APIF:' || id, club, mv, null from one where id like 'apif_%' and id not in (select apif_id from good))"""


def _staged(s, d) -> DataFrame:
    """Matched pairs as one row, then the unmatched rows of either source. The second source's club comes first, all else second."""
    good = exact.clean(_pairs(s, d), "tm_id", "apif_id")
    one = records.latest(table(s, d, "pipeline_players"), "id", ["current_club_name", "market_value_eur"], "updated_at").select("id", F.col("current_club_name").alias("club"), F.col("market_value_eur").alias("mv"))
    t, a = one.select(F.col("id").alias("tm_id"), F.col("club").alias("t_club"), F.col("mv").alias("t_mv")), one.select(F.col("id").alias("apif_id"), F.col("club").alias("a_club"), F.col("mv").alias("a_mv"))
    merged = good.join(t, "tm_id").join(a, "apif_id").select(F.concat(F.lit("TM:"), "tm_id", F.lit(" + APIF:"), "apif_id").alias("source_records"), exact.survive(F.col("a_club"), F.col("t_club")).alias("club"), exact.survive(F.col("t_mv"), F.col("a_mv")).alias("mv"), F.lit("Tier 2").alias("tier"))
    second = F.col("id").like("apif_%")
    rest_t = one.where(~second).join(good.select(F.col("tm_id").alias("id")), "id", "left_anti").select(F.concat(F.lit("TM:"), "id").alias("source_records"), "club", "mv")
    rest_a = one.where(second).join(good.select(F.col("apif_id").alias("id")), "id", "left_anti").select(F.concat(F.lit("APIF:"), "id").alias("source_records"), "club", "mv")
    return merged.unionByName(rest_t, allowMissingColumns=True).unionByName(rest_a, allowMissingColumns=True)


@query(_STAGED + " select * from staged")
def staging_union(s, d):
    return _staged(s, d)


@query(_STAGED + " select (select count(distinct id) from pipeline_players) rows_in, count(*) profiles, count(*) filter (where tier is not null) merged, (select count(*) from pairs) - (select count(*) from good) quarantined from staged")
def staging_funnel(s, d):
    p = _pairs(s, d)
    parts = table(s, d, "pipeline_players").agg(F.count_distinct("id").alias("rows_in")).crossJoin(_staged(s, d).agg(F.count("*").alias("profiles"), F.count("tier").alias("merged"))).crossJoin(exact.quarantined(p, "tm_id", "apif_id").agg(F.count("*").alias("quarantined")))
    return parts  # three single rows


@query("select coalesce(upper(trim(data_confidence)), 'NONE') confidence, count(*) n, cast(round(100.0 * count(*) / (select count(*) from profile_players_staging), 1) as double) pct, count(*) filter (where needs_curation) flagged from profile_players_staging group by 1")
def confidence_breakdown(s, d):
    p = table(s, d, "profile_players_staging")
    g = p.groupBy(F.coalesce(F.upper(F.trim("data_confidence")), F.lit("NONE")).alias("confidence")).agg(F.count("*").alias("n"), F.count_if("needs_curation").alias("flagged"))
    total = p.agg(F.count("*").alias("total"))
    return g.crossJoin(F.broadcast(total)).select("confidence", "n", "flagged", F.round(F.lit(100).cast("decimal(20,6)") * F.col("n") / F.col("total"), 1).cast("double").alias("pct"))  # one row


@query("select reason, count(*) n from (select unnest(string_split(curation_reason, '; ')) reason from profile_players_staging where curation_reason is not null) group by 1")
def reasons_exploded(s, d):
    return table(s, d, "profile_players_staging").select(F.explode(F.split("curation_reason", "; ")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("select coalesce(match_tier, 'none') tier, count(*) n from profile_players_staging group by 1")
def match_tier_counts(s, d):
    return table(s, d, "profile_players_staging").groupBy(F.coalesce("match_tier", F.lit("none")).alias("tier")).agg(F.count("*").alias("n"))


@query("select distinct profile_id, concat_ws('; ', curation_reason, case when height_cm is null then 'needs_height' end, case when birth_city is null then 'needs_city' end) reasons, nullif(array_to_string(list_filter(string_split(curation_reason, '; '), lambda x: x <> 'club_conflict'), '; '), '') rest from profile_players_staging")
def reason_append(s, d):
    p = table(s, d, "profile_players_staging")
    return p.select("profile_id", F.concat_ws("; ", "curation_reason", F.when(F.col("height_cm").isNull(), "needs_height"), F.when(F.col("birth_city").isNull(), "needs_city")).alias("reasons"), text.remove_reason(F.col("curation_reason"), "club_conflict").alias("rest")).distinct()


@query("select distinct tm_id, apif_id from dedup_pairs where lower(trim(tm_club)) <> lower(trim(apif_club))")
def conflict_v1(s, d):
    return table(s, d, "dedup_pairs").where("lower(trim(tm_club)) <> lower(trim(apif_club))").select("tm_id", "apif_id").distinct()


@query("select distinct tm_id, apif_id from dedup_pairs where not contains(lower(tm_club), lower(apif_club)) and not contains(lower(apif_club), lower(tm_club))")
def conflict_v2(s, d):
    a, b = F.lower("tm_club"), F.lower("apif_club")
    return table(s, d, "dedup_pairs").where(~F.contains(a, b) & ~F.contains(b, a)).select("tm_id", "apif_id").distinct()


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in text.CLUB_STOPWORDS)
_WORDS = f"list_filter(string_split(trim(regexp_replace(replace(replace(replace(translate(lower({{c}}), '{text.CLUB_FROM}', '{text.CLUB_TO}'), '-', ' '), '.', ' '), '''', ''), '\\s+', ' ', 'g')), ' '), lambda w: length(w) > 2 and w not in ({_STOP}))"


@query(f"select distinct tm_id, apif_id from dedup_pairs where tm_club is not null and apif_club is not null and not list_has_any({_WORDS.format(c='tm_club')}, {_WORDS.format(c='apif_club')})")
def conflict_v3(s, d):
    p = table(s, d, "dedup_pairs").where("tm_club is not null and apif_club is not null")
    return p.where(~F.arrays_overlap(text.club_words(F.col("tm_club")), text.club_words(F.col("apif_club")))).select("tm_id", "apif_id").distinct()


@query(f"select distinct name, array_to_string({_WORDS.format(c='name')}, ' ') words from clubs")
def club_words(s, d):
    return table(s, d, "clubs").select("name", F.array_join(text.club_words(F.col("name")), " ").alias("words")).distinct()


@query(f"select distinct id, translate(name, '{text.REF_FROM}', '{text.REF_TO}') stripped from pipeline_players where name is not null")
def strip_accents_ref(s, d):
    return table(s, d, "pipeline_players").where("name is not null").select("id", text.strip_accents_ref(F.col("name")).alias("stripped")).distinct()


@query("select position, sub_position, case when lower(trim(sub_position)) in ('centre-forward', 'right winger', 'left winger', 'second striker') then 'fwd' when lower(trim(sub_position)) in ('central midfield', 'defensive midfield', 'attacking midfield', 'right midfield', 'left midfield') then 'mid' when lower(trim(sub_position)) in ('centre-back', 'left-back', 'right-back') then 'def' when lower(trim(sub_position)) = 'goalkeeper' then 'gk' else lower(trim(sub_position)) end broad, count(*) n from pipeline_players group by all")
def broad_positions(s, d):
    return table(s, d, "pipeline_players").groupBy("position", "sub_position").agg(F.count("*").alias("n")).withColumn("broad", text.comparable(F.lit("position"), F.col("sub_position")))


@query("select team_name, count(*) variants, min(nationality_value) first_variant from wc_2026_team_map group by 1")
def team_variants(s, d):
    return table(s, d, "wc_2026_team_map").groupBy("team_name").agg(F.count("*").alias("variants"), F.min("nationality_value").alias("first_variant"))


@query("select team_code, count(distinct id) n, cast(round(avg(height_cm), 6) as double) avg_height from pipeline_players join wc_2026_team_map on nationality = nationality_value group by 1")
def team_dimension(s, d):
    j = table(s, d, "pipeline_players").join(table(s, d, "wc_2026_team_map"), F.expr("nationality = nationality_value"))
    return j.groupBy("team_code").agg(F.count_distinct("id").alias("n"), F.round(F.avg("height_cm"), 6).alias("avg_height"))


@query("select team_code, id, rank from (select team_code, id, row_number() over (partition by team_code order by mv desc nulls last, id) rank from (select team_code, id, max(market_value_eur) mv from pipeline_players join wc_2026_team_map on nationality = nationality_value group by 1, 2)) where rank <= 26")
def projected_squads(s, d):
    j = table(s, d, "pipeline_players").join(table(s, d, "wc_2026_team_map"), F.expr("nationality = nationality_value")).groupBy("team_code", "id").agg(F.max("market_value_eur").alias("mv"))
    return ranking.top_n(j, ["team_code"], [F.desc_nulls_last("mv"), F.asc("id")], 26).select("team_code", "id", "rank")


@query("select id, full_legal_name, current_club from (select id, max(full_legal_name) full_legal_name from players group by 1) join (select player_id, current_club from (select player_id, current_club, row_number() over (partition by player_id order by updated_at desc nulls last, current_club desc nulls last) r from player_career) where r = 1) c on id = c.player_id join (select distinct player_id from player_tournament where in_squad) t on id = t.player_id")
def player_chain(s, d):
    p = table(s, d, "players").groupBy("id").agg(F.max("full_legal_name").alias("full_legal_name"))
    c = records.latest(table(s, d, "player_career"), "player_id", ["current_club"], "updated_at").withColumnRenamed("player_id", "id")
    return p.join(c, "id").join(table(s, d, "player_tournament").where("in_squad").select(F.col("player_id").alias("id")).distinct(), "id")


@query("select source, count(*) n, cast(round(100.0 * count(wc_team_code) / count(*), 1) as double) pct_team, cast(round(100.0 * count(p.id) / count(*), 1) as double) pct_player from documents left join (select distinct id from players) p on player_id = p.id group by 1")
def coverage_left_join(s, d):
    pct = lambda c: F.round(F.lit(100).cast("decimal(20,6)") * F.count(c) / F.count("*"), 1).cast("double")
    known = table(s, d, "players").select(F.col("id").alias("player_id"), F.col("id")).distinct()
    return table(s, d, "documents").join(known, "player_id", "left").groupBy("source").agg(F.count("*").alias("n"), pct("wc_team_code").alias("pct_team"), pct("id").alias("pct_player"))


@query("select 'nationality' field, count(*) filter (where trim(nationality) not in ('', 'null')) filled, count(*) total from pipeline_players union all select 'name_short', count(*) filter (where trim(name_short) not in ('', 'null')), count(*) from pipeline_players union all select 'foot', count(*) filter (where trim(foot) not in ('', 'null')), count(*) from pipeline_players")
def completeness(s, d):
    return quality.completeness(table(s, d, "pipeline_players"), ["nationality", "name_short", "foot"])


@query("select 'rows' gate, cast(count(*) as double) \"value\", count(*) >= 100 passed from pipeline_players union all select 'nationality', cast(round(100 * avg(case when trim(nationality) not in ('', 'null') then 1.0 else 0.0 end), 1) as double), round(100 * avg(case when trim(nationality) not in ('', 'null') then 1.0 else 0.0 end), 1) >= 80 from pipeline_players union all select 'ids', cast(count(*) - count(distinct id) as double), count(*) = count(distinct id) from pipeline_players")
def coverage_gate(s, d):
    gates = [quality.at_least("rows", 100), quality.coverage("nationality", F.col("nationality"), 80.0), quality.unique("ids", F.col("id"))]
    return quality.evaluate(table(s, d, "pipeline_players"), gates)


_PLAYERS = """p as (select distinct id, name, position, nationality, born, in_squad from (select id, name, position, nationality, date_of_birth born, jersey_number is not null in_squad, row_number() over (partition by id order by updated_at desc nulls last, name desc nulls last, position desc nulls last, nationality desc nulls last, date_of_birth desc nulls last, jersey_number desc nulls last) r from pipeline_players) where r = 1),
a as (select *, date_diff('year', born, date '2026-06-11') - case when strftime(born, '%m%d') > '0611' then 1 else 0 end age from p), w as (select p.*, team_code from p join wc_2026_team_map on nationality = nationality_value where in_squad)"""


@query(f"""with {_PLAYERS} select name player_name, id source_id, 'missing_name' "check", 'critical' severity, 'Player has no name' detail from a where coalesce(trim(name), '') = '' union all select name, id, 'missing_position', 'warning', 'No position assigned' from a where coalesce(position, '') = '' union all select name, id, 'missing_nationality', 'warning', 'No nationality' from a where coalesce(nationality, '') = ''
union all select name, id, 'age_too_young', 'error', 'Age ' || age || ' (DOB: ' || strftime(born, '%Y-%m-%d') || ')' from a where age < 15 union all select name, id, 'age_too_old', 'warning', 'Age ' || age || ' (DOB: ' || strftime(born, '%Y-%m-%d') || ')' from a where age > 45
union all select 'TEAM:' || team_code, '', 'squad_incomplete', 'warning', team_code || ' has only ' || count(*) || ' players (expected 23-26)' from w group by team_code having count(*) < 23 union all select 'TEAM:' || team_code, '', 'squad_too_large', 'warning', team_code || ' has ' || count(*) || ' players (max 26)' from w group by team_code having count(*) > 26
union all select 'TEAM:' || team_code, '', 'no_goalkeeper', 'error', team_code || ' has no goalkeeper in squad' from w group by team_code having count(*) filter (where upper(position) in ('GK', 'GOALKEEPER')) = 0
union all select name, '', 'duplicate_in_team', 'error', chr(39) || name || chr(39) || ' appears multiple times in ' || team_code from (select *, row_number() over (partition by team_code, trim(lower(replace(name, chr(304), 'i'))) order by id) n from w where name is not null) where n > 1""")
def qa_issues(s, d):
    """Rows with a shirt number stand for the squads."""
    fields = ["name", "position", "nationality", "date_of_birth", "jersey_number"]
    p = records.latest(table(s, d, "pipeline_players"), "id", fields, "updated_at").withColumn("in_squad", F.col("jersey_number").isNotNull())
    teams = table(s, d, "wc_2026_team_map").select(F.col("nationality_value").alias("nationality"), "team_code")
    return quality.player_issues(p, p.where("in_squad").join(teams, "nationality"))


@query("select nationality, count(distinct id) n from pipeline_players group by 1 having count(distinct id) not between 20 and 30")
def group_sizes(s, d):
    return quality.group_sizes(table(s, d, "pipeline_players").select("id", "nationality").distinct(), "nationality", 20, 30)


@query("select key, count(*) n, min(profile_id) canonical from (select lower(trim(display_name)) || '|' || coalesce(strftime(date_of_birth, '%Y-%m-%d'), '') key, profile_id from profile_players_staging where display_name is not null) group by 1 having count(*) > 1")
def first_wins_collisions(s, d):
    p = table(s, d, "profile_players_staging").where("display_name is not null")
    key = F.concat_ws("|", _plain_lower(F.trim("display_name")), F.coalesce(F.date_format("date_of_birth", "yyyy-MM-dd"), F.lit("")))
    ranked = reconcile.first_of(p.select(key.alias("key"), "profile_id"), ["key"], [F.col("profile_id")])
    return ranked.groupBy("key").agg(F.count("*").alias("n"), F.max(F.when(F.col("_rank") == 1, F.col("profile_id"))).alias("canonical")).where("n > 1")


@query("select distinct profile_id, sha2 from (select profile_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) sha2 from (select profile_id, sha256(profile_id) h from profile_players_staging))")
def stable_ids(s, d):
    return table(s, d, "profile_players_staging").select("profile_id", reconcile.stable_id(F.col("profile_id")).alias("sha2")).distinct()


_ALIASES = "select player_id, kind, value from (select id player_id, 'known_as' kind, known_as value from players where known_as <> full_legal_name union all select id, 'legal_name', full_legal_name from players union all select player_id, 'club', current_club from player_career) where value is not null"


@query(f"select kind, value, min(player_id) player_id from ({_ALIASES}) group by 1, 2")
def aliases(s, d):
    p, c = table(s, d, "players"), table(s, d, "player_career")
    named = p.select(F.col("id").alias("player_id"), F.explode(F.array(F.struct(F.lit("known_as").alias("kind"), F.when(F.col("known_as") != F.col("full_legal_name"), F.col("known_as")).alias("value")), F.struct(F.lit("legal_name").alias("kind"), F.col("full_legal_name").alias("value")))).alias("a")).select("player_id", "a.*")
    every = named.unionByName(c.select("player_id", F.lit("club").alias("kind"), F.col("current_club").alias("value"))).where("value is not null")
    return every.groupBy("kind", "value").agg(F.min("player_id").alias("player_id"))


@query("select distinct id, case when lower(trim(foot)) in ('left', 'right', 'both') then upper(substr(trim(foot), 1, 1)) || lower(substr(trim(foot), 2)) end foot, nullif(nullif(nullif(trim(current_club_name), ''), 'N/A'), 'Unknown') club from pipeline_players")
def normalized_values(s, d):
    return table(s, d, "pipeline_players").select("id", text.foot(F.col("foot")).alias("foot"), F.trim(nulls.null_if_sentinel(F.col("current_club_name"))).alias("club")).distinct()


@query("select profile_id, case when bool_or(needs_curation) and not bool_or(coalesce(list_contains(string_split(curation_reason, '; '), 'recheck'), false)) then 1 else 0 end due from profile_players_staging group by 1")
def flag_idempotent(s, d):
    p = table(s, d, "profile_players_staging")
    listed = p.where("needs_curation").select("profile_id").distinct()
    once = dml.flag_in(p, listed, ["profile_id"], "recheck")
    twice = dml.flag_in(once, listed, ["profile_id"], "recheck")  # changes nothing
    return twice.groupBy("profile_id").agg(F.max(F.coalesce(F.size(F.filter(F.split("curation_reason", "; "), lambda x: x == "recheck")), F.lit(0))).alias("due")).withColumn("due", F.greatest("due", F.lit(0)))


@query("select tm_id, max(tm_name) tm_name from dedup_pairs where tm_id in (select tm_id from dedup_pairs_ambiguous) or apif_id in (select apif_id from dedup_pairs_ambiguous) group by 1")
def semi_or_ids(s, d):
    p, a = table(s, d, "dedup_pairs"), table(s, d, "dedup_pairs_ambiguous")
    x, y = a.where("tm_id is not null").select("tm_id").distinct().withColumn("_x", F.lit(True)), a.where("apif_id is not null").select("apif_id").distinct().withColumn("_y", F.lit(True))
    return p.join(x, "tm_id", "left").join(y, "apif_id", "left").where("_x or _y").groupBy("tm_id").agg(F.max("tm_name").alias("tm_name"))


_SLUG = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', '-', 'g'), '-')"
_PLAIN = "regexp_matches(coalesce(full_legal_name, '') || coalesce(known_as, ''), '^[ -~\u00c0-\u00ff]*$') and not regexp_matches(coalesce(full_legal_name, '') || coalesce(known_as, ''), '[\u00c6\u00d0\u00d8\u00de\u00df\u00e6\u00f0\u00f8\u00fe]')"


@query(f"""with b as (select slug, height, foot from (select *, row_number() over (partition by slug order by ord desc, height desc nulls last, foot desc nulls last) r from player_bio where slug is not null) where r = 1), p as (select distinct id, {_SLUG.format('full_legal_name')} s, {_SLUG.format('known_as')} t from players where {_PLAIN})
select id, case when a.slug is not null then a.height else b.height end height, case when a.slug is not null then a.foot else b.foot end foot from p left join b a on a.slug = s left join b on b.slug = t""")
def lookup_chain(s, d):
    """Biographies by the slug of the full name, else of the short one; names of Western European letters only, which SQL folds the same."""
    plain = F.concat(F.coalesce("full_legal_name", F.lit("")), F.coalesce("known_as", F.lit(""))).rlike("^[ -~\u00c0-\u00c5\u00c7-\u00cf\u00d1-\u00d7\u00d9-\u00dd\u00e0-\u00e5\u00e7-\u00ef\u00f1-\u00f7\u00f9-\u00fd\u00ff]*$")
    rows = table(s, d, "players").where(plain).select("id", text.slug(F.col("full_legal_name")).alias("s"), text.slug(F.col("known_as")).alias("t")).distinct()
    return records.lookup(rows, table(s, d, "player_bio"), "slug", ["s", "t"], ["height", "foot"], "ord").select("id", "height", "foot")


@query("select distinct tm_id, apif_id, coalesce(contains(lower(tm_birth_country), lower(trim(nationality))) or contains(lower(trim(nationality)), lower(tm_birth_country)) or contains(lower(apif_birth_country), lower(trim(nationality))) or contains(lower(trim(nationality)), lower(apif_birth_country)), true) plausible from dedup_pairs where tm_birth_country is not null and apif_birth_country is not null")
def plausible_nationality(s, d):
    p = table(s, d, "dedup_pairs").where("tm_birth_country is not null and apif_birth_country is not null")
    return p.select("tm_id", "apif_id", records.plausible(F.col("nationality"), F.array("tm_birth_country", "apif_birth_country")).alias("plausible")).distinct()


@query("select entity, field, string_agg(source || '=' || value, ' | ' order by source || '=' || value) sources from (select distinct profile_id entity, 'current_club' field, coalesce(match_tier, 'none') source, current_club \"value\" from profile_players_staging where current_club is not null) group by 1, 2")
def review_lines(s, d):
    p = table(s, d, "profile_players_staging").where("current_club is not null")
    return records.review_lines(p.select(F.col("profile_id").alias("entity"), F.lit("current_club").alias("field"), F.coalesce("match_tier", F.lit("none")).alias("source"), F.col("current_club").alias("value")))


@query("select p.id, full_legal_name, c.current_club club, c.jersey number, t.caps caps from (select id, max(full_legal_name) full_legal_name from players group by 1) p left join (select player_id, current_club, current_jersey_number jersey from (select *, row_number() over (partition by player_id order by updated_at desc nulls last, current_club desc nulls last, current_jersey_number desc nulls last) r from player_career) where r = 1) c on c.player_id = p.id left join (select player_id, international_caps caps from (select *, row_number() over (partition by player_id order by updated_at desc nulls last, international_caps desc nulls last) r from player_tournament) where r = 1) t on t.player_id = p.id")
def golden_record(s, d):
    identity = table(s, d, "players").groupBy("id").agg(F.max("full_legal_name").alias("full_legal_name"))
    career, cup = (table(s, d, t).withColumnRenamed("player_id", "id") for t in ("player_career", "player_tournament"))
    g = records.golden(identity, {"career": (career, ["current_club", "current_jersey_number"], "updated_at"), "cup": (cup, ["international_caps"], "updated_at")}, "id")
    return g.select("id", "full_legal_name", F.col("career.current_club").alias("club"), F.col("career.current_jersey_number").alias("number"), F.col("cup.international_caps").alias("caps"))


@query("""with k as (select id, height_cm, current_club_name club from (select *, row_number() over (partition by id order by updated_at desc nulls last, height_cm desc nulls last, current_club_name desc nulls last) r from pipeline_players where id not like 'apif_%') where r = 1), l as (select tm_id id, max(apif_height_cm) height_cm, max(apif_club) club from dedup_pairs group by 1)
select k.id, coalesce(l.club, k.club) club, case when l.height_cm > 100 and l.height_cm < 230 then l.height_cm else k.height_cm end height_cm, case when l.id is null then 'not_found' when coalesce(l.club, k.club) is distinct from k.club or (case when l.height_cm > 100 and l.height_cm < 230 then l.height_cm else k.height_cm end) is distinct from k.height_cm then 'updated' else 'no_changes' end status from k left join l on k.id = l.id""")
def live_compare(s, d):
    known = records.latest(table(s, d, "pipeline_players").where(~F.col("id").like("apif_%")), "id", ["height_cm", "current_club_name"], "updated_at").withColumnRenamed("current_club_name", "club")
    live_rows = table(s, d, "dedup_pairs").groupBy(F.col("tm_id").alias("id")).agg(F.max("apif_height_cm").alias("height_cm"), F.max("apif_club").alias("club"))
    return records.live_changes(known, live_rows, "id", ["club"], [], "height_cm")


@query("select id, name, nationality from (select distinct id, name, nationality from pipeline_players) where contains(lower(name), 'mateo') order by case when lower(name) = 'mateo' then 0 else 1 end, id limit 5")
def name_search(s, d):
    return records.search(table(s, d, "pipeline_players").select("id", "name", "nationality").distinct(), "Mateo", ["name"], [F.col("id")])


@query("select count(*) n from (select profile_id from profile_players_staging group by 1 having min(created_at) < (select min(updated_at) from profile_players_staging))")
def legacy_rows(s, d):
    p = table(s, d, "profile_players_staging")
    first = p.agg(F.min("updated_at").alias("first"))
    return p.groupBy("profile_id").agg(F.min("created_at").alias("created")).crossJoin(F.broadcast(first)).where("created < first").agg(F.count("*").alias("n"))  # one row


@query("select id, lower(full_legal_name || ' ' || known_as) words from (select distinct id, full_legal_name, known_as from players where full_legal_name is not null and known_as is not null)")
def search_column(s, d):
    return table(s, d, "players").where("full_legal_name is not null and known_as is not null").select("id", _plain_lower(F.concat_ws(" ", "full_legal_name", "known_as")).alias("words")).distinct()


# -- queries that SQL can't express; tests hold them against brute force --------------------------------------------


def _lists(s, d) -> tuple[DataFrame, DataFrame]:
    """The second source's rows as queries and the first one's as the base, one row an id."""
    p = table(s, d, "pipeline_players").groupBy("id").agg(F.max(F.struct("updated_at", "name", F.col("date_of_birth").cast("string").alias("born"), F.col("current_club_name").alias("club"), "nationality")).alias("m")).select("id", "m.name", "m.born", "m.club", "m.nationality")
    second = F.col("id").like("apif_%")
    return p.where(second).withColumnRenamed("id", "q_id"), p.where(~second).withColumnRenamed("id", "b_id").withColumn("b_ord", F.col("b_id"))


@query()
def token_candidates(s, d):
    # the name of each id's row in _lists, without its other fields
    p = table(s, d, "pipeline_players").groupBy("id").agg(F.max(F.struct("updated_at", "name")).alias("m")).select("id", "m.name")
    second = F.col("id").like("apif_%")
    return fuzzy.candidates(p.where(second).withColumnRenamed("id", "q_id"), p.where(~second).withColumnRenamed("id", "b_id").withColumn("b_ord", F.col("b_id")))


@query()
def fuzzy_scores(s, d):
    pairs = table(s, d, "dedup_pairs").select("tm_id", "apif_id", fuzzy.profile("tm_name", "date_of_birth", "tm_club", "nationality").alias("a"), fuzzy.profile("apif_name", "date_of_birth", "apif_club", "nationality").alias("b"))
    return fuzzy.scored(pairs).select("tm_id", "apif_id", "score", "reason").distinct()


@query()
def fuzzy_resolve(s, d):
    return fuzzy.resolve(*_lists(s, d))


@query()
def literal_squads(s, d):
    """Squads written as source text and read back by the literal reader."""
    p = table(s, d, "pipeline_players").join(table(s, d, "wc_2026_team_map"), F.expr("nationality = nationality_value")).where("name is not null").groupBy("team_code", "id").agg(F.max("name").alias("name"), F.max("jersey_number").alias("number"), F.max("position").alias("position"))
    rows = p.select(F.col("team_code").alias("team"), "name", "number", "position", (F.col("number") == 10).alias("captain"))
    return literals.squads(sinks.squad_source(rows).select("text")).select("team", "pos", "name", "number", "position", "captain")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1")
def streaming_snapshot(s, d):
    """The latest event of each user, folded batch by batch from a stream of files."""
    work = f"{shared_root(s)}/stream-{uuid.uuid4().hex[:8]}"
    events = table(s, d, "events").select("user_id", "ts", "event_id", "event_type")
    events.repartitionByRange(3, "ts").write.parquet(f"{work}/in")
    state = live.replace_each_batch(s, f"{work}/in", "user_id long, ts timestamp, event_id long, event_type string", "user_id", ["ts", "event_id"], ["event_type"], f"{work}/state", f"{work}/checkpoint")
    return state.select("user_id", "event_id", "event_type")


@query("select nationality, count(*) n from pipeline_players group by 1 order by n desc, nationality limit 20")
def readonly_sql(s, d):
    return readonly.answer(s, "select nationality, count(*) as n from pipeline_players group by 1 order by n desc, nationality limit 20", {"pipeline_players": table(s, d, "pipeline_players")})


@query()
def nickname_lists(s, d):
    """Nicknames of each player as a plain list."""
    return table(s, d, "players").select("id", records.as_list(F.col("nicknames"), "nickname").alias("nicknames")).distinct()


@query()
def seed_lines(s, d):
    """INSERT statements of the reference clubs."""
    return sinks.insert_lines(table(s, d, "clubs").select("club_id", "name", "domestic_competition_id"), "clubs", [F.col("club_id")])


@query("select profile_id from profile_players_staging where profile_id not in (select profile_id from profile_players_staging where not needs_curation) group by 1")
def resume_remaining(s, d):
    p = table(s, d, "profile_players_staging")
    return sinks.remaining(p.select("profile_id").distinct(), p.where("not needs_curation"), "profile_id")
