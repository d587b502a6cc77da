"""Queries over rosters, identities, reports and single functions, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import nulls, parse, text
from kinweave.operators import dml, identity, reconcile, records
from kinweave.plans.relational import _states, table
from kinweave.sources import sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _ascii(*columns: str):
    """Rows whose texts both engines fold alike."""
    return F.concat_ws("", *columns).rlike("^[ -~]*$")


# -- inline reference data and worked cases -------------------------------------------------------------------------

_STATUS = [("UEFA", 16), ("CONMEBOL", 6), ("CAF", 9), ("AFC", 8), ("CONCACAF", 6), ("OFC", 1)]


@query("select confederation, slots, count(distinct team_code) teams from (values ('UEFA', 16), ('CONMEBOL', 6), ('CAF', 9), ('AFC', 8), ('CONCACAF', 6), ('OFC', 1)) v(confederation, slots) left join wc_2026_team_map using (confederation) group by 1, 2")
def inline_values(s, d):
    """A reference list written in the query."""
    return s.createDataFrame(_STATUS, "confederation string, slots int").join(table(s, d, "wc_2026_team_map").select("confederation", "team_code"), "confederation", "left").groupBy("confederation", "slots").agg(F.count_distinct("team_code").alias("teams"))


_NAMES = [
    "José Núñez-O'Neil", "  Müller,  Søren ", "Straße", "Łukasz PIŁAT", "N. Kanté", "Éder", "Cristiano Ronaldo dos Santos Aveiro", "Ab", "Jean  Luc", "Đoković",
]


@query("""select * from (values ('José Núñez-O''Neil', 'jose nunez oneil', 'jose nunez-oneil', 'jose nunez-o''neil', 'jose-nunez-o-neil', 'nunez-oneil', false), ('  Müller,  Søren ', 'muller,  soren', 'muller sren', 'muller, søren', 'muller-s-ren', 'sren', false),
('Straße', 'strasse', 'strae', 'straße', 'stra-e', 'strae', false), ('Łukasz PIŁAT', 'lukasz pilat', 'ukasz piat', 'łukasz piłat', 'ukasz-pi-at', 'piat', false), ('N. Kanté', 'n. kante', 'n kante', 'n. kante', 'n-kante', 'kante', true), ('Éder', 'eder', 'eder', 'eder', 'eder', 'eder', false),
('Cristiano Ronaldo dos Santos Aveiro', 'cristiano ronaldo dos santos aveiro', 'cristiano ronaldo dos santos aveiro', 'cristiano ronaldo dos santos aveiro', 'cristiano-ronaldo-dos-santos-aveiro', 'aveiro', false), ('Ab', 'ab', 'ab', 'ab', 'ab', 'ab', false), ('Jean  Luc', 'jean  luc', 'jean luc', 'jean luc', 'jean-luc', 'luc', false), ('Đoković', 'dokovic', 'okovic', 'đokovic', 'okovic', 'okovic', false)) v(name, matcher, canonical, combined, slug, surname, abbreviated)""")
def name_forms(s, d):
    """Worked cases of the name forms, from the rules' text."""
    n = F.col("name")
    return s.createDataFrame([(x,) for x in _NAMES], "name string").select("name", text.matcher_name(n).alias("matcher"), text.canonical_name(n).alias("canonical"), text.combined_name(n).alias("combined"), text.slug(n).alias("slug"), identity.surname(n).alias("surname"), text.is_abbreviated(n).alias("abbreviated"))


@query("""select * from (values ('Chelsea FC', 'chelsea'), ('Man City F.C.', 'manchester city'), ('Spurs', 'tottenham'), ('PSG', 'paris saint-germain'), ('Ajax Ltd PLC', 'ajax'), ('Roma S.p.A.', 'roma'), ('FC', 'fc'), (' ', null)) v(club, normal)""")
def club_forms(s, d):
    return s.createDataFrame([(c,) for c in ("Chelsea FC", "Man City F.C.", "Spurs", "PSG", "Ajax Ltd PLC", "Roma S.p.A.", "FC", " ")], "club string").select("club", text.normal_club(F.col("club")).alias("normal"))


@query("""select * from (values ('date_of_birth', '2000-01-02T00:00', '2000-01-02'), ('date_of_birth', '2000', null), ('market_value_eur', '1,500,000.9', '1500000'), ('height_cm', 'tall', null), ('jersey_number', '7', '7'), ('career_trajectory', 'x', null), ('major_trophies', 'x', null), ('current_club', 'Man City FC', 'manchester city'), ('position', ' Striker ', 'fwd'), ('position', 'Libero', 'libero'), ('agent', ' Bob ', 'bob'), ('agent', ' ', null)) v(field, value, form)""")
def comparable_forms(s, d):
    rows = [("date_of_birth", "2000-01-02T00:00"), ("date_of_birth", "2000"), ("market_value_eur", "1,500,000.9"), ("height_cm", "tall"), ("jersey_number", "7"), ("career_trajectory", "x"), ("major_trophies", "x"), ("current_club", "Man City FC"), ("position", " Striker "), ("position", "Libero"), ("agent", " Bob "), ("agent", " ")]
    return s.createDataFrame(rows, "field string, value string").select("field", "value", text.comparable(F.col("field"), F.col("value")).alias("form"))


@query("select nationality_value, case nationality_value when 'USA' then 'United States' when 'United States of America' then 'United States' when 'Ivory Coast' then 'Côte d''Ivoire' when 'Curacao' then 'Curaçao' else nationality_value end canonical from (select nationality_value from wc_2026_team_map union all values ('USA'), ('Ivory Coast'), ('usa'), ('Curacao')) t")
def canonical_countries(s, d):
    rows = table(s, d, "wc_2026_team_map").select("nationality_value").unionAll(s.createDataFrame([(x,) for x in ("USA", "Ivory Coast", "usa", "Curacao")], "nationality_value string"))
    return rows.select("nationality_value", text.recode(F.col("nationality_value"), text.COUNTRIES).alias("canonical"))


@query("""select s_suppkey, '''' || replace(s_name, '#', '''''') || '''' literal, replace(replace(replace(s_name, '#', '"\\'), '\\', '\\\\'), '"', '\\"') script, case when length(trim(regexp_replace(s_name, '[^A-Za-z0-9 ]', '', 'g'))) >= 4 then trim(regexp_replace(s_name, '[^A-Za-z0-9 ]', '', 'g')) end search from supplier""")
def escaped_names(s, d):
    hashed = lambda x: F.replace("s_name", F.lit("#"), F.lit(x))
    return table(s, d, "supplier").select("s_suppkey", text.sql_literal(hashed("'")).alias("literal"), text.script_escape(hashed('"\\')).alias("script"), text.search_name(F.col("s_name")).alias("search"))


@query("select c_custkey, case when v >= 1000000 then '€' || printf('%.1f', v / 1e6) || 'M' when v >= 1000 then '€' || printf('%.0f', v / 1e3) || 'K' when v > 0 then '€' || cast(cast(v as bigint) as varchar) else '' end fee, strftime(timestamp '2020-01-01' + to_days(cast(c_custkey % 900 as int)), '%Y-%m-%d') \"day\" from (select c_custkey, (case when c_custkey % 4 = 0 then 250000 else 1000 end * round(c_acctbal)) v from customer)")
def fees_and_days(s, d):
    v = F.when(F.col("c_custkey") % 4 == 0, 250000).otherwise(1000) * F.round("c_acctbal")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int"))
    return table(s, d, "customer").select("c_custkey", parse.fee(v.cast("double")).alias("fee"), parse.iso_day(day.cast("timestamp")).alias("day"))


@query("select nationality, count(*) enriched, cast(round(count(*) * 0.0055, 2) as double) enrich_usd, cast(round(count(*) * 0.0037, 2) as double) verify_usd from pipeline_players group by 1")
def cost_estimate(s, d):
    """Linear estimates of what a run over each group would cost."""
    cost = lambda rate: F.round(F.col("enriched") * F.lit(rate).cast("decimal(6,4)"), 2).cast("double")
    return table(s, d, "pipeline_players").groupBy("nationality").agg(F.count("*").alias("enriched")).withColumn("enrich_usd", cost("0.0055")).withColumn("verify_usd", cost("0.0037"))


@query("select o_orderkey, coalesce(nullif(o_custkey % 3, 0), o_orderkey) filled, o_orderpriority not in ('', '5-LOW') and o_orderkey % 2 = 0 present, case when o_orderkey % 3 = 0 then o_orderstatus || ' ' || o_orderpriority else o_orderpriority end full_name, case when o_orderkey % 3 = 0 and o_orderstatus = 'F' then 'high' when o_orderkey % 3 = 0 then 'medium' else 'low' end grade from orders")
def filled_fields(s, d):
    """Zero as missing, presence by a dotted path, a full name with its fallback, a grade of confidence."""
    k = F.col("o_orderkey")
    o = table(s, d, "orders").withColumn("a", F.struct(F.struct(F.when(k % 2 == 0, F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.col("o_orderpriority"))).alias("c")).alias("b")))
    first = F.when(k % 3 == 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", F.coalesce(nulls.zero_as_null(F.col("o_custkey") % 3), k).alias("filled"), nulls.present(F.col("a.b.c")).alias("present"),
                    F.when(first.isNotNull(), F.concat_ws(" ", first, "o_orderpriority")).otherwise(F.col("o_orderpriority")).alias("full_name"), F.when((first == "F"), "high").when(first.isNotNull(), "medium").otherwise("low").alias("grade"))


@query("""select id, case when name_short is null then name when name is null then name_short when len(string_split_regex(trim(name_short), '\\s+')) > len(string_split_regex(trim(name), '\\s+')) then name_short else name end longer from (select distinct id, name, name_short from pipeline_players)""")
def longer_names(s, d):
    return table(s, d, "pipeline_players").select("id", "name", "name_short").distinct().select("id", text.longer_name(F.col("name"), F.col("name_short")).alias("longer"))


@query("select event_id, '{\"a\":' || cast(event_id % 7 as varchar) || ',\"b\":\"' || event_type || '\"}' sorted from events")
def sorted_json(s, d):
    """Objects with their keys in alphabetical order."""
    raw = F.to_json(F.struct(F.col("event_type").alias("b"), (F.col("event_id") % 7).alias("a")))
    return table(s, d, "events").select("event_id", F.to_json(F.parse_json(raw)).alias("sorted"))


@query("select c_custkey, 'plain;{\"k\":' || cast(c_nationkey as varchar) || '}' items from customer")
def lists_of_text(s, d):
    """List items that are objects become their JSON text."""
    items = F.array(F.lit("plain"), F.to_json(F.struct(F.col("c_nationkey").alias("k"))))
    return table(s, d, "customer").select("c_custkey", F.array_join(items, ";").alias("items"))


# -- joins, samples and limits --------------------------------------------------------------------------------------


@query("select count(*) n, count(distinct p.id) records from (select distinct id, full_legal_name, date_of_birth from players) w join (select distinct id, name, date_of_birth from pipeline_players) p on lower(w.full_legal_name) = lower(p.name) and w.date_of_birth = p.date_of_birth where regexp_matches(w.full_legal_name, '^[ -~]*$')")
def fallback_join(s, d):
    """Diagnostic: warehouse persons met by name and birth date alone."""
    w = table(s, d, "players").where(_ascii("full_legal_name")).select("id", F.lower("full_legal_name").alias("k"), "date_of_birth").distinct()
    p = table(s, d, "pipeline_players").select(F.col("id").alias("record"), F.lower("name").alias("k"), "date_of_birth").distinct()
    return w.join(p, ["k", "date_of_birth"]).agg(F.count("*").alias("n"), F.count_distinct("record").alias("records"))


@query("select count(*) filter (where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')) kept, count(*) filter (where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')) skipped from lineitem")
def kept_and_skipped(s, d):
    """Facts of valid keys, and how many were left out."""
    valid = table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(True).alias("ok"))
    return table(s, d, "lineitem").select("l_orderkey").join(valid, "l_orderkey", "left").agg(F.count_if(F.col("ok").isNotNull()).alias("kept"), F.count_if(F.col("ok").isNull()).alias("skipped"))


@query("select o_orderkey from orders a where not (o_orderstatus = 'F' and exists (select 1 from orders b where b.o_custkey = a.o_custkey and b.o_orderstatus <> 'F' and b.o_orderkey <> a.o_orderkey))")
def legacy_twins(s, d):
    """Old rows go where a newer twin of the same customer exists, another row than themselves."""
    o = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = o.where("o_orderstatus <> 'F'").select("o_custkey").distinct()
    gone = o.where("o_orderstatus = 'F'").join(new, "o_custkey", "left_semi").select("o_orderkey")  # an F row is never its own newer twin
    return o.select("o_orderkey").join(gone, "o_orderkey", "left_anti")


@query("select min(n) least, max(n) most, avg(n) mean from (select nationality, count(*) n from pipeline_players where nationality is not null group by 1)")
def group_extremes(s, d):
    return table(s, d, "pipeline_players").where("nationality is not null").groupBy("nationality").agg(F.count("*").alias("n")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"))


@query("select l_orderkey, l_linenumber, o_totalprice from lineitem join (select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 50) on l_orderkey = o_orderkey")
def top_then_rest(s, d):
    """The most valuable first, then everything that belongs to them."""
    top = table(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(50)
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber").join(F.broadcast(top), F.expr("l_orderkey = o_orderkey")).select("l_orderkey", "l_linenumber", "o_totalprice")  # 50 rows


@query("select cast(c_custkey as varchar) id from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P') order by id limit 100")
def first_missing(s, d):
    """The first keys, as text, that the other table lacks."""
    c = table(s, d, "customer").select("c_custkey")
    return c.join(table(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select(F.col("c_custkey").cast("string").alias("id")).orderBy("id").limit(100)


@query("select o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') order by o_orderpriority, o_orderkey limit 40")
def next_batch(s, d):
    """The next rows to do, of a stated number, after those done."""
    o = table(s, d, "orders")
    return sinks.remaining(o, o.where("o_orderstatus = 'F'"), "o_orderkey").orderBy("o_orderpriority", "o_orderkey").limit(40).select("o_orderkey")


_CHANGED = "from (select o_orderkey, count(*) filter (where l_discount > 0.05) first, count(*) n, min(case when l_discount > 0.05 then 1 else 3 end) tier from orders join lineitem on l_orderkey = o_orderkey group by 1)"


@query(f"select cast(o_orderkey as varchar) entity, tier, first, n {_CHANGED} order by tier, first desc, entity limit 25")
def worst_changes(s, d):
    """Entities with the gravest changes first: by the least tier, then by how many of tier 1."""
    li = table(s, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("entity"), F.when(F.col("l_discount") > 0.05, 1).otherwise(3).alias("tier"))
    return li.groupBy("entity").agg(F.min("tier").alias("tier"), F.count_if(F.col("tier") == 1).alias("first"), F.count("*").alias("n")).orderBy("tier", F.desc("first"), "entity").limit(25)


@query("select id, name, position, jersey_number from (select *, row_number() over (partition by id order by updated_at desc nulls last, name desc nulls last, position desc nulls last, jersey_number desc nulls last, current_club_name desc nulls last) r from pipeline_players) where r = 1 and current_club_name = (select min(name) from clubs where name like 'Real %') order by jersey_number nulls last, id")
def team_roster(s, d):
    """A club found by its name, then its members by number."""
    one = records.latest(table(s, d, "pipeline_players"), "id", ["name", "position", "jersey_number", "current_club_name"], "updated_at")
    club = table(s, d, "clubs").where("name like 'Real %'").agg(F.min("name").alias("current_club_name"))
    return one.join(F.broadcast(club), "current_club_name").select("id", "name", "position", "jersey_number").orderBy(F.asc_nulls_last("jersey_number"), "id")  # one row


@query("select user_id, event_id, ts, event_type from events where user_id = (select min(user_id) from events) order by ts desc, event_id desc")
def entity_history(s, d):
    e = table(s, d, "events").select("user_id", "event_id", "ts", "event_type")
    return e.join(F.broadcast(e.agg(F.min("user_id").alias("user_id"))), "user_id").orderBy(F.desc("ts"), F.desc("event_id"))  # one row


@query("select p.id, full_legal_name, current_club, in_squad from (select id, max(full_legal_name) full_legal_name from players group by 1) p join (select player_id, current_club from (select *, row_number() over (partition by player_id order by updated_at desc nulls last, current_club desc nulls last) r from player_career) where r = 1) c on c.player_id = p.id join (select player_id, in_squad from (select *, row_number() over (partition by player_id order by updated_at desc nulls last, in_squad desc nulls last) r from player_tournament) where r = 1) t on t.player_id = p.id where full_legal_name ilike '%mar%'")
def full_profile(s, d):
    """A person's three tables side by side, searched by a part of the name."""
    p = table(s, d, "players").groupBy("id").agg(F.max("full_legal_name").alias("full_legal_name")).where(F.col("full_legal_name").ilike("%mar%"))
    c, t = (records.latest(table(s, d, n), "player_id", [f], "updated_at").withColumnRenamed("player_id", "id") for n, f in (("player_career", "current_club"), ("player_tournament", "in_squad")))
    return p.join(c, "id").join(t, "id")


# -- identity --------------------------------------------------------------------------------------------------------

_CANON = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s-]', '', 'g'), '\\s+', ' ', 'g'))"
_IDENTITY = f"""with p as (select profile_id, display_name, date_of_birth, nationality, current_club from (select *, row_number() over (partition by profile_id order by updated_at desc nulls last, display_name desc nulls last, date_of_birth desc nulls last, nationality desc nulls last, current_club desc nulls last) r from profile_players_staging where profile_id is not null) where r = 1 and regexp_matches(coalesce(display_name, '') || coalesce(current_club, ''), '^[ -~]*$')),
k as (select p.profile_id, case when coalesce(display_name, '') <> '' and date_of_birth is not null and coalesce(team_code, '') <> '' then list_extract(string_split({_CANON.format('display_name')}, ' '), -1) || '|' || strftime(date_of_birth, '%Y-%m-%d') || '|' || upper(team_code) end pk, {_CANON.format("coalesce(display_name, '')")} || '|' || upper(coalesce(team_code, '')) || '|' || {_CANON.format("coalesce(nullif(current_club, ''), 'unknown')")} fk from p left join wc_2026_team_map on nationality = nationality_value),
i as (select profile_id, coalesce(pk, fk) dedup_key, case when pk is null then 'fallback' else 'primary' end kind, row_number() over (partition by coalesce(pk, fk) order by profile_id) > 1 duplicate from k)"""


def _identities(s, d) -> DataFrame:
    fields = ["display_name", "date_of_birth", "nationality", "current_club"]
    p = records.latest(table(s, d, "profile_players_staging"), "profile_id", fields, "updated_at").where(_ascii("display_name", "current_club"))
    teams = table(s, d, "wc_2026_team_map").select(F.col("nationality_value").alias("nationality"), "team_code")
    key = identity.identity_key(F.col("display_name"), F.col("display_name"), F.col("date_of_birth"), F.col("team_code"), F.col("current_club"))
    return identity.identified(p.join(teams, "nationality", "left"), key, [F.col("profile_id")])


@query(_IDENTITY + " select profile_id, dedup_key, kind, duplicate from i")
def identity_keys(s, d):
    """Keys of persons with ASCII names, by surname, birth date and team, or the fallback; later rows of a key are duplicates."""
    return _identities(s, d).select("profile_id", "dedup_key", "kind", "duplicate")


@query(_IDENTITY + " select a.profile_id owner, 'duplicate_source_id' alias_type, b.profile_id alias_value from i a join i b using (dedup_key) where not a.duplicate and b.duplicate")
def duplicate_aliases(s, d):
    """Duplicates as other ids of the row that keeps their key."""
    i = _identities(s, d).select("profile_id", "dedup_key", "duplicate")
    keeper = i.where("not duplicate").select("dedup_key", F.col("profile_id").alias("owner"))
    return i.where("duplicate").join(keeper, "dedup_key").select("owner", F.lit("duplicate_source_id").alias("alias_type"), F.col("profile_id").alias("alias_value"))


@query("""select min(profile_id) profile_id, alias_type, alias_value from (select profile_id, 'transfermarkt_id' alias_type, tm_id alias_value from profile_players_staging union all select profile_id, 'apif_id', apif_id from profile_players_staging union all select profile_id, 'transfermarkt_url', tm_url from profile_players_staging
union all select id, 'alternate_name', known_as from players where known_as <> full_legal_name union all select id, 'nickname', json_extract_string(j, '$.nickname') from (select id, unnest(json_extract(nicknames, '$[*]')) j from players)) where alias_value is not null and trim(alias_value) <> '' group by 2, 3""")
def aliases_by_kind(s, d):
    p = identity.aliases(table(s, d, "profile_players_staging"), "profile_id", {"transfermarkt_id": F.col("tm_id"), "apif_id": F.col("apif_id"), "transfermarkt_url": F.col("tm_url")}, {})
    w = table(s, d, "players").withColumnRenamed("id", "profile_id")
    other = F.when(F.col("known_as") != F.col("full_legal_name"), F.col("known_as"))
    return p.unionByName(identity.aliases(w, "profile_id", {"alternate_name": other}, {"nickname": records.as_list(F.col("nicknames"), "nickname")}))


@query("""with r as (select distinct apif_id, tm_id, apif_name, nationality from dedup_pairs where apif_id is not null), by_id as (select apif_id, min(tm_id) t from r group by 1 having count(distinct tm_id) = 1), squad as (select nationality, lower(name) n, min(id) t from pipeline_players where jersey_number is not null and id not like 'apif_%' group by 1, 2), a as (select distinct apif_id, lower(apif_name) n, nationality from r), by_squad as (select apif_id, min(squad.t) t from a join squad on squad.nationality = a.nationality and squad.n = a.n group by 1), names as (select lower(name) n, min(id) t from pipeline_players where id not like 'apif_%' group by 1), by_name as (select apif_id, min(names.t) t from a join names using (n) group by 1)
select distinct r.apif_id, case when abs(hash_bit) = 0 then null else coalesce(by_id.t, by_squad.t, by_name.t) end target, case when hash_bit = 0 then 'api_error' when by_id.t is not null then 'alias' when by_squad.t is not null then 'squad' when by_name.t is not null then 'name' else 'no_match' end route from (select distinct apif_id, length(apif_id) % 7 hash_bit from r where regexp_matches(apif_name, '^[ -~]*$')) r left join by_id using (apif_id) left join by_squad using (apif_id) left join by_name using (apif_id)""")
def three_way_match(s, d):
    """Live rows led to base rows by a known id, else by squad, else by name; failed answers as such. Rows with an ASCII name."""
    r = table(s, d, "dedup_pairs").where("apif_id is not null").select("apif_id", "tm_id", "apif_name", "nationality").distinct()
    by_id = r.groupBy("apif_id").agg(F.min("tm_id").alias("target"), F.count_distinct("tm_id").alias("n")).where("n = 1")
    base = table(s, d, "pipeline_players").where(~F.col("id").like("apif_%")).select("id", F.lower("name").alias("n"), "nationality", "jersey_number")
    rows = r.select("apif_id", F.lower("apif_name").alias("n"), "nationality").distinct()
    squad = rows.join(base.where("jersey_number is not null").groupBy("nationality", "n").agg(F.min("id").alias("target")), ["nationality", "n"])
    name = rows.join(base.groupBy("n").agg(F.min("id").alias("target")), "n")
    wanted = r.where(_ascii("apif_name")).select("apif_id").distinct()
    return identity.routed(wanted, "apif_id", [("alias", by_id), ("squad", squad), ("name", name)], F.length("apif_id") % 7 == 0)


# -- reports and counters --------------------------------------------------------------------------------------------


@query("""select 'rows' section, 'pipeline_players' "key", count(*) n from pipeline_players union all select 'position', coalesce(position, 'none'), count(*) from pipeline_players group by 2 union all select 'source', case when id like 'apif_%' then 'APIF' else 'TM' end, count(*) from pipeline_players group by 2""")
def run_summary(s, d):
    """Counts of a run: all rows, by source, by position."""
    source = F.when(F.col("id").like("apif_%"), "APIF").otherwise("TM")
    return sinks.summary(table(s, d, "pipeline_players"), "pipeline_players", {"position": F.coalesce("position", F.lit("none")), "source": source})


@query("""select * from (values (0, 'r_regionkey', 'int'), (1, 'r_name', 'string')) v(ord, "column", "type")""")
def column_catalogue(s, d):
    return records.catalogue(table(s, d, "region"))


@query("select source, max(coalesce(new_at, old_at))::timestamp last_at, max(case when new_at is null then 'OK' else 'REFRESHED' end) status from (select source, max(ingested_at) old_at, max(ingested_at) filter (where lang = 'en') new_at from documents where source is not null group by 1) group by 1")
def freshness_markers(s, d):
    """A marker for each kind of data, replaced by a newer run's."""
    docs = table(s, d, "documents").where("source is not null")
    old = docs.groupBy("source").agg(F.max("ingested_at").alias("last_at")).withColumn("status", F.lit("OK"))
    new = docs.where("lang = 'en'").groupBy("source").agg(F.max("ingested_at").alias("last_at")).withColumn("status", F.lit("REFRESHED"))
    return dml.upsert(old, new, ["source"])


@query("select user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') \"day\", cast(sum(case when half = 0 then 1 else 0 end) + sum(case when half = 1 then 1 else 0 end) as bigint) n, sum(count(*)) over (partition by user_id, date_trunc('month', date_trunc('day', ts))) <= 30 within_limit from (select user_id, ts, event_id % 2 half from events) group by user_id, date_trunc('day', ts)")
def usage_counters(s, d):
    """Daily counters to which a second batch is added, and whether the month stays within a limit."""
    daily = lambda half: table(s, d, "events").where(F.col("event_id") % 2 == half).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    both = dml.add_counts(daily(0), daily(1), ["user_id", "day"], "n")
    month = F.sum("n").over(Window.partitionBy("user_id", F.trunc("day", "month")))
    return both.withColumn("within_limit", month <= 30).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("select user_id, '{' || string_agg('\"' || event_type || '\":' || n, ',' order by event_type) || '}' shares from (select user_id, event_type, cast(cast(round(100.0 * count(*) / sum(count(*)) over (partition by user_id), 0) as int) as varchar) n from events group by 1, 2) group by 1")
def crowd_shares(s, d):
    """What share of a user's events is of each kind, as a JSON map."""
    n = table(s, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    share = F.round(F.lit(100).cast("decimal(20,6)") * F.col("n") / F.sum("n").over(Window.partitionBy("user_id")), 0).cast("int")
    return n.select("user_id", "event_type", share.alias("s")).groupBy("user_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "s"))))).alias("shares"))


@query("""with t as (select player_id, doc_id, text, row_number() over (partition by player_id order by doc_id) r from documents where player_id is not null and text is not null and (contains(lower(text), 'goal') or contains(lower(text), 'gol'))), direct as (select player_id, min(doc_id) doc_id from t where doc_id % 2 = 0 group by 1), found as (select player_id, min(doc_id) doc_id from t where doc_id % 2 = 1 group by 1)
select p.player_id, coalesce(direct.doc_id, found.doc_id) doc_id, case when direct.doc_id is not null then 'direct' when found.doc_id is not null then 'search' else 'none' end how from (select distinct player_id from documents where player_id is not null) p left join direct using (player_id) left join found using (player_id)""")
def summary_fallback(s, d):
    """A person's summary: the page of that title if it speaks of the subject, else the first search hit that does."""
    docs = table(s, d, "documents").where("player_id is not null")
    said = sinks.speaks_of(F.col("text"), ("goal", "gol"))
    first = lambda half: docs.where((F.col("doc_id") % 2 == half) & said).groupBy("player_id").agg(F.min("doc_id").alias("target"))
    return identity.routed(docs.select("player_id").distinct(), "player_id", [("direct", first(0)), ("search", first(1))]).select("player_id", F.col("target").alias("doc_id"), F.when(F.col("route") == "no_match", "none").otherwise(F.col("route")).alias("how"))


@query("select cast(l_orderkey as varchar) entity, min(l_linenumber) first_source, count(distinct l_linenumber) sources from lineitem where l_returnflag is not null and l_linenumber in (1, 3, 4) group by 1")
def permitted_sources(s, d):
    """Which source gives a field, where not every source may state it."""
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("current_club"))
    long = reconcile.long_form(li, "l_orderkey", F.concat(F.lit("source"), "l_linenumber"), F.col("l_linenumber"), ["current_club"])
    allowed = reconcile.permitted(long, {"source1": ("current_club",), "source2": ("position",), "source3": ("current_club", "position"), "source4": ("current_club",)})
    return allowed.groupBy("entity").agg(F.min("prio").alias("first_source"), F.count_distinct("source").alias("sources"))


@query("select cast(o_orderkey as varchar) entity, case when o_orderkey % 5 = 0 then ['contract_expires'] else [] end missing, round(case when o_orderkey % 5 = 0 then 1 else 2 end / 2.0, 2)::double coverage from orders where o_orderkey % 5 = 0")
def missing_critical(s, d):
    """Entities that lack critical fields, and the share they have."""
    current = _states(s, d)[0].withColumn("value", nulls.null_if_sentinel(F.col("value")))
    return reconcile.missing_fields(current, ["current_club", "contract_expires"])
