"""Queries over the star-schema tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.functions import parse, text
from kinweave.operators import dml, exact, quality, ranking, reconcile
from kinweave.streaming import live

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("select cast(c_custkey as varchar) id, c_name, cast(floor(c_acctbal) as bigint) balance from customer where c_acctbal > 0")
def scan_project_filter(s, d):
    return table(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("id"), "c_name", F.floor("c_acctbal").alias("balance"))


@query("""select o_orderkey, case when o_totalprice >= 300000 and o_orderstatus = 'F' then 'high' when o_totalprice >= 100000 or o_orderpriority in ('1-URGENT', '2-HIGH') then 'medium' else 'low' end grade from orders""")
def case_grade(s, d):
    grade = F.when((F.col("o_totalprice") >= 300000) & (F.col("o_orderstatus") == "F"), "high").when((F.col("o_totalprice") >= 100000) | F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "medium").otherwise("low")
    return table(s, d, "orders").select("o_orderkey", grade.alias("grade"))


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else o_orderstatus end status from orders")
def case_recode(s, d):
    return table(s, d, "orders").select("o_orderkey", text.recode(F.col("o_orderstatus"), {"O": "open", "F": "filled"}).alias("status"))


@query(r"""select p_partkey, case when p_name like 'small%' then 'small' when p_name ilike '%RING' or p_name ilike '%WIDGET' then 'ring or widget' when regexp_matches(p_name, '(?i)\bBLUE\b') then 'blue' when p_type in ('ECONOMY', 'PROMO') then 'cheap' else 'other' end class from part""")
def pattern_class(s, d):
    return table(s, d, "part").selectExpr("p_partkey", r"case when p_name like 'small%' then 'small' when p_name ilike any ('%RING', '%WIDGET') then 'ring or widget' when p_name rlike r'(?i)\bBLUE\b' then 'blue' when p_type in ('ECONOMY', 'PROMO') then 'cheap' else 'other' end as class")


@query("select count(*) n from orders")
def count_all(s, d):
    return table(s, d, "orders").agg(F.count("*").alias("n"))


@query("select o_orderstatus, count(*) n, cast(round(100.0 * count(*) / sum(count(*)) over (), 1) as double) pct, cast(sum(case when o_totalprice > 400000 then 1 else 0 end) as bigint) flagged from orders group by 1")
def share_breakdown(s, d):
    g = table(s, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.when(F.col("o_totalprice") > 400000, 1).otherwise(0)).alias("flagged"))
    total = F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # a row for each status
    return g.withColumn("pct", F.round(F.lit(100).cast("decimal(20,6)") * F.col("n") / total, 1).cast("double"))


@query("""select n_name, count(*) filter (where o_orderstatus = 'O') n_open, count(*) filter (where o_orderstatus = 'F') n_filled, count(*) filter (where o_orderstatus = 'P') n_part from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""")
def filter_pivot(s, d):
    j = table(s, d, "orders").join(table(s, d, "customer"), F.expr("o_custkey = c_custkey")).join(table(s, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    return j.groupBy("n_name").agg(*[F.count_if(F.col("o_orderstatus") == v).alias(n) for n, v in (("n_open", "O"), ("n_filled", "F"), ("n_part", "P"))])


@query("""select p_type, count(*) n, count(nullif(p_brand, 'Brand#1')) n_brand, count(nullif(p_size, 1)) n_size from part group by 1""")
def null_counts(s, d):
    return table(s, d, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.count(F.nullif("p_brand", F.lit("Brand#1"))).alias("n_brand"), F.count(F.nullif("p_size", F.lit(1))).alias("n_size"))


@query("select p_name, count(*) n, count(distinct p_brand) brands, count(distinct p_size) sizes from part group by 1 having count(*) > 1")
def name_twins(s, d):
    return table(s, d, "part").groupBy("p_name").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands"), F.count_distinct("p_size").alias("sizes")).where("n > 1")


@query("""select n_name, count(c_custkey) size, cast(round(avg(c_acctbal) filter (where c_acctbal > 0), 6) as double) avg_positive, max(c_acctbal) most, coalesce(round(sum(c_acctbal), 2), 0) total from nation left join customer on c_nationkey = n_nationkey group by 1""")
def group_report(s, d):
    j = table(s, d, "nation").join(table(s, d, "customer"), F.expr("c_nationkey = n_nationkey"), "left")
    return j.groupBy("n_name").agg(F.count("c_custkey").alias("size"), F.round(F.avg(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))), 6).alias("avg_positive"), F.max("c_acctbal").alias("most"), F.coalesce(F.round(F.sum("c_acctbal"), 2), F.lit(0.0)).alias("total"))


@query("select o_custkey, count(*) n from orders group by 1 having count(*) < 3")
def thin_groups(s, d):
    return table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n < 3")


@query("select n_name, cast(round(sum(o_totalprice), 2) as double) value from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1 order by value desc nulls last, n_name limit 10")
def top_value_groups(s, d):
    j = table(s, d, "orders").join(table(s, d, "customer"), F.expr("o_custkey = c_custkey")).join(table(s, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum("o_totalprice"), 2).alias("value")).orderBy(F.desc_nulls_last("value"), "n_name").limit(10)


@query("select * from (select c_nationkey, c_custkey, c_acctbal, row_number() over (partition by c_nationkey order by c_acctbal desc nulls last, c_mktsegment, c_custkey) rank from customer) where rank <= 40")
def squad_topn(s, d):
    order = [F.desc_nulls_last("c_acctbal"), F.asc_nulls_last("c_mktsegment"), F.asc("c_custkey")]
    return ranking.top_n(table(s, d, "customer"), ["c_nationkey"], order, 40).select("c_nationkey", "c_custkey", "c_acctbal", "rank")


@query("select c_nationkey, c_custkey, case when rank <= 26 then 'squad' else 'reserve' end part from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc nulls last, c_custkey) rank from customer) where rank <= 40")
def squad_split(s, d):
    top = ranking.top_n(table(s, d, "customer"), ["c_nationkey"], [F.desc_nulls_last("c_acctbal"), F.asc("c_custkey")], 40)
    return ranking.split_ranks(top, 26, 40).select("c_nationkey", "c_custkey", "part")


@query("select * from (select p_partkey, p_name, row_number() over (partition by p_name, p_brand order by case p_type when 'PROMO' then 0 when 'STANDARD' then 1 else 2 end, p_partkey) keep_rank from part) where keep_rank > 1")
def keep_rank_dupes(s, d):
    kind = F.when(F.col("p_type") == "PROMO", 0).when(F.col("p_type") == "STANDARD", 1).otherwise(2)
    return ranking.later_rows(table(s, d, "part"), [F.col("p_name"), F.col("p_brand")], [kind, F.col("p_partkey")]).select("p_partkey", "p_name", "keep_rank")


@query("select p_partkey, case when n > 1 then replace(p_name, ' ', '-') || '_' || n else replace(p_name, ' ', '-') end uid from (select *, row_number() over (partition by p_name order by p_partkey) n from part)")
def counter_suffix_ids(s, d):
    return ranking.counted_ids(table(s, d, "part").withColumn("base", F.replace("p_name", F.lit(" "), F.lit("-"))), "base", [F.col("p_partkey")]).select("p_partkey", "uid")


@query("select o_custkey, max(o_orderkey) filter (where rn = 1) o_orderkey, max(o_orderstatus) filter (where rn = 1) o_orderstatus from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn from orders) group by 1")
def last_wins(s, d):
    return ranking.last_of(table(s, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"]).drop("o_orderdate")


@query("select * from (select o_custkey, o_orderkey, o_orderstatus, lag(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderkey) previous from orders) where previous <> o_orderstatus")
def lag_switch(s, d):
    return quality.switched(table(s, d, "orders"), "o_custkey", "o_orderstatus", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus", "previous")


@query("select o_custkey, string_agg(strftime(o_orderdate, '%Y-%m-%d') || ' ' || o_orderstatus, ' | ' order by o_orderdate, o_orderkey) line from orders group by 1")
def trajectory(s, d):
    ordered = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")))
    line = F.array_join(F.transform(ordered, lambda x: F.concat(F.date_format(x["o_orderdate"], "yyyy-MM-dd"), F.lit(" "), x["o_orderstatus"])), " | ")
    return table(s, d, "orders").groupBy("o_custkey").agg(line.alias("line"))


@query("select p_partkey, p_name, p_retailprice from part where p_name ilike '%ring%' order by p_retailprice desc nulls last, p_partkey limit 5")
def search_topk(s, d):
    return table(s, d, "part").where(F.col("p_name").ilike("%ring%")).select("p_partkey", "p_name", "p_retailprice").orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey").limit(5)


@query("select c_custkey, c_acctbal from customer order by case c_mktsegment when 'MACHINERY' then 0 when 'HOUSEHOLD' then 1 else 2 end, c_acctbal asc nulls first, c_custkey limit 25")
def custom_order(s, d):
    rank = F.when(F.col("c_mktsegment") == "MACHINERY", 0).when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(2)
    return table(s, d, "customer").orderBy(rank, F.asc_nulls_first("c_acctbal"), "c_custkey").select("c_custkey", "c_acctbal").limit(25)


@query("select c_custkey from customer order by md5(cast(c_custkey as varchar) || '42'), c_custkey limit 100")
def sample_hash(s, d):
    return ranking.sample(table(s, d, "customer"), "c_custkey", 100).select("c_custkey")


@query("""select 'either' part, count(*) n from (select l_partkey from lineitem where l_returnflag = 'R' union select l_partkey from lineitem where l_returnflag = 'A') union all select 'both', count(*) from (select l_partkey from lineitem where l_returnflag = 'R' intersect select l_partkey from lineitem where l_returnflag = 'A') union all select 'only', count(*) from (select p_partkey from part except select l_partkey from lineitem where l_returnflag = 'R')""")
def set_ops(s, d):
    li = table(s, d, "lineitem")
    r, a = (li.where(F.col("l_returnflag") == x).select("l_partkey") for x in "RA")
    parts = (("either", r.union(a).distinct()), ("both", r.intersect(a)), ("only", table(s, d, "part").select(F.col("p_partkey").alias("l_partkey")).distinct().join(r, "l_partkey", "left_anti")))
    out = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("part"), "n") for n, df in parts]
    return out[0].unionAll(out[1]).unionAll(out[2])


@query("""select o_orderkey, (select count(*) from orders b where b.o_custkey = a.o_custkey and b.o_orderpriority = a.o_orderpriority) - 1 twins from orders a""")
def scalar_corr_count(s, d):
    o = table(s, d, "orders")
    counts = o.groupBy("o_custkey", "o_orderpriority").agg((F.count("*") - 1).alias("twins"))
    return o.join(counts, ["o_custkey", "o_orderpriority"], "left").select("o_orderkey", "twins")


@query("select distinct a.o_orderkey a, b.o_orderkey b from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderdate = b.o_orderdate and a.o_orderkey < b.o_orderkey")
def inequality_selfjoin(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    j = o.withColumnRenamed("o_orderkey", "a").join(o.withColumnRenamed("o_orderkey", "b"), ["o_custkey", "o_orderdate"]).where("a < b")
    return j.select("a", "b").distinct()


@query("select c_custkey, count(o_orderkey) n from customer left join orders on c_custkey = o_custkey and (o_orderstatus = 'F' or o_totalprice > 400000) group by 1")
def left_or_residual(s, d):
    on = F.expr("c_custkey = o_custkey and (o_orderstatus = 'F' or o_totalprice > 400000)")
    return table(s, d, "customer").join(table(s, d, "orders"), on, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 450000) or c_nationkey in (select s_nationkey from supplier where s_acctbal > 9900)")
def semi_or(s, d):
    a = table(s, d, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_a", F.lit(True))
    b = table(s, d, "supplier").where("s_acctbal > 9900").select(F.col("s_nationkey").alias("c_nationkey")).distinct().withColumn("_b", F.lit(True))
    return table(s, d, "customer").join(a, "c_custkey", "left").join(b, "c_nationkey", "left").where("_a or _b").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus <> 'F')")
def exists_antijoin(s, d):
    return table(s, d, "customer").join(table(s, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 48 and l_partkey is not null)")
def not_in_anti(s, d):
    return table(s, d, "part").select("p_partkey").join(table(s, d, "lineitem").where("l_quantity > 48 and l_partkey is not null").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


@query("select distinct c_custkey, k target from customer join (select 'name' kind, s_name v, s_suppkey k from supplier union all select 'nation', cast(s_nationkey as varchar), s_suppkey from supplier where s_acctbal > 9000) on (kind = 'name' and v = replace(c_name, 'Customer', 'Supplier')) or (kind = 'nation' and v = cast(c_nationkey as varchar))")
def alias_or_join(s, d):
    sup = table(s, d, "supplier")
    aliases = sup.select(F.lit("name").alias("kind"), F.col("s_name").alias("value"), F.col("s_suppkey").alias("target")).unionAll(sup.where("s_acctbal > 9000").select(F.lit("nation"), F.col("s_nationkey").cast("string"), "s_suppkey"))
    rows = table(s, d, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("as_name"), F.col("c_nationkey").cast("string").alias("as_nation"))
    return exact.or_join(rows, aliases, [("as_name", "name"), ("as_nation", "nation")], "target").select("c_custkey", "target").distinct()


_VALUES = """with v as (select cast(l_orderkey as varchar) entity, field, l_linenumber prio, min(value) "value" from (select l_orderkey, l_linenumber, 'current_club' field, l_returnflag "value" from lineitem union all select l_orderkey, l_linenumber, 'position', l_linestatus from lineitem union all select l_orderkey, l_linenumber, 'height_cm', cast(cast(l_quantity as bigint) as varchar) from lineitem) where "value" is not null group by all)"""
_VOTES = _VALUES + """, f as (select *, lower("value") form from v), c as (select entity, field, form, count(*) n, min(prio) prio, arg_min("value", prio) stated from f group by all), g as (select entity, field, cast(sum(n) as bigint) n_sources, count(*) n_values, max(n) majority, arg_min(stated, prio) top_value, arg_min(form, prio) top_form from c group by all having sum(n) >= 2), m as (select c.entity, c.field, c.form majority_value, row_number() over (partition by c.entity, c.field order by n desc, prio) r from c),
o as (select g.*, majority_value, majority_value = top_form agrees, majority >= 2 and n_sources - majority <= 1 outlier, case g.field when 'current_club' then 'CRITICAL' when 'position' then 'IMPORTANT' else 'INFORMATIONAL' end lvl from g join m on g.entity = m.entity and g.field = m.field and r = 1),
w as (select *, case when n_values = 1 then 'agreed' when outlier and agrees then 'dismissed' else 'conflict' end outcome, case when not outlier and majority >= 2 and agrees and lvl = 'CRITICAL' then 'INFORMATIONAL' else lvl end severity from o),
votes as (select entity, field, n_sources, n_values, majority_value, majority, top_value, outcome, severity, case when outcome <> 'conflict' then 'none' when severity = 'INFORMATIONAL' then 'auto_resolved' else 'needs_review' end status from w) """


def _values(s, d):
    """The lines of an order as sources of falling trust that state three fields of one entity."""
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("current_club"), F.col("l_linestatus").alias("position"), F.col("l_quantity").cast("bigint").alias("height_cm"))
    long = reconcile.long_form(li, "l_orderkey", F.concat(F.lit("source"), "l_linenumber"), F.col("l_linenumber"), ["current_club", "position", "height_cm"])
    return long.groupBy("entity", "field", "source", "prio").agg(F.min("value").alias("value"))


@query(_VALUES + """ select entity, field, arg_min("value", prio) "value", 'source' || min(prio) source, count(*) n_sources from v group by entity, field""")
def recon_merge(s, d):
    return reconcile.merge(_values(s, d))


@query(_VOTES + "select * from votes")
def recon_majority(s, d):
    return reconcile.vote(_values(s, d))


@query(_VOTES + "select entity, count(*) filter (where outcome = 'conflict') n_conflicts, bool_or(severity = 'CRITICAL' and status = 'needs_review') blocked from votes group by 1")
def recon_blocked(s, d):
    return reconcile.blocked(reconcile.vote(_values(s, d)))


@query(_VOTES + "select severity, field, count(*) n from votes where outcome = 'conflict' group by all")
def recon_report(s, d):
    return reconcile.report(reconcile.vote(_values(s, d)))


@query(_VOTES + "select entity, field, case when status = 'needs_review' and severity <> 'CRITICAL' then 'resolved' else status end status, case when status = 'needs_review' and severity <> 'CRITICAL' then top_value end resolved_value from votes")
def recon_noncritical(s, d):
    return reconcile.resolve_by_priority(reconcile.vote(_values(s, d))).select("entity", "field", "status", "resolved_value")


@query(_VALUES + """, w as (select entity, field, min("value") filter (where prio = 1) b, min("value") filter (where prio = 2) s, min("value") filter (where prio = 3) t from v group by all) select entity, field, s resolved_value from w where (contains(lower(s), lower(t)) or contains(lower(t), lower(s))) and lower(s) <> lower(b) and not contains(lower(s), lower(b))""")
def recon_agreement(s, d):
    return reconcile.agreement(_values(s, d), "source1", "source2", "source3")


@query("select a.o_orderkey a, b.o_orderkey b, greatest(a.o_totalprice, b.o_totalprice) >= 3 * least(a.o_totalprice, b.o_totalprice) conflict from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderpriority = b.o_orderpriority and a.o_orderkey < b.o_orderkey")
def recon_tolerant(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    j = o.withColumnsRenamed({"o_orderkey": "a", "o_totalprice": "x"}).join(o.withColumnsRenamed({"o_orderkey": "b", "o_totalprice": "y"}), ["o_custkey", "o_orderpriority"]).where("a < b")
    return j.select("a", "b", reconcile.tolerant_conflict(F.lit("market_value_eur"), F.col("x"), F.col("y")).alias("conflict"))


_CURRENT = "select cast(o_orderkey as varchar) entity, 'current_club' field, o_orderstatus \"value\" from orders union all select cast(o_orderkey as varchar), 'contract_expires', case when o_orderkey % 5 = 0 then 'null' else o_orderpriority end from orders"
_VERIFIED = "select cast(l_orderkey as varchar) entity, 'current_club' field, case when l_orderkey % 3 = 0 then ' N/A' else lower(min(l_linestatus)) end \"value\" from lineitem group by l_orderkey union all select cast(l_orderkey as varchar), 'contract_expires', case when l_orderkey % 4 = 0 then 'none' when l_orderkey % 4 = 1 then null else '2-HIGH ' end from lineitem group by l_orderkey"
_DIFF = f"""with c as ({_CURRENT}), v as ({_VERIFIED}), j as (select v.entity, v.field, case v.field when 'current_club' then 1 else 3 end tier, c."value" "old", v."value" "new", case when c."value" not in ('', 'null') then lower(trim(c."value")) end o, case when v."value" not in ('', 'null') and lower(trim(v."value")) not in ('null', 'none', 'n/a', 'unknown') then lower(trim(v."value")) end n from v left join c on c.entity = v.entity and c.field = v.field where v.entity in (select entity from c)),
d as (select entity, field, tier, "old", case when n is not null then "new" end "new", coalesce("old" in ('', 'null'), true) was_missing from j where o is distinct from n)"""


@query(_DIFF + " select * from d")
def verify_diff(s, d):
    return reconcile.diff(*_states(s, d))


@query(_DIFF + " select * from d where tier = 1")
def verify_diff_tier(s, d):
    return reconcile.diff(*_states(s, d), tier=1)


@query(_DIFF + """ select entity, 'recency_check: ' || string_agg('T' || tier || ':' || field || ':' || coalesce("old", 'NULL') || '->' || coalesce("new", 'NULL'), '; ' order by tier) curation_reason from d group by 1""")
def verify_flags(s, d):
    return reconcile.curation_flags(reconcile.diff(*_states(s, d)))


@query(_DIFF + " select case when was_missing then 'filled' else 'tier' || tier end kind, count(*) n from d group by 1")
def verify_counts(s, d):
    return reconcile.change_counts(reconcile.diff(*_states(s, d)))


@query("select cast(o_orderkey as varchar) entity from orders where o_orderstatus = 'F' and cast(o_orderkey as varchar) not in (select cast(o_orderkey as varchar) from orders where o_orderpriority = '1-URGENT')")
def verify_not_found(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("entity"), "o_orderstatus", "o_orderpriority")
    return reconcile.not_found(o.where("o_orderpriority = '1-URGENT'"), o.where("o_orderstatus = 'F'"))


@query(_DIFF + """ select c.entity, c.field, case when d.entity is not null then d."new" else c."value" end "value" from c left join d on c.entity = d.entity and c.field = d.field""")
def verify_apply(s, d):
    current, verified = _states(s, d)
    return reconcile.apply_changes(current, reconcile.diff(current, verified))


def _states(s, d):
    """An order's status and priority as two fields, and what its lines say of them, with words for nothing on both sides."""
    key = F.col("o_orderkey")
    current = table(s, d, "orders").select(key.cast("string").alias("entity"), F.explode(F.create_map(F.lit("current_club"), "o_orderstatus", F.lit("contract_expires"), F.when(key % 5 == 0, "null").otherwise(F.col("o_orderpriority")))).alias("field", "value"))
    lines, key = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_linestatus").alias("v")), F.col("l_orderkey")
    priority = F.when(key % 4 == 0, "none").when(key % 4 != 1, "2-HIGH ")
    verified = lines.select(key.cast("string").alias("entity"), F.explode(F.create_map(F.lit("current_club"), F.when(key % 3 == 0, " N/A").otherwise(F.lower("v")), F.lit("contract_expires"), priority)).alias("field", "value"))
    return current, verified


_OLD = "select c_custkey k, c_name n, c_acctbal b from customer where c_custkey % 7 <> 0"
_NEW = "select c_custkey k, c_name n, case when c_custkey % 5 = 0 then c_acctbal + 1 when c_custkey % 11 = 0 then null else c_acctbal end b from customer where c_custkey % 3 <> 0"


def _snapshots(s, d):
    """Two derived states of one table: keys missing from either, values changed and lost."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"))
    changed = F.when(F.col("k") % 5 == 0, F.col("b") + 1).when(F.col("k") % 11 == 0, None).otherwise(F.col("b"))
    return c.where("k % 7 <> 0"), c.where("k % 3 <> 0").withColumn("b", changed)


@query(f"select coalesce(a.k, b.k) k, case when a.k is null then 'added' when b.k is null then 'removed' when a.b is distinct from b.b or a.n is distinct from b.n then 'changed' else 'unchanged' end change from ({_OLD}) a full join ({_NEW}) b on a.k = b.k")
def snapshot_diff(s, d):
    return dml.snapshot_diff(*_snapshots(s, d), ["k"])


@query(f"select * from ({_OLD}) union all select * from ({_NEW}) where k not in (select k from ({_OLD}))")
def upsert_nothing(s, d):
    return dml.insert_missing(*_snapshots(s, d), ["k"])


@query(f"select coalesce(b.k, a.k) k, coalesce(b.n, a.n) n, coalesce(b.b, a.b) b from ({_OLD}) a full join ({_NEW}) b on a.k = b.k")
def upsert_coalesce(s, d):
    return dml.upsert(*_snapshots(s, d), ["k"])


@query(f"select a.k, a.n, case when b.k is not null then coalesce(b.b, 0) else a.b end b from ({_OLD}) a left join ({_NEW}) b on a.k = b.k")
def update_from(s, d):
    old, new = _snapshots(s, d)
    return dml.update_from(old, new, ["k"], {"b": F.coalesce("s_b", F.lit(0.0))})


@query(f"select * from ({_OLD}) where k not in (select k from ({_NEW}) where b is null)")
def delete_in(s, d):
    old, new = _snapshots(s, d)
    return dml.delete_in(old, new.where("b is null"), ["k"])


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1")
def live_latest(s, d):
    return live.latest(table(s, d, "events"), "user_id", ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


@query("select event_type, count(*) n, strftime(max(ts), '%Y-%m-%d %H:%M') last_at, case when date_diff('second', max(ts), timestamp '2024-01-31 06:00:00') <= 6 * 3600 + 300 then 'OK' when date_diff('second', max(ts), timestamp '2024-01-31 06:00:00') <= 172800 then 'STALE' else 'FAILING' end status from events group by 1")
def freshness(s, d):
    f = live.freshness(table(s, d, "events"), "event_type", "ts", "2024-01-31 06:00:00", 6 + 1 / 12, 48)
    return f.select("event_type", "n", F.date_format("last_at", "yyyy-MM-dd HH:mm").alias("last_at"), "status")


@query("""select event_type, cast(sum(cast(props ->> '$.k' as bigint)) as bigint) total, cast(max(cast(props ->> '$.k' as bigint)) as bigint) most from events group by 1""")
def json_extract(s, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(s, d, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.max(k).alias("most"))


@query("select strftime(ts, '%Y-%m-%d') \"day\", event_type, count(*) n, cast(round(count(*) / sum(count(*)) over (partition by strftime(ts, '%Y-%m-%d')), 6) as double) share from events group by 1, 2")
def share_by_day(s, d):
    g = table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))
    totals = g.groupBy("day").agg(F.sum("n").alias("all"))
    return g.join(totals, "day").select("day", "event_type", "n", F.round(F.col("n") / F.col("all"), 6).alias("share"))


@query("select event_type, strftime(ts, '%Y-%m') \"month\", count(distinct user_id) users, count(*) used, count(*) < 800 under_limit from events group by 1, 2")
def usage_rollup(s, d):
    return table(s, d, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("used")).withColumn("under_limit", F.col("used") < 800)


@query("""select l_orderkey, l_linenumber, case when a = x and b = y then 3 when sign(a - b) = sign(x - y) then 1 else 0 end points from (select l_orderkey, l_linenumber, l_partkey % 4 a, l_suppkey % 4 b, l_orderkey % 4 x, l_linenumber % 4 y from lineitem)""")
def score_rules(s, d):
    a, b, x, y = (F.col(c) % 4 for c in ("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"))
    points = F.when((a == x) & (b == y), 3).when(F.sign(a - b) == F.sign(x - y), 1).otherwise(0)
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", points.alias("points"))


@query("select n_name, cast(round(avg(c_acctbal), 6) as double) avg_balance from customer join nation on c_nationkey = n_nationkey where c_acctbal is not null group by 1")
def group_avg(s, d):
    return table(s, d, "customer").join(table(s, d, "nation"), F.expr("c_nationkey = n_nationkey")).where("c_acctbal is not null").groupBy("n_name").agg(F.round(F.avg("c_acctbal"), 6).alias("avg_balance"))


@query("select c_mktsegment, cast(round(sum(case when c_nationkey = 2 then c_acctbal else 0 end), 2) as double) a, cast(round(sum(case when c_nationkey = 19 then c_acctbal else 0 end), 2) as double) b from customer group by 1")
def group_compare(s, d):
    part = lambda n: F.round(F.sum(F.when(F.col("c_nationkey") == n, F.col("c_acctbal")).otherwise(0.0)), 2)
    return table(s, d, "customer").groupBy("c_mktsegment").agg(part(2).alias("a"), part(19).alias("b"))


@query("select cast(round(corr(l_quantity, l_extendedprice), 4) as double) r from lineitem")
def correlation(s, d):
    return table(s, d, "lineitem").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 4).alias("r"))


@query("select 'customer' name, count(*) n from customer union all select 'orders', count(*) from orders union all select 'lineitem', count(*) from lineitem")
def table_counts(s, d):
    parts = [table(s, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in ("customer", "orders", "lineitem")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("select p_partkey, cast(p_retailprice as bigint) // 100 hundreds from part order by p_retailprice desc, p_partkey limit 20")
def integer_division(s, d):
    return table(s, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20).selectExpr("p_partkey", "cast(round(p_retailprice) as bigint) div 100 as hundreds")


@query("select p_partkey, cast(p_size * 1000000 as bigint) merge, case when p_size % 2 = 0 then cast(p_size * 1000 as bigint) end even from part")
def parse_money(s, d):
    p = table(s, d, "part")
    m = parse.money(F.concat(F.lit("€"), F.col("p_size"), F.lit("M")))
    e = parse.money(F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size"), F.lit("K"))), "push")
    return p.select("p_partkey", m.alias("merge"), e.alias("even"))


_EURO = """select ord, height, trim(replace(replace(replace(lower(marketvalue), '€', ''), '$', ''), ',', '')) t from player_bio"""
_NUM = r"try_cast(case when regexp_matches(trim({0}), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') then trim({0}) end as double)"
_OF = lambda unit, times: f"cast(trunc({_NUM.format('regexp_replace(t, ' + repr(unit) + ', %s, %s)' % (repr(''), repr('g')))} * {times}) as bigint)"


@query(f"""with b as ({_EURO}) select ord,
  case when regexp_matches(trim(height), '^\\d+[.,]\\d+\\s*m') then cast(regexp_extract(trim(height), '^(\\d+)[.,]', 1) as int) * 100 + cast(regexp_extract(trim(height), '^\\d+[.,](\\d+)', 1) as int)
    when regexp_matches(trim(height), '^\\d+\\s*cm') then cast(regexp_extract(trim(height), '^(\\d+)', 1) as int)
    when floor({_NUM.format('height')}) > 100 and floor({_NUM.format('height')}) < 250 then cast(trunc({_NUM.format('height')}) as int) end height,
  case when contains(t, 'million') or suffix(t, 'm') then {_OF('million|m', 1e6)} when contains(t, 'billion') or suffix(t, 'b') then {_OF('billion|b', 1e9)} when contains(t, 'k') then {_OF('k', 1e3)} else cast(trunc({_NUM.format('t')}) as bigint) end of_merge,
  case when contains(t, 'm') then {_OF('million|m', 1e6)} when contains(t, 'b') then {_OF('billion|b', 1e9)} else cast(trunc({_NUM.format('t')}) as bigint) end of_literal from b""")
def parse_bios(s, d):
    """Heights and values as people type them, by the rules of two steps."""
    return table(s, d, "player_bio").select("ord", parse.height(F.col("height")).alias("height"), parse.money(F.col("marketvalue")).alias("of_merge"), parse.money(F.col("marketvalue"), "literal").alias("of_literal"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') iso, strftime(o_orderdate, '%Y') || '-06-30' of_year, strftime(o_orderdate, '%Y-%m') || '-28' of_month, strftime(o_orderdate, '%Y-%m') || '-28' of_day from orders")
def parse_contract(s, d):
    day = F.col("o_orderdate")
    forms = [F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy"), F.date_format(day, "MMMM yyyy"), F.date_format(day, "'until 'd MMMM yyyy")]
    return table(s, d, "orders").select("o_orderkey", *[parse.contract_day(f).alias(n) for f, n in zip(forms, ("iso", "of_year", "of_month", "of_day"), strict=True)])


@query("select o_orderkey, date_diff('year', cast(o_orderdate as date), date '2026-06-11') - case when strftime(o_orderdate, '%m%d') > '0611' then 1 else 0 end age from orders")
def age_at(s, d):
    return table(s, d, "orders").select("o_orderkey", parse.age_at(F.col("o_orderdate")).cast("bigint").alias("age"))


@query("select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') slug, list_extract(string_split(p_name, ' '), -1) last from part")
def slug_and_last(s, d):
    return table(s, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.last_token(F.col("p_name")).alias("last"))
