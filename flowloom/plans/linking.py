"""Queries of the linking stage, over the inventory, registry and catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import exprs as x
from flowloom.operators import catalog, keep, link, match
from flowloom.plans.scoring import Query, rnd
from flowloom.plans.scoring import query as _query
from flowloom.sources.tables import table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
COUNTRIES = ["BR", "CA", "CN", "DE", "FR", "IN", "JP", "KE", "PE", "RU", "US", "VN"]
PREFERRED = ["terra-biosphere-4.2", "efn-flows-31", "biosphere-old"]


def query(oracle: str | None = None):
    return _query(oracle, QUERIES, ORACLE)


_BUCKET = """coalesce(list_extract(list_filter(list_transform({c}, lambda e: case when contains(lower(trim(e)), 'air') then 'air' when contains(lower(trim(e)), 'water') then 'water' when contains(lower(trim(e)), 'soil') then 'soil' when contains(lower(trim(e)), 'resource') or contains(lower(trim(e)), 'raw') then 'resource' end), lambda e: e is not null), 1), 'unspecified')"""


def _bucket(c: str) -> str:
    return _BUCKET.format(c=c)


def _sp(c: str) -> str:  # Spark's trim takes blanks only
    return f"trim({c}, ' ')"


@query(f"select record_id, inventory, {_bucket('categories')} as bucket from flow_records")
def bucket_of(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "flow_records").select("record_id", "inventory", x.bucket_of(F.col("categories")).alias("bucket"))


@query("select record_id, array_to_string(list_transform(string_split(lower(c), '-'), lambda p: regexp_replace(p, '^0+(.)', '\\1')), '-') as cas from (select record_id, nullif(regexp_replace(cas, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g'), '') as c from flow_records) where c is not null")
def cas_normalise(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "flow_records").select("record_id", x.normal_cas(F.col("cas")).alias("cas")).where("cas is not null and cas <> ''")


_PLACES = "(select p_partkey, case p_partkey % 6 when 0 then p_name || ' {FR}' when 1 then p_name || ' {CA-QC} U' when 2 then p_name || ', US' when 3 then p_name || ' {FR} {RER}' when 4 then p_name || ' GLO U' else p_name end as name from part)"


def _places(spark: SparkSession, root: str) -> DataFrame:
    ends = {0: " {FR}", 1: " {CA-QC} U", 2: ", US", 3: " {FR} {RER}", 4: " GLO U"}
    end = F.lit("")
    for k, v in ends.items():
        end = F.when(F.col("p_partkey") % 6 == k, v).otherwise(end)
    return table(spark, root, "part").select("p_partkey", F.concat("p_name", end).alias("name"))


@query(f"select p_partkey, case p_partkey % 6 when 0 then 'FR' when 1 then 'CA' when 2 then 'US' else null end as location from {_PLACES}")
def location_parse(spark: SparkSession, root: str) -> DataFrame:
    return _places(spark, root).select("p_partkey", x.location_in(F.col("name")).alias("location"))


@query(f"select p_partkey, case when p_partkey % 6 = 2 then substr(name, 1, length(name) - 4) else name end as base, case when p_partkey % 6 = 2 then 'US' else '' end as region from {_PLACES}")
def regional_suffix(spark: SparkSession, root: str) -> DataFrame:
    return _places(spark, root).select("p_partkey", x.regional_suffix(F.col("name"), COUNTRIES).alias("r")).select("p_partkey", "r.*")


@query(
    "select mapping_id, source_kind, source_name, source_top_bucket, target_db, target_code from (select *, row_number() over (partition by source_kind, lower(trim(source_name, ' ')), source_top_bucket, source_cas, target_db, target_code, target_name, unit_conversion, priority_tier order by mapping_id, recorded_at, loaded_at) as rn from (select distinct * from mapping)) where rn = 1"
)
def dedupe_mappings(spark: SparkSession, root: str) -> DataFrame:
    m = table(spark, root, "mapping").withColumn("n", F.lower(F.trim("source_name")))
    key = ["source_kind", "n", "source_top_bucket", "source_cas", "target_db", "target_code", "target_name", "unit_conversion", "priority_tier"]
    return keep.keep_first(m, key, ["mapping_id", "recorded_at", "loaded_at"]).select("mapping_id", "source_kind", "source_name", "source_top_bucket", "target_db", "target_code")


@query("select name, target_db, target_code, n from (select *, row_number() over (partition by name order by n desc, target_db, target_code) as rn from (select lower(trim(name, ' ')) as name, target_db, target_code, count(*) as n from flow_records where target_code is not null and target_db is not null group by 1, 2, 3)) where rn = 1")
def dominant_target(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records").where("target_code is not null and target_db is not null").select(F.lower(F.trim("name")).alias("name"), "target_db", "target_code")
    return keep.dominant(f, ["name"], ["target_db", "target_code"])


@query("select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'P' then 1 else 2 end, o_orderdate, o_orderkey) as rn from orders) where rn = 1")
def label_preference(spark: SparkSession, root: str) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return keep.keep_first(table(spark, root, "orders"), ["o_custkey"], [rank, F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("select p_partkey::bigint as k, 'old' as side from part union all select o_orderkey, 'new' from orders where o_orderkey not in (select p_partkey from part)")
def insert_if_absent(spark: SparkSession, root: str) -> DataFrame:
    """Every part, and every order whose number no part has."""
    old = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("k"), F.lit("old").alias("side"))
    return keep.insert_if_absent(old, table(spark, root, "orders").select(F.col("o_orderkey").cast("long").alias("k"), F.lit("new").alias("side")), ["k"])


@query("select event_id, max(case when event_id % 97 = 0 then event_id end) over (order by event_id) as header from events")
def forward_fill(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "events").select("event_id")
    return keep.forward_fill(e, F.when(F.col("event_id") % 97 == 0, F.col("event_id")), "event_id", "header")


def _records(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records")
    return f.select("record_id", "name", "categories", F.get("units", F.lit(0)).alias("unit"), "cas")


_CAT = f"cat as (select lower(trim(name, ' ')) as n, unit, list_transform(categories, lambda c: lower(trim(c, ' '))) as c, {_bucket('categories')} as b, db, code from biosphere_catalog)"
_REC = f"rec as (select record_id, lower(trim(name, ' ')) as n, units[1] as unit, list_transform(categories, lambda c: lower(trim(c, ' '))) as c, {_bucket('categories')} as b from flow_records)"


def _catalog_keys(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "biosphere_catalog").select(F.lower(F.trim("name")).alias("n"), "unit", F.transform("categories", lambda c: F.lower(F.trim(c))).alias("c"), x.bucket_of(F.col("categories")).alias("b"), "db", "code")


def _record_keys(spark: SparkSession, root: str) -> DataFrame:
    r = _records(spark, root)
    return r.select("record_id", F.lower(F.trim("name")).alias("n"), "unit", F.transform("categories", lambda c: F.lower(F.trim(c))).alias("c"), x.bucket_of(F.col("categories")).alias("b"))


@query(f"with {_CAT}, {_REC}, one as (select n, unit, b, min(db) as db, min(code) as code from (select distinct n, unit, b, db, code from cat) group by 1, 2, 3 having count(*) = 1) select record_id, db, code from rec left join one using (n, unit, b)")
def unique_key_match(spark: SparkSession, root: str) -> DataFrame:
    keys = [(F.col(k), F.col(k)) for k in ("n", "unit", "b")]
    return match.unique_match(_record_keys(spark, root), _catalog_keys(spark, root), keys, ["db", "code"]).select("record_id", "db", "code")


@query(
    f"""with {_CAT}, {_REC},
p1 as (select n, unit, c, min(db) as db, min(code) as code from (select distinct n, unit, c, db, code from cat where n is not null and unit is not null and c is not null) group by 1, 2, 3 having count(*) = 1),
p2 as (select n, b, min(db) as db, min(code) as code from (select distinct n, b, db, code from cat where n is not null) group by 1, 2 having count(*) = 1),
p3 as (select n, min(db) as db, min(code) as code from (select distinct n, db, code from cat where n is not null) group by 1 having count(*) = 1)
select record_id, coalesce(p1.db, p2.db, p3.db) as db, coalesce(p1.code, p2.code, p3.code) as code, case when p1.code is not null then 1 when p2.code is not null then 2 when p3.code is not null then 3 end as match_pass
from rec left join p1 on p1.n = rec.n and p1.unit = rec.unit and p1.c = rec.c left join p2 on p2.n = rec.n and p2.b = rec.b left join p3 on p3.n = rec.n"""
)
def cascade_match(spark: SparkSession, root: str) -> DataFrame:
    passes = [[(F.col(k), F.col(k)) for k in ks] for ks in (("n", "unit", "c"), ("n", "b"), ("n",))]
    return match.cascade(_record_keys(spark, root), _catalog_keys(spark, root), passes, ["code", "db"]).select("record_id", "db", "code", "match_pass")


_FOLD = "nullif(lower(regexp_replace({c}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')), '')"


def _fold(c: str) -> str:
    return _FOLD.format(c=c)


_GROUPS = "case " + " ".join(f"when {{c}} in ({', '.join(chr(39) + m + chr(39) for m in members)}) then '{g}'" for g, members in x.SUB_GROUPS.items()) + " else '' end"
_TIERED = f"""
with exc as (select record_id as exc_id, lower(trim(name, ' ')) as n, {_bucket('categories')} as b, lower(trim(case when len(categories) >= 2 then coalesce(categories[-1], '') else '' end, ' ')) as sub, trim(units[1], ' ') as unit, coalesce(trim(cas, ' '), '') as cas, target_code is not null as linked from flow_records),
reg as (select distinct lower(trim(source_name, ' ')) as n, coalesce(nullif(regexp_replace(source_top_bucket, '^\\s+|\\s+$', '', 'g'), ''), 'unspecified') as rb, coalesce(trim(source_cas, ' '), '') as rcas, target_db, target_code, target_name, target_unit, coalesce(nullif(unit_conversion, 0), 1.0) as f, priority_tier as tier, provenance, coalesce(is_unmatchable, false) as halt,
  {_fold('target_db')} as db, {_fold('target_code')} as code, lower(nullif(regexp_replace(target_name, '^\\s+|\\s+$', '', 'g'), '')) as tn, nullif(regexp_replace(target_unit, '^\\s+|\\s+$', '', 'g'), '') as tu from mapping),
rr as (select row_number() over () as rid, * from reg),
cat as (select {_fold('db')} as cdb, {_fold('code')} as ccode, lower(trim(name, ' ')) as cn, {_bucket('categories')} as cb, unit as cunit, categories as cc from biosphere_catalog),
cand as (select e.*, r.*exclude (n), (r.rb = e.b or r.rb = 'unspecified') as own, (e.cas <> '' and e.cas = r.rcas) as bycas from (select distinct n, b, sub, unit, cas, linked from exc where n is not null) e join rr r using (n)),
cand2 as (select * from (select *, bool_or(own) over (partition by n, b, sub, unit, cas, linked) as anyown from cand) where own or bycas or (not anyown and b <> 'unspecified')),
hits as (
  select c.*, db as tdb, code as tcode, coalesce(k.cunit, tu) as tunit, k.cc from cand2 c left join cat k on k.cdb = c.db and k.ccode = c.code where db is not null and code is not null
  union all
  select c.*, h.cdb, h.ccode, h.cunit, h.cc from cand2 c left join lateral (
    select k.*, case when k.ccode = c.code then 1 when k.cb = c.b then 2 else 3 end as branch, case k.cdb when c.db then 0 when '{PREFERRED[0]}' then 1 when '{PREFERRED[1]}' then 2 when '{PREFERRED[2]}' then 3 end as rk
    from cat k where (k.ccode = c.code or k.cn = c.tn) and (k.cb = c.b or k.cb = 'unspecified') order by branch, rk, k.ccode limit 1) h on true
  where not (db is not null and code is not null)),
conv as (select trim(source_unit, ' ') as su, trim(target_unit, ' ') as tu2, arg_min(multiplier, conv_id) as m from unit_conversion where multiplier is not null group by 1, 2),
mult as (select h.*, case when coalesce(trim(tunit, ' '), '') = '' or trim(unit, ' ') = trim(tunit, ' ') then 1.0 else coalesce(conv.m, case when f <> 1 then f end) end as multiplier,
  lower(trim(coalesce(cc[-1], ''), ' ')) as have from hits h left join conv on conv.su = trim(unit, ' ') and conv.tu2 = trim(tunit, ' ')),
ranked as (select *, case when sub = '' then case when cc is not null and len(cc) = 1 then 0 else 3 end when cc is null or len(cc) = 0 then 3 when have = sub then 0 when {_GROUPS.format(c='have')} = '' or {_GROUPS.format(c='sub')} = '' then 3 when {_GROUPS.format(c='have')} = {_GROUPS.format(c='sub')} then 1 else 2 end as sr from mult),
o as (select *, row_number() over (partition by n, b, sub, unit, cas, linked order by tier, provenance, sr, coalesce(tcode, ''), coalesce(target_name, ''), halt desc, coalesce(tdb, ''), multiplier) as rn, (not halt and tcode is not null and multiplier is not null and not (tier in (5, 8, 9, 10, 11, 12) and linked)) as valid from ranked),
best as (select n, b, sub, unit, cas, linked, min(rn) filter (valid) as bn, min(rn) filter (halt) as hn from o group by all)
select e.exc_id, o.tier, o.provenance, o.tdb as t_db, o.tcode as t_code, round(o.multiplier, 6) as multiplier from exc e
join best using (n, b, sub, cas, linked) join o on o.n = e.n and o.b = e.b and o.sub = e.sub and o.cas = e.cas and o.linked = e.linked and o.unit is not distinct from e.unit and o.rn = best.bn
where best.unit is not distinct from e.unit and (best.hn is null or best.bn < best.hn)"""


@query(_TIERED)
def tiered_match(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records")
    e = f.select(F.col("record_id").alias("exc_id"), "name", "categories", F.get("units", F.lit(0)).alias("unit"), "cas", F.col("target_code").isNotNull().alias("linked"))
    conv = table(spark, root, "unit_conversion").withColumn("seq", F.col("conv_id"))
    m = match.tiered_match(e, table(spark, root, "mapping"), table(spark, root, "biosphere_catalog"), conv, PREFERRED)
    return m.withColumn("multiplier", rnd(F.col("multiplier")))


@query(
    "with conv as (select trim(source_unit, ' ') as su, trim(target_unit, ' ') as tu, arg_min(multiplier, conv_id) as m from unit_conversion where multiplier is not null group by 1, 2)"
    " select entry_id, case when coalesce(trim(target_unit, ' '), '') = '' or trim(source_unit, ' ') = trim(target_unit, ' ') then 1.0 else coalesce(conv.m, case when conversion_factor <> 1 then conversion_factor end) end as multiplier from flowmap left join conv on su = trim(source_unit, ' ') and tu = trim(target_unit, ' ')"
)
def unit_convert(spark: SparkSession, root: str) -> DataFrame:
    conv = table(spark, root, "unit_conversion").withColumn("seq", F.col("conv_id"))
    return match.multiplier(table(spark, root, "flowmap"), "source_unit", "target_unit", conv, row_factor="conversion_factor").select("entry_id", "multiplier")


_CHAIN = "with chain as (select c_custkey, unnest([c_nationkey, 7, 3, 0]) as at, unnest([0, 1, 2, 3]) as chain_rank from customer), one as (select s_nationkey, min(s_suppkey) as s_suppkey from supplier group by 1 having count(distinct s_suppkey) = 1)"


@query(_CHAIN + " select c.c_custkey, h.chain_rank, h.s_suppkey from customer c left join (select c_custkey, arg_min(s_suppkey, chain_rank) as s_suppkey, min(chain_rank) as chain_rank from chain join one on one.s_nationkey = chain.at group by 1) h using (c_custkey)")
def location_fallback(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "customer").select("c_custkey", F.lit(1).alias("k"), F.array(F.col("c_nationkey"), F.lit(7), F.lit(3), F.lit(0)).alias("chain"))
    s = table(spark, root, "supplier").select(F.lit(1).alias("k"), F.col("s_nationkey").alias("place"), "s_suppkey")
    return match.first_in_chain(c, s, ["k"], "chain", "place", ["s_suppkey"]).select("c_custkey", "chain_rank", "s_suppkey")


@query("select record_id, (select arg_min(m.provenance, m.mapping_id) from mapping m where m.is_unmatchable and lower(trim(m.source_name, ' ')) = lower(trim(r.name, ' '))) as reason from flow_records r where target_code is null")
def unmatchable_fallback(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "flow_records").where("target_code is null").select("record_id", F.lower(F.trim("name")).alias("n"))
    m = table(spark, root, "mapping").where("is_unmatchable").select(F.lower(F.trim("source_name")).alias("n"), F.col("provenance").alias("reason"), "mapping_id")
    return match.first_reason(r, ["n"], m, "reason", "mapping_id").select("record_id", "reason")


_TOKENS = "list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+'))"


@query(
    f"with q as (select source_id as q_id, {_bucket('cats')} as b, {_TOKENS.format(c='name')} as w from source_records), p as (select distinct db, code, length(name) as len, {_bucket('categories')} as b, {_TOKENS.format(c='name')} as w from biosphere_catalog),"
    " m as (select q_id, db, code, len, count(*) as overlap from (select q_id, b, unnest(w) as t from q) a join (select db, code, len, b, unnest(w) as t from p) c using (b, t) group by 1, 2, 3, 4)"
    " select q_id, db, code, overlap, rank from (select *, row_number() over (partition by q_id order by overlap desc, len, db, code) as rank from m) where rank <= 5"
)
def candidate_topk(spark: SparkSession, root: str) -> DataFrame:
    q = table(spark, root, "source_records").select(F.col("source_id").alias("q_id"), "name", x.bucket_of(F.col("cats")).alias("bucket"))
    p = table(spark, root, "biosphere_catalog").select("db", "code", "name", x.bucket_of(F.col("categories")).alias("bucket"))
    return match.token_candidates(q, p, 5).withColumn("overlap", F.col("overlap").cast("long")).withColumn("rank", F.col("rank").cast("long"))


_EXC = "exc as (select l_orderkey as activity_id, l_linenumber as seq, case when l_linenumber = 1 then 'production' when l_returnflag = 'R' then 'biosphere' else 'technosphere' end as type, case when l_linenumber = 1 and l_orderkey % 4 = 0 then 0.0 else l_quantity end as amount, l_linestatus = 'F' as functional from lineitem)"


def _inventory(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    kind = F.when(F.col("l_linenumber") == 1, "production").when(F.col("l_returnflag") == "R", "biosphere").otherwise("technosphere")
    amount = F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 4 == 0), 0.0).otherwise(F.col("l_quantity"))
    return li.select(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("seq"), kind.alias("type"), amount.alias("amount"), (F.col("l_linestatus") == "F").alias("functional"))


_PROMOTED = f"with {_EXC}, g as (select activity_id, bool_or(type = 'production' and functional and amount <> 0) as made, bool_or(type = 'technosphere' and functional) as able from exc group by 1), p as (select e.activity_id, e.seq, case when not made and able and type = 'technosphere' and functional then 'production' else type end as type, amount, functional from exc e join g using (activity_id) where not (not made and able and type = 'production' and amount = 0))"


@query(_PROMOTED + " select activity_id, seq, type, amount from p")
def waste_promotion(spark: SparkSession, root: str) -> DataFrame:
    return link.promote_functional(_inventory(spark, root)).select("activity_id", "seq", "type", "amount")


@query(f"with {_EXC} select case when type = 'production' and not functional then 'technosphere' else type end as type, activity_id, seq, amount from exc")
def production_reclassify(spark: SparkSession, root: str) -> DataFrame:
    return link.demote_unfunctional(_inventory(spark, root)).select("activity_id", "seq", "type", "amount")


@query(f"with {_EXC} select o_orderkey as activity_id from orders where o_orderpriority like '1%' or o_orderkey in (select activity_id from exc where type = 'production' or (type = 'technosphere' and functional))")
def orphan_activities(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "orders").select(F.col("o_orderkey").alias("activity_id"), F.when(F.col("o_orderpriority").startswith("1"), "product").otherwise("process").alias("kind"))
    return link.with_output(a, _inventory(spark, root)).select("activity_id")


@query(
    f"with {_EXC}, a as (select o_orderkey as activity_id, 'c' || (o_orderkey % 50) as code, 'n' || (o_custkey % 40) as name from orders), hit as (select activity_id from a where code in ('c1', 'c2') or name in ('n3', 'n4')), sys as (select activity_id from exc group by 1 having count(*) filter (type = 'technosphere') = 0 and count(*) filter (type = 'biosphere') > 0)"
    " select activity_id from a where activity_id not in (select activity_id from hit where activity_id not in (select activity_id from sys))"
)
def aggregate_deletion(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "orders").select(F.col("o_orderkey").alias("activity_id"), F.concat(F.lit("c"), (F.col("o_orderkey") % 50).cast("string")).alias("code"), F.concat(F.lit("n"), (F.col("o_custkey") % 40).cast("string")).alias("name"))
    d = spark.createDataFrame([("c1", None), ("c2", "n9"), (None, "N3"), (None, "n4 ")], "code string, name string")
    return link.delete_listed(a, _inventory(spark, root), d).select("activity_id")


@query("select o_orderkey, case o_orderpriority when '1-URGENT' then 'first' when '2-HIGH' then 'second' else o_orderpriority end as o_orderpriority, round(o_totalprice * case o_orderpriority when '1-URGENT' then 2.0 else 1.0 end, 6) as o_totalprice from orders")
def rule_migration(spark: SparkSession, root: str) -> DataFrame:
    rules = spark.createDataFrame([("1-urgent", "first", 2.0, 1), ("1-URGENT", "later", 3.0, 2), ("2-HIGH ", "second", 0.0, 3)], "o_orderpriority string, new string, m double, seq int")
    o = table(spark, root, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = link.apply_rules(o, rules, ["o_orderpriority"], {"o_orderpriority": "new"}, multiplier="m", amount="o_totalprice")
    return out.withColumn("o_totalprice", rnd(F.col("o_totalprice")))


@query(
    "with r as (select l_orderkey, l_linenumber, l_quantity as a, l_tax as sc, l_discount as lo, l_extendedprice as hi, l_linenumber % 6 as kind, case when l_linenumber % 2 = 0 then -2.0 else 3.0 end as f from lineitem)"
    " select l_orderkey, l_linenumber, round(a * f, 6) as amount, round(case when kind = 2 then ln(abs(a * f)) when kind in (3, 4, 5) then a * f else a * f end, 6) as loc, round(case when kind = 3 then abs(sc * f) else sc end, 6) as scale, round(case when f < 0 then hi * f else lo * f end, 6) as minimum, round(case when f < 0 then lo * f else hi * f end, 6) as maximum from r"
)
def uncertainty_rescale(spark: SparkSession, root: str) -> DataFrame:
    c = F.col
    factor = F.when(c("l_linenumber") % 2 == 0, -2.0).otherwise(3.0)
    s = x.rescaled(c("l_quantity"), c("l_quantity"), c("l_tax"), c("l_discount"), c("l_extendedprice"), c("l_linenumber") % 6, factor)
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", s.alias("s")).select("l_orderkey", "l_linenumber", *[rnd(F.col(f"s.{n}")).alias(n) for n in ("amount", "loc", "scale", "minimum", "maximum")])


@query("select type, count(*) as total, count(*) filter (linked) as linked, round(100.0 * count(*) filter (linked) / count(*), 2) as rate from (select inventory as type, target_code is not null as linked from flow_records) group by 1")
def coverage(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records").select(F.col("inventory").alias("type"), F.col("target_code").isNotNull().alias("linked"))
    return link.coverage(f)


@query("select name, count(*) as n from flow_records where target_code is null group by 1")
def unlinked_counts(spark: SparkSession, root: str) -> DataFrame:
    return link.unlinked_counts(table(spark, root, "flow_records").select("name", F.col("target_code").isNotNull().alias("linked")))


@query("select lower(trim(name, ' ')) as name, count(distinct array_to_string(categories, ' / ')) as n_places, min(cas) as cas, sum(n_exchanges)::bigint as n, sum(n_linked)::bigint as linked, list_sort(list_distinct(flatten(list(units)))) as units from flow_records group by 1")
def flow_usage(spark: SparkSession, root: str) -> DataFrame:
    return link.flow_usage(table(spark, root, "flow_records"))


@query("select db, code, name from biosphere_catalog union all select c.db, c.code || '@' || u.region, c.name from (select distinct target_db as db, target_code as code, 'R' || (n_exchanges % 3) as region from flow_records where n_exchanges % 3 > 0) u join biosphere_catalog c using (db, code)")
def regional_rows(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records").select(F.col("target_db").alias("db"), F.col("target_code").alias("code"), F.when(F.col("n_exchanges") % 3 > 0, F.concat(F.lit("R"), (F.col("n_exchanges") % 3).cast("string"))).alias("region"))
    return link.add_regional_rows(table(spark, root, "biosphere_catalog").select("db", "code", "name"), f)


@query("select p_partkey::bigint as col_id, case when p_partkey % 7 = 0 then 'OV' when p_partkey % 3 = 0 then 'BG' || (p_partkey % 4) else 'PA' end as location from part")
def activity_locations(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("col_id"))
    bg = p.where("col_id % 3 = 0").withColumn("location", F.concat(F.lit("BG"), (F.col("col_id") % 4).cast("string")))
    return link.locations_of(p.withColumn("location", F.lit("PA")), bg, p.where("col_id % 7 = 0").withColumn("location", F.lit("OV")))


def _tiered_inputs(spark: SparkSession, root: str) -> tuple:
    f = table(spark, root, "flow_records")
    e = f.select(F.col("record_id").alias("exc_id"), "name", "categories", F.get("units", F.lit(0)).alias("unit"), "cas", F.col("target_code").isNotNull().alias("linked"))
    conv = table(spark, root, "unit_conversion").withColumn("seq", F.col("conv_id"))
    return e, table(spark, root, "mapping"), table(spark, root, "biosphere_catalog"), conv, PREFERRED


_STATUS = _TIERED[: _TIERED.index("best as (select")] + """pick as (select n, b, sub, unit, cas, linked, min(rn) filter (valid) as bn, min(rn) filter (halt) as hn, count(*) filter (halt) as nh,
  count(*) filter (not halt and not (tier in (5, 8, 9, 10, 11, 12) and linked) and tcode is null) as no_, count(*) filter (not halt and not (tier in (5, 8, 9, 10, 11, 12) and linked) and tcode is not null and multiplier is null) as nu from o group by all),
st as (select *, case when bn is not null and (hn is null or bn < hn) then 'matched' when nh > 0 then 'recognised_unmatchable' when nu > 0 and no_ = 0 then 'unit_mismatch_only' when no_ > 0 and nu = 0 then 'target_unresolved_only' else 'mixed' end as status from pick)
select e.exc_id, coalesce(st.status, 'no_registry') as status from exc e left join st on st.n = e.n and st.b = e.b and st.sub = e.sub and st.cas = e.cas and st.linked = e.linked and st.unit is not distinct from e.unit"""


@query(_STATUS)
def match_status(spark: SparkSession, root: str) -> DataFrame:
    return match.match_status(*_tiered_inputs(spark, root))


@query(f"with m as ({_TIERED}) select case when {_fold('r.target_code')} is null then 'new_link' else 'override' end as kind, m.exc_id, m.tier, m.t_code as new_code from m join flow_records r on r.record_id = m.exc_id where {_fold('r.target_code')} is null or not ({_fold('r.target_code')} = m.t_code and coalesce({_fold('r.target_db')} = m.t_db, true))".replace("with m as (\nwith", "with m as (with"))
def match_audit(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records").select(F.col("record_id").alias("exc_id"), F.col("target_db").alias("prior_db"), F.col("target_code").alias("prior_code"))
    a = match.match_audit(f, match.tiered_match(*_tiered_inputs(spark, root)))
    return a.select("kind", "exc_id", "tier", "new_code")


@query(
    "select p_partkey::bigint as activity_id, case when p_partkey % 4 = 0 then 'fg' when p_partkey % 4 = 1 then 'bg' when p_partkey % 4 = 2 then 'fg' else '' end as database, case when p_partkey % 4 = 2 then 4 when p_partkey % 4 = 3 then p_partkey else p_partkey end::varchar as code, case when p_partkey % 4 = 2 then p_partkey + 7 when p_partkey % 4 = 3 then p_partkey else p_partkey + 1 end::bigint as product_id from part"
)
def column_catalog(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("activity_id"), F.col("p_name").alias("name"))
    blank = [F.lit("").alias(c) for c in ("type", "unit", "location", "reference_product")]
    side = lambda db, m: p.where(f"activity_id % 4 = {m}").select("activity_id", F.lit(db).alias("database"), F.col("activity_id").cast("string").alias("code"), "name", *blank, (F.col("activity_id") + 1).alias("product_id"))
    split = p.where("activity_id % 4 = 2").select(F.col("activity_id").alias("synthetic_id"), F.lit(4).cast("long").alias("activity_id"), (F.col("activity_id") + 7).alias("product_id"))
    return catalog.column_catalog(p, side("fg", 0), side("bg", 1), split).select("activity_id", "database", "code", "product_id")


@query("select o_orderkey as id, case when o_orderkey % 2 = 0 then 'a' || (o_orderkey % 10) when o_orderkey % 3 = 0 then 'b' || (o_orderkey % 10) end as label, case when o_orderkey % 2 = 0 then 0 when o_orderkey % 3 = 0 then 1 end as source from orders")
def id_labels(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("id"))
    side = lambda c, m: o.where(f"id % {m} = 0").withColumn("label", F.concat(F.lit(c), (F.col("id") % 10).cast("string")))
    return catalog.labels_of(o, [side("a", 2), side("b", 3)])


_FORM_NAMES = "(select p_partkey as id, p_name || ' {' || case p_partkey % 3 when 0 then 'FR' when 1 then 'GLO' else 'XX' end || '}| ' || case p_partkey % 4 when 0 then 'production' when 1 then 'market for' when 2 then p_name || ' making' else 'nothing known' end || ' | U' as name, p_name as display, case p_partkey % 3 when 0 then 'FR' when 1 then 'GLO' else 'XX' end as loc, case p_partkey % 4 when 0 then 'production' when 1 then 'market for' when 2 then p_name || ' making' else 'nothing known' end as activity from part)"


@query(
    f"""with n as {_FORM_NAMES}, c0 as (select distinct p_name from part), c as (
  select p_name || ' production' as name, 'GLO' as loc, p_name as product, 'c1-' || p_name as code from c0 union all select 'market for ' || p_name, 'FR', p_name, 'c2-' || p_name from c0 union all select 'market for ' || p_name, 'RoW', p_name, 'c3-' || p_name from c0
  union all select p_name || ' making', 'FR', p_name, 'c4-' || p_name from c0 union all select p_name || ' making', 'FR', 'x', 'c5-' || p_name from c0),
t as (select id, display, loc, unnest([activity, activity || ' ' || display, display || ' ' || activity]) as nm, unnest([0, 1, 2]) as t from n),
l as (select id, display, nm, t, unnest([loc, 'GLO', 'RoW', 'RER']) as at, unnest([0, 1, 2, 3]) as l from t),
h as (select l.id, l.t, l.l, count(distinct c.code) as k, min(c.code) as code, count(distinct c.code) filter (c.product = l.display) as m, min(c.code) filter (c.product = l.display) as own from l join c on c.name = l.nm and c.loc = l.at group by 1, 2, 3),
f as (select id, t, arg_min(case when k = 1 then code when m = 1 then own else '' end, l) as code from h group by 1, 2),
g as (select id, arg_min(code, t) as code from f where code <> '' group by 1),
mk as (select n.id, count(*) filter (len(list_filter(regexp_extract_all(n.activity, '[a-z0-9]+'), lambda w: not list_contains(regexp_extract_all(c.name, '[a-z0-9]+'), w))) = 0) as k, min(c.code) filter (len(list_filter(regexp_extract_all(n.activity, '[a-z0-9]+'), lambda w: not list_contains(regexp_extract_all(c.name, '[a-z0-9]+'), w))) = 0) as hit, count(*) as m, min(c.code) as one_, bool_or(contains(n.activity, 'market')) as wants
  from n join c on c.product = n.display and c.loc = n.loc where n.id not in (select id from g) and (contains(n.activity, 'market') or not starts_with(c.name, 'market ')) group by 1)
select n.id, coalesce(g.code, case when mk.k = 1 then mk.hit when mk.k = 0 and not wants and mk.m = 1 then one_ end) as code from n left join g using (id) left join mk using (id)"""
)
def written_names(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    place = F.when(k % 3 == 0, "FR").when(k % 3 == 1, "GLO").otherwise("XX")
    act = F.when(k % 4 == 0, "production").when(k % 4 == 1, "market for").when(k % 4 == 2, F.concat(n, F.lit(" making"))).otherwise("nothing known")
    names = p.select(k.alias("id"), F.concat(n, F.lit(" {"), place, F.lit("}| "), act, F.lit(" | U")).alias("name"))
    c0 = p.select("p_name").distinct()
    row = lambda name, loc, product, code: F.struct(name.alias("name"), F.lit(loc).alias("location"), product.alias("product"), F.concat(F.lit(code), n).alias("code"))
    market, making = F.concat(F.lit("market for "), n), F.concat(n, F.lit(" making"))
    rows = F.array(row(F.concat(n, F.lit(" production")), "GLO", n, "c1-"), row(market, "FR", n, "c2-"), row(market, "RoW", n, "c3-"), row(making, "FR", n, "c4-"), row(making, "FR", F.lit("x"), "c5-"))
    return catalog.resolve_names(names, c0.select(F.explode(rows).alias("r")).select("r.*"))


@query(
    "with s as (select distinct p_name, p_partkey % 5 as k, min(p_partkey) over (partition by p_name, p_partkey % 5) as code from part where p_partkey % 5 < 3), o as (select p_partkey as id, p_name, p_partkey % 2 as alt from part where p_partkey % 7 = 0),"
    " h as (select o.id, s.code, case when o.alt = 0 and s.k = 0 then 0 when s.k = 1 then 1 when s.k = 2 then 3 else 9 end as r from o join s using (p_name)) select o.id::varchar as code, arg_min(h.code, (h.r, h.code))::varchar as target_code, case when min(h.id) is not null then 'inventory' end as source from o left join h using (id) group by 1"
)
def orphan_relinks(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    k = F.col("p_partkey")
    label = lambda loc: F.concat("p_name", F.lit(" {"), loc, F.lit("}| making | U"))
    at = F.when(k % 5 == 0, "FR").when(k % 5 == 1, "RER").otherwise("GLO")
    s = p.where("p_partkey % 5 < 3").groupBy("p_name", (k % 5).alias("m")).agg(F.min(k).alias("p_partkey")).select(k.cast("string").alias("code"), label(at).alias("name"), k.alias("seq"))
    o = p.where("p_partkey % 7 = 0").select(k.cast("string").alias("code"), label(F.when(k % 2 == 0, "FR").otherwise("CN")).alias("name"))
    bg = spark.createDataFrame([], "code string, name string, location string, seq long")
    return catalog.relink_orphans(o, s, bg)


@query(
    "with u as (select lower(trim(name, ' ')) as name, target_db, target_code, count(*) as n from flow_records where target_code is not null group by 1, 2, 3) select u.name, u.target_db, u.target_code, u.n, c.name as target_name, c.unit as target_unit from u left join biosphere_catalog c on c.db = u.target_db and c.code = u.target_code where u.name not in (select lower(trim(source_name, ' ')) from mapping where source_name is not null)"
)
def review_rows(spark: SparkSession, root: str) -> DataFrame:
    u = table(spark, root, "flow_records").where("target_code is not null").groupBy(F.lower(F.trim("name")).alias("name"), "target_db", "target_code").agg(F.count(F.lit(1)).alias("n"))
    return catalog.review_table(u, table(spark, root, "mapping").select(F.col("source_name").alias("name")), table(spark, root, "biosphere_catalog"))


@query(
    "with u as (select lower(trim(name, ' ')) as name, count(*) as n from flow_records group by 1), m as (select distinct lower(trim(source_name, ' ')) as name from mapping where source_name is not null), c as (select distinct lower(trim(name, ' ')) as name from biosphere_catalog where name is not null) select u.name, n, m.name is not null as in_mapping, c.name is not null as in_catalog, (m.name is not null)::int + (c.name is not null)::int as n_sheets from u left join m using (name) left join c using (name)"
)
def sheet_presence(spark: SparkSession, root: str) -> DataFrame:
    u = table(spark, root, "flow_records").groupBy(F.lower(F.trim("name")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return catalog.presence(u, {"mapping": table(spark, root, "mapping").select(F.col("source_name").alias("name")), "catalog": table(spark, root, "biosphere_catalog").select("name")})


@query("with s as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as n, count(*) over () as total from (select distinct o_orderkey from orders)) select o_orderkey from s where n % (total // 100) = 0 and n < (total // 100) * 100")
def product_sample(spark: SparkSession, root: str) -> DataFrame:
    """A systematic sample of 100 ids: the sample is the operator."""
    return catalog.systematic_sample(table(spark, root, "orders"), "o_orderkey", 100)


@query("select c_custkey, case when c_nationkey % 3 = 0 then 's' || c_nationkey when c_nationkey % 2 = 0 then 'n' || c_nationkey end as target, case when c_nationkey % 3 = 0 then 'adapted' when c_nationkey % 2 = 0 then 'rebuilt' end as how from customer")
def target_cascade(spark: SparkSession, root: str) -> DataFrame:
    n = table(spark, root, "nation").select(F.col("n_nationkey").alias("key"))
    side = lambda c, m: n.where(f"key % {m} = 0").select("key", F.concat(F.lit(c), F.col("key").cast("string")).alias("target"), F.lit(1.0).alias("multiplier"))
    ambiguous = n.where("key % 5 = 0").select("key", F.explode(F.array(F.lit("x"), F.lit("y"))).alias("target"), F.lit(1.0).alias("multiplier"))
    c = table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    return catalog.first_target(c, [("several", ambiguous), ("adapted", side("s", 3)), ("rebuilt", side("n", 2))]).select("c_custkey", "target", "how")
