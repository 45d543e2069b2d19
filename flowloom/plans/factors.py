"""Queries of the factor layer, the reports and the parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import exprs as x
from flowloom.operators import cf, params, report
from flowloom.plans.linking import _fold
from flowloom.plans.scoring import Query, r6, rnd
from flowloom.plans.scoring import query as _query
from flowloom.sources.tables import table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    return _query(oracle, QUERIES, ORACLE)


def _joined(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "cf_flow_join")


_ONCE = "once as (select distinct run_id, method_slug, code, db, name, categories, cas, case when isnan(sp_cf) then null else sp_cf end as sp_cf, case when isnan(ef_cf) then null else ef_cf end as ef_cf, sp_match_provenance, sp_name, sp_compartment, sp_sub_compartment from cf_flow_join)"


def _once(spark: SparkSession, root: str) -> DataFrame:
    j = _joined(spark, root).drop("written_at")
    nan = lambda c: F.when(~F.isnan(c), F.col(c))
    return j.withColumn("sp_cf", nan("sp_cf")).withColumn("ef_cf", nan("ef_cf")).distinct()


def _located(spark: SparkSession, root: str) -> DataFrame:
    """Lineitems as located factors: every fifth has no location."""
    li = table(spark, root, "lineitem")
    return li.select(F.col("l_returnflag").alias("method"), F.col("l_partkey").alias("flow"), F.when(F.col("l_linenumber") != 1, F.concat(F.lit("N"), (F.col("l_suppkey") % 25).cast("string"))).alias("location"), F.col("l_extendedprice").alias("cf"), F.col("l_shipdate").cast("string").alias("name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


_LOCATED = "loc as (select l_returnflag as method, l_partkey as flow, case when l_linenumber <> 1 then 'N' || (l_suppkey % 25) end as location, l_extendedprice as cf, l_orderkey * 10 + l_linenumber as seq, l_orderkey, l_linenumber from lineitem)"


@query(f"with {_LOCATED} select method, flow, round(coalesce(arg_min(cf, (seq, l_orderkey)) filter (location is null), avg(cf) filter (location is not null)), 6) as cf from loc group by 1, 2")
def global_cf_collapse(spark: SparkSession, root: str) -> DataFrame:
    return cf.global_factors(_located(spark, root)).select("method", "flow", *r6("cf"))


@query(f"with {_LOCATED} select method, location, round(avg(abs(cf)), 6) as cf from loc where location is not null group by 1, 2 having avg(abs(cf)) > 0")
def regional_mean(spark: SparkSession, root: str) -> DataFrame:
    return cf.location_means(_located(spark, root), ["method"]).select("method", "location", *r6("cf"))


@query(f"with {_LOCATED}, g as (select method, flow, avg(cf) as cf from loc group by 1, 2), m as (select method, location, avg(abs(cf)) as local_cf from loc where location is not null group by 1, 2) select method, flow, location, round(local_cf, 6) as local_cf from g join m using (method) where abs(local_cf - abs(cf)) >= 0.01")
def regional_cf_rows(spark: SparkSession, root: str) -> DataFrame:
    loc = _located(spark, root)
    g = loc.groupBy("method", "flow").agg(F.avg("cf").alias("cf"))
    return cf.regional_rows(g, cf.location_means(loc, ["method"]), ["method"]).select("method", "flow", "location", *r6("local_cf"))


@query("select s_suppkey as code, 'N' || n_nationkey as location, sign(s_acctbal) * (n_nationkey + 1) * 10.0::double as cf from supplier, nation where s_acctbal <> 0 and abs(sign(s_acctbal) * (n_nationkey + 1) * 10 - s_acctbal) > 1e-12")
def location_spread(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "supplier").where("s_acctbal <> 0").select(F.col("s_suppkey").alias("code"), F.col("s_acctbal").alias("cf"))
    n = table(spark, root, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("location"), ((F.col("n_nationkey") + 1) * 10.0).alias("cf"))
    return cf.every_location(s, n)


@query(f"with {_ONCE}, f as (select method_slug as method, lower(name) as name, categories[-1] as sub, arg_min(ef_cf, (run_id, code)) as cf from once where ef_cf is not null and name is not null and categories[-1] is not null group by 1, 2, 3), g as (select method, name, min(cf) as min_cf, max(cf) as max_cf, count(*) as n_subcomps from f group by 1, 2) select method, name, n_subcomps, round(ln(max_cf / nullif(min_cf, 0)), 6) as log_ratio from g where min_cf <> max_cf and min_cf > 0 and max_cf / min_cf >= 2.0")
def subcomp_drift(spark: SparkSession, root: str) -> DataFrame:
    j = _once(spark, root).select(F.col("method_slug").alias("method"), F.lower("name").alias("name"), F.element_at("categories", -1).alias("sub"), F.col("ef_cf").alias("cf"), F.struct("run_id", "code").alias("seq"))
    return cf.subcompartment_drift(j).where("min_cf > 0").select("method", "name", "n_subcomps", rnd(F.log("ratio")).alias("log_ratio"))


@query("with a as (select method_slug as method, lower(trim(sp_name, ' ')) as name, max(abs(case when isnan(sp_cf) then null else sp_cf end)) as max_abs_cf from cf_flow_join where sp_name is not null group by 1, 2) select method, name, max_abs_cf from a where not exists (select 1 from cf_flow_join_copy c where c.method_slug = a.method and lower(trim(c.name, ' ')) = a.name)")
def delta_audit(spark: SparkSession, root: str) -> DataFrame:
    a = _once(spark, root).where("sp_name is not null").select(F.col("method_slug").alias("method"), F.col("sp_name").alias("name"), F.col("sp_cf").alias("cf"))
    b = table(spark, root, "cf_flow_join_copy").where("name is not null").select(F.col("method_slug").alias("method"), "name")
    return cf.missing_on_other_side(a, b)


_NC = "array_to_string(list_transform(string_split(lower(nullif(regexp_replace({c}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g'), '')), '-'), lambda p: regexp_replace(p, '^0+(.)', '\\1')), '-')"


@query(
    f"""with c as (select method_slug as method, db, code, name, lower(categories[1]) as top, cas from cf_flow_join where name is not null),
t as (select method_slug as m, lower(trim(sp_name, ' ')) as n, case lower(trim(sp_compartment, ' ')) when 'raw' then 'natural resource' else lower(trim(sp_compartment, ' ')) end as t, {_NC.format(c='cas')} as c from cf_flow_join_copy where sp_name is not null),
s as (select lower(trim(name, ' ')) as n, lower(trim(categories[1], ' ')) as t, lower(trim(unnest(synonyms), ' ')) as syn from biosphere_catalog)
select method, db, code, count(*) as n from c where not (method = 'efx-acid-load' and lower(trim(name, ' ')) in (select lower(trim(name, ' ')) from deletion where name is not null))
 and (db not in ('terra-biosphere-4.2', 'biosphere-old') or method not in (select m from t)
  or exists (select 1 from t where t.m = method and t.n = lower(trim(c.name, ' ')) and t.t = c.top)
  or exists (select 1 from s join t on t.n = s.syn and t.t = s.t where t.m = method and s.n = lower(trim(c.name, ' ')) and s.t = c.top)
  or exists (select 1 from t where t.m = method and t.c = {_NC.format(c='c.cas')} and t.c <> '' and t.t = c.top)) group by 1, 2, 3"""
)
def cf_filter_cascade(spark: SparkSession, root: str) -> DataFrame:
    c = _joined(spark, root).where("name is not null").select(F.col("method_slug").alias("method"), "db", "code", "name", F.lower(F.get("categories", F.lit(0))).alias("top"), "cas")
    top = F.lower(F.trim("sp_compartment"))
    t = table(spark, root, "cf_flow_join_copy").where("sp_name is not null").select(F.col("method_slug").alias("method"), F.col("sp_name").alias("name"), F.when(top == "raw", "natural resource").otherwise(top).alias("top"), "cas")
    s = table(spark, root, "biosphere_catalog").select("name", F.get("categories", F.lit(0)).alias("top"), F.explode("synonyms").alias("synonym"))
    e = table(spark, root, "deletion").where("name is not null").select(F.lit("efx-acid-load").alias("method"), "name")
    return cf.filter_cascade(c, t, s, e, ["terra-biosphere-4.2", "biosphere-old"]).groupBy("method", "db", "code").agg(F.count(F.lit(1)).alias("n"))


_SHORT = "case when regexp_matches(sh, '\\d') then sh else '' end"
_LAST = "trim(replace(lower(case when trim(string_split(trim({c}), ',')[-1]) <> '' then trim(string_split(trim({c}), ',')[-1]) else trim({c}) end), '-', ' '))"
_TOPCASE = "case lower(categories[1]) when 'air' then 'Air' when 'water' then 'Water' when 'soil' then 'Soil' when 'natural resource' then 'Raw' else array_to_string(list_transform(string_split(lower(categories[1]), ' '), lambda w: upper(w[1]) || w[2:]), ' ') end"


@query(
    f"""with t0 as (select distinct method_slug as m, sp_name, trim(sp_compartment, ' ') as comp, coalesce(trim(sp_sub_compartment, ' '), '') as sub, trim(cas, ' ') as cas, sp_cf as cf, run_id, code, hash(method_slug) as h from cf_flow_join_copy where sp_name is not null and sp_cf is not null and not isnan(sp_cf)),
t as (select *, lower(trim(sp_name, ' ')) as n, length(sp_name) as len, {_LAST.format(c='sp_name')} as sh, dense_rank() over (order by m, lower(trim(code)), run_id, sp_name, comp, sub, cas, cf) as seq from t0),
ix as (
 select m, 'name' as kind, n as key, comp, sub, arg_max(cf, seq) as cf, arg_max(sp_name, seq) as nm, arg_max(sub, seq) as rsub from t group by 1, 2, 3, 4, 5
 union all select m, 'cas', cas, comp, sub, arg_min(cf, (len, seq)), arg_min(sp_name, (len, seq)), arg_min(sub, (len, seq)) from t where cas <> '' group by 1, 2, 3, 4, 5
 union all select m, 'cas_any', cas, comp, '', arg_min(cf, (sub <> '(unspecified)', len, seq)), arg_min(sp_name, (sub <> '(unspecified)', len, seq)), arg_min(sub, (sub <> '(unspecified)', len, seq)) from t where cas <> '' group by 1, 2, 3, 4, 5
 union all select m, 'short', {_SHORT}, comp, sub, arg_max(cf, seq), arg_max(sp_name, seq), arg_max(sub, seq) from t where {_SHORT} <> '' group by 1, 2, 3, 4, 5),
f0 as (select distinct method_slug as m, code, name, categories, cas from cf_flow_join where name is not null and code is not null),
f as (select m, code, min(name) as name, min(categories) as categories, min(cas) as cas from f0 group by 1, 2),
sy as (select {_fold('code')} as code, min(synonyms) as synonyms from biosphere_catalog group by 1),
g as (select f.*, coalesce({_TOPCASE}, '') as comp, coalesce(categories[2], '(unspecified)') as sub, lower(trim(name, ' ')) as n, {_LAST.format(c='name')} as sh, sy.synonyms from f left join sy on sy.code = lower(trim(f.code))),
k as (
 select m, code, comp, 0 as p, 'name' as kind, n as key, sub, 'exact_name' as prov from g union all select m, code, comp, 1, 'name', n, '(unspecified)', 'exact_name' from g
 union all select m, code, comp, 2 + 2 * i, 'name', s, sub, 'synonym' from (select m, code, comp, sub, n, unnest(list_filter(list_transform(synonyms, lambda z: lower(trim(z))), lambda z: z <> '')) as s, generate_subscripts(synonyms, 1) as i from g where len(synonyms) > 0) where s <> n
 union all select m, code, comp, 3 + 2 * i, 'name', s, '(unspecified)', 'synonym' from (select m, code, comp, sub, n, unnest(list_filter(list_transform(synonyms, lambda z: lower(trim(z))), lambda z: z <> '')) as s, generate_subscripts(synonyms, 1) as i from g where len(synonyms) > 0) where s <> n
 union all select m, code, comp, 100000, 'cas', trim(cas), sub, 'cas' from g union all select m, code, comp, 100001, 'cas_any', trim(cas), '', 'cas' from g
 union all select m, code, comp, 100002, 'short', {_SHORT}, sub, 'short_name' from g union all select m, code, comp, 100003, 'short', {_SHORT}, '(unspecified)', 'short_name' from g),
hit as (select k.m, k.code, arg_min(ix.cf, p) as sp_cf, arg_min(prov, p) as prov, arg_min(nm, p) as sp_name, arg_min(rsub, p) as rsub from k join ix using (m, kind, key, comp, sub) where key <> '' group by 1, 2)
select f.m as method, f.code, hit.sp_cf, coalesce(prov, 'unmatched') as sp_match_provenance, sp_name, rsub as sp_sub_compartment from f left join hit using (m, code)"""
)
def cf_flow_join(spark: SparkSession, root: str) -> DataFrame:
    """Every (method, code) of one system looked up in the factor table of the other."""
    c = table(spark, root, "cf_flow_join_copy").where("sp_name is not null and sp_cf is not null and not isnan(sp_cf)")
    seq = F.struct(F.lower(F.trim("code")).alias("code"), "run_id")  # the order of the table's rows
    t = c.select(F.col("method_slug").alias("method"), F.col("sp_name").alias("name"), F.trim("sp_compartment").alias("compartment"), F.coalesce(F.trim("sp_sub_compartment"), F.lit("")).alias("sub_compartment"), F.trim("cas").alias("cas"), F.col("sp_cf").alias("cf"), seq.alias("seq"))
    f = _joined(spark, root).where("name is not null and code is not null").groupBy(F.col("method_slug").alias("method"), "code").agg(F.min("name").alias("name"), F.min("categories").alias("categories"), F.min("cas").alias("cas"))
    syn = table(spark, root, "biosphere_catalog").groupBy(F.lower(F.trim("code")).alias("lc")).agg(F.min("synonyms").alias("synonyms"))
    f = f.withColumn("lc", F.lower(F.trim("code"))).join(syn, "lc", "left").withColumn("ctx", cf.table_context(F.col("categories")))
    f = f.select(F.struct("method", "code").alias("flow_key"), "method", "code", "name", "cas", "synonyms", F.col("ctx.comp").alias("comp"), F.col("ctx.sub").alias("sub"))
    return cf.flow_join(f, t).select("method", "code", "sp_cf", "sp_match_provenance", "sp_name", "sp_sub_compartment")


@query(
    f"with {_ONCE} select run_id, method_slug, code, round(abs(sp_cf - ef_cf) / nullif(abs(ef_cf), 0), 6) as rel_diff, case when sp_cf is null then 'registry_only' when case when ef_cf <> 0 then abs(sp_cf - ef_cf) / abs(ef_cf) < 1e-3 else abs(sp_cf - ef_cf) < 1e-9 end then 'agree' else 'differ' end as status from once where ef_cf is not null"
)
def cf_agreement(spark: SparkSession, root: str) -> DataFrame:
    return cf.comparison(_once(spark, root).where("ef_cf is not null")).select("run_id", "method_slug", "code", *r6("rel_diff"), "status")


@query(
    f"with {_ONCE}, a as (select lower(name) as n, lower(categories[1]) as t, count(ef_cf) as n_ours, avg(ef_cf) as ours from once group by 1, 2), b as (select lower(name) as n, lower(categories[1]) as t, count(case when isnan(sp_cf) then null else sp_cf end) as n_theirs, avg(case when isnan(sp_cf) then null else sp_cf end) as theirs from cf_flow_join_copy group by 1, 2)"
    " select coalesce(a.n, b.n) as n, coalesce(a.t, b.t) as t, n_ours, n_theirs, case when ours is null and theirs is null then 'empty' when theirs is null then 'only_ours' when ours is null then 'only_theirs' when case when theirs <> 0 then abs(ours - theirs) <= 0.01 * abs(theirs) else ours = 0 end then 'match' else 'differ' end as status from a full join b on a.n is not distinct from b.n and a.t is not distinct from b.t"
)
def cf_compare_outer(spark: SparkSession, root: str) -> DataFrame:
    side = lambda d, c: d.select(F.lower("name").alias("n"), F.lower(F.get("categories", F.lit(0))).alias("t"), F.when(~F.isnan(c), F.col(c)).alias("cf"))
    out = cf.outer_comparison(side(_once(spark, root), "ef_cf"), side(table(spark, root, "cf_flow_join_copy"), "sp_cf"), ["n", "t"])
    return out.select("n", "t", "n_ours", "n_theirs", "status")


@query(f"with {_ONCE} select method_slug, count(ef_cf) as count, min(ef_cf) as min, max(ef_cf) as max, round(avg(ef_cf), 6) as mean, round(median(ef_cf), 6) as median, round(stddev_samp(ef_cf), 6) as std from once group by 1")
def cf_stats(spark: SparkSession, root: str) -> DataFrame:
    s = cf.stats(_once(spark, root), ["method_slug"], "ef_cf")
    return s.select("method_slug", "count", "min", "max", *r6("mean", "median", "std"))


@query(f"with {_ONCE} select method_slug, count(*) filter (sp_cf is not null and ef_cf is not null) as n_matched, count(ef_cf) as n_registry, round(median(sp_cf) filter (sp_cf is not null and ef_cf is not null), 6) as median_table, round(median(ef_cf) filter (sp_cf is not null and ef_cf is not null), 6) as median_registry from once group by 1")
def cf_paired_stats(spark: SparkSession, root: str) -> DataFrame:
    p = cf.paired_stats(_once(spark, root), ["method_slug"])
    return p.select("method_slug", "n_matched", "n_registry", *r6("median_table", "median_registry"))


@query("select method_slug, code, run_id from (select *, row_number() over (partition by method_slug, code order by run_id, written_at) as rn from cf_flow_join) where rn = 1")
def cf_by_code(spark: SparkSession, root: str) -> DataFrame:
    return cf.first_by_code(_joined(spark, root), ["run_id", "written_at"]).select("method_slug", "code", "run_id")


def _references(spark: SparkSession, root: str) -> DataFrame:
    """Orders as reference rows: some carry a part's code, some its name or a piece of it."""
    o = table(spark, root, "orders")
    code = lambda m, f: F.when(F.col("o_orderkey") % 7 == m, f)
    key = (F.col("o_custkey") % 700).cast("string")
    p = F.col("o_custkey") % 5
    name = F.when(p == 0, "blue bolt").when(p == 1, "old gizmo [Ciqual code: 00").when(p == 2, "GEAR").when(p == 3, "no such thing").otherwise(F.concat(F.lit("item "), key))
    return o.select(F.col("o_orderkey").alias("ref_id"), code(0, F.concat(F.lit("00"), key)).alias("code_a"), code(1, key).alias("code_b"), F.when(F.col("o_orderkey") % 2 == 0, "widget").otherwise("").alias("storage"), name.alias("name"))


def _entries(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    label = F.concat("p_name", F.lit(" [Ciqual code: 00"), (F.col("p_partkey") % 900).cast("string"), F.lit("] "), F.col("p_brand"))
    return p.select(F.col("p_partkey").alias("key"), F.when(F.col("p_size") % 3 == 0, "process").otherwise("product").alias("type"), label.alias("name"))


_MAP = """
with r as (select o_orderkey as ref_id, case when o_orderkey % 7 = 0 then (o_custkey % 700)::varchar end as ca, case when o_orderkey % 7 = 1 then (o_custkey % 700)::varchar end as cb, case when o_orderkey % 2 = 0 then 'widget' else '' end as storage,
  case o_custkey % 5 when 0 then 'blue bolt' when 1 then 'old gizmo [Ciqual code: 00' when 2 then 'GEAR' when 3 then 'no such thing' else 'item ' || (o_custkey % 700) end as name from orders),
e as (select p_partkey as key, case when p_size % 3 = 0 then 'process' else 'product' end as type, p_name || ' [Ciqual code: 00' || (p_partkey % 900) || '] ' || p_brand as name, (p_partkey % 900)::varchar as code from part),
h as (select ref_id, pos, count(*) as n0, min(key) as k0, count(*) filter (type = 'product') as n1, min(key) filter (type = 'product') as k1, count(*) filter (type = 'product' and storage <> '' and contains(e.name, storage)) as n2, min(key) filter (type = 'product' and storage <> '' and contains(e.name, storage)) as k2
  from (select ref_id, storage, 0 as pos, ca as code from r where ca is not null union all select ref_id, storage, 1, cb from r where cb is not null) c join e using (code) group by 1, 2),
bc as (select ref_id, arg_min(key, pos) as key from (select ref_id, pos, case when n0 = 1 then k0 when n1 = 1 then k1 when n2 = 1 then k2 end as key from h) where key is not null group by 1),
names as (select distinct name from r),
part_ as (select n.name, arg_min(e.key, (length(e.name), e.key)) as key from names n join e on contains(lower(e.name), lower(n.name)) group by 1)
select r.ref_id, coalesce(bc.key, part_.key) as key, case when bc.key is not null then 'code' when part_.key is not null then 'contained' end as how from r left join bc using (ref_id) left join part_ on part_.name = r.name"""


@query(_MAP)
def backtest_map(spark: SparkSession, root: str) -> DataFrame:
    return report.map_products(_references(spark, root), _entries(spark, root)).select("ref_id", "key", "how")


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("computed"))
    o = table(spark, root, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("method"), "computed", F.when(F.col("o_orderkey") % 50 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("reference"))


_PAIRS = """p as (select o_orderkey, o_orderpriority as method, computed, case when o_orderkey % 50 = 0 then 0.0 else o_totalprice end as reference from orders left join (select l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) as computed from lineitem group by 1) on l_orderkey = o_orderkey),
lim as (select method, median(abs(reference)) * 0.01 as lim from p where abs(reference) > 0 group by 1),
d as (select p.*, coalesce(abs(computed) < lim and abs(reference) < lim, false) as floored from p left join lim using (method))"""


@query(f"with {_PAIRS} select o_orderkey, method, floored, round(case when floored then 0 else computed - reference end, 6) as diff_abs, round(case when floored then 0 else round_even((computed - reference) / nullif(reference, 0) * 100, 4) end, 6) as diff_pct from d")
def backtest_diff(spark: SparkSession, root: str) -> DataFrame:
    d = report.differences(_pairs(spark, root))
    return d.select("o_orderkey", "method", "floored", *r6("diff_abs", "diff_pct"))


@query(
    f"with {_PAIRS}, q as (select *, (computed - reference) / nullif(reference, 0) * 100 as pct from d) select method, count(pct) as n_compared, round(avg(pct), 4) as mean_diff_pct, round(median(pct), 4) as median_diff_pct, round(stddev_samp(pct), 4) as std_diff_pct, count(*) filter (abs(pct) <= 1) as within_1pct, count(*) filter (abs(pct) <= 5) as within_5pct, count(*) filter (abs(pct) > 5) as outliers_gt5pct, round(max(abs(pct)), 4) as max_abs_diff_pct, count(*) filter (floored) as n_near_zero_floored from q group by 1"
)
def backtest_summary(spark: SparkSession, root: str) -> DataFrame:
    s = report.summary(report.differences(_pairs(spark, root)))
    return s.select("method", "n_compared", *[F.round(c, 4).alias(c) for c in ("mean_diff_pct", "median_diff_pct", "std_diff_pct", "max_abs_diff_pct")], "within_1pct", "within_5pct", "outliers_gt5pct", "n_near_zero_floored")


@query("with w as (select l_orderkey as k, l_linenumber as n, l_discount * 1000 as discount, l_tax * 1000 - 40 as tax, l_quantity - 25 as quantity from lineitem) select * from (select k, n, 'discount' as method, round(discount, 6) as pct, case when discount > 0 then 'above' else 'below' end as side from w where abs(discount) >= 30 union all select k, n, 'tax', round(tax, 6), case when tax > 0 then 'above' else 'below' end from w where abs(tax) >= 30 union all select k, n, 'quantity', round(quantity, 6), case when quantity > 0 then 'above' else 'below' end from w where abs(quantity) >= 30)")
def outlier_scan(spark: SparkSession, root: str) -> DataFrame:
    w = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), (F.col("l_discount") * 1000).alias("discount"), (F.col("l_tax") * 1000 - 40).alias("tax"), (F.col("l_quantity") - 25).alias("quantity"))
    return report.outliers(w, ["k", "n"], ["discount", "tax", "quantity"]).withColumn("pct", rnd(F.col("pct")))


def _parameters(spark: SparkSession, root: str) -> DataFrame:
    """Each order is a process: discount and tax of its lineitems are inputs, what is left of the price is calculated."""
    li = table(spark, root, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_discount").alias("d"), F.max("l_tax").alias("t"), F.max("l_quantity").alias("q"))
    code, n = F.col("l_orderkey").cast("string").alias("process_code"), F.col("l_linenumber").cast("string")
    row = lambda prefix, kind, amount, formula: F.struct(F.concat(F.lit(prefix), n).alias("name"), F.concat(F.lit("User_" + prefix), n).alias("original_name"), F.lit(kind).alias("kind"), amount.alias("amount"), formula.alias("formula"))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    rows = F.array(row("d", "input", F.col("d"), text), row("t", "input", F.col("t"), text), row("q", "input", F.col("q"), text), row("net", "calculated", none, F.concat(F.lit("q"), n, F.lit(" * (1 - d"), n, F.lit(")"))))
    parent = F.when(F.col("l_orderkey") % 10 != 0, (F.col("l_orderkey") - F.col("l_orderkey") % 10).cast("string"))
    return li.select(code, F.explode(rows).alias("r"), parent.alias("mf_parent_code")).select("process_code", "r.*", "mf_parent_code")


def _overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("user_t1", "*", 0.5, 1), ("T1", "*", 0.25, 2), ("t2", "100", 0.75, 3), ("d1", "101", 0.9, 4), ("d1", "100", 0.8, 5)], "parameter_name string, scope string, value double, seq int")


_PARAMS = """par as (select l_orderkey as o, l_linenumber as n, max(l_discount) as d, max(l_tax) as t, max(l_quantity) as q from lineitem group by 1, 2),
ov as (select o, n, q, d, t, case when n = 1 then 0.25 when n = 2 and (o = 100 or (o % 10 <> 0 and o - o % 10 = 100)) and exists (select 1 from par z where z.o = par.o and z.n = 2) then 0.75 end as nt, case when n = 1 and o = 101 then 0.9 when n = 1 and (o = 100 or (o % 10 <> 0 and o - o % 10 = 100)) then 0.8 end as nd from par),
touched as (select distinct o from ov where nt is not null or nd is not null)"""


@query(f"with {_PARAMS} select o::varchar as process_code, n::bigint as exchange_index, round(q * (1 - d) * (1 + t), 6) as old_amount, round(q * (1 - coalesce(nd, d)) * (1 + coalesce(nt, t)), 6) as new_amount from ov where o in (select o from touched)")
def param_override(spark: SparkSession, root: str) -> DataFrame:
    p = _parameters(spark, root)
    n = F.col("l_linenumber").cast("string")
    li = table(spark, root, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("_"), F.max("l_quantity").alias("q"), F.max("l_discount").alias("d"), F.max("l_tax").alias("t"))
    e = li.select(F.col("l_orderkey").cast("string").alias("process_code"), F.col("l_linenumber").cast("long").alias("exchange_index"), F.concat(F.lit("net"), n, F.lit(" * (1 + t"), n, F.lit(")")).alias("formula"), (F.col("q") * (1 - F.col("d")) * (1 + F.col("t"))).alias("amount"))
    out = params.reevaluate(p, e, params.override_plan(p, _overrides(spark)))
    return out.select("process_code", "exchange_index", *r6("old_amount", "new_amount"))


@query(f"with {_PARAMS} select o::varchar as process_code, 't1' as name from ov where n = 1 union all select o::varchar, 'd' || n from ov where nd is not null union all select o::varchar, 't2' from ov where n = 2 and nt is not null union all select o::varchar, 'net' || n from ov where nd is not null")
def param_closure(spark: SparkSession, root: str) -> DataFrame:
    p = _parameters(spark, root)
    return params.influenced(p, params.override_plan(p, _overrides(spark)))


@query("with par as (select l_orderkey as o, l_linenumber as n, max(l_discount) as d, max(l_tax) as t, max(l_quantity) as q from lineitem group by 1, 2) select name, kind, count(distinct o) as n_processes, min(a) as min_amount, max(a) as max_amount from (select o, 'd' || n as name, 'input' as kind, d as a from par union all select o, 't' || n, 'input', t from par union all select o, 'q' || n, 'input', q from par union all select o, 'net' || n, 'calculated', null from par) group by 1, 2")
def param_summary(spark: SparkSession, root: str) -> DataFrame:
    return params.parameter_summary(_parameters(spark, root))


@query("select c_custkey, trim(regexp_replace(lower(c_mktsegment), '[-_,]', ' ', 'g')) as method from customer")
def method_names(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select("c_custkey", x.normal_method(F.concat(F.lit("EF-"), "c_mktsegment", F.lit(" - organics"))).alias("method"))
