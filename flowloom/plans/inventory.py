"""Queries of the technosphere matcher, the normalisers, the catalogues, the factor registry and the exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import export, match, normalise, registry, techno
from flowloom.plans.linking import PREFERRED, _bucket, _fold, _tiered_inputs
from flowloom.plans.linking import ORACLE as LINKING
from flowloom.plans.scoring import Query, r6, rnd
from flowloom.plans.scoring import query as _query
from flowloom.sources.tables import table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    return _query(oracle, QUERIES, ORACLE)


def _case(c: Column, *values: str) -> Column:
    """values[c % len(values)]"""
    out = F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        out = F.when(c % len(values) == i, v).otherwise(out)
    return out


# technosphere: parts are activities, orders ask for them in various writing

_ACTIVITIES = "cat as (select 'a' || p_partkey as code, lower(p_name || ' ' || (p_partkey // 2)) as name, case when p_partkey % 5 = 0 then 'kilowatt hour' else 'kilogram' end as unit, case p_partkey % 3 when 0 then 'FR' when 1 then 'GLO' else 'RER' end as location, lower(p_name) as product from part)"


def _activities(spark: SparkSession, root: str) -> DataFrame:
    p, k = table(spark, root, "part"), F.col("p_partkey")
    unit = F.when(k % 5 == 0, "kilowatt hour").otherwise("kilogram")
    return p.select(F.concat(F.lit("a"), k.cast("string")).alias("code"), F.concat("p_name", F.lit(" "), F.floor(k / 2).cast("string")).alias("name"), unit.alias("unit"), _case(k, "FR", "GLO", "RER").alias("location"), F.col("p_name").alias("product"))


def _asked(spark: SparkSession, root: str) -> DataFrame:
    """Orders ask for part c = o_custkey: as it is, in tons, with a stale product, under an old name, in the written form, or redirected."""
    o = table(spark, root, "orders").select("o_orderkey", (F.col("o_orderkey") % 9).alias("w"), F.col("o_totalprice").alias("amount"), F.col("o_custkey").alias("c"))
    p = table(spark, root, "part").select(F.col("p_partkey").alias("c"), "p_name")
    j, c, w = o.join(p, "c"), F.col("c"), F.col("w")
    name, loc = F.concat("p_name", F.lit(" "), F.floor(c / 2).cast("string")), _case(c, "FR", "GLO", "RER")
    unit = F.when(c % 5 == 0, "kilowatt hour").otherwise("kilogram")
    written = F.concat("p_name", F.lit(" {"), loc, F.lit("}| "), name, F.lit(" | U"))
    return j.select(
        F.col("o_orderkey").alias("exc_id"),
        F.when(w == 1, F.concat(F.lit("OLD "), name)).when(w == 2, written).when(w == 3, F.lit("extract of fuel")).when(w == 4, F.concat(F.lit(" "), F.upper(name))).otherwise(name).alias("name"),
        F.when((w == 5) & (c % 5 != 0), "ton").when((w == 6) & (c % 5 == 0), "megajoule").otherwise(unit).alias("unit"),
        F.when(w == 1, F.lit("old")).otherwise(loc).alias("location"),
        F.when(w == 7, F.lit("stale")).otherwise(F.col("p_name")).alias("product"),
        "amount",
    )


_ASKED = """o as (select o_orderkey as id, o_orderkey % 9 as w, o_totalprice as amount, o_custkey as c, lower(p_name) as pn, lower(p_name || ' ' || (p_partkey // 2)) as nm, case p_partkey % 3 when 0 then 'FR' when 1 then 'GLO' else 'RER' end as loc, case when p_partkey % 5 = 0 then 'kilowatt hour' else 'kilogram' end as unit from orders join part on p_partkey = o_custkey)"""


@query(
    f"""with {_ACTIVITIES}, {_ASKED},
e as (select id, w, pn, nm, loc, case when w = 1 then 'old ' || nm when w = 2 then 'written' when w = 3 then 'extract of fuel' else nm end as name, case when w = 5 and c % 5 <> 0 then 'ton' else unit end as unit, case when w = 1 then 'old' else loc end as location, case when w = 7 then 'stale' else pn end as product, amount, w = 6 and c % 5 = 0 as mj from o),
e1 as (select * exclude (amount), case when mj and (starts_with(name, 'blue') or starts_with(name, 'market')) then amount / 3.6 else amount end as amount, case when mj and not (starts_with(name, 'blue') or starts_with(name, 'market')) then 'megajoule' else unit end as u1 from e),
full_ as (select name, unit, location, product, min(code) as code from cat group by 1, 2, 3, 4 having count(distinct code) = 1),
short as (select name, unit, location, min(code) as code from cat group by 1, 2, 3 having count(distinct code) = 1),
x as (select e1.*, case u1 when 'ton' then 'kilogram' when 'megajoule' then 'kilowatt hour' else u1 end as u2, case u1 when 'ton' then amount * 1000 when 'megajoule' then amount * 0.25 else amount end as amount2 from e1),
p1 as (select x.*, f.code as c1 from x left join full_ f on f.name = x.name and f.unit = x.u1 and f.location = x.location and f.product = x.product),
p2 as (select p1.*, f.code as c2 from p1 left join full_ f on f.name = p1.name and f.unit = p1.u2 and f.location = p1.location and f.product = p1.product),
fx as (select p2.*, case when w = 1 and regexp_matches(nm, ' [0-9]*[02468]$') then nm else name end as n3, case when w = 1 and regexp_matches(nm, ' [0-9]*[02468]$') then 'GLO' else location end as l3 from p2),
p3 as (select fx.*, f.code as c3 from fx left join full_ f on f.name = n3 and f.unit = u2 and f.location = l3 and f.product = fx.product),
p4 as (select p3.*, s.code as c4 from p3 left join short s on s.name = n3 and s.unit = u2 and s.location = l3),
form as (select id, case when count(distinct k.code) filter (k.location = p4.loc) > 0 then case when count(distinct k.code) filter (k.location = p4.loc) = 1 then min(k.code) filter (k.location = p4.loc) end else case when count(distinct k.code) filter (k.location = 'GLO') > 0 then case when count(distinct k.code) filter (k.location = 'GLO') = 1 then min(k.code) filter (k.location = 'GLO') end else case when count(distinct k.code) filter (k.location = 'RER') = 1 then min(k.code) filter (k.location = 'RER') end end end as c6 from p4 join cat k on k.name = p4.nm where w = 2 group by id, p4.loc)
select id as exc_id, coalesce(c1, c2, c3, c4, case when w = 3 then 'a7' end, case when kk.unit = u2 then c6 end) as code, case when c1 is not null then 1 when c2 is not null then 2 when c3 is not null then 3 when c4 is not null then 4 when w = 3 then 5 when kk.unit = u2 then 6 end as match_pass,
 round(case when c1 is not null then amount else amount2 end, 6) as amount, case when c1 is not null then u1 else u2 end as unit from p4 left join form using (id) left join cat kk on kk.code = c6"""
)
def techno_match(spark: SparkSession, root: str) -> DataFrame:
    asked, cat = _asked(spark, root), _activities(spark, root)
    conv = spark.createDataFrame([("Ton ", "kilogram", 1000.0, 1), ("ton", "gram", 1e6, 2), ("megajoule", "kilowatt hour", 0.25, 3), ("x", "kilogram", None, 4)], "source_unit string, target_unit string, multiplier double, seq int")
    even = cat.where(F.col("name").rlike("[02468]$")).select(F.concat(F.lit("old "), F.lower("name")).alias("name"), F.lower("name").alias("new_name")).distinct()
    fixes = even.select("name", "new_name", F.lit("GLO").alias("new_location"), F.lit(None).cast("string").alias("new_product"), F.lit(1).alias("seq"))
    redirects = spark.createDataFrame([("extract of fuel", "a7")], "name string, code string")
    out = techno.techno_match(asked, cat, conv, fixes, redirects, ["blue", "market"])
    return out.select("exc_id", "code", F.col("match_pass").cast("long").alias("match_pass"), *r6("amount"), "unit")


def _water(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(_case(k, "Water, river", "water", "Zinc", "Water, lake"), _case(F.floor(k / 4), "", ", FR", ", CN-SH", ", RoW", ", Xy", ", ZZ"))
    return table(spark, root, "part").select(
        k.alias("exc_id"), F.when(k % 13 != 0, F.lit("bio-a")).otherwise("bio-b").alias("t_db"), F.when(k % 11 != 0, F.concat(F.lit("c"), k.cast("string"), F.when(k % 17 == 0, "@BR").otherwise(""))).alias("t_code"),
        _case(k, "Water, river", "water", "Zinc", "Water, lake").alias("name"), name.alias("source_name"),
    )


@query(
    "with e as (select p_partkey as exc_id, case when p_partkey % 13 <> 0 then 'bio-a' else 'bio-b' end as t_db, case when p_partkey % 11 <> 0 then 'c' || p_partkey || case when p_partkey % 17 = 0 then '@BR' else '' end end as t_code, p_partkey % 4 as n, ['', 'FR', 'CN-SH', 'RoW', '', ''][(p_partkey // 4) % 6 + 1] as region from part)"
    " select exc_id, case when t_db = 'bio-a' and not contains(t_code, '@') and n <> 2 and region <> '' then t_code || '@' || region else t_code end as t_code from e"
)
def region_sweep(spark: SparkSession, root: str) -> DataFrame:
    """Water flows take the region of the name they were written with; all country codes count."""
    return techno.region_sweep(_water(spark, root), ["bio-a"]).select("exc_id", "t_code")


@query(
    f"with m as ({LINKING['tiered_match']}), u as (select {_fold('db')} as db, {_fold('code')} as code, min(unit) as unit from biosphere_catalog group by 1, 2) select r.record_id as exc_id, m.t_db, m.t_code, round(r.n_exchanges * coalesce(m.multiplier, 1.0), 6) as amount, case when m.multiplier <> 1 then coalesce(u.unit, r.units[1]) else r.units[1] end as unit from flow_records r left join m on m.exc_id = r.record_id left join u on u.db = m.t_db and u.code = m.t_code".replace("with m as (\nwith", "with m as (with")
)
def matched_exchanges(spark: SparkSession, root: str) -> DataFrame:
    """Exchanges with the target, amount and unit of their match."""
    e, reg, cat, conv, preferred = _tiered_inputs(spark, root)
    m = match.tiered_match(e, reg, cat, conv, preferred).withColumn("multiplier", rnd(F.col("multiplier")))
    f = table(spark, root, "flow_records").select(F.col("record_id").alias("exc_id"), "name", F.get("units", F.lit(0)).alias("unit"), F.col("n_exchanges").cast("double").alias("amount"))
    units = cat.select(match.folded("db").alias("t_db"), match.folded("code").alias("t_code"), F.col("unit").alias("t_unit"))
    return techno.apply_matches(f, m, units, []).select("exc_id", "t_db", "t_code", *r6("amount"), "unit")


# normalisers


def _labelled(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    cats = F.when(k % 6 == 0, F.array(F.lit("Air"), F.lit("high. pop."))).when(k % 6 == 1, F.array(F.lit("Emissions to water"), F.lit("river"), F.lit("x"))).when(k % 6 == 2, F.array(F.lit("Raw"), F.lit("(unspecified)"))).when(k % 6 == 3, F.array(F.lit("Odd"))).when(k % 6 == 4, F.array(F.lit("Soil"), F.lit("old soil")))
    name = _case(k, "Zinc", "Lead", "Water", "Iron", "Tin")
    return table(spark, root, "part").select(
        k.alias("id"), F.when(k % 4 != 3, "biosphere").otherwise("technosphere").alias("type"), name.alias("name"), cats.alias("categories"), F.lit("FR").alias("location"),
        F.when(k % 3 == 0, F.concat(F.lit("t"), k.cast("string"))).alias("target_code"), F.when(k % 2 == 0, F.lit("c")).alias("code"), F.lit("i").alias("identifier"), F.array(F.lit("ctx")).alias("context"),
    )


_LABELLED = "e as (select p_partkey as id, p_partkey % 4 <> 3 as bio, ['Zinc', 'Lead', 'Water', 'Iron', 'Tin'][p_partkey % 5 + 1] as name, p_partkey % 6 as k, p_partkey from part)"


@query(
    f"with {_LABELLED} select id, case when bio and k = 0 and name = 'Zinc' then 'Zinc, air' when name = 'Lead' then 'Lead II' when bio and k = 4 and name = 'Tin' then 'Tin, soil' else name end as name,"
    " case when bio then case k when 0 then 'air|urban air close to ground' when 1 then 'water|surface water' when 2 then 'natural resource' when 3 then 'Odd' when 4 then 'soil|new soil' end else case k when 0 then 'Air|high. pop.' when 1 then 'Emissions to water|river|x' when 2 then 'Raw|(unspecified)' when 3 then 'Odd' when 4 then 'Soil|old soil' end end as categories, case when not bio then 'FR' end as location from e"
)
def biosphere_labels(spark: SparkSession, root: str) -> DataFrame:
    """The chain of six normalisers; the migrations of names and categories reach rows of every type."""
    names = spark.createDataFrame([("air", "Zinc", "Zinc, first", 1), ("air", "Zinc", "Zinc, air", 2), ("soil", "Tin", "Tin, soil", 3)], "category string, name string, new_name string, seq int")
    cats = spark.createDataFrame([(["soil", "old soil"], ["soil", "new soil"], 1), (["soil", "old soil"], ["soil", "z"], 2)], "old array<string>, new array<string>, seq int")
    renames = spark.createDataFrame([("Lead", "Lead II", 1), ("Lead II", "Lead III", 2)], "old string, new string, seq int")
    out = normalise.biosphere_labels(_labelled(spark, root), names, cats, renames.where("old = 'Lead'"))
    return out.where("type is not null").select("id", "name", F.array_join("categories", "|").alias("categories"), "location")


@query(f"with {_LABELLED} select id, case when id % 3 = 0 then case when id % 2 = 0 then 'c' end else case when id % 2 = 0 then 'c' else 'i' end end as code, case when id % 3 <> 0 and k = 5 then 1 when k = 5 then null else 0 end as from_context from e")
def standard_labels(spark: SparkSession, root: str) -> DataFrame:
    out = normalise.standard_labels(_labelled(spark, root))
    return out.select("id", "code", F.when(F.col("categories").isNotNull(), (F.get("categories", F.lit(0)) == "ctx").cast("int")).alias("from_context"))


@query(f"with {_LABELLED} select id, case when bio then name end as source_name from e where id % 3 = 0")
def linked_with_names(spark: SparkSession, root: str) -> DataFrame:
    """Linked rows only, with the name that biosphere rows had before any renaming, kept through a second snapshot."""
    e = normalise.remembered_names(_labelled(spark, root)).withColumn("name", F.lit("renamed"))
    return normalise.linked_only(normalise.remembered_names(e), drop=True).select("id", "source_name")


@query(
    "with t as (select lower(p_name || p_brand) as h, min('t' || p_partkey) as code from part group by 1 having count(*) = 1) select l_orderkey, l_linenumber, case when l_linenumber = 1 then 'kept' when l_linestatus = 'F' then t.code end as target_code from lineitem left join part on p_partkey = l_partkey left join t on t.h = lower(upper(p_name) || p_brand)"
)
def link_by_hash(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    li = table(spark, root, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    e = li.select("l_orderkey", "l_linenumber", F.upper("p_name").alias("name"), F.col("p_brand").alias("brand"), F.when(F.col("l_linestatus") == "F", "technosphere").otherwise("biosphere").alias("type"), F.when(F.col("l_linenumber") == 1, "kept").alias("target_code"))
    t = p.select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("code"))
    return normalise.link_by_hash(e, t, ["name", "brand"], ["technosphere"]).select("l_orderkey", "l_linenumber", "target_code")


_RULES = "r as (select p_partkey as id, ['Energy, from peat', 'Water', 'Manganese-55', 'Zinc', 'Energy, from hydro power'][p_partkey % 5 + 1] as n, ['MJ', 'kg', 'Bq', 'kg', 'MJ'][p_partkey % 5 + 1] as su, ['kg', 'm3', 'x', 'g', 'MJ'][p_partkey % 5 + 1] as tu, p_size as f from part)"


@query(
    f"with {_RULES} select id, case n when 'Manganese-55' then 'Manganese-54' else 'T' end as target_name, case n when 'Manganese-55' then 'kBq' else tu end as target_unit, round(case n when 'Energy, from peat' then 1.0 / 9.9 when 'Water' then 0.001 when 'Manganese-55' then 0.001 when 'Energy, from hydro power' then 1.0 else f end, 6) as conversion_factor, case when n like 'Energy%' then 'inverted' when n <> 'Zinc' then 'missing' end as patch from r"
)
def patched_rules(spark: SparkSession, root: str) -> DataFrame:
    """Factors of rules: heat contents inverted, missing ones filled in, one isotope redirected."""
    k = F.col("p_partkey")
    n = _case(k, "Energy, from peat", "Water", "Manganese-55", "Zinc", "Energy, from hydro power")
    factor = F.when(k % 5 == 1, float("nan")).when(k % 5 == 2, float("nan")).otherwise(F.col("p_size").cast("double"))
    r = table(spark, root, "part").select(k.alias("id"), n.alias("source_name"), _case(k, "MJ", "kg", "Bq", "kg", "MJ").alias("source_unit"), F.lit("T").alias("target_name"), _case(k, "kg", "m3", "x", "g", "MJ").alias("target_unit"), F.lit("tc").alias("target_code"), factor.alias("conversion_factor"))
    return normalise.check_rules(normalise.patched_rules(r)).select("id", "target_name", "target_unit", *r6("conversion_factor"), "patch")


# catalogues and the factor registry


@query(
    "with a as (select db, coalesce(code, '') as code, coalesce(name, '') as name, coalesce(unit, '') as unit, nullif(cas, '') as cas, coalesce(len(categories), 0) as n_categories, 0 as i from biosphere_catalog where db <> 'biosphere-old' union all select db, coalesce(code, ''), coalesce(upper(name), ''), coalesce(unit, ''), nullif(cas, ''), coalesce(len(categories), 0), 1 from biosphere_catalog)"
    " select db, code, name, unit, cas, n_categories from (select *, row_number() over (partition by db, code order by i, name) as rn from a) where rn = 1"
)
def flow_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Two snapshots as one catalogue: the first one counts, an absent one is skipped."""
    c = table(spark, root, "biosphere_catalog")
    out = registry.flow_catalog([c.where("db <> 'biosphere-old'"), None, c.withColumn("name", F.upper("name"))])
    return out.select("db", "code", "name", "unit", "cas", F.size("categories").cast("long").alias("n_categories"))


@query(f"select db, code, {_bucket('categories')} as bucket from biosphere_catalog where db in ('{PREFERRED[0]}', '{PREFERRED[1]}')")
def catalog_of_databases(spark: SparkSession, root: str) -> DataFrame:
    """The filter on databases is pushed into the scan."""
    return registry.with_bucket(table(spark, root, "biosphere_catalog"), PREFERRED[:2]).select("db", "code", "bucket")


@query("select 'bg' as db, p_partkey::varchar as code, p_name as name, '' as unit, p_brand as location, case when p_partkey % 2 = 0 then p_name when p_partkey % 3 = 0 then p_brand else '' end as product from part")
def activity_catalog(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    a = table(spark, root, "part").select(k.alias("code"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("unit"), F.col("p_brand").alias("location"), F.when(k % 2 == 0, F.col("p_name")).otherwise("").alias("reference_product"), F.when(k % 3 == 0, F.col("p_brand")).alias("reference product"))
    return registry.activity_catalog(a, "bg")


@query("select db, code from biosphere_catalog where code in (select target_code from mapping where target_code is not null union select code from cf_flow_join where code is not null)")
def needed_flows(spark: SparkSession, root: str) -> DataFrame:
    used = [table(spark, root, "mapping").select(F.col("target_code").alias("code")), table(spark, root, "cf_flow_join").select("code")]
    return registry.needed_flows(table(spark, root, "biosphere_catalog"), used).select("db", "code")


_LONG = ", ".join("('" + "|".join(k) + f"', '{v[0]}', '{v[1]}')" for k, v in registry.LONG_CONTEXTS.items())


@query(
    f"with long(path, comp, sub) as (values {_LONG}), rules(s0, s1, t) as (values ('Air', 'high. pop.', 'air|urban'), ('Air', 'later', 'air|urban'), ('Water', '', 'water'), ('Resources', 'in x', 'natural resource|living stock')),"
    " back as (select t, coalesce(nullif(min_by(s1, n), ''), '(unspecified)') as sub from (select *, row_number() over () as n from rules where s0 in ('Air', 'Water', 'Soil', 'Raw')) group by 1),"
    " rows as (select distinct categories, array_to_string(categories, '|') as path from biosphere_catalog where len(categories) > 0 union select string_split(path, '|'), path from long)"
    " select r.path, coalesce(long.comp, case lower(r.categories[1]) when 'air' then 'Air' when 'water' then 'Water' when 'soil' then 'Soil' when 'natural resource' then 'Raw' else array_to_string(list_transform(string_split(lower(r.categories[1]), ' '), lambda w: upper(w[1]) || w[2:]), ' ') end) as comp, coalesce(long.sub, back.sub, r.categories[2], '(unspecified)') as sub from rows r left join long on long.path = r.path left join back on back.t = lower(r.path)"
)
def context_normaliser(spark: SparkSession, root: str) -> DataFrame:
    """Compartments of the catalogue, and all long paths, in the factor table's style."""
    c = table(spark, root, "biosphere_catalog").select("categories").where(F.size("categories") > 0)
    every = c.unionByName(spark.createDataFrame([(list(k),) for k in registry.LONG_CONTEXTS], "categories array<string>")).distinct()
    rules = [(["Air", "high. pop."], ["air", "urban"], 1), (["Air", "later"], ["air", "urban"], 2), (["Water", ""], ["water"], 3), (["Resources", "in x"], ["natural resource", "living stock"], 4)]
    out = registry.contexts(every, spark.createDataFrame(rules, "source_context array<string>, target_context array<string>, seq int"))
    return out.select(F.array_join("categories", "|").alias("path"), "comp", "sub")


@query("select l_orderkey, l_linenumber, round(l_quantity * case when l_returnflag = 'R' and l_linestatus = 'F' then 1000.0 else 1.0 end, 6) as cf from lineitem")
def unit_scales(spark: SparkSession, root: str) -> DataFrame:
    method = F.when(F.col("l_returnflag") == "R", "Water use").otherwise("Climate change")
    unit = F.when(F.col("l_linestatus") == "F", "kg").otherwise("m3")
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", rnd(F.col("l_quantity") * registry.unit_scale(method, unit)).alias("cf"))


@query(
    "with m as (select c_custkey, c_mktsegment || case c_custkey % 3 when 0 then ' - inorganics' when 1 then ' - organics' else '' end as method from customer) select c_custkey, method, case c_mktsegment when 'BUILDING' then 'acid' when 'MACHINERY' then 'climate' end as key, case c_mktsegment when 'BUILDING' then 'AE' when 'MACHINERY' then 'GWP' end as indicator from m join customer using (c_custkey)"
)
def method_aliases(spark: SparkSession, root: str) -> DataFrame:
    """Sub-methods fold into their root before the alias is looked up; unknown ones have none."""
    m = table(spark, root, "customer").select("c_custkey", F.concat("c_mktsegment", _case(F.col("c_custkey"), " - inorganics", " - organics", "")).alias("method"))
    aliases = spark.createDataFrame([("BUILDING", "acid", "AE"), ("MACHINERY", "climate", "GWP"), ("MACHINERY", "z", "z")], "method string, key string, indicator string")
    return registry.method_aliases(m, aliases)


@query("select c_custkey, trim(regexp_replace(lower(c_mktsegment), '[-_,]', ' ', 'g')) as normal from customer where contains(lower(c_mktsegment), 'build') or contains(lower(c_mktsegment), 'hold')")
def comparable_methods(spark: SparkSession, root: str) -> DataFrame:
    m = table(spark, root, "customer").select("c_custkey", F.col("c_mktsegment").alias("method"))
    return registry.comparable_methods(m, ["Build", "HOLD"]).select("c_custkey", "normal")


@query("select o_orderkey, replace(url_encode(o_orderpriority || '_a b/é*~'), '_', '%5F') || '__' || replace(url_encode(o_orderstatus), '_', '%5F') as slug from orders")
def method_slugs(spark: SparkSession, root: str) -> DataFrame:
    parts = F.array(F.concat("o_orderpriority", F.lit("_a b/é*~")), F.col("o_orderstatus"))
    return table(spark, root, "orders").select("o_orderkey", registry.slug_column(parts).alias("slug"))


def _waters(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    cat = table(spark, root, "part").select(_case(k, "bio-a", "bio-b", "other").alias("db"), F.concat(F.lit("c"), k.cast("string")).alias("code"), _case(F.floor(k / 3), "Water, lake", "water, river ", "Water, salt").alias("name"), F.when(k % 10 < 8, F.array(F.lit("natural resource"), F.lit("in water"))).otherwise(F.array(F.lit("water"))).alias("categories"), F.lit(None).cast("string").alias("cas"))
    s = table(spark, root, "supplier")
    t = s.select(_case(F.col("s_suppkey"), "Lake water", "river water", "ground water").alias("name"), F.when((F.col("s_suppkey") % 3 != 0) | (F.col("s_suppkey") > 20), F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("location"), F.col("s_acctbal").alias("cf"), F.col("s_suppkey").alias("seq"))
    return t, cat


_WATERS = "cat as (select ['bio-a', 'bio-b', 'other'][p_partkey % 3 + 1] as db, 'c' || p_partkey as code, ['water, lake', 'water, river', 'water, salt'][(p_partkey // 3) % 3 + 1] as n, case when p_partkey % 10 < 8 then 'natural resource' else 'water' end as top, p_partkey from part), g as (select s_suppkey % 3 as k, coalesce(min_by(s_acctbal, s_suppkey) filter (s_suppkey % 3 = 0 and s_suppkey <= 20), avg(s_acctbal)) as cf from supplier group by 1)"


@query(f"with {_WATERS} select db, code, round(cf, 6) as cf from cat join g on (n = 'water, lake' and k = 0) or (n = 'water, river' and k = 1) where db in ('bio-a', 'bio-b') and top = 'natural resource'")
def water_factors(spark: SparkSession, root: str) -> DataFrame:
    """Catalogue flows that take the global factor of a resource flow of another name."""
    t, cat = _waters(spark, root)
    return registry.water_rows(t, cat, ["bio-a", "bio-b"]).select("db", "code", *r6("cf"))


@query(f"with {_WATERS}, t as (select ['water, lake', 'water, salt'][s_suppkey % 2 + 1] as n, ['natural resource', 'water', 'soil'][s_suppkey % 3 + 1] as top, min_by(s_acctbal, s_suppkey) as cf from supplier where s_acctbal <> 0 group by 1, 2) select db, code, cf from cat join t using (n, top) where db in ('bio-a', 'bio-b') and p_partkey % 7 <> 0")
def factors_by_name(spark: SparkSession, root: str) -> DataFrame:
    _, cat = _waters(spark, root)
    k = F.col("s_suppkey")
    t = table(spark, root, "supplier").select(_case(k, "Water, lake", "water, salt").alias("name"), _case(k, "Raw", "Water", "Soil").alias("compartment"), F.col("s_acctbal").alias("cf"), k.alias("seq"))
    have = cat.where(F.expr("cast(substring(code, 2) as int) % 7 = 0"))
    return registry.factors_by_name(t, cat, have, ["bio-a", "bio-b"])


@query("with cat as (select 'd' as db, 'c' || p_partkey || '@N' || (p_partkey % 30) as code, p_partkey % 30 as r, p_partkey from part where p_partkey % 4 <> 0) select db, code, (n_nationkey + 1) * 2.0::double as cf from cat join nation on n_nationkey = r where p_partkey % 3 = 0")
def regional_flow_factors(spark: SparkSession, root: str) -> DataFrame:
    """Resource rows '<code>@<region>' whose base flow has a factor."""
    k = F.col("p_partkey")
    p = table(spark, root, "part")
    base = p.select(F.lit("d").alias("db"), F.concat(F.lit("c"), k.cast("string")).alias("code"), F.when(k % 3 == 0, F.array(F.lit("natural resource"))).otherwise(F.array(F.lit("water"))).alias("categories"), k)
    rows = base.withColumn("code", F.concat("code", F.lit("@N"), (k % 30).cast("string")))
    regional = table(spark, root, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("region"), ((F.col("n_nationkey") + 1) * 2.0).alias("cf"))
    return registry.regional_flow_rows(rows.unionByName(base), regional, base.where(k % 4 != 0))


@query(
    "with own as (select p_partkey as k, 1.0 as cf from part where p_partkey % 2 = 0), inh as (select p_partkey as k, 2.0 as cf from part where p_partkey % 3 = 0 and p_partkey % 2 <> 0), more as (select p_partkey as k, 3.0 as cf from part where p_partkey % 5 = 0 and p_partkey % 2 <> 0 and p_partkey % 3 <> 0), e as (select * from own union all select * from inh union all select * from more)"
    " select 'm' as method, case when k % 4 = 0 then 'free' else 'checked' end as db, 'c' || k as code, cf::double as cf from e where k % 9 <> 0 and (k % 4 = 0 or k % 7 < 3)"
)
def method_registry(spark: SparkSession, root: str) -> DataFrame:
    """Own, inherited and added factors, filtered by what the factor table knows."""
    k = F.col("p_partkey")
    p = table(spark, root, "part").withColumn("db", F.when(k % 4 == 0, "free").otherwise("checked")).withColumn("code", F.concat(F.lit("c"), k.cast("string")))
    side = lambda m, cf: p.where(k % m == 0).select(F.lit("m").alias("method"), "db", "code", F.lit(cf).alias("cf"))
    name = F.when(k % 9 == 0, F.lit("banned")).otherwise(F.concat(F.lit("n"), (k % 7).cast("string")))
    cat = p.select("db", "code", name.alias("name"), F.array(F.lit("air")).alias("categories"), F.lit(None).cast("string").alias("cas"))
    known = spark.createDataFrame([("m", f"N{i} ", "air", None) for i in range(2)] + [("m", "other name", "air", None)], "method string, name string, top string, cas string")
    synonyms = spark.createDataFrame([("n2", "air", "Other name")], "name string, top string, synonym string")
    excluded = spark.createDataFrame([("m", "Banned")], "method string, name string")
    return registry.method_registry(side(2, 1.0), side(3, 2.0), [side(5, 3.0)], cat, known, synonyms, excluded, ["checked"])


@query("select method, count(*) as n_cfs, coalesce(max(r), 0) as n_regional from (select 'm' || (s_nationkey % 4) as method from supplier) left join (select 'm' || (n_regionkey % 4) as method, count(*) as r from nation where n_regionkey < 3 group by 1) using (method) group by 1")
def registry_index(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "supplier").select(F.concat(F.lit("m"), (F.col("s_nationkey") % 4).cast("string")).alias("method"))
    n = table(spark, root, "nation").where("n_regionkey < 3").select(F.concat(F.lit("m"), (F.col("n_regionkey") % 4).cast("string")).alias("method"))
    return registry.registry_index(s, n)


@query("select source_id, name from source_records where name is not null and lower(trim(name, ' ')) not in (select lower(trim(source_name, ' ')) from mapping where source_name is not null union select lower(trim(name, ' ')) from biosphere_catalog where name is not null)")
def open_residual(spark: SparkSession, root: str) -> DataFrame:
    side = lambda t, c: table(spark, root, t).select(F.col(c).alias("name")).where("name is not null")
    return registry.open_residual(table(spark, root, "source_records").where("name is not null"), side("mapping", "source_name"), side("biosphere_catalog", "name")).select("source_id", "name")


@query("select o_orderkey from orders where o_orderkey % 5 <> 0 and o_orderstatus = 'F'")
def methods_of_version(spark: SparkSession, root: str) -> DataFrame:
    parts = F.array("o_orderpriority", "o_orderstatus", F.lit("c"), F.lit("i"))
    m = table(spark, root, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.slice(parts, 1, 3)).otherwise(parts).alias("parts"))
    return registry.of_version(m, "F").select("o_orderkey")


# exports


def _entries(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, root, "part").select(k.cast("long").alias("product_id"), F.concat(F.when(k % 6 == 0, "[Dummy] ").otherwise(""), F.col("p_name")).alias("name"), F.concat(F.lit("c"), k.cast("string")).alias("code"), F.lit("db").alias("database"), _case(k, "process", "product", "emission", "multifunctional", "processwithreferenceproduct").alias("type"), F.lit("kg").alias("unit"), k.alias("seq"))


@query("select p_partkey::bigint as product_id from part where p_partkey % 5 <> 2")
def scoreable_entries(spark: SparkSession, root: str) -> DataFrame:
    return export.scoreable(_entries(spark, root)).select("product_id")


@query("select p_partkey::bigint as product_id from part where p_partkey % 5 in (0, 3) and p_partkey % 6 <> 0 order by p_partkey limit 50")
def smoke_entries(spark: SparkSession, root: str) -> DataFrame:
    """The first 50 entries of a smoke run: the limit is the operator."""
    return export.smoke_entries(_entries(spark, root), 50).select("product_id")


@query("select o_orderkey from orders order by o_orderdate, o_orderkey limit 25")
def reference_head(spark: SparkSession, root: str) -> DataFrame:
    """The first 25 rows of a reference in its own order: the limit is the operator."""
    o = table(spark, root, "orders").withColumn("seq", F.struct("o_orderdate", "o_orderkey"))
    return export.first_rows(o, "seq", 25).select("o_orderkey")


@query("select p_partkey::bigint as product_id, case when p_partkey % 4 <> 3 then p_name end as name, case when p_partkey % 4 <> 3 then 'c' || p_partkey end as code from part")
def product_labels(spark: SparkSession, root: str) -> DataFrame:
    e = _entries(spark, root).withColumn("name", F.replace("name", F.lit("[Dummy] "), F.lit("")))
    cat = e.where("product_id % 4 <> 3")
    return export.product_labels(e.select("product_id"), cat.unionByName(cat.withColumn("database", F.lit("later")).withColumn("code", F.lit("x")))).select("product_id", "name", "code")


@query("select p_partkey::bigint as col_id, p_partkey::bigint + 1 as production_product_id, p_name as name, 'db' as database from part")
def activity_labels(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey").cast("long")
    p = table(spark, root, "part")
    blank = [F.lit("").alias(c) for c in ("unit", "location", "reference_product")]
    labels = p.select(k.alias("activity_id"), F.col("p_name").alias("name"), *blank, F.lit("db").alias("database"), k.cast("string").alias("code"))
    return export.activity_labels(p.select(k.alias("col_id"), (k + 1).alias("product_id")), labels).select("col_id", "production_product_id", "name", "database")


@query("select p_partkey::bigint as bioflow_id, p_partkey % 10 = 0 as is_correction, case when p_partkey % 10 = 0 then 'correction' else p_name end as name, case when p_partkey % 10 = 0 then '' else 'air::urban' end as categories from part")
def flow_labels(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("flow_id"), F.col("p_name").alias("name"))
    labels = p.where("flow_id % 10 <> 0").select("flow_id", "name", F.array(F.lit("air"), F.lit("urban")).alias("categories"), F.lit("kg").alias("unit"), F.lit("db").alias("database"), F.col("flow_id").cast("string").alias("code"))
    return export.flow_labels(p, labels, p.where("flow_id % 10 = 0").withColumn("name", F.lit("correction"))).select("bioflow_id", "is_correction", "name", "categories")


@query("select o_orderkey as product_id, o_custkey as activity_col_id, (select string_agg(l_linenumber || '=' || round(l_quantity), ',' order by l_linenumber, l_quantity) from lineitem where l_orderkey = o_orderkey) as expected from orders where o_orderkey in (select l_orderkey from lineitem)")
def parity_samples(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("product_id"), F.col("l_linenumber").alias("method"), F.col("l_quantity").alias("score"))
    pairs = table(spark, root, "orders").select(F.col("o_orderkey").alias("product_id"), F.col("o_custkey").alias("col_id"))
    e = export.parity_samples(s, pairs)
    text = F.array_join(F.transform("expected", lambda x: F.concat(x["method"].cast("string"), F.lit("="), F.round(x["score"]).cast("string"))), ",")
    return e.select("product_id", "activity_col_id", text.alias("expected"))


@query("select distinct p_name as name, p_brand as identifier from part where contains(p_name, 'bolt') or contains(p_brand, '#1')")
def deletion_list(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "part").select("p_name", "p_brand")
    first = a.select(F.col("p_name").alias("name"), F.lit(None).cast("string").alias("category"), F.col("p_brand").alias("identifier"))
    hit = export.deletion_list(first, "bolt").unionByName(export.deletion_list(first.withColumn("category", F.col("identifier")), "#1"))
    return hit.distinct()


@query("select distinct p_name || ', copy' as name, p_name as restored from part where p_partkey % 2 = 0")
def restored_names(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    return export.restored_names(table(spark, root, "part").select(F.concat("p_name", F.when(k % 2 == 0, ", copy").otherwise(", copy 2")).alias("name")), ", copy")


@query("with f as (select name, units[1] as unit, record_id from flow_records where target_code is null and name <> ''), g as (select name, arg_min(struct_pack(u := unit), record_id).u as unit from f group by 1), p as (select source_name as name, min(target_name) as target from mapping where target_name is not null group by 1) select g.name, g.unit, p.target from g left join p using (name)")
def residual_review(spark: SparkSession, root: str) -> DataFrame:
    f = table(spark, root, "flow_records").select(F.lit("biosphere").alias("type"), "target_code", "name", F.get("units", F.lit(0)).alias("unit"), "categories", F.col("record_id").alias("seq"))
    prior = table(spark, root, "mapping").where("target_name is not null").select(F.col("source_name").alias("name"), F.col("target_name").alias("target"))
    return export.residual_review(f, prior).select("name", "unit", "target")


@query("select o_orderpriority as k, count(*) filter (o_orderstatus = 'F') as \"F\", count(*) filter (o_orderstatus = 'O') as \"O\", count(*) as n from orders group by 1")
def status_summary(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("status"))
    return export.status_summary(o, "k", ["F", "O"])


@query("with c as (select l_orderkey, l_linenumber, l_quantity * (case when l_linenumber % 2 = 0 then -1 else 1 end) as contribution, l_quantity / 400.0 as share from lineitem), t as (select *, row_number() over (partition by l_orderkey order by share desc, 'f' || l_linenumber) as rank from c where share >= 0.01) select l_orderkey, 'f' || l_linenumber as name, rank, round(share * 100, 6) as share_pct, case when contribution < 0 then 'negative' else 'positive' end as sign from t where rank <= 6")
def evidence(spark: SparkSession, root: str) -> DataFrame:
    """The flows of each product that a report names: six at most, which is the operator."""
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    c = table(spark, root, "lineitem").select("l_orderkey", F.concat(F.lit("f"), n.cast("string")).alias("name"), (q * F.when(n % 2 == 0, -1).otherwise(1)).alias("contribution"), (q / 400.0).alias("share"))
    return export.evidence(c, ["l_orderkey"]).select("l_orderkey", "name", F.col("rank").cast("long").alias("rank"), *r6("share_pct"), "sign")


@query("with c as (select distinct code, method_slug as method from cf_flow_join where code is not null), u as (select code, min(unit) as unit from biosphere_catalog where unit is not null group by 1), j as (select code, method_slug as method, min(struct_pack(a := sp_cf, b := ef_cf)) as x from cf_flow_join where not isnan(coalesce(sp_cf, 0)) and not isnan(coalesce(ef_cf, 0)) and sp_cf is not null and ef_cf is not null group by 1, 2) select c.code, c.method, u.unit, j.x.a as sp_cf, j.x.b as ef_cf from c left join u using (code) left join j using (code, method)")
def enriched_contributions(spark: SparkSession, root: str) -> DataFrame:
    j = table(spark, root, "cf_flow_join").select("code", F.col("method_slug").alias("method"), "sp_cf", "ef_cf")
    sound = j.where("sp_cf is not null and ef_cf is not null and not isnan(sp_cf) and not isnan(ef_cf)")
    return export.enriched(j.select("code", "method").where("code is not null").distinct(), table(spark, root, "biosphere_catalog").where("unit is not null"), sound).select("code", "method", "unit", "sp_cf", "ef_cf")


@query("select count(distinct l_orderkey) as n_l_orderkey, count(distinct l_partkey) as n_l_partkey from lineitem")
def distinct_counts(spark: SparkSession, root: str) -> DataFrame:
    return export.distinct_counts(table(spark, root, "lineitem"), ["l_orderkey", "l_partkey"])


@query("select l_orderkey as activity_id, max(l_quantity) as largest from lineitem where l_returnflag <> 'R' and l_linestatus = 'F' and l_quantity > 0 group by 1")
def largest_input(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("activity_id"), F.when(F.col("l_returnflag") == "R", "biosphere").otherwise("technosphere").alias("type"), F.when(F.col("l_linestatus") == "F", " Kilogram").otherwise("kWh").alias("unit"), F.col("l_quantity").alias("amount"))
    return export.largest_input(e, "kilogram")


@query("select l_returnflag as edge_type, count(*) as n from lineitem group by 1")
def snapshot_counts(spark: SparkSession, root: str) -> DataFrame:
    return export.snapshot_counts(table(spark, root, "lineitem").select(F.col("l_returnflag").alias("edge_type")))


@query("select n_part, sum(1)::bigint as parts, max(c) - min(c) <= 8 as balanced from (select count(*) over () as n_part, c from (select p_partkey % 7 as m, count(*) as c from part group by 1)) group by 1")
def dealt_parts(spark: SparkSession, root: str) -> DataFrame:
    """Products dealt to seven workers: how many parts there are, and whether they are balanced (to one row for each range)."""
    d = export.dealt(table(spark, root, "part"), "p_partkey", 7).groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    return d.agg(F.count(F.lit(1)).alias("n_part"), F.count(F.lit(1)).alias("parts"), (F.max("c") - F.min("c") <= 8).alias("balanced"))
