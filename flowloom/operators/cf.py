"""Characterisation factors: collapse, compare, audit, filter and join flow by flow."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import joined_parts, method_root, normal_cas, short_name
from flowloom.functions.text import number
from flowloom.operators.keep import keep_first

#: Relative and absolute gap up to which two factors agree, and the gap of the outer comparison.
AGREE_REL, AGREE_ABS, MATCH_GAP = 1e-3, 1e-9, 0.01
UNSPECIFIED = "(unspecified)"
#: Compartment names of the factor table by the catalogue's top compartment.
TABLE_COMPARTMENTS = {"air": "Air", "water": "Water", "soil": "Soil", "natural resource": "Raw"}


def global_factors(table: DataFrame) -> DataFrame:
    """method, flow, cf, name: the first row without location if there is one, else the mean over locations.

    table: method, flow, location, cf, name, seq.
    """
    flat = F.col("location").isNull() | (F.col("location") == "")
    g = table.groupBy("method", "flow").agg(F.min_by(F.struct("cf"), F.when(flat, F.col("seq"))).alias("g"), F.avg(F.when(~flat, F.col("cf"))).alias("m"), F.min_by("name", "seq").alias("name"))
    return g.select("method", "flow", F.coalesce("g.cf", "m").alias("cf"), "name")


def location_means(table: DataFrame, key: list[str]) -> DataFrame:
    """Mean magnitude by key and location, where it is above 0."""
    return table.where("location is not null").groupBy(*key, "location").agg(F.avg(F.abs("cf")).alias("cf")).where("cf > 0")


#: Fixed value: difference of a regional factor from the global one that makes a row of its own.
REGIONAL_GAP = 0.01


def regional_rows(cfs: DataFrame, means: DataFrame, key: list[str], least: float = REGIONAL_GAP) -> DataFrame:
    """Rows of cfs for each location whose mean differs from the global factor by `least` or more."""
    j = cfs.join(means.withColumnRenamed("cf", "local_cf"), key)
    return j.where(F.abs(F.col("local_cf") - F.abs("cf")) >= least)


#: Locations in one block; a longer list is taken block by block.
BLOCK_LOCATIONS = 5000


def every_location(cfs: DataFrame, by_location: DataFrame) -> DataFrame:
    """code, location, cf with the sign of the global factor, for each location whose factor differs.

    by_location: location, cf. Each factor is expanded by a block of the list where it stands; nothing is joined or
    shuffled, and a list of any length is taken in blocks of BLOCK_LOCATIONS.
    """
    out, block = None, []

    def spread(block: list[dict]) -> DataFrame:
        each = cfs.withColumn("_p", F.explode(F.from_json(F.lit(json.dumps(block)), "array<struct<location:string,local_cf:double>>")))
        value = F.signum("cf") * F.col("_p.local_cf")
        return each.where(F.abs(value - F.col("cf")) > 1e-12).select("code", F.col("_p.location").alias("location"), value.alias("cf"))

    for r in by_location.where("location is not null and cf is not null").select("location", "cf").toLocalIterator():
        block.append({"location": r.location, "local_cf": r.cf})
        if len(block) == BLOCK_LOCATIONS:
            out, block = spread(block) if out is None else out.unionByName(spread(block)), []
    if block or out is None:
        out = spread(block) if out is None else out.unionByName(spread(block))
    return out


def subcompartment_drift(table: DataFrame, least_ratio: float = 2.0) -> DataFrame:
    """method, name, min_cf, max_cf, n_subcomps, ratio of flows whose factor depends on the sub-compartment.

    table: method, name, sub, cf, seq; the first row of each sub-compartment counts. ratio is null where the
    smallest factor isn't positive (no ratio exists) but the largest isn't 0.
    """
    first = table.where("name is not null and sub is not null and cf is not null").groupBy("method", "name", "sub").agg(F.min_by("cf", "seq").alias("cf"))
    g = first.groupBy("method", "name").agg(F.min("cf").alias("min_cf"), F.max("cf").alias("max_cf"), F.count(F.lit(1)).alias("n_subcomps"))
    g = g.withColumn("ratio", F.when(F.col("min_cf") > 0, F.try_divide("max_cf", "min_cf")))
    return g.where(F.col("max_cf") != F.col("min_cf")).where(F.when(F.col("min_cf") > 0, F.col("ratio") >= least_ratio).otherwise(F.col("max_cf") != 0))


def missing_on_other_side(ours: DataFrame, other: DataFrame) -> DataFrame:
    """method, name, max_abs_cf of the pairs that `other` lacks. Both: method, name, cf; sub-methods fold into their root."""
    name = F.lower(F.trim("name"))
    a = ours.groupBy(method_root(F.col("method")).alias("method"), name.alias("name")).agg(F.max(F.abs("cf")).alias("max_abs_cf"))
    return a.join(other.select(method_root(F.col("method")).alias("method"), name.alias("name")).distinct(), ["method", "name"], "left_anti")


def filter_cascade(cfs: DataFrame, table: DataFrame, synonyms: DataFrame, excluded: DataFrame, checked_dbs: list[str], exempt: list[str] = ()) -> DataFrame:
    """Factors that the table knows: by name, else by a synonym, else by registry number, each with the top compartment.

    cfs: method, db, code, name, top, cas. table: method, name, top, cas. synonyms: name, top, synonym. excluded:
    method, name. Rows of other databases and of unknown or exempt methods pass; excluded names never do.
    """
    n = lambda c: F.lower(F.trim(c))
    t = table.select(F.col("method").alias("t_m"), n("name").alias("t_n"), n("top").alias("t_t"), normal_cas(F.col("cas")).alias("t_c"))
    c = cfs.withColumn("_n", n("name")).withColumn("_t", n("top")).withColumn("_c", normal_cas(F.col("cas")))
    known = t.select("t_m").distinct().withColumn("_known", F.lit(True))
    by_name = t.select("t_m", F.col("t_n").alias("_n"), F.col("t_t").alias("_t")).distinct().withColumn("_by_name", F.lit(True))
    syn = synonyms.select(n("name").alias("_n"), n("top").alias("_t"), n("synonym").alias("t_n"))
    by_syn = syn.join(t.select("t_m", "t_n", F.col("t_t").alias("_t")), ["t_n", "_t"]).select("t_m", "_n", "_t").distinct().withColumn("_by_syn", F.lit(True))
    by_cas = t.where("t_c is not null and t_c <> ''").select("t_m", F.col("t_c").alias("_c"), F.col("t_t").alias("_t")).distinct().withColumn("_by_cas", F.lit(True))
    c = c.withColumn("t_m", F.col("method"))
    out = c.join(excluded.select(F.col("method").alias("t_m"), n("name").alias("_n")).distinct(), ["t_m", "_n"], "left_anti")
    out = out.join(known, "t_m", "left").join(by_name, ["t_m", "_n", "_t"], "left").join(by_syn, ["t_m", "_n", "_t"], "left").join(by_cas, ["t_m", "_c", "_t"], "left")
    passes = ~F.col("db").isin(checked_dbs) | F.col("_known").isNull() | F.col("method").isin(list(exempt))
    return out.where(passes | F.coalesce("_by_name", "_by_syn", "_by_cas", F.lit(False))).select(*cfs.columns)


def table_context(categories: Column, long_forms: dict[tuple[str, ...], tuple[str, str]] | None = None) -> Column:
    """struct(comp, sub) of the factor table for catalogue categories. long_forms maps whole lists first."""
    top = F.lower(F.get(categories, F.lit(0)))
    comp = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in TABLE_COMPARTMENTS.items() for v in kv]), top), F.initcap(F.get(categories, F.lit(0))), F.lit(""))
    sub = F.coalesce(F.get(categories, F.lit(1)), F.lit(UNSPECIFIED))
    for path, (c, s) in (long_forms or {}).items():
        hit = F.coalesce(categories == F.array(*[F.lit(p) for p in path]), F.lit(False))
        comp, sub = F.when(hit, c).otherwise(comp), F.when(hit, s).otherwise(sub)
    return F.struct(comp.alias("comp"), sub.alias("sub"))


def _hashed(*columns: Column) -> list[Column]:
    """128 bits of a lookup key: what is shuffled instead of its texts."""
    text = F.concat_ws("\u0001", *[F.coalesce(c, F.lit("\u0003")) for c in columns])
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("\u0002"), text).alias("k2")]


def _index(table: DataFrame) -> DataFrame:
    """k1, k2 of (method, kind, key, comp, sub) -> the record that counts.

    table: method, name, compartment, sub_compartment, cas, cf, seq (anything with an order). By name and short
    name the last record counts, by registry number the shortest name (then the first), any sub-compartment
    giving way to the unspecified one.
    """
    t = table.select("method", F.lower(F.trim("name")).alias("name"), F.col("name").alias("raw"), F.trim("compartment").alias("comp"), F.coalesce(F.trim("sub_compartment"), F.lit("")).alias("sub"), F.trim("cas").alias("cas"), "cf", "seq", short_name(F.col("name")).alias("short"))
    rec = F.struct("cf", F.col("raw").alias("name"), "comp", F.col("sub").alias("rsub")).alias("rec")
    m, size = F.col("method"), F.length("raw")
    by_name = t.select(*_hashed(m, F.lit("name"), F.col("name"), F.col("comp"), F.col("sub")), rec, "seq").groupBy("k1", "k2").agg(F.max_by("rec", "seq").alias("rec"))
    by_short = t.where("short <> ''").select(*_hashed(m, F.lit("short"), F.col("short"), F.col("comp"), F.col("sub")), rec, "seq").groupBy("k1", "k2").agg(F.max_by("rec", "seq").alias("rec"))
    has = t.where("cas is not null and cas <> ''")
    one, any_ = _hashed(m, F.lit("cas"), F.col("cas"), F.col("comp"), F.col("sub")), _hashed(m, F.lit("cas_any"), F.col("cas"), F.col("comp"), F.lit(""))
    order = lambda first: F.struct(first.alias("a"), size.alias("b"), F.col("seq").alias("c")).alias("o")
    both = has.select(*one, rec, order(F.lit(0))).unionByName(has.select(*any_, rec, order((F.col("sub") != UNSPECIFIED).cast("int"))))
    by_cas = both.groupBy("k1", "k2").agg(F.min_by("rec", "o").alias("rec"))
    return by_name.unionByName(by_short).unionByName(by_cas)


#: Places in the order of lookups, and the compartment that is tried last.
_CAS, _SHORT_NAME, _BRIDGED = 100_000, 100_002, 1_000_000


def flow_join(flows: DataFrame, table: DataFrame, bridged: dict[str, str] | None = None) -> DataFrame:
    """flows with sp_cf, sp_match_provenance, sp_name, sp_compartment, sp_sub_compartment.

    flows: flow_key, method, name, comp, sub, synonyms, cas. Tried in order, each with the flow's own
    sub-compartment and then the unspecified one: name, synonyms, registry number, short name. All keys that a
    flow may be found by are looked up in one join of hashes, and the first in this order wins. bridged: methods
    whose flows are looked up in another compartment last.
    """
    flow_id_ = F.to_json(F.struct("flow_key"))
    f = flows.withColumn("_f1", F.xxhash64(flow_id_)).withColumn("_f2", F.xxhash64(F.lit("\u0002"), flow_id_))
    name = F.lower(F.trim("name"))
    syns = F.filter(F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda s: F.lower(F.trim(s))), lambda s: (s != "") & (s != F.lower(F.trim("name"))))
    un, sub, cas, short = F.lit(UNSPECIFIED), F.col("sub"), F.trim("cas"), short_name(F.col("name"))

    def key(p: Column | int, kind: str, k: Column, s: Column) -> Column:
        return F.struct((F.lit(p) if isinstance(p, int) else p).cast("int").alias("p"), F.lit(kind).alias("kind"), k.alias("key"), s.alias("sub"))

    fixed = F.array(key(0, "name", name, sub), key(1, "name", name, un), key(_CAS, "cas", cas, sub), key(_CAS + 1, "cas_any", cas, F.lit("")), key(_SHORT_NAME, "short", short, sub), key(_SHORT_NAME + 1, "short", short, un))
    by_syn = F.flatten(F.transform(syns, lambda s, i: F.array(key(2 + 2 * i, "name", s, sub), key(3 + 2 * i, "name", s, un))))
    asked = f.select("_f1", "_f2", "method", "comp", F.explode(F.concat(fixed, by_syn)).alias("k")).select("_f1", "_f2", "method", "comp", "k.*").where("key is not null and key <> ''")
    if bridged:
        other = F.element_at(F.create_map(*[F.lit(v) for kv in bridged.items() for v in kv]), F.col("method"))
        asked = asked.unionByName(asked.where(other.isNotNull() & (other != F.col("comp"))).withColumn("comp", other).withColumn("p", F.col("p") + _BRIDGED))
    asked = asked.select("_f1", "_f2", "p", *_hashed(F.col("method"), F.col("kind"), F.col("key"), F.col("comp"), F.col("sub")))
    hits = asked.join(_index(table), ["k1", "k2"])
    best = hits.groupBy("_f1", "_f2").agg(F.min_by(F.struct("rec", "p"), "p").alias("b"))
    place = F.col("b.p") % _BRIDGED
    how = F.when(place < 2, "exact_name").when(place < _CAS, "synonym").when(place < _SHORT_NAME, "cas").otherwise("short_name")
    best = best.select("_f1", "_f2", F.col("b.rec.cf").alias("sp_cf"), how.alias("sp_match_provenance"), F.col("b.rec.name").alias("sp_name"), F.col("b.rec.comp").alias("sp_compartment"), F.col("b.rec.rsub").alias("sp_sub_compartment"))
    return f.join(best, ["_f1", "_f2"], "left").drop("_f1", "_f2").withColumn("sp_match_provenance", F.coalesce("sp_match_provenance", F.lit("unmatched")))


def comparison(joined: DataFrame) -> DataFrame:
    """joined (sp_cf, ef_cf and labels) with ratio, rel_diff, abs_diff, status and the two compartments as text.

    With a reference other than 0 the relative gap decides, else the absolute one; rows without a match are
    'registry_only'.
    """
    sp, ef = number("sp_cf"), number("ef_cf")
    gap = F.abs(sp - ef)
    rel = F.try_divide(gap, F.abs(ef))
    agree = F.when(ef != 0, rel < AGREE_REL).otherwise(gap < AGREE_ABS)
    return joined.select(
        "*", F.try_divide(sp, ef).alias("ratio"), rel.alias("rel_diff"), gap.alias("abs_diff"),
        F.when(sp.isNull(), "registry_only").when(agree, "agree").otherwise("differ").alias("status"),
        joined_parts(F.col("categories")).alias("compartment_registry"),
        F.when(sp.isNotNull(), joined_parts(F.filter(F.array("sp_compartment", "sp_sub_compartment"), lambda c: c.isNotNull()))).otherwise(F.lit("")).alias("compartment_table"),
    )


def outer_comparison(ours: DataFrame, theirs: DataFrame, key: list[str]) -> DataFrame:
    """Counts and means of both sides by key (nulls are a key), joined in full, with a status within 1 %."""
    a = ours.groupBy(*key).agg(F.count("cf").alias("n_ours"), F.avg("cf").alias("ours"))
    b = theirs.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.count("cf").alias("n_theirs"), F.avg("cf").alias("theirs"))
    on = None
    for k in key:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = c if on is None else on & c
    j = a.join(b, on, "full_outer")
    x, y = F.col("ours"), F.col("theirs")
    near = F.when(y != 0, F.abs(x - y) <= MATCH_GAP * F.abs(y)).otherwise(x == 0)
    status = F.when(x.isNull() & y.isNull(), "empty").when(y.isNull(), "only_ours").when(x.isNull(), "only_theirs").when(near, "match").otherwise("differ")
    return j.select(*[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in key], "n_ours", "ours", "n_theirs", "theirs", status.alias("status"))


def stats(table: DataFrame, key: list[str], value: str = "cf") -> DataFrame:
    """count, min, max, mean, median, std, sum by key; null and NaN don't count. The median is exact."""
    v = number(value)
    return table.groupBy(*key).agg(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_samp(v).alias("std"), F.sum(v).alias("sum"))


def paired_stats(joined: DataFrame, key: list[str]) -> DataFrame:
    """Means and medians of both sides over the rows that match, and the count of all rows of the registry."""
    sp, ef = number("sp_cf"), number("ef_cf")
    both = sp.isNotNull() & ef.isNotNull()
    return joined.groupBy(*key).agg(
        F.count_if(both).alias("n_matched"), F.count(ef).alias("n_registry"), F.avg(F.when(both, sp)).alias("mean_table"), F.avg(F.when(both, ef)).alias("mean_registry"),
        F.median(F.when(both, sp)).alias("median_table"), F.median(F.when(both, ef)).alias("median_registry"),
    )


def first_by_code(joined: DataFrame, order: list[str]) -> DataFrame:
    return keep_first(joined, ["method_slug", "code"], order)
