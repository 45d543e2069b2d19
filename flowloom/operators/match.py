"""Linking exchanges to targets: unique keys, cascades, tiers, location chains, token candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.exprs import bucket_of, sub_compartment, sub_rank, words
from flowloom.functions.text import blank_to_null, folded
from flowloom.operators.keep import keep_first, unique_lookup

#: Priority tiers, lower first; which only fill gaps, which depend on the reviewed-suggestion switch.
TIERS = {
    "curated_targeted": 1, "package_specific": 2, "package_general": 3, "flow_mapper": 4, "harmonised": 5, "water_volume": 6, "native_sheet": 7,
    "native_generic": 8, "catalogue_match": 9, "case_insensitive": 10, "reviewed_suggestion": 11, "synonym_fallback": 12, "unmatchable": 13,
}
FILL_ONLY = (5, 8, 9, 10, 11, 12)
SWITCHED = (11, 12)


def unique_match(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column]], value: list[str]) -> DataFrame:
    """left with the value columns of the one row of right whose keys are equal; null where none or several fit."""
    names = [f"_k{i}" for i in range(len(keys))]
    r = unique_lookup(right.select(*[k[1].alias(n) for k, n in zip(keys, names, strict=True)], *value).where(" and ".join(f"{n} is not null" for n in names)), names, value)
    l = left.select("*", *[k[0].alias(n) for k, n in zip(keys, names, strict=True)])  # noqa: E741
    return l.join(r, names, "left").drop(*names)


def cascade(left: DataFrame, right: DataFrame, passes: list[list[tuple[Column, Column]]], value: list[str]) -> DataFrame:
    """Passes in order, each with the rows that are still without a match; `match_pass` is the pass from 1, null if none."""
    out = left
    for i, keys in enumerate(passes):
        hit = unique_match(left if i == 0 else out, right, keys, [*value]) if i == 0 else unique_match(out, right.withColumnsRenamed({v: f"_n_{v}" for v in value}), keys, [f"_n_{v}" for v in value])
        if i == 0:
            out = hit.withColumn("match_pass", F.when(F.col(value[0]).isNotNull(), 1))
            continue
        found = F.col("match_pass").isNull() & F.col(f"_n_{value[0]}").isNotNull()
        out = hit.select(*[c for c in left.columns], *[F.when(found, F.col(f"_n_{v}")).otherwise(F.col(v)).alias(v) for v in value], F.when(found, i + 1).otherwise(F.col("match_pass")).alias("match_pass"))
    return out


def multiplier(df: DataFrame, source: str, target: str, conversions: DataFrame, into: str = "multiplier", row_factor: str | None = None) -> DataFrame:
    """`into`: 1 for equal units or no target unit, else the first conversion of the pair, else a row factor other than 1, else null.

    conversions: source_unit, target_unit, multiplier, seq (the smallest seq counts). Units are compared trimmed.
    """
    first = keep_first(conversions.where("multiplier is not null").select(F.trim("source_unit").alias("_su"), F.trim("target_unit").alias("_tu"), F.col("multiplier").alias("_m"), "seq"), ["_su", "_tu"], ["seq"]).drop("seq")
    out = df.withColumn("_su", F.trim(source)).withColumn("_tu", F.trim(target)).join(first, ["_su", "_tu"], "left")
    same = F.coalesce(F.col("_tu"), F.lit("")).isin("") | (F.col("_su") == F.col("_tu"))
    rest = F.when(F.col(row_factor) != 1, F.col(row_factor)) if row_factor else F.lit(None).cast("double")
    return out.withColumn(into, F.when(same, 1.0).otherwise(F.coalesce("_m", rest))).drop("_su", "_tu", "_m")


def resolved_targets(registry: DataFrame, catalog: DataFrame, preferred: list[str]) -> DataFrame:
    """registry (rid, target_db, target_code, target_name) for each bucket: t_db, t_code, t_unit, t_categories.

    In order: the row's own database and code; the code in a preferred database, in the same or no compartment;
    the name in the same compartment; the name in no compartment. Of several hits the database that comes first
    in the preference, then the smallest code. Rows that resolve to nothing are left out.
    """
    cat = catalog.select(folded("db").alias("c_db"), folded("code").alias("c_code"), F.lower(F.trim("name")).alias("c_name"), bucket_of(F.col("categories")).alias("c_bucket"), F.col("unit").alias("t_unit"), F.col("categories").alias("t_categories"))
    r = registry.select("rid", folded("target_db").alias("r_db"), folded("target_code").alias("r_code"), F.lower(blank_to_null("target_name")).alias("r_name"), blank_to_null("target_unit").alias("r_unit"))
    buckets = F.array(*[F.lit(b) for b in ("air", "water", "soil", "resource", "unspecified")])
    prefs = [p.lower() for p in preferred]
    rank = F.when(F.col("c_db") == F.col("r_db"), 0)
    for i, p in enumerate(prefs):
        rank = rank.when(F.col("c_db") == p, i + 1)
    direct = r.where("r_db is not null and r_code is not null").join(cat, (F.col("r_db") == F.col("c_db")) & (F.col("r_code") == F.col("c_code")), "left")
    direct = direct.withColumn("bucket", F.explode(buckets)).select("rid", "bucket", F.lit(0).alias("branch"), F.lit(0).alias("rank"), F.col("r_db").alias("t_db"), F.col("r_code").alias("t_code"), F.coalesce("t_unit", "r_unit").alias("t_unit"), "t_categories")
    rest = r.where("not (r_db is not null and r_code is not null)").withColumn("bucket", F.explode(buckets))
    by_code = rest.join(cat, F.col("r_code") == F.col("c_code")).withColumn("rank", rank).where("rank is not null and (c_bucket = bucket or c_bucket = 'unspecified')")
    by_name = rest.join(cat, F.col("r_name") == F.col("c_name")).withColumn("rank", rank).where("rank is not null and (c_bucket = bucket or c_bucket = 'unspecified')")
    cols = ["rank", F.col("c_db").alias("t_db"), F.col("c_code").alias("t_code"), "t_unit", "t_categories"]
    hits = by_code.select("rid", "bucket", F.lit(1).alias("branch"), *cols).unionByName(by_name.select("rid", "bucket", F.when(F.col("c_bucket") == F.col("bucket"), 2).otherwise(3).alias("branch"), *cols))
    best = hits.groupBy("rid", "bucket").agg(F.min_by(F.struct("branch", "rank", "t_db", "t_code", "t_unit", "t_categories"), F.struct("branch", "rank", "t_code")).alias("b")).select("rid", "bucket", "b.*")
    return direct.unionByName(best)


def _signed(exchanges: DataFrame) -> DataFrame:
    """exc_id, what a match depends on, and 128 bits of it (h1, h2)."""
    parts = {
        "s_name": F.lower(F.trim("name")), "s_bucket": bucket_of(F.col("categories")), "s_sub": F.lower(F.trim(sub_compartment(F.col("categories")))), "s_unit": F.trim("unit"),
        "s_cas": F.coalesce(F.trim("cas"), F.lit("")), "s_linked": F.coalesce("linked", F.lit(False)),
    }
    text = F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0003")) for c in parts.values()])
    return exchanges.select("exc_id", *[c.alias(n) for n, c in parts.items()], F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("\u0002"), text).alias("h2"))


def _offers(registry: DataFrame, catalog: DataFrame, preferred: list[str]) -> DataFrame:
    """Registry rows by name and compartment of the exchange, with their targets there: what an exchange may be offered.

    only_cas: the row is of another compartment while the name has rows of this one (or of none), so that it
    counts for exchanges with its registry number only.
    """
    reg = registry.select(
        F.lower(F.trim("source_name")).alias("r_name"), F.coalesce(blank_to_null("source_top_bucket"), F.lit("unspecified")).alias("r_bucket"), F.coalesce(F.trim("source_cas"), F.lit("")).alias("r_cas"),
        "target_db", "target_code", "target_name", "target_unit", F.coalesce(F.when(F.col("unit_conversion") != 0, F.col("unit_conversion")), F.lit(1.0)).alias("r_factor"),
        F.col("priority_tier").alias("tier"), "provenance", F.coalesce("is_unmatchable", F.lit(False)).alias("halt"),
    ).where("r_name is not null").distinct()
    reg = reg.withColumn("rid", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in reg.columns]))
    targets = resolved_targets(reg, catalog, preferred).select("rid", "bucket", "t_db", "t_code", "t_unit", "t_categories")
    named = reg.groupBy("r_name").agg(F.collect_set("r_bucket").alias("_buckets"))  # at most a handful of compartments
    buckets = F.array(*[F.lit(b) for b in ("air", "water", "soil", "resource", "unspecified")])
    o = reg.join(named, "r_name").withColumn("bucket", F.explode(buckets))
    own = (F.col("r_bucket") == F.col("bucket")) | (F.col("r_bucket") == "unspecified")
    some = F.array_contains("_buckets", F.col("bucket")) | F.array_contains("_buckets", "unspecified")
    o = o.withColumn("only_cas", ~own & (some | (F.col("bucket") == "unspecified"))).where(~F.col("only_cas") | (F.col("r_cas") != ""))
    o = o.join(targets, ["rid", "bucket"], "left")
    return o.select("r_name", "bucket", "r_cas", "only_cas", "r_factor", "tier", "provenance", "halt", F.coalesce("target_name", F.lit("")).alias("o_name"), "t_db", "t_code", "t_unit", "t_categories")


def tiered_candidates(exchanges: DataFrame, registry: DataFrame, catalog: DataFrame, conversions: DataFrame, preferred: list[str], reviewed: bool = True) -> DataFrame:
    """Signature (h1, h2), order (tier, provenance, sub, o_code, o_name), t_db, multiplier and outcome of each candidate.

    outcome: 'halt_unmatchable', 'switched_off', 'already_linked', 'target_unresolved', 'unit_mismatch' or 'valid'.
    Exchanges are reduced to signatures and the registry to distinct rows before they meet, so that a name which
    a third of all exchanges share is matched once for each way of writing it. Targets are resolved on the side
    of the registry, once for each compartment.
    """
    s = _signed(exchanges).drop("exc_id").where("s_name is not null").distinct()
    c = s.join(_offers(registry, catalog, preferred), (F.col("s_name") == F.col("r_name")) & (F.col("s_bucket") == F.col("bucket")))
    c = c.where(~F.col("only_cas") | ((F.col("s_cas") != "") & (F.col("s_cas") == F.col("r_cas"))))
    c = c.select("h1", "h2", "s_unit", "s_linked", "r_factor", "tier", "provenance", sub_rank(F.col("s_sub"), F.col("t_categories")).alias("sub"), "halt", "o_name", "t_db", "t_code", "t_unit")
    c = multiplier(c, "s_unit", "t_unit", conversions, row_factor="r_factor")
    off = F.lit(False) if reviewed else F.col("tier").isin(*SWITCHED)
    outcome = (
        F.when(F.col("halt"), "halt_unmatchable").when(off, "switched_off").when(F.col("tier").isin(*FILL_ONLY) & F.col("s_linked"), "already_linked")
        .when(F.col("t_code").isNull(), "target_unresolved").when(F.col("multiplier").isNull(), "unit_mismatch").otherwise("valid")
    )
    return c.select("h1", "h2", "tier", "provenance", "sub", F.coalesce("t_code", F.lit("")).alias("o_code"), "o_name", F.coalesce("t_db", F.lit("")).alias("t_db"), "multiplier", outcome.alias("outcome"))


_ORDER = ["tier", "provenance", "sub", "o_code", "o_name"]


def _picked(candidates: DataFrame) -> DataFrame:
    """For each signature its best candidate (null if an unmatchable one comes first) and counts of the outcomes."""
    valid, halt = F.col("outcome") == "valid", F.col("outcome") == "halt_unmatchable"
    g = candidates.groupBy("h1", "h2").agg(
        F.min(F.when(valid, F.struct(*_ORDER, "t_db", "multiplier"))).alias("best"), F.min(F.when(halt, F.struct(*_ORDER))).alias("stop"), F.count(F.lit(1)).alias("n"),
        F.count_if(halt).alias("n_halt"), F.count_if(F.col("outcome") == "unit_mismatch").alias("n_unit"), F.count_if(F.col("outcome") == "target_unresolved").alias("n_open"),
    )
    before = F.struct(*[F.col(f"best.{n}") for n in _ORDER])
    return g.withColumn("best", F.when(F.col("stop").isNull() | (before < F.col("stop")), F.col("best")))


def tiered_match(exchanges: DataFrame, registry: DataFrame, catalog: DataFrame, conversions: DataFrame, preferred: list[str], reviewed: bool = True) -> DataFrame:
    """exc_id, tier, provenance, t_db, t_code, multiplier of each exchange that the registry links.

    exchanges: exc_id, name, categories, unit, cas, linked. registry: the mapping columns. Candidates have the
    exchange's name and compartment (or none), or name and registry number; only if there is no candidate of its
    own compartment or of none, those of other compartments count. In the order of tier, provenance,
    sub-compartment, code and name the first valid one wins, unless an unmatchable row comes before it. A
    candidate is valid if its target is known and its unit converts, if it isn't switched off, and if a tier
    that only fills gaps meets an exchange that isn't linked.
    """
    p = _picked(tiered_candidates(exchanges, registry, catalog, conversions, preferred, reviewed)).where("best is not null")
    out = _signed(exchanges).select("exc_id", "h1", "h2").join(p.select("h1", "h2", "best.*"), ["h1", "h2"])
    return out.select("exc_id", "tier", "provenance", "t_db", F.col("o_code").alias("t_code"), "multiplier")


def match_status(exchanges: DataFrame, registry: DataFrame, catalog: DataFrame, conversions: DataFrame, preferred: list[str], reviewed: bool = True) -> DataFrame:
    """exc_id, status: matched, recognised_unmatchable, no_registry, unit_mismatch_only, target_unresolved_only or mixed."""
    p = _picked(tiered_candidates(exchanges, registry, catalog, conversions, preferred, reviewed))
    status = (
        F.when(F.col("best").isNotNull(), "matched").when(F.col("n_halt") > 0, "recognised_unmatchable").when(F.col("n").isNull(), "no_registry")
        .when((F.col("n_unit") > 0) & (F.col("n_open") == 0), "unit_mismatch_only").when((F.col("n_open") > 0) & (F.col("n_unit") == 0), "target_unresolved_only").otherwise("mixed")
    )
    return _signed(exchanges).select("exc_id", "h1", "h2").join(p, ["h1", "h2"], "left").select("exc_id", status.alias("status"))


def match_audit(exchanges: DataFrame, matched: DataFrame) -> DataFrame:
    """exc_id, kind, prior and new target of each match: 'new_link', or 'override' where another target was linked before.

    exchanges: exc_id, prior_db, prior_code; matched: tiered_match.
    """
    m = matched.join(exchanges.select("exc_id", folded("prior_db").alias("prior_db"), folded("prior_code").alias("prior_code")), "exc_id")
    changed = ~(F.col("prior_code").eqNullSafe(F.col("t_code")) & F.coalesce(F.col("prior_db") == F.col("t_db"), F.lit(True)))
    kind = F.when(F.col("prior_code").isNull(), "new_link").when(changed, "override")
    return m.select("exc_id", kind.alias("kind"), "prior_db", "prior_code", F.col("t_db").alias("new_db"), F.col("t_code").alias("new_code"), "tier").where("kind is not null")


def first_in_chain(left: DataFrame, right: DataFrame, key: list[str], chain: str, place: str, value: list[str]) -> DataFrame:
    """left with the value of the unique row of right at the first location of left's chain that has one; `chain_rank` from 0."""
    at = left.select(*key, chain).distinct().select("*", F.posexplode(chain).alias("chain_rank", "_at"))
    one = unique_lookup(right.withColumn("_at", F.col(place)), [*key, "_at"], value)
    hits = at.join(one, [*key, "_at"]).groupBy(*key, chain).agg(F.min(F.struct("chain_rank", *value)).alias("h")).select(*key, chain, "h.*")
    return left.join(hits, [*key, chain], "left")


def first_reason(left: DataFrame, key: list[str], known: DataFrame, reason: str, order: str) -> DataFrame:
    """left with the first reason that is known for its key, null if none is."""
    return left.join(keep_first(known.select(*key, reason, order), key, [order]).drop(order), key, "left")


def token_candidates(queries: DataFrame, pool: DataFrame, n: int) -> DataFrame:
    """q_id, db, code, overlap, rank: the n entries of the same compartment that share most words with a query.

    queries: q_id, name, bucket. pool: db, code, name, bucket. Ties: shorter name, database, code. The most
    frequent word of a query brings in only its first n entries: what shares that word alone comes last in the
    order, and what shares others too is found by those. Queries that read alike are ranked once.
    """
    q = queries.select("q_id", "bucket", F.array_sort(words(F.col("name"))).alias("q_words"))
    distinct = q.select("bucket", "q_words").distinct()
    p = pool.select("db", "code", F.length("name").alias("len"), "bucket", words(F.col("name")).alias("p_words")).distinct()
    index = p.select("bucket", "db", "code", "len", "p_words", F.explode("p_words").alias("w"))
    counts = index.groupBy("bucket", "w").agg(F.count(F.lit(1)).alias("df"))
    asked = distinct.select("bucket", "q_words", F.explode("q_words").alias("w")).join(counts, ["bucket", "w"])
    asked = asked.withColumn("_top", F.row_number().over(Window.partitionBy("bucket", "q_words").orderBy(F.desc("df"), "w")) == 1)
    short = index.withColumn("_r", F.row_number().over(Window.partitionBy("bucket", "w").orderBy("len", "db", "code"))).where(F.col("_r") <= n).drop("_r")
    met = asked.where("not _top").join(index, ["bucket", "w"]).unionByName(asked.where("_top").join(short, ["bucket", "w"])).select("bucket", "q_words", "db", "code", "len", "p_words").distinct()
    met = met.withColumn("overlap", F.size(F.array_intersect("q_words", "p_words")))
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "q_words").orderBy(F.desc("overlap"), "len", "db", "code"))).where(F.col("rank") <= n)
    return q.join(ranked, ["bucket", "q_words"]).select("q_id", "db", "code", "overlap", "rank")
