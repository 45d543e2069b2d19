"""Comparison of computed scores with a reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import normal_product_code, product_code_in

#: Share of the median reference below which both sides count as zero.
NEAR_ZERO = 0.01
_GRAM = 3
#: Numbers that pieces are folded to before they are broadcast.
_FOLDS = 1 << 18


def _grams(name: Column) -> Column:
    """All pieces of up to _GRAM characters of a lower-case name."""
    n = F.length(name)

    def of(size: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: name.substr(i, F.lit(size)))

    return F.array_distinct(F.flatten(F.array(*[of(size) for size in range(1, _GRAM + 1)])))


def contained_in(references: DataFrame, entries: DataFrame) -> DataFrame:
    """ref_id, key: the entry of the shortest name (then smallest key) that contains the reference's name, letter case aside.

    references: ref_id, name. entries: key, name. Names meet on one rare piece of three letters of the
    reference, then the containment is checked; no pair is formed without a piece in common. Entries are reduced to
    their different names, and pieces that no reference has are dropped where they are made. Pieces of entries are
    never broadcast: they are many times the names, which Spark's estimate of a generator does not see.
    """
    e = entries.groupBy(F.lower("name").alias("e_name")).agg(F.min("key").alias("key")).where("e_name is not null")
    r = references.where("name is not null and name <> ''").select("ref_id", F.lower("name").alias("r_name"))
    index = e.select("key", "e_name", F.explode(_grams(F.col("e_name"))).alias("g"))
    names = r.select("r_name").distinct()
    pieces = names.select("r_name", F.explode(_grams(F.col("r_name"))).alias("g")).where(F.length("g") == F.least(F.length("r_name"), F.lit(_GRAM)))
    # a piece that no entry has settles the name: nothing contains it
    counts = _among(index, pieces).groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    rare = pieces.hint("merge").join(counts, "g", "left").groupBy("r_name").agg(F.min_by("g", F.struct(F.coalesce("df", F.lit(0)), "g")).alias("g"))
    best = rare.join(_among(index, rare).hint("merge"), "g").where(F.col("e_name").contains(F.col("r_name"))).groupBy("r_name").agg(F.min(F.struct(F.length("e_name").alias("n"), "key")).alias("b"))
    return r.join(best, "r_name").select("ref_id", F.col("b.key").alias("key"))


def _among(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of index whose piece g may be one of wanted's: no such row is lost, a few others stay."""
    fold = lambda c: F.pmod(F.xxhash64(c), F.lit(_FOLDS))
    marks = wanted.select(fold("g").alias("_f")).distinct()  # at most _FOLDS numbers
    return index.withColumn("_f", fold("g")).join(F.broadcast(marks), "_f", "left_semi").drop("_f")


def map_products(references: DataFrame, entries: DataFrame) -> DataFrame:
    """ref_id, key, how: the catalogue entry of each reference row; key is null where none is found.

    references: ref_id (unique), code_a, code_b, storage, name. entries: key, type, name. In order: the product code in
    the entry's name (first code_a, then code_b), unique, or unique among products, or among the products whose
    name has the storage label; the exact name, unique or unique among products; the shortest name that
    contains the reference's. Entries are counted for each code and name, and only different codes with their label meet
    entries, so that a code which many rows and many entries share forms no pairs of them.
    """
    e = entries.select("key", "type", "name", normal_product_code(product_code_in(F.col("name"))).alias("code"))
    product = F.col("type") == "product"
    labelled = references.select("name", F.coalesce("storage", F.lit("")).alias("label"), normal_product_code(F.col("code_a")).alias("code_a"), normal_product_code(F.col("code_b")).alias("code_b"), "ref_id")

    def counted(group: str) -> DataFrame:
        g = e.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("k"), F.count_if(product).alias("np"), F.min(F.when(product, F.col("key"))).alias("kp"))
        return g.select(group, F.when(F.col("n") == 1, F.col("k")).when(F.col("np") == 1, F.col("kp")).alias("only"))

    asked = labelled.select("label", F.explode(F.array("code_a", "code_b")).alias("code")).where("code is not null").distinct()
    codes = asked.join(counted("code").hint("merge"), "code")
    open_ = codes.where("only is null and label <> ''").drop("only")
    stored = open_.join(e.where(product).select("code", "key", "name").hint("merge"), "code").where(F.col("name").contains(F.col("label"))).groupBy("code", "label").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("k"))
    by_code = codes.join(stored, ["code", "label"], "left").select("code", "label", F.coalesce("only", F.when(F.col("n") == 1, F.col("k"))).alias("key")).where("key is not null")

    names = labelled.select("name").where("name is not null").distinct()
    exact = names.join(counted("name").hint("merge"), "name", "left")
    part = contained_in(exact.where("only is null").select(F.col("name").alias("ref_id"), "name"), entries)
    by_name = exact.join(part.select(F.col("ref_id").alias("name"), "key"), "name", "left").select("name", F.coalesce("only", "key").alias("by_name"), F.when(F.col("only").isNotNull(), "name").when(F.col("key").isNotNull(), "contained").alias("how_name"))
    found = labelled.select("ref_id", "label", "name", "code_a", "code_b")
    for side in ("a", "b"):
        found = found.join(by_code.select(F.col("code").alias(f"code_{side}"), "label", F.col("key").alias(f"by_{side}")), [f"code_{side}", "label"], "left")
    found = found.join(by_name, "name", "left").withColumn("_c", F.coalesce("by_a", "by_b"))
    return found.select("ref_id", F.coalesce("_c", "by_name").alias("key"), F.when(F.col("_c").isNotNull(), "code").otherwise(F.col("how_name")).alias("how"))


def differences(pairs: DataFrame) -> DataFrame:
    """pairs (method, computed, reference) with diff_abs, diff_pct and floored.

    Where both sides lie below NEAR_ZERO times the median magnitude of the method's references, both differences
    are 0. diff_pct is rounded half to even at four decimals and null where the reference is 0.
    """
    limit = pairs.where("abs(reference) > 0").groupBy("method").agg((F.median(F.abs("reference")) * NEAR_ZERO).alias("_limit"))
    p = pairs.join(F.broadcast(limit), "method", "left")  # one row for each method
    floored = F.coalesce((F.abs("computed") < F.col("_limit")) & (F.abs("reference") < F.col("_limit")), F.lit(False))
    gap = F.col("computed") - F.col("reference")
    pct = F.bround(F.try_divide(gap, F.col("reference")) * 100, 4)
    return p.withColumn("diff_abs", F.when(floored, 0.0).otherwise(gap)).withColumn("diff_pct", F.when(floored, 0.0).otherwise(pct)).withColumn("floored", floored).drop("_limit")


def summary(diffs: DataFrame) -> DataFrame:
    """One row for each method: how many are compared, mean, median, spread, and how many lie near or far."""
    d = diffs.withColumn("pct", F.try_divide(F.col("computed") - F.col("reference"), F.col("reference")) * 100)
    p = F.col("pct")
    return d.groupBy("method").agg(
        F.count(p).alias("n_compared"), F.avg(p).alias("mean_diff_pct"), F.median(p).alias("median_diff_pct"), F.stddev_samp(p).alias("std_diff_pct"),
        F.count_if(F.abs(p) <= 1).alias("within_1pct"), F.count_if(F.abs(p) <= 5).alias("within_5pct"), F.count_if(F.abs(p) > 5).alias("outliers_gt5pct"),
        F.max(F.abs(p)).alias("max_abs_diff_pct"), F.count_if("floored").alias("n_near_zero_floored"),
    )


def outliers(wide: DataFrame, key: list[str], methods: list[str], threshold: float = 30.0) -> DataFrame:
    """key, method, pct of the cells of a wide table that are at least the threshold away, and on which side."""
    long = wide.unpivot(key, methods, "method", "pct").where(F.abs("pct") >= threshold)
    return long.withColumn("side", F.when(F.col("pct") > 0, "above").otherwise("below"))
