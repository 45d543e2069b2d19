"""Labels and catalogues: names for ids, targets for written names, stand-ins, review tables, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.exprs import name_parts, words
from flowloom.operators.keep import keep_first
from flowloom.session import checkpointed

#: Locations that are tried after a name's own, and after an orphan's own.
FORM_CHAIN = ("GLO", "RoW", "RER")
ORPHAN_CHAIN = ("RER", "Europe without Switzerland", "EU", "GLO", "RoW")


def column_catalog(columns: DataFrame, foreground: DataFrame, background: DataFrame, provenance: DataFrame) -> DataFrame:
    """activity_id, database, code, name, type, unit, location, reference_product, product_id of every column.

    In order: the foreground's label, the background's, that of the activity which the column was split from (with
    the product of the split), and 'unresolved' with the id as code. foreground and background: activity_id and
    the labels; provenance: synthetic_id, activity_id, product_id. Each column once.
    """
    labels = ["database", "code", "name", "type", "unit", "location", "reference_product", "product_id"]
    known = foreground.select("activity_id", *labels, F.lit(0).alias("o")).unionByName(background.select("activity_id", *labels, F.lit(1).alias("o")))
    known = keep_first(known, ["activity_id"], ["o"]).drop("o").withColumn("_hit", F.lit(True))
    split = provenance.select(F.col("synthetic_id").alias("_s"), F.col("activity_id").alias("_a"), F.col("product_id").alias("_p"))
    of = known.select(F.col("activity_id").alias("_a"), *[F.col(c).alias(f"_{c}") for c in labels])
    parents = split.join(of, "_a").select("_s", F.col("_p").alias("_split_product"), *[f"_{c}" for c in labels]).withColumn("_from", F.lit(True))
    out = columns.select("activity_id").distinct().join(known, "activity_id", "left").join(parents, F.col("activity_id") == F.col("_s"), "left")
    open_ = {"database": F.lit(""), "code": F.col("activity_id").cast("string"), "name": F.concat(F.lit("activity "), F.col("activity_id").cast("string")), "type": F.lit("unresolved"), "unit": F.lit(""), "location": F.lit(""), "reference_product": F.lit(""), "product_id": F.col("activity_id")}
    own = F.coalesce("_hit", F.lit(False))
    pick = lambda c: F.when(own, F.col(c)).when(F.col("_from"), F.col("_split_product") if c == "product_id" else F.col(f"_{c}")).otherwise(open_[c]).alias(c)
    return out.select("activity_id", *[pick(c) for c in labels])


def labels_of(ids: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """id, label, source of each id: the first source that knows it, null if none does. sources: id, label."""
    every = None
    for i, s in enumerate(sources):
        one = s.select("id", "label", F.lit(i).alias("source"))
        every = one if every is None else every.unionByName(one)
    return ids.select("id").distinct().join(keep_first(every, ["id"], ["source", "label"]), "id", "left")


def resolve_names(names: DataFrame, catalog: DataFrame, chain: tuple[str, ...] = FORM_CHAIN) -> DataFrame:
    """names (id, name like 'display {LOC}| activity | ...') with the code that each means, null if none or several.

    catalog: code, name, location, product. The activity, 'activity display' and 'display activity' are looked up
    in this order, each at the name's location and then along the chain; several hits at one place are decided by
    the product. Else the only maker of the product at the location whose name has all words of the activity, or
    the only maker at all if none has. Markets count for that only if the activity says market.
    """
    p = names.select("id", name_parts(F.col("name")).alias("p")).select("id", F.lower("p.display").alias("display"), F.col("p.location").alias("loc"), F.lower("p.activity").alias("activity")).where("display is not null and activity is not null")
    cat = catalog.select("code", F.lower("name").alias("c_name"), F.col("location").alias("c_loc"), F.lower("product").alias("c_product")).distinct()
    tries = F.array(F.col("activity"), F.concat_ws(" ", "activity", "display"), F.concat_ws(" ", "display", "activity"))
    places = F.array_distinct(F.concat(F.array("loc"), F.array(*[F.lit(c) for c in chain])))
    asked = p.select("id", "display", F.posexplode(tries).alias("t", "c_name"), places.alias("places")).select("id", "display", "t", "c_name", F.posexplode("places").alias("l", "c_loc"))
    hits = asked.join(cat, ["c_name", "c_loc"]).groupBy("id", "t", "l").agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("code"), F.count_if(F.col("c_product") == F.col("display")).alias("m"), F.min(F.when(F.col("c_product") == F.col("display"), F.col("code"))).alias("own"))
    # the first place with hits decides for its form, found or not; the first form that finds one wins
    by_form = hits.groupBy("id", "t").agg(F.min_by(F.when(F.col("n") == 1, F.col("code")).when(F.col("m") == 1, F.col("own")), "l").alias("code")).where("code is not null")
    by_form = by_form.groupBy("id").agg(F.min_by("code", "t").alias("code"))
    rest = p.join(by_form, "id", "left_anti").withColumn("need", words(F.col("activity"))).where(F.size("need") > 0)
    market = F.array_contains("need", "market")
    made = rest.join(cat, (F.col("display") == F.col("c_product")) & (F.col("loc") == F.col("c_loc"))).where(market | ~F.col("c_name").startswith("market "))
    every = F.size(F.array_except("need", words(F.col("c_name")))) == 0
    g = made.groupBy("id").agg(F.count_if(every).alias("n"), F.min(F.when(every, F.col("code"))).alias("hit"), F.count(F.lit(1)).alias("m"), F.min("code").alias("only"), F.first(market).alias("wants"))
    by_product = g.select("id", F.when(F.col("n") == 1, F.col("hit")).when((F.col("n") == 0) & ~F.col("wants") & (F.col("m") == 1), F.col("only")).alias("code")).where("code is not null")
    return names.select("id").distinct().join(by_form.unionByName(by_product), "id", "left")


def stand_ins(activities: DataFrame, blocks: DataFrame) -> DataFrame:
    """code, stand_in: the block that was used for an activity without a block of its own.

    activities: code, name, product, location. blocks: label, product, location, code. The product and location
    are the same and the activity's name begins with the label; only one block may fit.
    """
    a = activities.join(blocks.select("code").distinct(), "code", "left_anti")
    b = blocks.where("label <> ''").select(F.lower("label").alias("label"), F.lower("product").alias("b_product"), F.col("location").alias("b_location"), F.col("code").alias("stand_in"))
    j = a.join(b, (F.lower("product") == F.col("b_product")) & (F.col("location") == F.col("b_location"))).where(F.lower("name").startswith(F.col("label")))
    return j.groupBy("code").agg(F.count_distinct("stand_in").alias("n"), F.min("stand_in").alias("stand_in")).where("n = 1").drop("n")


def relink_orphans(orphans: DataFrame, siblings: DataFrame, background: DataFrame, chain: tuple[str, ...] = ORPHAN_CHAIN) -> DataFrame:
    """code, target_code, source of each orphan product: a sibling of the inventory, else the background, else null.

    orphans: code, name. siblings: code, name, seq (both names 'display {LOC}| suffix'). background: code, name,
    location, seq. Siblings have the same display and suffix, the first location of the chain that has one counts,
    else the first sibling. Background names are tried as 'suffix display', 'display suffix', suffix and display.
    """
    def parsed(df: DataFrame, *keep: str) -> DataFrame:
        q = df.select(*keep, name_parts(F.col("name")).alias("p"))
        return q.select(*keep, F.lower("p.display").alias("d"), F.lower("p.activity").alias("s"), F.col("p.location").alias("loc"))

    o = parsed(orphans, "code").where("d is not null and s is not null")
    places = F.array_distinct(F.concat(F.array("loc"), F.array(*[F.lit(c) for c in chain])))
    far = F.size(places) + 1
    sib = parsed(siblings, "code", "seq").select(F.col("code").alias("target_code"), "seq", "d", "s", F.col("loc").alias("at"))
    near = o.withColumn("places", places).join(sib, ["d", "s"])
    rank = F.array_position("places", F.col("at"))
    by_sib = near.groupBy("code").agg(F.min_by("target_code", F.struct(F.when(rank > 0, rank).otherwise(far).alias("r"), "seq")).alias("target_code")).withColumn("source", F.lit("inventory"))
    rest = o.join(by_sib, "code", "left_anti").withColumn("places", places)
    forms = F.array(F.concat_ws(" ", "s", "d"), F.concat_ws(" ", "d", "s"), F.col("s"), F.col("d"))
    asked = rest.select("code", "places", F.posexplode(forms).alias("t", "n")).select("code", "t", "n", F.posexplode("places").alias("l", "at"))
    bg = background.select(F.col("code").alias("target_code"), F.lower("name").alias("n"), F.col("location").alias("at"), "seq")
    by_bg = asked.join(bg, ["n", "at"]).groupBy("code").agg(F.min_by("target_code", F.struct("t", "l", "seq")).alias("target_code")).withColumn("source", F.lit("background"))
    return orphans.select("code").distinct().join(by_sib.unionByName(by_bg), "code", "left")


def rewrite_targets(exchanges: DataFrame, relinked: DataFrame) -> DataFrame:
    """Edges at an orphan (target_code) point to its new target, or nowhere if there is none."""
    r = relinked.select(F.col("code").alias("_o"), F.col("target_code").alias("_t"), F.lit(True).alias("_hit"))
    out = exchanges.join(r, F.col("target_code") == F.col("_o"), "left")
    return out.withColumn("target_code", F.when(F.col("_hit"), F.col("_t")).otherwise(F.col("target_code"))).select(*exchanges.columns)


def first_target(inputs: DataFrame, cascade: list[tuple[str, DataFrame]]) -> DataFrame:
    """inputs with target, multiplier and `how`: the first lookup of the cascade that has exactly one target for the key.

    cascade: (name, DataFrame of key, target, multiplier).
    """
    out = None
    for i, (name, table) in enumerate(cascade):
        one = table.groupBy("key").agg(F.count_distinct("target").alias("n"), F.min("target").alias("target"), F.min("multiplier").alias("multiplier")).where("n = 1").select("key", F.struct(F.lit(i).alias("i"), "target", "multiplier", F.lit(name).alias("how")).alias("h"))
        out = one if out is None else out.unionByName(one)
    best = out.groupBy("key").agg(F.min("h").alias("h"))
    return inputs.join(best, "key", "left").select(*inputs.columns, "h.target", "h.multiplier", "h.how")


def review_table(usage: DataFrame, placeholders: DataFrame, catalog: DataFrame) -> DataFrame:
    """Linked names that no placeholder covers, with the label of their target. usage: name, target_db, target_code, n."""
    names = placeholders.select(F.lower(F.trim("name")).alias("name")).distinct()
    rest = usage.where("target_code is not null").join(names, "name", "left_anti")
    labels = catalog.select(F.col("db").alias("target_db"), F.col("code").alias("target_code"), F.col("name").alias("target_name"), F.col("unit").alias("target_unit"))
    return rest.join(labels, ["target_db", "target_code"], "left")


def presence(usage: DataFrame, sheets: dict[str, DataFrame]) -> DataFrame:
    """usage with a flag for each sheet that has its name (name), and the number of sheets."""
    out = usage
    for s, df in sheets.items():
        one = df.select(F.lower(F.trim("name")).alias("name")).where("name is not null").distinct().withColumn(f"in_{s}", F.lit(True))
        out = out.join(one, "name", "left").withColumn(f"in_{s}", F.coalesce(f"in_{s}", F.lit(False)))
    return out.withColumn("n_sheets", sum((F.col(f"in_{s}").cast("int") for s in sheets), F.lit(0)))


def systematic_sample(ids: DataFrame, column: str, n: int) -> DataFrame:
    """n ids at equal steps of the sorted ids; all of them if there are no more than n.

    Ids are numbered range by range, so no task sorts them all.
    """
    d = ids.select(column).where(f"`{column}` is not null").distinct()
    total = d.count()
    if total <= n:
        return d
    parts = max(1, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    ranged = checkpointed(d.repartitionByRange(parts, column).withColumn("_p", F.spark_partition_id()))  # the limits of the ranges must not change between the two passes
    sizes = {r["_p"]: r["count"] for r in ranged.groupBy("_p").count().collect()}  # one number for each range
    start, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, start))
        start += sizes[p]
    first = F.broadcast(d.sparkSession.createDataFrame(rows, "_p int, _s long"))
    numbered = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(column)) - 1).join(first, "_p").withColumn("_n", F.col("_n") + F.col("_s"))
    step = total // n
    return numbered.where((F.col("_n") % step == 0) & (F.col("_n") < step * n)).select(column)
