"""Scalar expressions of the linking, factor and reporting stages. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.text import blank_to_null, strip

#: Compartments by the word that names them, in order of precedence within one element.
BUCKET_WORDS = (("air", "air"), ("water", "water"), ("soil", "soil"), ("resource", "resource"), ("raw", "resource"))
#: Prefixes of the last segment of a context address, and their compartments.
CONTEXT_PREFIXES = (("envi-air", "air"), ("envi-wate", "water"), ("envi-grou", "soil"), ("reso", "resource"), ("laus", "resource"))
#: Sub-compartment labels that mean the same.
SUB_GROUPS = {
    "sea": ["ocean", "sea water", "emissions to sea water", "marine"],
    "fresh": ["fresh water", "river", "surface water", "emissions to fresh water"],
    "ground": ["ground-", "ground water", "groundwater", "emissions to ground water", "ground-, long-term", "emissions to ground water, long-term", "ground water, long-term"],
    "urban_air": ["urban air close to ground", "high. pop.", "high. pop., long-term", "urban"],
    "non_urban_air": ["non-urban air or from high stacks", "low. pop.", "low. pop., long-term", "low population density, long-term"],
    "stratosphere": ["lower stratosphere + upper troposphere", "lower stratosphere and upper troposphere", "stratosphere"],
    "agricultural_soil": ["agricultural", "emissions to agricultural soil"],
    "industrial_soil": ["industrial", "emissions to industrial soil"],
    "forest_soil": ["forest", "forestry"],
    "natural_soil": ["non-agricultural", "emissions to non-agricultural soil"],
    "unspecified": ["", "(unspecified)", "unspecified", "emissions to water, unspecified", "emissions to air, unspecified", "emissions to soil, unspecified"],
}
#: Codes of regions that are no country.
AGGREGATE_REGIONS = ["GLO", "ROW", "RER", "RNA", "RLA", "RAS", "RAF", "OECD", "RME", "ENTSO-E", "UCTE", "WECC", "FRCC", "MRO", "NPCC", "RFC", "SERC", "SPP", "TRE", "WORLD", "WORLDPROD"]
#: Aggregates that are accepted as the suffix of a regional flow name.
SUFFIX_AGGREGATES = ["GLO", "RoW", "RoE", "RER", "RNA", "RLA", "RAS", "RAF", "RME", "OECD", "UCTE", "ENTSO-E", "NORDEL", "WEU", "WORLD", "IAI"]


def _last(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.element_at(c, -1))


def bucket_of(categories: Column) -> Column:
    """Top-level compartment: of the first element that names one; 'unspecified' if none does (null list too)."""

    def one(x: Column) -> Column:
        s = F.lower(F.trim(x))
        out = None
        for word, bucket in BUCKET_WORDS:
            out = F.when(s.contains(word), bucket) if out is None else out.when(s.contains(word), bucket)
        return out

    named = F.filter(F.transform(categories, one), lambda x: x.isNotNull())
    return F.coalesce(F.get(named, F.lit(0)), F.lit("unspecified"))


def bucket_of_context(iri: Column) -> Column:
    last = F.lower(F.element_at(F.split(F.regexp_replace(iri, "/+$", ""), "/"), -1))
    out = None
    for prefix, bucket in CONTEXT_PREFIXES:
        out = F.when(last.startswith(prefix), bucket) if out is None else out.when(last.startswith(prefix), bucket)
    return F.coalesce(out, F.lit("unspecified"))


def sub_compartment(categories: Column) -> Column:
    """Last element if there are two or more, else empty."""
    return F.when(F.size(categories) >= 2, F.coalesce(F.element_at(categories, -1), F.lit(""))).otherwise(F.lit(""))


def sub_group(label: Column) -> Column:
    """Group of a sub-compartment label: 'unspecified' for none, empty for an unknown one."""
    pairs = [x for g, members in SUB_GROUPS.items() for m in members for x in (F.lit(m), F.lit(g))]
    key = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(""))


def sub_rank(wanted: Column, target: Column) -> Column:
    """0 same label (or neither has one), 1 same group, 2 another group, 3 unknown. target: the target's categories."""
    want, have = F.lower(F.trim(wanted)), F.lower(F.trim(F.coalesce(_last(target), F.lit(""))))
    known = F.coalesce(F.size(target), F.lit(0)) > 0
    bare = F.when(known & (F.size(target) == 1), 0).otherwise(3)
    group = F.when((sub_group(have) == "") | (sub_group(want) == ""), 3).when(sub_group(have) == sub_group(want), 1).otherwise(2)
    return F.when(want == "", bare).when(~known, 3).when(have == want, 0).otherwise(group)


def normal_cas(cas: Column) -> Column:
    """Registry number in lower case, each part without leading zeros (a part of zeros keeps one)."""
    parts = F.split(F.lower(blank_to_null(cas)), "-")
    return F.array_join(F.transform(parts, lambda x: F.regexp_replace(x, "^0+(?=.)", "")), "-")


def normal_product_code(code: Column) -> Column:
    """Trimmed; compound codes stay, others lose leading zeros."""
    c = blank_to_null(code)
    return F.when(c.rlike(r"^\d+$"), F.regexp_replace(c, "^0+(?=.)", "")).otherwise(c)


def product_code_in(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(?i)\[Ciqual code:\s*(\d+(?:_\d+)*)\]", 1), F.lit(""))


def location_in(name: Column) -> Column:
    """Country of an activity name: of its last {XX}, else of a trailing code; aggregates give null."""
    braces = F.regexp_extract_all(name, F.lit(r"\{([A-Z][A-Z0-9-]{1,9})\}"), F.lit(1))
    trailing = F.regexp_extract(F.regexp_replace(name, r"\s+[Uu]\s*$", ""), r"[,\s]([A-Z][A-Z0-9]{1,4}(?:-[A-Z0-9-]+)?)\s*$", 1)
    head = F.substring_index(F.coalesce(_last(braces), F.nullif(trailing, F.lit(""))), "-", 1)
    return F.when((F.length(head) >= 2) & ~F.upper(head).isin(AGGREGATE_REGIONS), head)


def country_of(location: Column) -> Column:
    """Stripped location without sub-region; null for aggregates and codes of one letter."""
    head = F.substring_index(blank_to_null(location), "-", 1)
    return F.when((F.length(head) >= 2) & ~F.upper(head).isin(AGGREGATE_REGIONS), head)


def regional_suffix(name: Column, countries: list[str]) -> Column:
    """struct(base, region) of names such as 'Water, river, BR'; the region is empty unless it is known.

    countries: two-letter codes, a parameter.
    """
    token = F.regexp_extract(name, r",\s*([A-Z][A-Za-z0-9-]{1,9})\s*$", 1)
    country = F.regexp_extract(token, r"^([A-Z]{2})(?:-[A-Z0-9]{2,7})?$", 1)
    known = token.isin(SUFFIX_AGGREGATES) | country.isin(list(countries))
    base = F.rtrim(F.regexp_replace(name, r",\s*[A-Z][A-Za-z0-9-]{1,9}\s*$", ""))
    return F.struct(F.when(known, base).otherwise(name).alias("base"), F.when(known, token).otherwise(F.lit("")).alias("region"))


def without_location(name: Column, location: Column) -> Column:
    """Drops ', LOC' from the end where it is the dataset's own location."""
    tail = F.concat(F.lit(", "), location)
    return F.when(name.endswith(tail), F.substring(name, F.lit(1), F.length(name) - F.length(tail))).otherwise(name)


def without_unspecified(categories: Column) -> Column:
    """Drops trailing elements that say unspecified."""
    empty = F.transform(categories, lambda x: F.lower(F.trim(x)).isin("unspecified", "(unspecified)", ""))
    kept = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(categories), F.lit(1))), F.lit(0), lambda acc, i: F.when(~F.coalesce(F.get(empty, i - 1), F.lit(True)), i).otherwise(acc))
    return F.slice(categories, F.lit(1), kept)


def name_parts(name: Column) -> Column:
    """struct(display, location, activity, rest) of 'display {LOC}| activity | rest'."""
    e = lambda i: F.nullif(F.trim(F.regexp_extract(name, r"^(.*?)\s*\{([^}]*)\}\s*\|\s*([^|]*?)\s*(?:\|\s*(.*))?$", i)), F.lit(""))
    return F.struct(e(1).alias("display"), e(2).alias("location"), e(3).alias("activity"), e(4).alias("rest"))


def name_and_geography(name: Column) -> Column:
    """struct(name, location) of 'name/GEO U', 'name/GEO/I S'."""
    pattern = r"^(.+?)/([A-Za-z][A-Za-z-]{1,9})(?:/I)? [SU]$"
    hit = name.rlike(pattern)
    return F.struct(F.when(hit, F.regexp_extract(name, pattern, 1)).otherwise(name).alias("name"), F.when(hit, F.regexp_extract(name, pattern, 2)).alias("location"))


def short_name(name: Column) -> Column:
    """Last part between commas in lower case, hyphens as spaces; empty unless it has a digit."""
    parts = F.split(strip(name), ",")
    last = F.trim(_last(parts))
    s = F.trim(F.regexp_replace(F.lower(F.when(last != "", last).otherwise(strip(name))), "-", " "))
    return F.when(s.rlike(r"\d"), s).otherwise(F.lit(""))


def method_root(method: Column) -> Column:
    """Method name without ' - inorganics' or ' - organics'."""
    return F.regexp_replace(method, " - (?:in)?organics$", "")


def normal_method(method: Column) -> Column:
    """Method name fit for comparison: lower case, single spaces, no prefix, no sub-method, short form spelled out."""
    s = F.regexp_replace(F.lower(method_root(method)), "^ef-", "")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "[-_,]", " "), r"\s+", " "))
    return F.regexp_replace(s, r"\blu\b", "land use")


def joined_parts(parts: Column) -> Column:
    """'a / b' of the elements that say something."""
    kept = F.filter(F.transform(without_unspecified(parts), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(kept, " / ")


def words(text: Column) -> Column:
    """Distinct runs of letters and digits in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1)))


def literal_list(text: Column) -> Column:
    """Elements of a written tuple such as "('air', 'urban')"."""
    return F.regexp_extract_all(text, F.lit(r"""['"]([^'"]*)['"]"""), F.lit(1))


def split_categories(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"::|/|\|"), lambda x: F.trim(x)), lambda x: x != "")


def first_json(text: Column) -> Column:
    """First balanced JSON object inside a text, braces in quoted strings aside; null if there is none."""
    zero = F.lit(0)
    start = F.struct(zero.alias("at"), zero.alias("lo"), zero.alias("hi"), zero.alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"))

    def step(s: Column, c: Column) -> Column:
        done, inside = s["hi"] > 0, s["lo"] > 0
        opens, closes = (c == "{") & ~s["quoted"], (c == "}") & ~s["quoted"] & inside
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        at = s["at"] + 1
        new = F.struct(
            at.alias("at"), F.when(~inside & opens, at).otherwise(s["lo"]).alias("lo"), F.when(closes & (depth == 0), at).otherwise(zero).alias("hi"), depth.alias("depth"),
            F.when(inside & (c == '"') & ~s["escaped"], ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"), (s["quoted"] & (c == "\\") & ~s["escaped"]).alias("escaped"),
        )
        return F.when(done, s).otherwise(new)

    s = F.aggregate(F.split(text, ""), start, step)
    return F.when(s["hi"] > 0, F.substring(text, s["lo"], s["hi"] - s["lo"] + 1))


def flow_id(db: Column, code: Column) -> Column:
    """63-bit id of a key: the first 8 bytes of its SHA-256, big endian, sign bit off. Null parts count as empty."""
    text = F.concat(F.coalesce(db, F.lit("")), F.lit("\u0000"), F.coalesce(code, F.lit("")))
    head = F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")


def synthetic_id(activity: Column, product: Column) -> Column:
    """Id of an activity split off for one product: (activity * 1000003 + product) mod (2**61 - 1)."""
    total = activity.cast("decimal(20,0)") * F.lit(1_000_003).cast("decimal(10,0)") + product.cast("decimal(20,0)")
    return (total % F.lit("2305843009213693951").cast("decimal(20,0)")).cast("bigint")


def activity_hash(*fields: Column) -> Column:
    """MD5 of the lower-cased fields one after the other."""
    return F.md5(F.lower(F.concat(*[F.coalesce(f.cast("string"), F.lit("")) for f in fields])))


def relative_difference(a: Column, b: Column) -> Column:
    """(a - b) / |b| * 100; null where b is 0 or missing."""
    return F.try_divide((a - b) * 100, F.abs(b))


def rescaled(amount: Column, loc: Column, scale: Column, low: Column, high: Column, kind: Column, factor: Column) -> Column:
    """struct of an uncertain amount multiplied by a factor.

    kind 2 (lognormal): loc is ln|amount|; 3 (normal): loc and scale follow; 4, 5 (uniform, triangular): loc
    and bounds follow; other kinds keep amount as loc. Bounds swap under a negative factor; a zero factor
    clears the spread.
    """
    value = amount * factor
    zero = factor == 0
    new_loc = F.when(kind == 2, F.when(value == 0, None).otherwise(F.log(F.abs(value)))).when(kind.isin(3, 4, 5), loc * factor).otherwise(value)
    new_scale = F.when(kind == 3, F.abs(scale * factor)).otherwise(scale)
    a, b = low * factor, high * factor
    return F.struct(
        value.alias("amount"),
        F.when(zero, F.lit(0.0)).otherwise(new_loc).alias("loc"),
        F.when(~zero, new_scale).alias("scale"),
        F.when(~zero, F.when(factor < 0, b).otherwise(a)).alias("minimum"),
        F.when(~zero, F.when(factor < 0, a).otherwise(b)).alias("maximum"),
    )
