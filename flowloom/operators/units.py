"""Quantities recorded in different units, expressed in common units.

Conversions are edges of a graph, each an affine function value * scale + offset. For every unit the
shortest composition to the canonical unit of its kind is computed once on the driver (the graph is a
fixed table of a few dozen edges); the edges outside the shortest paths close cycles, and each cycle must
be the identity. What grows with the data is only joined: unit cells are parsed by JVM expressions and
equi-joined with the fixed spelling table.
"""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.text import blank_to_null, number, strip
from flowloom.session import checkpointed


@dataclass(frozen=True)
class Affine:
    """x -> x * scale + offset"""

    scale: float
    offset: float = 0.0

    def then(self, other: Affine) -> Affine:
        return Affine(self.scale * other.scale, self.offset * other.scale + other.offset)

    def inverse(self) -> Affine:
        return Affine(1.0 / self.scale, -self.offset / self.scale)


#: Unit, unit, how many of the second one of the first is.
EDGES = [
    ("mg", "g", 1e-3), ("g", "kg", 1e-3), ("t", "kg", 1e3), ("kt", "t", 1e3), ("kt", "kg", 1e6), ("lb", "kg", 0.45359237), ("mg", "kg", 1e-6),
    ("ml", "l", 1e-3), ("l", "m3", 1e-3), ("hl", "l", 100.0), ("hl", "m3", 0.1), ("ml", "m3", 1e-6),
    ("kJ", "MJ", 1e-3), ("GJ", "MJ", 1e3), ("TJ", "GJ", 1e3), ("TJ", "MJ", 1e6), ("kWh", "MJ", 3.6), ("MWh", "kWh", 1e3), ("MWh", "MJ", 3600.0),
    ("cm2", "m2", 1e-4), ("ha", "m2", 1e4), ("km2", "ha", 100.0), ("km2", "m2", 1e6),
    ("cm", "m", 1e-2), ("km", "m", 1e3), ("km", "cm", 1e5),
    ("s", "min", 1 / 60), ("min", "h", 1 / 60), ("s", "h", 1 / 3600), ("d", "h", 24.0),
    ("kgkm", "tkm", 1e-3),
    ("Bq", "kBq", 1e-3), ("MBq", "kBq", 1e3), ("MBq", "Bq", 1e6),
]
#: The canonical unit of each kind.
CANONICAL = ("kg", "m3", "MJ", "m2", "m", "h", "tkm", "kBq")
#: Ways in which the units are written. A standard cubic meter counts as one m3.
SPELLINGS = {
    "mg": ["mg", "milligram", "milligrams", "milligramme"],
    "g": ["g", "gr", "gram", "grams", "gramme", "grammes"],
    "kg": ["kg", "Kg", "kgs", "kilo", "kilogram", "kilograms", "kilogramme", "kilogrammes"],
    "t": ["t", "tonne", "tonnes", "metric ton", "metric tons", "ton (metric)", "Mg", "megagram"],
    "kt": ["kt", "kilotonne", "kilotonnes", "kiloton"],
    "lb": ["lb", "lbs", "pound", "pounds"],
    "ml": ["ml", "mL", "millilitre", "millilitres", "milliliter", "milliliters", "cm3", "cm³", "cm^3", "cubic centimeter", "cubic centimetre"],
    "l": ["l", "L", "litre", "litres", "liter", "liters", "dm3", "dm³", "dm^3", "cubic decimeter", "cubic decimetre"],
    "hl": ["hl", "hL", "hectolitre", "hectolitres", "hectoliter", "hectoliters"],
    "m3": ["m3", "m³", "m^3", "cubic meter", "cubic metre", "cubic meters", "cubic metres", "Sm3", "Sm³", "standard cubic meter", "standard cubic metre"],
    "kJ": ["kJ", "kilojoule", "kilojoules"],
    "MJ": ["MJ", "Mj", "megajoule", "megajoules"],
    "GJ": ["GJ", "gigajoule", "gigajoules"],
    "TJ": ["TJ", "terajoule", "terajoules"],
    "kWh": ["kWh", "KWH", "kwh", "kW.h", "kilowatt hour", "kilowatt-hour", "kilowatt hours", "kilowatthour"],
    "MWh": ["MWh", "MWH", "mwh", "megawatt hour", "megawatt-hour", "megawatt hours"],
    "cm2": ["cm2", "cm²", "cm^2", "square centimeter", "square centimetre"],
    "m2": ["m2", "m²", "m^2", "sq m", "sqm", "sq. m", "square meter", "square metre", "square meters"],
    "ha": ["ha", "hectare", "hectares"],
    "km2": ["km2", "km²", "km^2", "square kilometer", "square kilometre", "square kilometers"],
    "cm": ["cm", "centimeter", "centimetre", "centimeters", "centimetres"],
    "m": ["m", "meter", "metre", "meters", "metres"],
    "km": ["km", "kilometer", "kilometre", "kilometers", "kilometres"],
    "s": ["s", "sec", "second", "seconds", "seconde", "secondes"],
    "min": ["min", "mins", "minute", "minutes"],
    "h": ["h", "hr", "hrs", "hour", "hours", "heure", "heures"],
    "d": ["d", "day", "days", "jour", "jours"],
    "kgkm": ["kgkm", "kg*km", "kg.km", "kg km", "kilogram kilometer", "kilogram kilometre"],
    "tkm": ["tkm", "t*km", "t.km", "t km", "ton kilometer", "ton kilometre", "tonne kilometer", "tonne kilometre"],
    "Bq": ["Bq", "becquerel", "becquerels"],
    "kBq": ["kBq", "kilobecquerel", "kilo Becquerel", "kilo-becquerel"],
    "MBq": ["MBq", "megabecquerel", "mega Becquerel"],
}
#: Cells that hold no unit and refer to the note.
PLACEHOLDERS = ["", "-", "--", "?", "n/a", "na", "n.a.", "none", "null", "nan", "see note", "voir note", "tbd"]
#: Note formats. One unit: the source's, the result's. Both: result first, source first.
NOTE_SOURCE = r"(?iuU)^\s*(?:source amounts in|basis: one|per|input booked in|quantité source en)\s+(.+?)(?:,\s*see sheet)?[\s.]*$"
NOTE_TARGET = r"(?iuU)^\s*(?:answer column holds|gives|result in|résultat en|target is counted in)\s+(.+?)[\s.]*$"
NOTE_RESULT_FIRST = (
    r"(?iuU)^\s*(?:Factor gives\s+|unit of result:\s*|exprimé en\s+|Read as\s+|value taken from the\s+)?(.+?)"
    r"(?:\s+for each\s+|;\s*unit of source:\s*|\s+par\s+|\s+obtained from one\s+|/|\s+per\s+)(.+?)(?:\s+of the source flow|\s+column)?[\s.]*$"
)
NOTE_SOURCE_FIRST = r"(?iuU)^\s*1\s+(.+?)\s+of input counts as so many\s+(.+?)[\s.]*$"


class InconsistentCycle(ValueError):
    """A cycle of conversions that is not the identity."""


def compose(edges, canonical, tolerance: float = 1e-9) -> dict[str, tuple[str, Affine]]:
    """For each unit its canonical unit and the shortest composition to it.

    edges: (unit, unit, Affine or scale). Raises InconsistentCycle when some cycle differs from the
    identity by more than tolerance (relative), ValueError when two canonical units are connected.
    """
    edges = [(a, b, f if isinstance(f, Affine) else Affine(f)) for a, b, f in edges]
    out: dict[str, list] = {}
    for a, b, f in edges:
        out.setdefault(a, []).append((b, f))
        out.setdefault(b, []).append((a, f.inverse()))
    found: dict[str, tuple[str, Affine]] = {}
    for c in canonical:
        if c in found:
            raise ValueError(f"{c} is connected with {found[c][0]}")
        found[c] = (c, Affine(1.0))
        queue = deque([c])
        while queue:
            u = queue.popleft()
            for v, f in out.get(u, []):
                if v not in found:  # f goes from u to v, its inverse leads back towards the canonical unit
                    found[v] = (c, f.inverse().then(found[u][1]))
                    queue.append(v)
    for a, b, f in edges:
        if a in found:
            direct, around = found[a][1], f.then(found[b][1])
            near = math.isclose(direct.scale, around.scale, rel_tol=tolerance) and math.isclose(direct.offset, around.offset, rel_tol=tolerance, abs_tol=tolerance)
            if not near:
                raise InconsistentCycle(f"{a} -> {b}: {direct} against {around}")
    return found


def spelling_table(spark: SparkSession) -> DataFrame:
    """spelling, unit, kind, scale: a fixed table (about 300 rows), fit for a broadcast.

    Exact spellings come first; a spelling in other letter case is offered in lower case only where no two
    units share it (mg and Mg do).
    """
    to = compose(EDGES, CANONICAL)
    exact = {s: u for u, words in SPELLINGS.items() for s in words}
    lower: dict[str, set] = {}
    for s, u in exact.items():
        lower.setdefault(s.lower(), set()).add(u)
    rows = {s: u for s, u in exact.items()} | {s: next(iter(us)) for s, us in lower.items() if len(us) == 1 and s not in exact}
    return spark.createDataFrame([(s, u, to[u][0], to[u][1].scale) for s, u in rows.items()], "spelling string, unit string, kind string, scale double")


_NUMBER = r"(10\^[0-9]+|[0-9]+(?:[.,][0-9]+)?(?:[eE][+-]?[0-9]+)?)"
#: multiple, unit, multiple, multiple of '100 kg', 'kg x 100', 'kg (x100)', '[kg]', '10^6 kg', 'kg.'
_CELL_FORM = rf"(?U)^\s*\[?\s*(?:{_NUMBER}\s*[x×]?\s+)?(\S.*?)(?:\s*\(\s*[x×]\s*{_NUMBER}\s*\)|\s+[x×]\s*{_NUMBER})?[\s.]*\]?[\s.]*$"


def _multiple(text: Column) -> Column:
    return F.when(text == "", F.lit(1.0)).otherwise(F.replace(F.replace(text, F.lit("10^"), F.lit("1e")), F.lit(","), F.lit(".")).try_cast("double"))


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _tidy(text: Column) -> Column:
    """Single blanks, no points at the end; a longer run of points within, which no unit has, becomes one odd character.

    On such a text the patterns of cells and notes take time in proportion to its length.
    """
    end = F.regexp_replace(_squeezed(text), r"(?<![ .])[ .]++$", "")
    return F.regexp_replace(end, r"[ .]{3,}", "\u0001")


def unit_parts(cell: Column) -> tuple[Column, Column]:
    """Base text and multiple of a unit cell; a cell of another form keeps its text."""
    group = lambda i: F.regexp_extract(cell, _CELL_FORM, i)
    return F.regexp_replace(group(2), r"(?U)\s+", " "), _multiple(group(1)) * _multiple(F.concat(group(3), group(4)))


def note_unit(note: Column, side: str) -> Column:
    """The unit that a note gives for the source (side 'S') or the result ('T'); null if it gives none."""
    single, first, second = (NOTE_SOURCE, 2, 1) if side == "S" else (NOTE_TARGET, 1, 2)
    hits = [(single, 1), (NOTE_SOURCE_FIRST, second), (NOTE_RESULT_FIRST, first)]
    return F.coalesce(*[F.nullif(F.regexp_extract(note, p, g), F.lit("")) for p, g in hits])


def _is_placeholder(cell: Column) -> Column:
    bare = F.lower(strip(F.regexp_replace(F.coalesce(cell, F.lit("")), r"^\s*\[|\]\s*$", "")))
    return bare.isin(PLACEHOLDERS)


def _with_unit(df: DataFrame, cell: Column, name: str, spellings: DataFrame) -> DataFrame:
    """Adds {name}_unit, {name}_kind and {name}_scale (canonical units in one of the cell's); null if unreadable."""
    exact = [s for words in SPELLINGS.values() for s in words]
    base, times = unit_parts(cell)
    df = df.withColumn("_b", base).withColumn("_t", times)
    meant: dict[str, set] = {}
    for u, words in SPELLINGS.items():
        for s in words:
            meant.setdefault(s.lower(), set()).add(u)
    doubtful = [s for s, us in meant.items() if len(us) > 1]  # in another letter case these may be either unit
    df = df.withColumn("_b", F.when(F.col("_b").isin(exact), F.col("_b")).when(~F.lower("_b").isin(doubtful), F.lower("_b")))
    s = spellings.select(F.col("spelling").alias("_b"), F.col("unit").alias(f"{name}_unit"), F.col("kind").alias(f"{name}_kind"), F.col("scale").alias("_s"))
    df = df.join(F.broadcast(s), "_b", "left")
    return df.withColumn(f"{name}_scale", F.col("_t") * F.col("_s")).drop("_b", "_t", "_s")


def common_factors(df: DataFrame, source: str = "source_unit", target: str = "target_unit", factor: str = "conversion_factor", note: str | None = "note") -> DataFrame:
    """Adds source_kind, target_kind, source_base, target_base (units without multiple) and common_factor.

    common_factor is how many common target units one common source unit is. It is null where the factor is
    null or NaN, or a unit can't be read as one of the known kinds. Blank and placeholder cells take their
    unit from the note. Cells and notes of any length are read. No row is dropped; columns of other names pass through, those of these names are replaced.
    """
    sp = spelling_table(df.sparkSession)
    names = ("source_kind", "target_kind", "source_base", "target_base", "common_factor")
    cells = {}
    for side, c in (("S", source), ("T", target)):
        cell = F.col(c).cast("string")
        cells[side] = F.when(_is_placeholder(_squeezed(cell)), note_unit(_tidy(F.col(note).cast("string")), side)).otherwise(_tidy(cell)) if note else _tidy(cell)
    out = df.withColumn("_sc", cells["S"]).withColumn("_tc", cells["T"])
    out = _with_unit(_with_unit(out, F.col("_sc"), "_src", sp), F.col("_tc"), "_tgt", sp)
    return out.select(
        *[c for c in df.columns if c not in names],
        F.col("_src_kind").alias("source_kind"),
        F.col("_tgt_kind").alias("target_kind"),
        F.col("_src_unit").alias("source_base"),
        F.col("_tgt_unit").alias("target_base"),
        (number(factor) * F.col("_tgt_scale") / F.col("_src_scale")).alias("common_factor"),
    )


#: Cells of one key that are paired in one task; a key with more is split.
SPLIT_CELLS = 2_000
#: Width of a cell of ln(factor). Two factors of one cell differ by less than 1 %.
_CELL = -math.log(0.99) * 0.999


def contradictions(df: DataFrame, key: list[str], id_col: str, by: str = "provenance", value: str = "common_factor", tolerance: float = 0.01) -> DataFrame:
    """Pairs (id_a < id_b) of one key whose values differ by more than `tolerance` of the larger and whose `by` differs.

    A null key, value or id takes no part; null in `by` is a value of its own. Redelivered ids count once.
    Keys whose smallest and largest value agree are dropped after a partial aggregation. The rest is paired
    by cells of nearly equal values, so that agreeing rows never meet one another, however many share a
    key: the work follows the number of contradictions, not the square of a group.
    """
    width = _CELL * tolerance / 0.01
    k = [F.col(c) for c in key]
    rows = checkpointed(
        df.where(F.col(value).isNotNull() & F.col(id_col).isNotNull())
        .select(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0002")) for c in k]).alias("k"), F.col(id_col).alias("id"), F.coalesce(F.col(by).cast("string"), F.lit("\u0002")).alias("p"), F.col(value).alias("v"), *[c.isNotNull().alias(f"_n{i}") for i, c in enumerate(k)])
        .where(F.expr(" and ".join(f"_n{i}" for i in range(len(key)))))
        .select("k", "id", "p", "v")
        .distinct()
        .select("*", F.signum("v").cast("int").alias("s"), F.when(F.col("v") == 0, F.lit(0).cast("long")).otherwise(F.floor(F.log(F.abs("v")) / width)).alias("c"))
    )

    def far(a: Column, b: Column) -> Column:
        return F.abs(a - b) > F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))

    mixed = rows.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where(far(F.col("lo"), F.col("hi"))).select("k")
    rows = rows.join(mixed, "k", "left_semi")
    cells = rows.groupBy("k", "p", "s", "c").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # a key with very many cells is split: each cell of one side meets a part's cells of the other
    split = cells.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / SPLIT_CELLS).cast("long").alias("n"))
    cells = cells.join(split, "k")
    a = cells.select("k", F.pmod(F.xxhash64("p", "s", "c"), F.col("n")).alias("part"), *[F.col(x).alias(f"{x}a") for x in ("p", "s", "c", "lo", "hi")])
    b = cells.select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("part"), *[F.col(x).alias(f"{x}b") for x in ("p", "s", "c", "lo", "hi")])
    apart = (F.col("pa") < F.col("pb")) & (far(F.col("loa"), F.col("hib")) | far(F.col("hia"), F.col("lob")))
    met = a.join(b, ["k", "part"]).where(apart).select("k", "pa", "sa", "ca", "pb", "sb", "cb")
    left = rows.select("k", F.col("p").alias("pa"), F.col("s").alias("sa"), F.col("c").alias("ca"), F.col("id").alias("ia"), F.col("v").alias("va"))
    right = rows.select("k", F.col("p").alias("pb"), F.col("s").alias("sb"), F.col("c").alias("cb"), F.col("id").alias("ib"), F.col("v").alias("vb"))
    pairs = met.join(left, ["k", "pa", "sa", "ca"]).join(right, ["k", "pb", "sb", "cb"])
    pairs = pairs.where(far(F.col("va"), F.col("vb")) & (F.col("ia") != F.col("ib")))
    return pairs.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()


def contradicting_factors(flowmap: DataFrame, unit_conversion: DataFrame) -> DataFrame:
    """table_name, id_a, id_b of the entries that contradict each other once in common units.

    Rows with a missing factor or an unreadable unit take no part; empty tables give no rows.
    """
    f = common_factors(flowmap).withColumn("source_name", blank_to_null("source_name")).withColumn("target_name", blank_to_null("target_name"))
    u = common_factors(unit_conversion, factor="multiplier", note=None)
    # parsed once, then filtered: filters on what the patterns give would repeat the patterns
    names = ["package_id", "source_name", "target_name", "source_kind", "target_kind"]
    f = checkpointed(f.select("entry_id", "provenance", "common_factor", *names))
    u = checkpointed(u.select("conv_id", "provenance", "common_factor", "source_base", "target_base"))
    a = contradictions(f, names, "entry_id")
    b = contradictions(u, ["source_base", "target_base"], "conv_id")
    return a.select(F.lit("flowmap").alias("table_name"), "id_a", "id_b").unionByName(b.select(F.lit("unit_conversion").alias("table_name"), "id_a", "id_b"))
