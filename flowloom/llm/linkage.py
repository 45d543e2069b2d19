"""Records of two sources matched without a common key, each match with a confidence.

Probabilistic record linkage in five steps: names, registry numbers, units and compartments are standardised;
several blocking passes (name, synonym, registry number, names with one letter left out, halves and pieces of
names) give candidate pairs by equi-joins; the agreement of each attribute is graded in levels; expectation-maximisation over the
counts of level patterns (a few hundred at most) learns how often matches and non-matches show each level;
the posterior is the confidence. Source rows are reduced to distinct signatures before anything is joined.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.valuemap import BKTree, ContextMatcher, edits, shards_of
from flowloom.session import checkpointed

#: Qualifiers that workers hold, all that the catalogue has (a few dozen words of its language); more raise.
QUALIFIERS = 500_000
#: Matches are reported from this posterior on.
CONFIDENCE = 0.5
#: Stems from this length on are compared by pieces, as leaving letters out takes the square of the length.
LONG_STEM, PIECES = 40, 5
#: What is added to a name without being part of it.
_DECOR = re.compile(r"\{[^}]*\}|\[[^\]]*\]|[*†]|\((?:[a-z]|adapted|\d+)\)|,?\s*\bat plant\b")
_PIECES = re.compile(r"[^\W\d_]+|\d+")
#: Spellings of the units of catalogue flows.
_UNITS = {
    "kg": "kg", "kgs": "kg", "kilogram": "kg", "kilograms": "kg", "mj": "MJ", "megajoule": "MJ", "m3": "m3", "m³": "m3", "m^3": "m3", "cubic meter": "m3", "cubic metre": "m3",
    "kbq": "kBq", "kilobecquerel": "kBq", "kilo becquerel": "kBq", "m2": "m2", "m²": "m2", "m2a": "m2a", "square meter": "m2",
}


def pieces(name: str | None) -> list[str]:
    return _PIECES.findall(_DECOR.sub(" ", (name or "").lower()))


def raw_tail(name: str | None) -> str:
    """Words after the first one."""
    return " ".join([p for p in pieces(name) if not p.isdigit()][1:])


class Standard:
    """Splits names into locant, stem and qualifier, given the known qualifiers, the most frequent first."""

    def __init__(self, tails: list[str]):
        self.tails = [t for t in tails if t]
        self.known = set(self.tails)
        self.sorted = sorted(self.known)
        self.tree = BKTree(((t,), i) for i, t in enumerate(self.sorted))

    @lru_cache(maxsize=100_000)  # noqa: B019
    def qualifier(self, text: str) -> str | None:
        """The known qualifier that a text is, slips allowed, or of which alone it is the beginning; None if it is none."""
        if text in self.known:
            return text
        near = [(d, t[0]) for d, t, _ in self.tree.within((text,), 2) if d <= (1 if len(t[0]) <= 4 else 2)]
        if near:
            return min(near)[1]
        if len(text) < 2:
            return None
        lo = bisect_left(self.sorted, text)
        begun = [t for t in self.sorted[lo : lo + 2] if t.startswith(text)]
        return begun[0] if len(begun) == 1 else None

    def split(self, name: str | None) -> tuple[str, str, str]:
        p = pieces(name)
        words = [x for x in p if not x.isdigit()]
        locant = next((x for x in p if x.isdigit()), "")
        if len(words) <= 1:
            return locant, "".join(words), ""
        tail = self.qualifier(" ".join(words[1:]))
        if tail is not None:
            return locant, words[0], tail
        front = self.qualifier(" ".join(words[:-1]))
        if front is not None:
            return locant, words[-1], front
        return locant, words[0], " ".join(words[1:])


def cas_digits(cas: str | None) -> str:
    """Registry number as digits without leading zeros; empty if there is none."""
    return re.sub(r"\D", "", cas or "").lstrip("0")


def unit_kind(unit: str | None) -> str:
    u = (unit or "").strip().lower()
    return _UNITS.get(u, u)


_STD = "locant string, stem string, tail string, cas string, unit string, comp string"


_built: dict[int, tuple] = {}


def _matchers(shared) -> tuple[Standard, list[ContextMatcher]]:
    """The worker's standards, built once."""
    key = hash(str(shared.value))
    if key not in _built:
        _built.clear()
        _built[key] = (Standard(shared.value[0]), [ContextMatcher(shard) for shard in shared.value[1]])
    return _built[key]


def _standardised(rows: DataFrame, shared, schema: str) -> DataFrame:
    """rows: name, cas, unit, cats first, then what passes through. comp is '' without categories.

    shared: a broadcast of the qualifiers and the shards of the compartment list; of equally near entries of
    different shards none is meant.
    """
    keep = rows.columns[4:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        std, matchers = _matchers(shared)
        places: dict[tuple, str] = {}

        def nearest(path: list) -> tuple[int, int] | None:
            hits = {h for m in matchers if (h := m.find(path))}
            best = [h for h in hits if h[0] == min(d for d, _ in hits)]
            return best[0] if len(best) == 1 else None

        def place(path: list | None) -> str:
            key = tuple(x for x in path or [] if x and x.strip())
            if key not in places:
                if len(places) > 100_000:
                    places.clear()
                hit = nearest(list(key)) if key else None
                places[key] = "" if not key else str(hit[1]) if hit else "? " + " / ".join(" ".join(pieces(x)) for x in key)
            return places[key]

        for b in batches:
            names, cas, units, cats = (b[i].to_pylist() for i in range(4))
            split = [std.split(n) for n in names]
            out = [*zip(*split, strict=True)] if split else [(), (), ()]
            columns = [pa.array(c, pa.string()) for c in (*out, map(cas_digits, cas), map(unit_kind, units), map(place, cats))]
            yield pa.RecordBatch.from_arrays([*columns, *[b[4 + i] for i in range(len(keep))]], names=["locant", "stem", "tail", "cas", "unit", "comp", *keep])

    return rows.mapInArrow(run, f"{_STD}, {schema}")


def _left_out(stem: Column) -> Column:
    """The text and each that it becomes when one letter is left out."""
    n = F.length(stem)
    return F.concat(F.array(stem), F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(stem.substr(F.lit(1), i - 1), stem.substr(i + 1, n))))


def _one_slip(stem: Column) -> Column:
    """Keys of which two stems with one slip between them share one: letters left out, or pieces where that is too much."""
    n = F.length(stem)
    return F.array_distinct(F.when(n < 4, F.array(stem)).when(n < LONG_STEM, _left_out(stem)).otherwise(F.array(stem)))


def _half_keys(side: str, half: Column) -> Column:
    return F.transform(_left_out(half), lambda x: F.concat(F.lit(side), x))


def _halves(stem: Column) -> Column:
    """Keys of a name's own halves: with two slips in all, one half has no more than one."""
    n = F.length(stem)
    m = F.floor(n / 2).cast("int")
    return F.array_distinct(F.concat(_half_keys("<", stem.substr(F.lit(1), m)), _half_keys(">", stem.substr(m + 1, n))))


def _half_probes(stem: Column) -> Column:
    """Keys by which a text meets the halves of every name within two slips: its halves cut up to two letters aside."""
    n = F.length(stem)
    cuts = F.array_distinct(F.transform(F.array(*[F.lit(x) for x in range(-2, 3)]), lambda x: F.greatest(F.lit(1), F.least(n - 1, F.floor(n / 2).cast("int") + x))))
    return F.array_distinct(F.flatten(F.transform(cuts, lambda m: F.concat(_half_keys("<", stem.substr(F.lit(1), m)), _half_keys(">", stem.substr(m + 1, n))))))


def _piece_keys(stem: Column) -> Column:
    """The PIECES pieces of a long name, with their number and its length: two slips, swaps included, leave one as it is."""
    n = F.length(stem)
    at = lambda i: F.floor(n * i / PIECES).cast("int")
    return F.array(*[F.concat_ws(" ", n, F.lit(i), stem.substr(at(i) + 1, at(i + 1) - at(i))) for i in range(PIECES)])


def _piece_probes(stem: Column) -> Column:
    """Keys by which a long text meets the pieces of every name within two slips: two letters longer or shorter, two aside."""
    keys = []
    for d in range(-2, 3):
        n = F.length(stem) + d
        at = lambda i, n=n: F.floor(n * i / PIECES).cast("int")
        keys += [F.concat_ws(" ", n, F.lit(i), stem.substr(F.greatest(F.lit(1), at(i) + 1 + x), at(i + 1) - at(i))) for i in range(PIECES) for x in range(-2, 3)]
    return F.array_distinct(F.array(*keys))


#: Differences beyond this are all alike; the comparison of long names stops there.
_FAR = 5


def _slips(a: Column, b: Column) -> Column:
    d = F.levenshtein(a, b, _FAR)
    return F.when(d < 0, _FAR + 1).otherwise(d)


def _one_beside_a_swap(a: Column, b: Column) -> Column:
    """Whether two neighbours of a, swapped, leave it one slip from b: two slips, though three letters differ."""
    n = F.length(a)
    swapped = lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, n))
    return F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.levenshtein(swapped(i), b, 2).between(0, 1))


def _levels() -> dict[str, Column]:
    """Agreement levels of a candidate pair; the number of levels of each is in LEVELS."""
    slips = _slips(F.col("u.stem"), F.col("v.stem"))
    same_variant = (F.col("u.locant") == F.col("v.locant")) & (F.col("u.tail") == F.col("v.tail"))
    swapped = F.array_sort(F.split("u.stem", "")) == F.array_sort(F.split("v.stem", ""))
    name = F.when(slips == 0, 4).when((slips == 1) | ((slips == 2) & swapped), 3).when(((slips == 2) & (F.length("u.stem") >= 6)) | ((slips == 4) & swapped & (F.length("u.stem") >= 8)), 2).when((slips == 3) & (F.length("u.stem") >= 7), 1).otherwise(0)
    cas = F.when((F.col("u.cas") == "") | (F.size("v.all_cas") == 0), 1).when(F.array_contains("v.all_cas", F.col("u.cas")), 3)
    cas = cas.when(F.exists("v.all_cas", lambda c: F.levenshtein(c, F.col("u.cas")) <= 2), 2).otherwise(0)
    unit = F.when((F.col("u.unit") == "") | (F.size("v.units") == 0), 1).when(F.array_contains("v.units", F.col("u.unit")), 2).otherwise(0)
    comp = F.when(F.col("u.comp") == "", 1).when(F.array_contains("v.comps", F.col("u.comp")), 2).otherwise(0)
    return {"l_name": name, "l_variant": F.when(same_variant, 2).when(name == 0, 1).otherwise(0), "l_cas": cas, "l_unit": unit, "l_comp": comp}


LEVELS = {"l_name": 5, "l_variant": 3, "l_cas": 4, "l_unit": 3, "l_comp": 3}
#: Where the expectation-maximisation starts: how matches show each level.
_START = {"l_name": [0.02, 0.03, 0.1, 0.2, 0.65], "l_variant": [0.02, 0.08, 0.9], "l_cas": [0.03, 0.07, 0.4, 0.5], "l_unit": [0.02, 0.08, 0.9], "l_comp": [0.1, 0.05, 0.85]}

#: How non-matches show each level before anything is learned, and how many pairs this and _START count for.
_APART = {"l_name": [0.985, 0.008, 0.005, 0.001, 0.001], "l_variant": [0.6, 0.2, 0.2], "l_cas": [0.6, 0.38, 0.015, 0.005], "l_unit": [0.3, 0.1, 0.6], "l_comp": [0.8, 0.05, 0.15]}
_PRIOR = 200.0


def learn_weights(patterns: dict[tuple, int], apart: dict[str, list[float]] | None = None, unblocked: float = 0.0, turns: int = 300) -> dict[tuple, float]:
    """Posterior of each level pattern, from the counts of the patterns.

    unblocked: how many pairs no blocking pass has brought together, all taken as non-matches; apart: how these
    show the levels of each attribute. Without them non-matches would be judged by candidates alone, which
    agree by construction. Another variant (level 0) is never a match.
    """
    if not patterns:
        return {}
    names = list(LEVELS)
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    at = np.array(keys, int)
    total = n.sum() + unblocked
    rest = {c: unblocked * np.array(apart[c]) if apart else np.zeros(LEVELS[c]) for c in names}
    possible = at[:, names.index("l_variant")] > 0

    def spread(w: np.ndarray, c: str, prior: list[float], extra: np.ndarray | float = 0.0) -> np.ndarray:
        got = np.array([w[at[:, names.index(c)] == level].sum() for level in range(LEVELS[c])]) + extra
        return (got + _PRIOR * np.array(prior)) / (got.sum() + _PRIOR)

    m = {c: np.array(_START[c]) for c in names}
    u = {c: spread(0.2 * n, c, _APART[c], rest[c]) for c in names}
    guess = float(np.clip(0.8 * n.sum() / total, 1e-12, 0.5))
    share, post = guess, np.zeros(len(keys))
    for _ in range(turns):
        lm = np.log(share) + sum(np.log(m[c][at[:, i]]) for i, c in enumerate(names))
        lu = np.log(1 - share) + sum(np.log(u[c][at[:, i]]) for i, c in enumerate(names))
        new = np.where(possible, 1 / (1 + np.exp(np.clip(lu - lm, -700, 700))), 0.0)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
        share = float(np.clip(((n * post).sum() + _PRIOR * guess) / (total + _PRIOR), 1e-15, 0.999999))
        for c in names:
            m[c], u[c] = spread(n * post, c, _START[c]), spread(n * (1 - post), c, _APART[c], rest[c])
    return dict(zip(keys, post.tolist(), strict=True))


def _agreement(u: DataFrame, v: DataFrame, left: list[Column], right: list[Column]) -> float:
    """How many of all pairs agree in these values: a join of counts, not of rows."""
    a = u.select(*[c.alias(f"x{i}") for i, c in enumerate(left)]).groupBy(*[f"x{i}" for i in range(len(left))]).agg(F.count(F.lit(1)).alias("a"))
    b = v.select(*[c.alias(f"x{i}") for i, c in enumerate(right)]).groupBy(*[f"x{i}" for i in range(len(right))]).agg(F.count(F.lit(1)).alias("b"))
    return float(a.join(b, [f"x{i}" for i in range(len(left))]).agg(F.sum(F.col("a").cast("double") * F.col("b"))).first()[0] or 0.0)


def _apart(u: DataFrame, v: DataFrame) -> tuple[float, dict[str, list[float]]]:
    """Number of all pairs, and how pairs met at random show each level (names and registry numbers don't agree)."""
    c = u.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(x) == "").alias(x) for x in ("cas", "unit", "comp")]).first()
    d = v.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("all_cas") == 0).alias("cas"), F.count_if(F.size("units") == 0).alias("unit")).first()
    every = float(c.n) * d.n
    if not every:
        return 0.0, {}
    no_cas, no_unit, no_comp = 1 - (1 - c.cas / c.n) * (1 - d.cas / d.n), 1 - (1 - c.unit / c.n) * (1 - d.unit / d.n), c.comp / c.n
    variant = _agreement(u, v, [F.col("locant"), F.col("tail")], [F.col("locant"), F.col("tail")]) / every
    unit = _agreement(u, v, [F.col("unit")], [F.explode("units")]) / every
    comp = _agreement(u, v, [F.col("comp")], [F.explode("comps")]) / every
    return every, {
        "l_name": [1.0, 0.0, 0.0, 0.0, 0.0], "l_variant": [0.0, 1 - variant, variant], "l_cas": [1 - no_cas, no_cas, 0.0, 0.0],
        "l_unit": [max(0.0, 1 - no_unit - unit), no_unit, unit], "l_comp": [max(0.0, 1 - no_comp - comp), no_comp, comp],
    }


def _candidates(source: DataFrame, catalog: DataFrame, context_list: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Source rows with signatures, their distinct signatures, catalogue rows with substances, and graded candidate pairs."""
    spark = source.sparkSession
    contexts = list(shards_of(context_list, "ref_id", "target_context", "ef_categories"))
    # qualifiers: what stands after the first word, most frequent first
    tail = F.regexp_replace(F.regexp_replace(F.lower("n"), r"^[\d\W_]*[\p{L}]+", ""), r"[^\p{L}]+", " ")
    both = catalog.select(F.col("name").alias("n")).unionByName(catalog.select(F.explode("synonyms").alias("n")))
    found = both.select(F.trim(tail).alias("tail")).where("tail <> ''").groupBy("tail").count().orderBy(F.desc("count"), "tail").limit(QUALIFIERS + 1).collect()
    if len(found) > QUALIFIERS:
        raise ValueError(f"more than {QUALIFIERS} qualifiers")
    shared = spark.sparkContext.broadcast(([r.tail for r in found], contexts))

    rows = catalog.where("code is not null").select("name", "cas", "unit", F.col("categories").alias("cats"), "db", "code", F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"))
    cat = _standardised(rows, shared, "db string, code string, synonyms array<string>")
    cat = checkpointed(cat.withColumn("vid", F.xxhash64("locant", "stem", "tail")))
    src = _standardised(source.where("source_id is not null").select("name", "cas", "unit", "cats", F.col("source_id").cast("long").alias("source_id")), shared, "source_id long")
    src = checkpointed(src.withColumn("sig", F.xxhash64("locant", "stem", "tail", "cas", "unit", "comp")))

    u = src.select("sig", "locant", "stem", "tail", "cas", "unit", "comp").distinct()
    v = cat.groupBy("vid").agg(F.first("locant").alias("locant"), F.first("stem").alias("stem"), F.first("tail").alias("tail"), *[F.array_remove(F.collect_set(c), "").alias(a) for c, a in (("cas", "all_cas"), ("unit", "units"), ("comp", "comps"))])
    # every name of a substance: its own and its synonyms
    syn = _standardised(cat.select(F.explode("synonyms").alias("name"), "vid").distinct().select("name", F.lit("").alias("cas"), F.lit("").alias("unit"), F.array().cast("array<string>").alias("cats"), "vid"), shared, "vid long")
    names = checkpointed(v.select("vid", "locant", "stem", "tail").unionByName(syn.select("vid", "locant", "stem", "tail")).distinct().where("stem <> ''"))

    def met(who: DataFrame, of_name, of_text) -> DataFrame:
        """nid and vid of the texts and names that share a key and are no more than two slips (or two swaps) apart."""
        key = lambda c: F.xxhash64("locant", "tail", c)
        them = names.select("vid", F.col("locant").alias("vl"), F.col("stem").alias("vs"), F.col("tail").alias("vt"), F.explode(of_name(F.col("stem"))).alias("k"))
        them = them.select("vid", "vs", F.xxhash64("vl", "vt", "k").alias("k"))
        us = who.select("nid", "locant", "stem", "tail", F.explode(of_text(F.col("stem"))).alias("k")).select("nid", "stem", key("k").alias("k"))
        slips = _slips(F.col("stem"), F.col("vs"))
        swapped = (slips <= 4) & (F.array_sort(F.split("stem", "")) == F.array_sort(F.split("vs", "")))
        hit = us.join(them, "k").where((slips <= 2) | swapped | ((slips == 3) & _one_beside_a_swap(F.col("stem"), F.col("vs"))))
        return hit.select("nid", "vid", "vs").distinct()

    # pass 1: names and synonyms, slips of one letter (or two swapped) in the stem; pass 2: two slips, for names that
    # no name or synonym equals; pass 3: the same registry number
    called = checkpointed(u.where("stem <> ''").select("locant", "stem", "tail").distinct().withColumn("nid", F.xxhash64("locant", "stem", "tail")))
    once = checkpointed(met(called, _one_slip, _one_slip))
    exact = once.join(called.select("nid", F.col("stem").alias("vs")), ["nid", "vs"], "left_semi").select("nid").distinct()
    open_ = called.join(exact, "nid", "left_anti")
    n = F.length("stem")
    empty = F.array().cast("array<string>")
    some = lambda f, when: lambda stem: F.when(when(F.length(stem)), f(stem)).otherwise(empty)
    halves = met(open_.where((n >= 6) & (n < LONG_STEM + 2)), some(_halves, lambda n: (n >= 4) & (n < LONG_STEM + 2)), _half_probes)
    pieces = met(open_.where(n >= LONG_STEM - 2), some(_piece_keys, lambda n: n >= LONG_STEM - 2), _piece_probes)
    near = once.unionByName(halves).unionByName(pieces).distinct()
    by_name = called.select("nid", "locant", "stem", "tail").join(near, "nid").select("locant", "stem", "tail", "vid", F.col("locant").alias("vl"), "vs", F.col("tail").alias("vt"))
    by_name = u.select("sig", "locant", "stem", "tail").join(by_name, ["locant", "stem", "tail"]).select("sig", "vid", "vl", "vs", "vt")
    own = v.select("vid", F.explode("all_cas").alias("cas"))
    by_cas = u.where("cas <> ''").select("sig", "cas").join(own, "cas").join(v.select("vid", F.col("locant").alias("vl"), F.col("stem").alias("vs"), F.col("tail").alias("vt")), "vid")
    pairs = by_name.unionByName(by_cas.select("sig", "vid", "vl", "vs", "vt")).distinct()
    scored = pairs.join(u, "sig").join(v.drop("locant", "stem", "tail"), "vid")
    side = F.struct("locant", "stem", "tail", "cas", "unit", "comp").alias("u")
    other = F.struct(F.col("vl").alias("locant"), F.col("vs").alias("stem"), F.col("vt").alias("tail"), "all_cas", "units", "comps").alias("v")
    scored = scored.select("sig", "vid", side, other).select("sig", "vid", *[c.cast("int").alias(n) for n, c in _levels().items()])
    scored = checkpointed(scored)
    counts = {tuple(r[c] for c in LEVELS): r["count"] for r in scored.groupBy(*LEVELS).count().collect()}  # at most 540 patterns
    every, apart = _apart(u, v)
    learned = learn_weights(counts, apart, max(0.0, every - sum(counts.values())))
    weights = spark.createDataFrame([(*k, w) for k, w in learned.items()], ", ".join(f"{c} int" for c in LEVELS) + ", confidence double")
    scored = scored.join(F.broadcast(weights), list(LEVELS)).where((F.col("confidence") >= CONFIDENCE) & (F.col("l_variant") > 0))
    best = scored.groupBy("sig", "vid").agg(F.max(F.struct("confidence", "l_name", "l_cas", "l_comp")).alias("s"))
    top = best.groupBy("sig").agg(F.max("s").alias("top"))
    best = best.join(top, "sig").where("s = top").withColumn("confidence", F.col("top.confidence"))
    single = v.select("vid", F.when(F.size("comps") == 1, F.col("comps")[0]).alias("only"))
    return src, u.select("sig", "comp"), cat, best.select("sig", "vid", "confidence").join(single, "vid")


def _rows(src: DataFrame, u: DataFrame, cat: DataFrame, best: DataFrame) -> DataFrame:
    """Signatures meet the catalogue rows; the source rows, of which one signature may have very many, are joined last."""
    hits = u.join(best, "sig")
    hits = hits.withColumn("comp", F.when(F.col("comp") == "", F.col("only")).otherwise(F.col("comp")))
    hits = hits.join(cat.select("vid", "comp", "db", "code").distinct(), ["vid", "comp"]).select("sig", "db", "code", "confidence")
    return src.select("source_id", "sig").distinct().join(hits, "sig").select("source_id", "db", "code", "confidence")


def linked(source: DataFrame, catalog: DataFrame, context_list: DataFrame) -> DataFrame:
    """source_id, db, code, confidence: each catalogue row of the flow that a source record describes.

    source: source_id, name, cats, unit, cas. catalog: db, code, name, categories, unit, cas, synonyms. A flow
    in several databases gives a row for each. A record without categories belongs to the compartment of its
    substance if that has only one. Locant and qualifier must be the same unless the name is another one
    altogether. Where several substances are equally likely nothing can be said, and no row is given here:
    `undecided` gives them. Null or empty names match by registry number only. Repeated rows give their row once; an
    empty table on either side gives none. Names of any length and any number of compartments take part.
    """
    src, u, cat, best = _candidates(source, catalog, context_list)
    alone = best.groupBy("sig").agg(F.count(F.lit(1)).alias("_n"), F.min("vid").alias("vid"), F.min("confidence").alias("confidence"), F.min("only").alias("only")).where("_n = 1").drop("_n")
    return _rows(src, u, cat, alone)


def undecided(source: DataFrame, catalog: DataFrame, context_list: DataFrame) -> DataFrame:
    """source_id, db, code, confidence of the catalogue rows between which `linked` can't decide: equally likely substances."""
    src, u, cat, best = _candidates(source, catalog, context_list)
    several = best.groupBy("sig").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("sig")
    return _rows(src, u, cat, best.join(several, "sig", "left_semi"))
