"""Copies, typed values and linkage, against brute force, held-out truth and awkward rows."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.llm import copies, linkage, valuemap

RECORDS = "record_id long, inventory string, name string, categories array<string>"


def _key(r):
    plain = lambda s: " ".join(re.findall(r"[^\W_]+", s.lower()))
    parts = sorted(p for p in (plain(x) for x in re.split(r"[,;|/]", r[2] or "")) if p)
    return r[1], tuple(parts), tuple(sorted(p for p in (plain(x or "") for x in r[3] or []) if p))


@pytest.mark.parametrize("least", [2_000, 3])
def test_copies_against_brute_force(spark, rows, monkeypatch, least):
    monkeypatch.setattr(copies, "HOT_ROWS", least)  # 3: hot keys take the salted path
    rng = random.Random(4)
    names = ["Zinc, ion", "ION;  zinc", "zinc ion", "zinc|ion*", "Lead", None, "", "é, É", "a_b, c"]
    cats = [["air", "Urban"], ["urban ", "AIR"], ["air/urban"], [], None, ["air", None]]
    data = [(i, rng.choice(["i1", "i2", None]), "Zinc, ion" if rng.random() < 0.4 else rng.choice(names), rng.choice(cats)) for i in rng.sample(range(1000), 150)]
    first: dict = {}
    for r in data:
        first[_key(r)] = min(first.get(_key(r), 10**9), r[0])
    want = sorted((first[_key(r)], r[0]) for r in data if r[0] != first[_key(r)])
    df = spark.createDataFrame([*data, *data[:20], (None, "i1", "x", [])], RECORDS).withColumn("k1", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("hot", F.lit(True))
    assert rows(copies.later_copies(df)) == sorted(want, key=lambda t: tuple((True, str(x)) for x in t))
    counts = dict(rows(copies.copy_counts(df)))
    assert counts == {f: sum(1 for r in data if first[_key(r)] == f) for f in set(first.values())}


def test_no_copies_in_empty_tables(spark, rows):
    df = spark.createDataFrame([], RECORDS)
    assert rows(copies.later_copies(df)) == [] and rows(copies.copy_counts(df)) == []


WORD = st.text("abc", max_size=5)


@given(WORD, WORD, WORD)
@settings(max_examples=300, deadline=None)
def test_edits_is_a_metric(a, b, c):
    assert valuemap.edits(a, b) == valuemap.edits(b, a)
    assert (valuemap.edits(a, b) == 0) == (a == b)
    assert valuemap.edits(a, c) <= valuemap.edits(a, b) + valuemap.edits(b, c)


WORDS = st.lists(st.text("ab", min_size=1, max_size=3), max_size=3).map(tuple)


@given(WORDS, WORDS, WORDS)
@settings(max_examples=200, deadline=None)
def test_assignment_is_a_metric(a, b, c):
    d = lambda x, y: valuemap.assignment(x, y)[0]
    assert d(a, b) == d(b, a)
    assert d(a, c) <= d(a, b) + d(b, c)
    best = min(sum(valuemap.edits(x, y) for x, y in zip(p, [*b] + [""] * max(0, len(a) - len(b)), strict=True)) for p in itertools.permutations([*a] + [""] * max(0, len(b) - len(a))))
    assert d(a, b) == best


@given(st.lists(WORDS, min_size=1, max_size=25), WORDS, st.integers(0, 4))
@settings(max_examples=150, deadline=None)
def test_tree_finds_every_entry_within(entries, asked, radius):
    tree = valuemap.BKTree((e, i) for i, e in enumerate(entries))
    got = {i for _, _, ids in tree.within(asked, radius) for i in ids}
    assert got == {i for i, e in enumerate(entries) if valuemap.assignment(asked, e)[0] <= radius}


CONTEXTS = [(1, ["air"], ["Emissions", "Emissions to air", "Emissions to air, not specified"]), (2, ["air", "tall chimney"], ["Emissions", "Emissions to air", "Emissions to air from tall chimneys"]), (3, ["air", "open country, ground level"], None), (4, ["air", "near settlements, ground level"], None), (5, ["water"], None), (6, ["water", "salt sea"], None), (7, ["natural resource", "out of water"], None), (8, ["natural resource", "sea bed"], None)]


@pytest.mark.parametrize(
    ("path", "want"),
    [
        (["Air", "tall chimn."], 2), (["AIR", "chimney, tall"], 2), (["Emisions to air", "tal chimney [sheet 2]"], 2), (["Airborne emissions / tall chimney *"], 2),
        (["Emissions", "Emissions to air", "Emissions to air from tall chimneys"], 2), (["air", "(unspecified)"], 1), (["air", "n.s."], 1), (["air", ""], 1), (["air"], 1), (["air", None], 1),
        (["air", "open ctry., ground"], 3), (["air", "ground level, near settlements"], 4), (["air", "ground level"], 0), (["Raw", "water"], 7), (["water", "sea"], 6), (["Resources", "sea bed"], 8),
        (["airless void", "x"], 0), (["air", "ship funnel"], 0), (["waste"], 0), (["soil", "salt sea"], 0), ([], 0), (None, 0), ([None], 0), (["x" * 100_000], 0), (["air", "y" * 100_000], 0), (["air", "tall " * 5000], 0),
    ],
)
def test_contexts(path, want):
    hit = valuemap.ContextMatcher(CONTEXTS).find(path)
    assert (hit[1] if hit else 0) == want


FLOWS = [(11, "Occupation, walled heath"), (12, "Occupation, coppiced dyke"), (13, "Transformation, from walled heath"), (14, "Transformation, to walled heath"), (15, "Water, cooling, stream"), (16, "Water, process steam, stream")]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("occ., walled heath", 11), ("walled heaths, Occpuation", 11), ("Land occupation walled heath (adapted)", 11), ("Occupation, coppiced heath", 0), ("Transf., frmo walled heath", 13), ("transformation, too walled heath", 14),
        ("Wtr, cooling, stream", 15), ("Water resource, coolng, straem", 15), ("Water, proc. steam, stream", 16), ("stream, Water, cooling", 15), ("???", 0), ("", 0), (None, 0), ("test row", 0), ("Occupation, lit ski slope", 0), ("w" * 200_000, 0),
    ],
)
def test_flows(value, want):
    hit = valuemap.FlowMatcher(FLOWS).find(value)
    assert (hit[1] if hit else 0) == want


def test_every_reading_counts():
    """Abbreviations with many readings and values of many words, against trying all readings."""
    many = [f"st{c}rm" for c in "abcdefghij"]
    m = valuemap.Matcher([(i, (w, "field")) for i, w in enumerate(many)] + [(50, ("st" + "z" + "rm", "meadow"))])
    assert m.nearest(["st.", "meadow"]) == (0, 50)
    assert m.nearest(["st.", "medow"]) == (1, 50)
    assert m.nearest(["st.", "field"]) is None
    long = tuple(f"word{c}{c}" for c in "abcdefghijklm")
    assert valuemap.Matcher([(1, (*long, "stone")), (2, ("sand", "soil"))]).nearest([*long, "st."]) == (0, 1)
    assert valuemap.Matcher([(1, (*long, "stone")), (2, (*long, "sand"))]).nearest([*long, "stn."]) == (0, 1)
    m = valuemap.Matcher([(1, (*long, "stain")), (2, ("sain", "soil"))])
    assert m.nearest([*long, "sn."]) == (0, 1)  # 'sain' is the first reading
    rng = random.Random(4)
    stems = ["sand", "soil", "silt", "salt", "sedge", "swamp", "shore", "slope", "stone", "spring"]
    m = valuemap.Matcher([(i, tuple(rng.choices(stems, k=3))) for i in range(60)])
    for _ in range(60):
        tokens = [rng.choice(["s.", "sl.", "sd.", "sp.", "sil", "sandd", "stone"]) for _ in range(3)]
        options = [m.lexicon.readings(t) for t in tokens]
        best: dict[int, int] = {}
        for words in itertools.product(*options):
            for d, entry, ids in m.tree.within(words, valuemap.RADIUS):
                if valuemap.accepted(valuemap.assignment(words, entry)[1], len(valuemap.assignment(words, entry)[1]) < len(entry)):
                    best |= {i: min(best.get(i, d), d) for i in ids}
        near = [i for i, d in best.items() if d == min(best.values())]
        assert m.nearest(tokens) == ((min(best.values()), near[0]) if len(near) == 1 else None)


def test_typed_values_and_shards(spark, rows, monkeypatch):
    c = spark.createDataFrame([(1, ["Air", "tall chimn."]), (1, ["Air", "tall chimn."]), (2, None), (3, ["air", "x"])], "rule_id long, source_context array<string>").withColumn("value", F.lit(1)).withColumn("d", F.lit(2))
    f = spark.createDataFrame([(1, "occ., walled heath"), (2, None), (None, "x")], "synonym_id long, simapro string")
    cl = spark.createDataFrame(CONTEXTS, "ref_id long, target_context array<string>, ef_categories array<string>")
    fl = spark.createDataFrame(FLOWS, "ref_id long, flow string")
    want = [("simapro", 1, 11), ("simapro", 2, 0), ("source_context", 1, 2), ("source_context", 2, 0), ("source_context", 3, 0)]
    assert rows(valuemap.typed_values(c, f, cl, fl)) == want
    monkeypatch.setattr(valuemap, "SHARD_ENTRIES", 2)
    assert len(list(valuemap.shards_of(fl, "ref_id", "flow"))) == 3
    assert rows(valuemap.typed_values(c.limit(0), f, cl, fl)) == want[:2]
    assert rows(valuemap.typed_values(c, f.limit(0), cl.limit(0), fl.limit(0))) == [("source_context", i, 0) for i in (1, 2, 3)]


SOURCE = "source_id long, name string, cats array<string>, unit string, cas string"
CATALOG = "db string, code string, name string, categories array<string>, unit string, cas string, synonyms array<string>"


def _syllables(rng, n=4):
    return "".join(rng.choice(["tra", "bei", "mol", "ste", "kru", "vin", "dau", "lop", "gri", "fex", "nau", "zil"]) for _ in range(n))


def test_linkage_on_held_out_truth(spark, rows):
    rng = random.Random(9)
    places = [["air", "tall chimney"], ["water", "salt sea"], ["air"]]
    tails = ["", "", "", ", ion", ", fossil", " oxide"]
    subs = []
    for i in range(250):
        locant = f"{rng.randrange(1, 9)}-" if rng.random() < 0.4 else ""
        subs.append((locant + _syllables(rng), rng.choice(tails), f"{100000 + 7 * i}-{i % 90 + 10}-{i % 9}", rng.choice(["kg", "m3"]), f"Syn{_syllables(rng)}" if rng.random() < 0.3 else None))
    cat, where = [], {}
    for i, (stem, tail, cas, unit, syn) in enumerate(subs):
        for p in rng.sample(places, rng.randrange(1, 3)):
            for db in rng.sample(["A", "B"], rng.randrange(1, 3)):
                code = f"{i}-{len(cat)}"
                cat.append((db, code, (stem + tail) if db == "A" else (stem + tail).capitalize(), p, unit, cas if rng.random() < 0.7 else None, [syn] if syn else []))
                where.setdefault((i, tuple(p)), set()).add((db, code))
    src, truth = [], set()
    for sid in range(600):
        i = rng.randrange(len(subs))
        stem, tail, cas, unit, syn = subs[i]
        p = rng.choice(places)
        name, roll = stem, rng.random()
        if roll < 0.3:
            at = rng.randrange(3, len(stem) - 1)
            name = stem[:at] + stem[at + 1 :]
        elif roll < 0.4:
            name = stem.upper()
        given = syn if syn and rng.random() < 0.2 else name + tail + rng.choice(["", "", " *", ", at plant"])
        src.append((sid, given, [p[0].upper(), *p[1:]], unit if rng.random() < 0.9 else None, rng.choice([cas, cas.replace("-", ""), None, None])))
        truth |= {(sid, *x) for x in where.get((i, tuple(p)), ())}
    src += [(1000 + k, "9-" + _syllables(rng, 5) + ", ion", ["air"], "kg", None) for k in range(40)]
    cl = spark.createDataFrame(CONTEXTS, "ref_id long, target_context array<string>, ef_categories array<string>")
    out = linkage.linked(spark.createDataFrame(src, SOURCE).withColumn("k", F.lit(1)).withColumn("vid", F.lit(2)), spark.createDataFrame(cat, CATALOG), cl)
    got = {(r.source_id, r.db, r.code) for r in out.collect()}
    hit = len(got & truth)
    assert hit / len(got) > 0.95 and hit / len(truth) > 0.9
    assert all(linkage.CONFIDENCE <= r.confidence <= 1 for r in out.collect())


def test_linkage_of_awkward_rows(spark, rows):
    cl = spark.createDataFrame(CONTEXTS, "ref_id long, target_context array<string>, ef_categories array<string>")
    cat = spark.createDataFrame([("A", "c1", "Zinctrioxal", ["air"], "kg", "1-1", None), ("B", "c2", "zinctrioxal", ["air"], "kg", None, []), ("A", "c3", "Leadtrioxal", ["air"], "kg", None, []), ("A", "c4", "Leadtrioxal", ["water"], "kg", None, []), ("A", None, "x", None, None, None, None), ("A", "c5", None, None, None, None, None)], CATALOG)
    src = spark.createDataFrame([(1, "zinctrioxal", None, None, None), (1, "zinctrioxal", None, None, None), (2, "leadtrioxal", [], "kg", None), (3, None, None, None, None), (4, "", ["air"], "", ""), (5, "q" * 50_000, ["air"], "kg", None), (6, "Zinctrioxal", ["water"], "kg", None), (None, "zinctrioxal", ["air"], "kg", None)], SOURCE)
    got = rows(linkage.linked(src, cat, cl), "source_id", "db", "code")
    assert got == [(1, "A", "c1"), (1, "B", "c2")]
    assert rows(linkage.linked(src.limit(0), cat, cl)) == []
    assert rows(linkage.linked(src, cat.limit(0), cl)) == []


def test_names_are_split():
    s = linkage.Standard(["ion", "in spray", "residue", "unrefined ore"])
    assert s.split("3 Fluoxal, dissolved") == ("3", "fluoxal", "dissolved")
    assert s.split("Teidol - iom *") == ("", "teidol", "ion")
    assert s.split("in spray, Dauxal") == ("", "dauxal", "in spray")
    assert s.split("Kluxal resiidue, at plant {GLX}") == ("", "kluxal", "residue")
    assert s.split("Kluxal resid.") == ("", "kluxal", "residue") and s.split("Kluxal - un.")[2] == "unrefined ore" and s.split("Kluxal i")[2] == "i"
    assert s.split(None) == ("", "", "")
    assert linkage.cas_digits("CAS 0012-3 4") == "1234" and linkage.unit_kind(" M³ ") == "m3"


def _slipped(rng, name, slips):
    for _ in range(slips):
        i = rng.randrange(1, len(name) - 1)
        name = rng.choice([name[:i] + name[i + 1 :], name[:i] + "q" + name[i:], name[:i] + "z" + name[i + 1 :], name[:i] + name[i + 1] + name[i] + name[i + 2 :]])
    return name


@pytest.mark.parametrize("length", [6, 9, 14, 39, 41, 60, 150])
def test_keys_meet_every_pair_of_two_slips(spark, length):
    rng = random.Random(length)
    data = [(i, n, _slipped(rng, n, 1), _slipped(rng, n, 2)) for i in range(60) for n in ["".join(rng.choices("abcdefghij", k=length + rng.randrange(2)))]]
    df = spark.createDataFrame(data, "i long, n string, one string, two string")
    n = F.length("n")
    short = F.size(F.array_intersect(linkage._halves(F.col("n")), linkage._half_probes(F.col("two")))) > 0
    long = F.size(F.array_intersect(linkage._piece_keys(F.col("n")), linkage._piece_probes(F.col("two")))) > 0
    both = F.greatest(n, F.length("two"))
    assert df.where(~F.when(both >= linkage.LONG_STEM + 2, long).otherwise(short)).count() == 0
    single = F.size(F.array_intersect(linkage._one_slip(F.col("n")), linkage._one_slip(F.col("one")))) > 0
    assert df.where((F.greatest(n, F.length("one")) < linkage.LONG_STEM) & ~single).count() == 0


def test_linkage_beyond_earlier_bounds(spark, rows, monkeypatch):
    """More qualifiers than 300, a rare one mistyped; compartments of several shards; stems of 60 letters; ties reported."""
    monkeypatch.setattr(valuemap, "SHARD_ENTRIES", 2)
    rng = random.Random(8)
    word = lambda k: "".join(rng.choices("bcdfghjklmnprstv", k=k))
    cl = spark.createDataFrame([(i, ["air", p], None) for i, p in enumerate(("urban", "stratosphere", "tunnel", "forest"))], "ref_id long, target_context array<string>, ef_categories array<string>")
    tails = [word(8) for _ in range(400)]
    cat = [("d", f"c{i}", f"{word(9)} {t}", ["air", "forest"], "kg", None, []) for i, t in enumerate(tails)]
    long = word(60)
    cat.append(("d", "long", long, ["air", "tunnel"], "kg", None, []))
    cat += [("d", f"t{i}", n, ["air", "urban"], "kg", "50-00-0", []) for i, n in enumerate(("Mavelone", "Tuxerine"))]
    name = cat[399][2]
    src = [(1, name[:-3] + "x" + name[-2:], ["Air", "forest"], "kg", None), (2, long[:20] + long[21:40] + "e" + long[41:], ["air", "tunnel"], "kg", None), (3, "", ["air", "urban"], "kg", "50-00-0")]
    args = (spark.createDataFrame(src, SOURCE), spark.createDataFrame(cat, CATALOG), cl)
    assert rows(linkage.linked(*args), "source_id", "code") == [(1, "c399"), (2, "long")]
    assert rows(linkage.undecided(*args), "source_id", "code") == [(3, "t0"), (3, "t1")]
