"""Units, copies and orphan references, against brute force and on awkward rows."""

from __future__ import annotations

import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowloom.operators import copydiff, orphans, units

FLOWMAP = "entry_id long, package_id string, provenance string, source_name string, source_unit string, target_name string, target_unit string, conversion_factor double, note string"
UNITS = "conv_id long, source_unit string, target_unit string, multiplier double, provenance string"


def test_compositions_are_shortest_and_consistent():
    to = units.compose(units.EDGES, units.CANONICAL)
    assert to["kt"] == ("kg", units.Affine(1e6))
    assert to["MWh"][1].scale == pytest.approx(3600)
    assert set(units.SPELLINGS) <= set(to)


def test_affine_compositions_and_broken_cycles():
    edges = [("C", "K", units.Affine(1, 273.15)), ("F", "C", units.Affine(5 / 9, -160 / 9))]
    to = units.compose(edges, ["K"])
    assert to["F"][1].scale * 212 + to["F"][1].offset == pytest.approx(373.15)
    with pytest.raises(units.InconsistentCycle):
        units.compose([("a", "b", 2.0), ("b", "c", 3.0), ("a", "c", 7.0)], ["c"])
    with pytest.raises(ValueError):
        units.compose([("a", "b", 2.0)], ["a", "b"])


@pytest.mark.parametrize(
    ("source", "target", "note", "factor", "want"),
    [
        ("kt", "kg", None, 1e6, 1.0),
        ("100 kg", "kg", None, 100.0, 1.0),
        ("kg x 100", "g", None, 1e5, 1.0),
        ("kg (x100)", "Mg", None, 0.1, 1.0),
        ("[10^6 mg]", "KILOGRAM", None, 1.0, 1.0),
        ("Mj", "kJ.", None, 1000.0, 1.0),
        ("mg", "Mg", None, 1e-9, 1.0),
        ("Sm3", "hl", None, 10.0, 1.0),
        ("see note", "", "exprimé en g par 100 kg", 1e5, 1.0),
        ("n/a", "kg", "per tonne", 1000.0, 1.0),
        ("kWh", None, "résultat en megajoule", 3.6, 1.0),
        ("-", "-", "Factor gives g for each kg of the source flow.", 1000.0, 1.0),
        ("-", "?", "1 t of input counts as so many kg x 10", 100.0, 1.0),
        ("-", "kg", "older edition worked with kWh and tonnes", 1.0, None),
        ("stall place", "kg", None, 1.0, None),
        ("kg", "kg", None, None, None),
        ("kg", "kg", None, float("nan"), None),
        (None, None, None, 1.0, None),
        ("MG", "kg", None, 1.0, None),
        ("x" * 5000, "kg", "y" * 5000, 1.0, None),
    ],
)
def test_common_factor(spark, source, target, note, factor, want):
    df = spark.createDataFrame([(1, "p", "a", "s", source, "t", target, factor, note)], FLOWMAP)
    got = units.common_factors(df).first().common_factor
    assert got is None if want is None else got == pytest.approx(want, rel=1e-6)


def test_contradictions_against_all_pairs(spark, rows):
    rng = random.Random(3)
    data = [(i, rng.choice("ab") if rng.random() > 0.4 else "hot", rng.choice(["x", "y", None]), rng.choice([1.0, 1.005, 1.02, 5.0, -1.0, 0.0])) for i in range(120)]
    df = spark.createDataFrame(data + data[:5], "id long, k string, provenance string, common_factor double")
    want = set()
    for a, b in itertools.combinations(data, 2):
        if a[1] == b[1] and a[2] != b[2] and abs(a[3] - b[3]) > 0.01 * max(abs(a[3]), abs(b[3])):
            want.add((min(a[0], b[0]), max(a[0], b[0])))
    assert set(rows(units.contradictions(df, ["k"], "id"))) == want


def test_contradictions_of_nothing_and_of_clashing_columns(spark, rows):
    f = spark.createDataFrame([], FLOWMAP)
    u = spark.createDataFrame([(1, "kg", "g", 1000.0, "a"), (2, "Kg", "100 g", 10.0, "b"), (3, "kilogram", "gram", 100.0, "b"), (4, "g", "kg", 1000.0, "c")], UNITS)
    assert rows(units.contradicting_factors(f, u)) == [("unit_conversion", 1, 3)]  # 2 and 3 are of one provenance
    clash = u.withColumn("source_kind", F.lit("z")).withColumn("k", F.lit(1)).withColumn("v", F.lit(2))
    assert rows(units.contradicting_factors(f, clash)) == [("unit_conversion", 1, 3)]


COPY = "run_id string, method_slug string, code string, db string, name string, categories array<string>, cas string, sp_cf double, ef_cf double, sp_match_provenance string, sp_name string, sp_compartment string, sp_sub_compartment string"
FIELDS = ["db", "name", "categories", "cas", "sp_cf", "ef_cf", "sp_match_provenance", "sp_name", "sp_compartment", "sp_sub_compartment"]


def _norm(field, v):
    if field == "categories":
        return tuple((x or "").strip() for x in v) if v and any((x or "").strip() for x in v) else None
    if isinstance(v, float):
        return None if v != v else v
    return (v or "").strip() or None


def test_units_in_long_cells_and_notes(spark, rows):
    """Padding of any length, points without end, long texts that hold no unit: read or not, but in linear time."""
    pad = " " * 20_000
    data = [
        (1, "p", "a", "x", "t", "y", "kg", 1.0, None),
        (2, "p", "b", "x", f"{pad}t{pad}", "y", f"[kg]{pad}", 2.0, None),
        (3, "p", "c", "x", "-" + pad, "y", "kg", 3.0, f"per t{pad}."),
        (4, "p", "d", "x", "n/a", "y", "kg", 4.0, "Factor gives kg for each" + pad + "t" + "." * 20_000),
        (5, "p", "e", "x", "kg " * 20_000, "y", "kg", 5.0, None),
        (6, "p", "f", "x", "", "y", "kg", 6.0, "." * 50_000 + " per t " * 5_000),
        (7, "p", "g", "x", "kg" + "." * 50_000 + "x", "y", "kg", 7.0, None),
    ]
    got = units.common_factors(spark.createDataFrame(data, FLOWMAP))
    assert {r.entry_id: r.common_factor for r in got.collect()} == {1: 1e-3, 2: 2e-3, 3: 3e-3, 4: 4e-3, 5: None, 6: None, 7: None}


def test_contradictions_of_a_key_with_many_values(spark, rows, monkeypatch):
    monkeypatch.setattr(units, "SPLIT_CELLS", 7)
    rng = random.Random(2)
    data = [(i, "k", rng.choice("ab"), rng.choice([-1, 1]) * 1.02 ** rng.randrange(60)) for i in range(120)]
    df = spark.createDataFrame(data, "id long, k string, provenance string, common_factor double")
    want = sorted((a[0], b[0]) for a, b in itertools.combinations(data, 2) if a[2] != b[2] and abs(a[3] - b[3]) > 0.01 * max(abs(a[3]), abs(b[3])))
    assert sorted(rows(units.contradictions(df, ["k"], "id"))) == want


def _copy_rows(rng, n):
    text = lambda: rng.choice([None, "", " ", "a", "A", "b ", "\tb", "é "])
    number = lambda: rng.choice([None, float("nan"), 0.0, 1.0, 1.0 + 1e-8, 1.001, -1.0, 1e-300])
    return [("r" + str(rng.randrange(2)), rng.choice(["m", "n"]), f"{i:03d}", text(), text(), rng.choice([None, [], ["x"], ["x ", "y"], ["y", "x"], [None]]), text(), number(), number(), text(), text(), text(), text()) for i in range(n)]


def test_copy_differences_against_brute_force(spark, rows):
    rng = random.Random(11)
    left = _copy_rows(rng, 200)
    right = []
    for r in left:
        roll = rng.random()
        if roll < 0.1:
            continue
        r = list(r)
        if roll < 0.5:
            i = rng.randrange(3, 13)
            r[i] = _copy_rows(rng, 1)[0][i]
        r[2] = rng.choice([r[2], r[2] + " ", " " + r[2] + "\n"])
        right.append(tuple(r))
    right += _copy_rows(rng, 230)[210:]
    columns = [c.split()[0] for c in COPY.split(", ")]
    a = {(r[0], r[1], r[2].strip()): dict(zip(columns, r, strict=True)) for r in left}
    b = {(r[0], r[1], r[2].strip()): dict(zip(columns, r, strict=True)) for r in right}
    want = {(*k, "missing_in_copy") for k in a.keys() - b.keys()} | {(*k, "missing_in_join") for k in b.keys() - a.keys()}
    for k in a.keys() & b.keys():
        for f in FIELDS:
            x, y = _norm(f, a[k][f]), _norm(f, b[k][f])
            near = isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(abs(x), abs(y))
            if x != y and not near:
                want.add((*k, f))
    x = spark.createDataFrame(left + left[:30], COPY).withColumn("_h", F.lit(1)).withColumn("field_name", F.lit("z"))
    y = spark.createDataFrame(right[::-1], COPY).select(*columns[::-1])
    got = rows(copydiff.factor_copy_differences(x, y))
    assert len(got) == len(set(got))
    assert set(got) == want


def test_copy_differences_of_keys_with_several_contents(spark, rows):
    """Every content of one copy against every content of the other, as a join of the distinct rows does it."""
    rng = random.Random(3)
    near = lambda x, y: x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(abs(x), abs(y)))
    numbers = [({None, 5.0}, {5.0}), ({1.0, 2.0, 3.0}, {1.0, 3.0}), ({1.0, 2.0}, {1.0, 2.0}), ({None, 5.0}, {None, 5.0}), ({None}, {None}), ({1.0, 1.0 + 1e-8}, {1.0}), ({-1.0, 4.0}, {4.0})]
    texts = [({"a", "b"}, {"a", "b"}), ({"a", None}, {"a"}), ({"a", "b", "c"}, {"a", "c"}), ({"a "}, {"a"})]
    pick = lambda some: set(rng.sample(some, rng.randrange(1, 4)))
    numbers += [(pick([None, 0.0, 1.0, 1.0 + 1e-8, -1.0]), pick([None, 0.0, 1.0, 1.0 + 1e-8, -1.0])) for _ in range(40)]
    texts += [(pick([None, "a", "b"]), pick([None, "a", "b"])) for _ in range(40)]
    sides, want = ([], []), set()
    for field, at, cases in (("sp_cf", 7, numbers), ("ef_cf", 8, numbers), ("cas", 6, texts)):
        for i, case in enumerate(cases):
            for side, values in zip(sides, case, strict=True):
                for v in values:
                    r = ["r", field, f"{i:03d}", *[None] * 10]
                    r[at] = v
                    side.append(tuple(r))
            if any(not near(_norm(field, x), _norm(field, y)) for x in case[0] for y in case[1]):
                want.add(("r", field, f"{i:03d}", field))
    got = rows(copydiff.factor_copy_differences(spark.createDataFrame(sides[0], COPY), spark.createDataFrame(sides[1][::-1], COPY)))
    assert len(got) == len(set(got)) and set(got) == want and 40 < len(want) < len(numbers) * 2 + len(texts)


def test_copy_differences_of_empty_and_null_keys(spark, rows):
    one = spark.createDataFrame([(None, "m", None, *[None] * 10), (None, "m", None, *[None] * 10)], COPY)
    none = spark.createDataFrame([], COPY)
    assert rows(copydiff.factor_copy_differences(one, none)) == [(None, "m", None, "missing_in_copy")]
    assert rows(copydiff.factor_copy_differences(none, one)) == [(None, "m", None, "missing_in_join")]
    assert rows(copydiff.factor_copy_differences(one, one)) == []
    assert rows(copydiff.factor_copy_differences(none, none)) == []


def test_chunk_cuts_depend_on_nearby_keys_only():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**63, 2000).astype(np.uint64))
    cut = copydiff.chunk_starts(keys)
    less = copydiff.chunk_starts(np.delete(keys, 1000))
    assert 150 < cut.sum() < 400
    assert (cut[:1000] == less[:1000]).all()
    assert (cut[1000 + copydiff.WINDOW + 1 :] == less[1000 + copydiff.WINDOW :]).all()


def test_chunks_are_the_same_however_the_rows_are_batched():
    import numpy as np

    rng = np.random.default_rng(5)
    for trial in range(30):
        k = np.sort(rng.integers(0, 300 if trial % 2 else 2**63, rng.integers(1, 400)).astype(np.uint64))
        a, b = rng.integers(0, 2**63, (2, len(k))).astype(np.uint64)

        def chunks(cuts, k=k, a=a, b=b):
            c, got = copydiff._Chunks(), []
            for lo, hi in zip([0, *cuts], [*cuts, len(k)], strict=True):
                if hi > lo:
                    got.append(c.take(k[lo:hi], a[lo:hi], b[lo:hi]))
            got.append(c.rest())
            out = []
            for f1, f2, sizes, keys in got:
                at = np.r_[0, np.cumsum(sizes)]
                out += [(int(x), int(y), tuple(keys[i:j].tolist())) for x, y, i, j in zip(f1, f2, at[:-1], at[1:], strict=True)]
            return [x for x in out if x[2]]

        whole = chunks([])
        assert sum(len(x[2]) for x in whole) == len(np.unique(k))
        for _ in range(5):
            assert chunks(sorted(rng.integers(0, len(k), 6).tolist())) == whole


REFS = "row_id long, target_code string, target_db string, recorded_at timestamp"
CAT = "db string, code string, added_at timestamp"
DEL = "code string, deleted_at timestamp, kind string"


def day(n):
    return datetime(2024, 1 + n // 28, 1 + n % 28)


def test_orphans_against_brute_force(spark, rows):
    rng = random.Random(5)
    codes = [f"c{i}" for i in range(40)]
    cat = [(rng.choice(["A", "b", "c "]), c.upper() if rng.random() < 0.3 else c, day(rng.randrange(200))) for c in codes[:30]] + [("b", "c3", day(5)), (None, "c4", None)]
    gone = [(rng.choice(codes).upper(), day(rng.randrange(200)), "flow") for _ in range(8)] + [(None, day(1), "flow"), ("c1", None, "flow")]
    refs = [(i, "c2" if rng.random() < 0.4 else rng.choice([*codes, None, " ", "c7 ", "\tC9"]), rng.choice([None, "", "a", "B ", "z"]), None if rng.random() < 0.05 else day(rng.randrange(200))) for i in range(400)]
    fold = lambda s: (s or "").strip().lower() or None
    want = set()
    for i, c, d, at in refs:
        c, d = fold(c), fold(d)
        if c is None:
            continue
        hits = [x for x in cat if fold(x[1]) == c and (d is None or fold(x[0]) == d)]
        period = at and at.strftime("%Y-%m")
        if not hits:
            want.add(("t", i, "missing", period))
        if at and any(fold(g[0]) == c and g[1] and g[1] <= at for g in gone):
            want.add(("t", i, "deleted", period))
        if at and hits and min(x[2] or datetime(1900, 1, 1) for x in hits) > at:
            want.add(("t", i, "later", period))
    r = spark.createDataFrame(refs + refs[:50], REFS).withColumn("k1", F.lit("clash"))
    got = rows(orphans.orphan_references([("t", r)], spark.createDataFrame(cat, CAT), spark.createDataFrame(gone, DEL)))
    assert set(got) == want
    assert len(got) == len(want)


def test_orphans_of_empty_tables(spark, rows):
    refs = spark.createDataFrame([(1, "x", None, day(3))], REFS)
    cat, gone = spark.createDataFrame([], CAT), spark.createDataFrame([], DEL)
    assert rows(orphans.orphan_references([("t", refs), ("u", refs.limit(0))], cat, gone)) == [("t", 1, "missing", "2024-01")]
    assert rows(orphans.orphan_references([("t", refs.limit(0))], cat, gone)) == []
    months = orphans.orphans_by_month(orphans.orphan_references([("t", refs)], cat, gone))
    assert rows(months) == [("t", "2024-01", "missing", 1)]
