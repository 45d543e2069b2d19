"""The hand-computed systems: frames, matrices, solver, scores."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.operators import frame as fr
from flowloom.operators import graph, matrix, score, solve
from flowloom.schema import SchemaError, assert_schema

FRAME = "output_id long, input_id long, amount double, edge_type string, is_biosphere boolean"


@pytest.fixture(scope="module")
def chain(spark):
    """Wheat: 1 wheat, 0.5 steel in, 2 CO2; steel: 1 steel, 5 CO2."""
    data = [(201, 101, 1.0, "production", False), (201, 102, 0.5, "technosphere", False), (201, 301, 2.0, "biosphere", True), (202, 102, 1.0, "production", False), (202, 301, 5.0, "biosphere", True)]
    return spark.createDataFrame(data, FRAME)


def parts(spark, frame, cf=1.0):
    a, b = matrix.technosphere_matrix(frame), matrix.biosphere_matrix(frame)
    q = matrix.characterisation(spark.createDataFrame([("m", 301, cf), ("m", 999, 1.0)], "method string, flow_id long, cf double"), b)
    made = spark.createDataFrame([(101, 201), (102, 202)], "product_id long, activity_id long")
    want = spark.createDataFrame([(101, 101, 1.0), (102, 102, 1.0), (7, 7, 1.0)], "demand_id long, product_id long, amount double")
    return a, b, q, made, want


def test_chain(spark, rows, chain):
    a, b, q, made, want = parts(spark, chain)
    s = solve.supply(a, made, want)
    assert rows(s, "demand_id", "col_id", "supply") == [(101, 201, 1.0), (101, 202, 0.5), (102, 202, 1.0)]
    assert rows(score.scores(s, b, q)) == [(101, "m", 4.5), (102, "m", 5.0)]
    assert [r[3] for r in rows(score.activity_contributions(s, b, q).where("demand_id = 101"))] == [2.0, 2.5]
    for total in (score.flow_contributions(s, b, q), score.activity_contributions(s, b, q), score.edge_contributions(s, b, q)):
        assert total.where("demand_id = 101").agg(F.sum("contribution")).first()[0] == pytest.approx(4.5)
    assert rows(solve.unsolvable(a, made, want)) == [(7, "unknown product")]
    assert matrix.check_square(chain) == 2


def test_two_by_two(spark, rows):
    data = [(201, 101, 1.0, "production", False), (202, 102, 1.0, "production", False), (202, 101, 0.5, "technosphere", False), (201, 301, 2.0, "biosphere", True), (202, 301, 3.0, "biosphere", True)]
    f = spark.createDataFrame(data, FRAME)
    a, b, q, made, want = parts(spark, f, 10.0)
    s = solve.supply(a, made, want)
    assert rows(s, "demand_id", "col_id", "supply") == [(101, 201, 1.0), (102, 201, 0.5), (102, 202, 1.0)]
    c = spark.createDataFrame([("m", 201, 0.5)], "method string, col_id long, value double")
    assert rows(score.scores(s, b, q)) == [(101, "m", 20.0), (102, "m", 40.0)]
    assert rows(score.scores(s, b, q, c).where("demand_id = 101")) == [(101, "m", 20.5)]


def _system(spark, cells):
    a = spark.createDataFrame(cells, "row_id long, col_id long, value double")
    ids = sorted({c for _, c, _ in cells})
    return a, spark.createDataFrame([(i, i) for i in ids], "product_id long, activity_id long"), spark.createDataFrame([(i, i, 1.0) for i in ids], "demand_id long, product_id long, amount double")


def _dense(cells):
    ids = sorted({c for _, c, _ in cells})
    m = np.zeros((len(ids), len(ids)))
    for r, c, v in cells:
        m[ids.index(r), ids.index(c)] += v
    return ids, np.linalg.inv(m)


LOOPS = {
    "pair": [(10, 10, 1.0), (20, 20, 1.9), (20, 10, -0.5), (10, 20, -0.4)],
    "strong": [(1, 1, 1.0), (2, 2, 1.0), (2, 1, -0.97), (1, 2, -0.97)],
    "small": [(1, 1, 1.0), (2, 2, 1.0), (2, 1, -5e-13)],
    "several": [(i, i, 1.0 + i % 3) for i in range(12)] + [((i + 1) % 4, i, -0.6) for i in range(4)] + [(4 + (i + 2) % 3, 4 + i, -0.3) for i in range(3)] + [(2, 5, -1e-7), (11, 3, -2.0), (9, 8, -0.1), (5, 9, -3.0), (8, 11, 0.5)],
}


@pytest.mark.parametrize(("name", "way"), [*((n, "held") for n in LOOPS), ("several", "rounds"), ("strong", "krylov")])
def test_systems_with_cycles(spark, name, way, monkeypatch):
    cells = LOOPS[name]
    if way != "held":
        default = solve.recurrence
        monkeypatch.setattr(solve, "recurrence", lambda start, edges, dense: default(start, edges, 1 if way == "krylov" else dense, held=-1))
    a, made, want = _system(spark, cells)
    ids, inverse = _dense(cells)
    got = {(r.demand_id, r.col_id): r.supply for r in solve.supply(a, made, want).collect()}
    for j, d in enumerate(ids):
        for i, c in enumerate(ids):
            assert got.get((d, c), 0.0) == pytest.approx(inverse[i, j], rel=1e-8, abs=0 if name == "small" and way != "krylov" else 1e-13)
    x = spark.createDataFrame([("m", c, 1e15 if c == ids[-1] else 0.0) for c in ids], "method string, col_id long, x double")
    y = {r.product_id: r.score for r in solve.unit_scores(a, made, x).collect()}
    for j, d in enumerate(ids):
        assert y.get(d, 0.0) == pytest.approx(1e15 * inverse[-1, j], rel=1e-8, abs=0 if name == "small" and way != "krylov" else 100)


def test_a_graph_over_the_bound_never_comes_to_the_driver(spark, monkeypatch):
    start = spark.createDataFrame([("m", 1, 1.0)], "grp string, node long, x double")
    edges = spark.createDataFrame([(i, i + 1, 0.5) for i in range(1, 6)], "src long, dst long, w double")
    monkeypatch.setattr(type(edges), "toArrow", lambda df: pytest.fail("collected"))
    got = {r.node: r.x for r in solve.recurrence(start, edges, held=3).collect()}
    assert got == {i: 0.5 ** (i - 1) for i in range(1, 7)}


def test_components_are_inverted_many_at_once(spark, monkeypatch):
    from pyspark.sql import GroupedData

    monkeypatch.setattr(GroupedData, "applyInPandas", lambda *_: pytest.fail("a call for each component"))
    default = solve.recurrence
    monkeypatch.setattr(solve, "recurrence", lambda start, edges, dense: default(start, edges, dense, held=-1))
    pairs = [(n, m, -0.1 - (n % 5) / 10) for i in range(0, 60, 2) for n, m in ((i, i + 1), (i + 1, i))]
    ring = [(100 + i, 100 + (i + 1) % 5, -0.7) for i in range(5)]
    cells = [*((i, i, 1.0 + i % 3) for i in [*range(60), *range(100, 105)]), *pairs, *ring, (100, 7, -2.0), (9, 102, -1e-7)]
    a, made, want = _system(spark, cells)
    ids, inverse = _dense(cells)
    got = {(r.demand_id, r.col_id): r.supply for r in solve.supply(a, made, want).collect()}
    assert [got.get((d, c), 0.0) for d in ids for c in ids] == pytest.approx(inverse.T.ravel().tolist(), rel=1e-10, abs=1e-16)


def test_what_a_group_reaches_is_the_whole_solution():
    rng = np.random.default_rng(7)
    src, dst = rng.integers(0, 60, (2, 150))
    keep = src < dst
    src, dst = np.r_[src[keep], [1, 2, 3, *range(20, 30)]], np.r_[dst[keep], [0, 1, 1, *range(21, 30), 20]]  # two cycles
    pairs, w = np.unique(np.c_[src, dst], axis=0), None
    src, dst, w = pairs[:, 0], pairs[:, 1], rng.uniform(-0.3, 0.3, len(pairs))
    g = solve.Graph(src, dst, w, *graph.components_of(src, dst))
    n = len(g.nodes)
    x, met = np.zeros((n, 5)), np.zeros((n, 5), bool)
    node, of, v = np.array([0, 5, 20, 25, 25, n - 1]), np.array([0, 1, 2, 2, 3, 4]), np.arange(1.0, 7.0)
    x[node, of], met[node, of] = v, True
    g.solve(x, met)
    group, at, value = g.spread(of, node, v, 10**6)
    assert sorted(zip(group, at, strict=True)) == sorted((j, i) for i, j in np.argwhere(met))
    assert value == pytest.approx(x[at, group], rel=1e-12, abs=1e-15)
    assert g.spread(of, node, v, 10) is None


def test_a_share_that_nobody_asks_for_costs_no_join(spark, chain):
    _, b, q, *_ = parts(spark, chain)
    s = spark.createDataFrame([(101, 201, 1.0), (101, 202, 0.5)], "demand_id long, col_id long, supply double")
    c = score.activity_contributions(s, b, q)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_t#" in plan(c) and "_t#" not in plan(c.drop("share"))
    assert {r.col_id: round(r.share, 6) for r in c.collect()} == {201: 0.444444, 202: 0.555556}


@pytest.mark.parametrize("name", ["flow_contrib", "parity_check"])
def test_emissions_are_read_once_for_each_use(spark, tmp_path, name):
    from flowloom.plans import scoring

    for table, rows_, schema in (
        ("part", [(p, 1) for p in range(1, 5)], "p_partkey int, p_size int"), ("lineitem", [(1, 1, 1.0)], "l_partkey int, l_suppkey int, l_quantity double"),
        ("supplier", [(1, 1, 5.0)], "s_suppkey int, s_nationkey int, s_acctbal double"), ("nation", [(1, 1)], "n_nationkey int, n_regionkey int"),
    ):
        spark.createDataFrame(rows_, schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    plan = scoring.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_quantity#") and sum("Relation" in x and "l_suppkey#" in x for x in plan.splitlines()) == (1 if name == "flow_contrib" else 2)


def _asked(spark):
    """A system with a cycle, emissions of both signs (a cell in two rows), a flow of two methods, and two demands for a product."""
    cells = [*((i, i, 1.0 + i % 3) for i in range(9)), (1, 0, -0.4), (0, 1, -0.3), (2, 1, -0.5), (5, 2, 0.2), (6, 5, -2.0), (7, 5, -0.1), (3, 7, -1.0)]
    a, made, _ = _system(spark, cells)
    want = spark.createDataFrame([(100 + i, i % 9, 0.5 + i) for i in range(11)] + [(300, 77, 1.0)], "demand_id long, product_id long, amount double")
    b = spark.createDataFrame([(40 + (i * 7) % 5, i % 8, (i % 4 - 1.5) / 3) for i in range(30)] + [(49, 3, 2.0), (41, 99, 1.0)], "row_id long, col_id long, value double")
    q = spark.createDataFrame([("m", 40, 1.5), ("m", 41, -2.0), ("k", 41, 0.5), ("k", 43, 3.0), ("z", 43, 1.0), ("z", 48, 1.0)], "method string, row_id long, cf double")
    return a, made, want, b, q


def test_scores_by_inventory_shuffle_sums_only(spark, rows, monkeypatch):
    from flowloom.operators import flows

    a, made, want, b, q = _asked(spark)
    s = solve.supply(a, made, want)
    old = {(r.demand_id, r.method): r.score for r in score.scores(s, b, q).collect()}
    held, methods = flows.held(a, made, want), flows.methods_of(q)
    got = {(r.demand_id, r.method): (r.x, r.y) for r in flows.named(held.scores(b, q, methods), methods).collect()}
    assert got.keys() == old.keys()
    for key, pair in got.items():
        assert pair == (pytest.approx(old[key], rel=1e-9, abs=1e-12), pytest.approx(old[key], rel=1e-9, abs=1e-12))
    monkeypatch.setattr(flows, "HELD_SUMS", 0)  # sums are given out in parts
    assert {(r.demand_id, r.method) for r in flows.named(held.scores(b, q, methods), methods).collect()} == old.keys()
    monkeypatch.setattr(score, "inventory", lambda *_: pytest.fail("an inventory is shuffled"))
    n = {m: sum(k[1] == m for k in old) for m in methods}
    assert [r[:2] for r in rows(score.demand_parity(a, made, want, b, q))] == [(m, n[m]) for m in methods]


def test_flow_contributions_shuffle_no_inventory(spark, monkeypatch):
    a, made, want, b, q = _asked(spark)
    get = lambda df: {(r.demand_id, r.method, r.row_id): r[3:] for r in df.where("abs(contribution) > 1e-12").collect()}
    old = get(score.flow_contributions(solve.supply(a, made, want), b, q))
    monkeypatch.setattr(score, "inventory", lambda *_: pytest.fail("an inventory is shuffled"))
    got = get(score.demand_flow_contributions(a, made, want, b, q))
    assert got.keys() == old.keys()
    assert all(got[k] == pytest.approx(old[k], rel=1e-9, abs=1e-12) for k in old)


def test_a_cycle_that_nets_to_nothing_raises(spark):
    a, made, want = _system(spark, [(1, 1, 1.0), (2, 2, 1.0), (2, 1, -1.0), (1, 2, -1.0)])
    with pytest.raises(Exception, match="nets to nothing"):
        solve.supply(a, made, want).collect()


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=40))
@settings(max_examples=60, deadline=None)
def test_components_are_mutually_reachable(pairs):
    reach = np.eye(10, dtype=bool)
    for s, d in pairs:
        reach[s, d] = True
    for k in range(10):
        reach |= reach[:, [k]] & reach[[k], :]
    pairs = [p for p in pairs if p[0] != p[1]]
    n, c = graph.components_of(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64))
    want = {i: min(j for j in range(10) if reach[i, j] and reach[j, i]) for i in range(10) if any(j != i and reach[i, j] and reach[j, i] for j in range(10))}
    assert dict(zip(n.tolist(), c.tolist(), strict=True)) == want


def test_reachability_query_starts_from_every_part(spark, rows, tmp_path):
    from flowloom.plans import scoring

    spark.createDataFrame([(p, 1) for p in range(1, 31)], "p_partkey int, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 1, 1.0)], "l_partkey int, l_suppkey int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert sorted(rows(scoring.reachability(spark, str(tmp_path)), "start", "node")) == sorted((p, p >> k) for p in range(1, 31) for k in range(p.bit_length()))


def test_zero_production_gives_a_reason(spark, rows):
    f = spark.createDataFrame([(1, 10, 1.0, "production", False), (1, 10, 1.0, "technosphere", False)], FRAME)
    made = spark.createDataFrame([(10, 1)], "product_id long, activity_id long")
    want = spark.createDataFrame([(10, 10, 1.0)], "demand_id long, product_id long, amount double")
    a = matrix.technosphere_matrix(f)
    assert rows(solve.unsolvable(a, made, want)) == [(10, "nothing is made")]
    assert rows(solve.supply(a, made, want)) == []


def test_allocation(spark, rows):
    data = [(1, 10, 1.0, "production", False, 0.6), (1, 20, 1.0, "production", False, 0.4), (1, 30, 0.5, "technosphere", False, 1.0), (1, 99, 0.1, "biosphere", True, 1.0), (2, 40, 1.0, "production", False, 1.0), (3, 99, 1.0, "biosphere", True, 1.0)]
    f = spark.createDataFrame(data, FRAME + ", allocation_factor double")
    out, split = fr.allocate(f)
    assert split.count() == 2
    assert out.where("edge_type = 'technosphere'").agg(F.sum("amount")).first()[0] == pytest.approx(0.5)
    assert out.where("is_biosphere").agg(F.sum("amount")).first()[0] == pytest.approx(0.1)
    assert out.where("output_id = 3").count() == 0
    fr.check_allocation(f)
    for bad in (None, float("nan"), -1.0):
        broken = f.where("input_id <> 10").unionByName(spark.createDataFrame([(1, 10, 1.0, "production", False, bad)], f.schema))
        with pytest.raises(ValueError, match="can't be used"):
            fr.check_allocation(broken)


def test_self_loops(spark):
    for amount, kind, kept in ((1.0, "technosphere", False), (0.035, "technosphere", True), (1.2, "technosphere", False), (0.2, "substitution", False)):
        f = spark.createDataFrame([(1, 10, 1.0, "production", False), (1, 10, amount, kind, False)], FRAME)
        assert (fr.without_self_loops(f).count() == 2) is kept


def test_dangling(spark, rows):
    data = [(1, 10, 1.0, "production", False), (99, 999, 0.0, "production", False), (99, 50, 1.0, "technosphere", False), (1, 999, 1.0, "technosphere", False), (7, 301, 1.0, "biosphere", True)]
    f = spark.createDataFrame(data, FRAME)
    assert rows(fr.prune(f), "output_id", "input_id") == [(1, 10), (7, 301)]


def test_duplicate_producers(spark, rows):
    data = [(3, 10, 1.0, "production", False), (1, 10, 1.0, "production", False), (2, 10, 1.0, "production", False), (3, 5, 1.0, "technosphere", False), (5, 99, 1.0, "production", False)]
    assert rows(fr.one_producer(spark.createDataFrame(data, FRAME)), "output_id", "input_id") == [(1, 10), (5, 99)]


def test_regional_correction_and_gate(spark, rows):
    b = spark.createDataFrame([(301, 1, 1.0), (301, 2, 2.0)], "row_id long, col_id long, value double")
    q = spark.createDataFrame([("m", 301, 42.95)], "method string, row_id long, cf double")
    reg = spark.createDataFrame([("m", 301, "BR", 2.43), ("m", 301, "CY", 74.30)], "method string, flow_id long, location string, cf double")
    loc = spark.createDataFrame([(1, "BR"), (2, "CY")], "col_id long, location string")
    got = dict(r[1:] for r in rows(matrix.regional_correction(b, q, reg, loc)))
    assert got[1] == pytest.approx(2.43 - 42.95) and got[2] == pytest.approx((74.30 - 42.95) * 2)
    flows = spark.createDataFrame([(1, 1, 10.0), (1, 2, 5.0), (2, 2, 4.9), (2, 3, 10.0)], "row_id long, col_id long, value double")
    river, surface = spark.createDataFrame([(1,)], "row_id long"), spark.createDataFrame([(2,)], "row_id long")
    at = spark.createDataFrame([(1, "BR"), (2, "FR"), (3, "DE")], "col_id long, location string")
    local = spark.createDataFrame([("BR", 2.43), ("FR", 6.98)], "location string, cf double")
    assert rows(matrix.consumption_correction(flows, river, surface, at, local)) == [(1, pytest.approx(24.3))]
    assert rows(matrix.consumption_correction(flows, river, surface, at.where("col_id > 3"), local)) == [(1, pytest.approx(70.0))]


def test_empty_frame_and_schema(spark, rows):
    f = spark.createDataFrame([], FRAME)
    assert rows(fr.prune(f)) == [] and rows(matrix.technosphere_matrix(f)) == []
    assert_schema(f, "exchange_long")
    with pytest.raises(SchemaError):
        assert_schema(f.drop("amount"), "exchange_long")
    with pytest.raises(SchemaError):
        assert_schema(f.withColumn("edge_type", F.lit(1)), "exchange_long")
    with pytest.raises(matrix.NotSquareError):
        matrix.check_square(spark.createDataFrame([(1, 10, 1.0, "production", False), (1, 20, 1.0, "production", False)], FRAME))


def test_flatten_and_waste(spark, rows):
    nested = spark.createDataFrame([(1, [(10, 1.0, "production"), (None, 2.0, "technosphere"), (30, 3.0, None)])], "output_id long, exchanges array<struct<input_id:long,amount:double,edge_type:string>>")
    assert rows(fr.flatten(nested), "input_id", "edge_type", "allocation_factor") == [(10, "production", 1.0), (30, "technosphere", 1.0)]
    f = spark.createDataFrame([(1, 10, -1.0, "production", False), (2, 10, -3.0, "technosphere", False), (2, 20, 1.0, "production", False)], FRAME)
    assert rows(fr.positive_waste(f), "output_id", "amount") == [(1, 1.0), (2, 1.0), (2, 3.0)]
    bad = spark.createDataFrame([(1, 1, float("nan"), "production", False), (1, 1, None, "production", False)], FRAME)
    assert fr.not_numbers(bad).count() == 2
