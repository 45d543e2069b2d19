"""Inventories of many demands by the transposed system: one right side for each flow, not one for each demand.

What one unit of every product has of a flow is one recurrence along the graph of consumption, which each worker holds.
So emissions are shuffled once, by flow, and the inventory of all demands, many times the tables, is formed where it is
used: it is summed up or given out by the task that forms it, and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.operators.solve import DENSE, HELD_EDGES, Graph, _counted, _fetched, _parts, _Shared, _slices, _solved, _whole
from flowloom.session import checkpointed, parallelism

#: Nodes whose sums travel together.
_BLOCK = 8192
#: Rows of inventories that a worker forms at once.
_ROWS = 400_000
#: Rows of a batch that is given out.
_OUT = 250_000
#: Cells of the largest table of sums (nodes by methods) that workers hold (8 bytes each).
HELD_SUMS = 20_000_000

_systems: dict[int, tuple] = {}


def _here(shared: _Shared) -> tuple:
    """The worker's graph, ordered once, with what the nodes make and the demands for them."""
    if shared.id not in _systems:
        _systems.clear()
        graph, act, made, first, demand, amount = shared.value
        _systems[shared.id] = Graph(*graph, act), made, first, demand, amount
    return _systems[shared.id]


def held(a: DataFrame, producers: DataFrame, demands: DataFrame, dense: int = DENSE, most: int = HELD_EDGES) -> Flows | None:
    """The transposed system in each worker; None if it is larger than `most` edges, activities or demands, if a component has more
    than `dense` nodes, if products and activities are not one to one, or if a demand is for several products."""
    diagonal, used = _parts(a, producers, cut=True)
    wanted = checkpointed(demands.join(diagonal, "product_id").select("demand_id", "activity_id", "amount"))
    n = diagonal.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("p"), F.count_distinct("activity_id").alias("a")).first()
    d = wanted.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("demand_id").alias("d")).first()
    if not n.n == n.p == n.a or d.n != d.d or max(n.n, d.n) > most:
        return None
    edges, size = _counted(used.select(F.col("giver").alias("src"), F.col("user").alias("dst"), (F.col("amount") / F.col("made")).alias("w")))
    if size > most or (graph := _fetched(edges, dense)) is None:
        return None
    table = diagonal.select("activity_id", "made").toArrow()
    act, made = table["activity_id"].to_numpy(), table["made"].to_numpy()
    order = np.argsort(act)
    act, made = act[order], made[order]
    table = wanted.toArrow()
    at = np.searchsorted(act, table["activity_id"].to_numpy())
    order = np.argsort(at, kind="stable")
    demand, amount = table["demand_id"].to_numpy()[order], table["amount"].to_numpy()[order]
    first = np.searchsorted(at[order], np.arange(len(act) + 1))
    spark = a.sparkSession
    return Flows(spark, _Shared(spark.sparkContext.broadcast((graph, act, made, first, demand, amount))), len(act), demands.schema["demand_id"].dataType.simpleString())


def _chunks(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[tuple]:
    """Flow, node, emission for a unit of the node's product, and the factors (flow in order, method, factor), of many flows at a time.

    Rows of a flow (grp): its emissions (m = -1, node, x) and its factors (m, x). Flows without a factor and activities
    that make nothing are left out.
    """
    graph, made, *_ = _here(shared)
    nodes = graph.nodes
    for g, m, node, x in _whole(batches, ("grp", "m", "node", "x")):
        f = m >= 0
        gf, mf, cf = g[f], m[f], x[f]
        if not len(gf) or not len(nodes):
            continue
        if (gf[1:] < gf[:-1]).any():  # from several partitions
            order = np.argsort(gf, kind="stable")
            gf, mf, cf = gf[order], mf[order], cf[order]
        g, node, x = g[~f], node[~f], x[~f]
        at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
        keep = (nodes[at] == node) & (gf[np.minimum(np.searchsorted(gf, g), len(gf) - 1)] == g)
        at = at[keep]
        yield g[keep], at, x[keep] / made[at], (gf, mf, cf)


def _factored(names: np.ndarray, group: np.ndarray, at: np.ndarray, x: np.ndarray, factors: tuple) -> tuple:
    """Flow, method, node, amount, factor: each row of a flow (group: its place among the names) with each factor of it."""
    gf, mf, cf = factors
    lo, hi = np.searchsorted(gf, names), np.searchsorted(gf, names, "right")
    if (hi - lo == 1).all():
        of = lo[group]
    else:
        count = (hi - lo)[group]
        of = np.repeat(lo[group] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        group, at, x = np.repeat(group, count), np.repeat(at, count), np.repeat(x, count)
    return names[group], mf[of], at, x, cf[of]


def _of_flows(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[tuple]:
    """Flow, method, node, amount in a unit of the node's product with all that it needs, factor."""
    for part in _solved(_here(shared)[0], _chunks(batches, shared), _ROWS):
        yield _factored(*part)


def _of_activities(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[tuple]:
    """None, method, node, score, 1: factors meet the emissions first, and what activities score is solved for each method."""
    graph = _here(shared)[0]
    sums = _Sums(len(graph.nodes))
    for g, at, x, factors in _chunks(batches, shared):
        first, end = _slices(g)
        _, m, at, x, cf = _factored(g[first], np.repeat(np.arange(len(first)), end - first), at, x, factors)
        sums.add(m, at, x * cf)
    while sums.of:
        m, total, met = sums.taken()
        at = np.flatnonzero(met)
        for _, group, node, x, _ in _solved(graph, [(np.zeros(len(at), np.int64), at, total[at], None)]):
            yield None, np.full(len(group), m), node, x, np.ones(len(group))


class _Sums:
    """Sums by method and node, and which of them there are."""

    def __init__(self, nodes: int):
        self.nodes, self.of = nodes, {}

    def add(self, m: np.ndarray, at: np.ndarray, c: np.ndarray) -> None:
        kinds = np.unique(m)
        for k in kinds.tolist():
            total, met = self.of.setdefault(k, (np.zeros(self.nodes), np.zeros(self.nodes, bool)))
            mine = slice(None) if len(kinds) == 1 else np.flatnonzero(m == k)
            np.add.at(total, at[mine], c[mine])
            met[at[mine]] = True

    def taken(self) -> tuple[int, np.ndarray, np.ndarray]:
        k, (total, met) = self.of.popitem()
        return k, total, met

    def full(self) -> bool:
        return len(self.of) * self.nodes > HELD_SUMS


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """way, m, block, sums."""
    for batch in batches:
        for *key, cells in zip(*(batch[c].to_pylist() for c in ("way", "m", "block", "sums")), strict=True):
            yield *key, np.frombuffer(cells)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """way, m, block, sums of all tasks, of rows in order of them."""
    key, total = None, None
    for *at, v in _cells(batches):
        if key == at:
            total = np.where(np.isnan(total), v, np.where(np.isnan(v), total, total + v))
            continue
        if key is not None:
            yield *key, total
        key, total = at, v
    if key is not None:
        yield *key, total


def _blocks(rows) -> pa.RecordBatch:
    """The batch of rows way, m, block, sums."""
    way, m, block, sums = zip(*rows, strict=True) if (rows := list(rows)) else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(way, pa.string()), pa.array(m, pa.int32()), pa.array(block, pa.int32()), pa.array([v.tobytes() for v in sums], pa.binary())], ["way", "m", "block", "sums"])


class Flows:
    """What can be asked of the transposed system that workers hold."""

    def __init__(self, spark, shared: _Shared, nodes: int, demand: str):
        self.spark, self.shared, self.nodes, self._demand = spark, shared, nodes, demand

    def _rows(self, b: DataFrame, q: DataFrame, methods: list) -> DataFrame:
        """grp, m, node, x: emissions and factors by flow, in order of flows."""
        m = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in methods]), F.col("method")).cast("int") - 1, F.lit(-1))
        emitted = b.select(F.col("row_id").alias("grp"), F.lit(-1).alias("m"), F.col("col_id").cast("long").alias("node"), F.coalesce("value", F.lit(0.0)).alias("x"))
        factors = q.where("method is not null").select(F.col("row_id").alias("grp"), m.alias("m"), F.lit(0).cast("long").alias("node"), F.coalesce("cf", F.lit(0.0)).alias("x"))
        return emitted.unionByName(factors).where("grp is not null").repartition(parallelism(self.spark), "grp").sortWithinPartitions("grp")

    def sums(self, b: DataFrame, q: DataFrame, methods: list, way: str = "inventory") -> DataFrame:
        """way, m, block, sums: by method and node the factors times the amounts of all flows; NaN where there is no flow.

        way: by the inventory, by its magnitudes, or by the activities, whose emissions meet the factors before anything is solved.
        Tasks sum up what they form and only sums are shuffled: at most nodes times methods from each task, so there is one
        task for each core.
        """
        shared, n = self.shared, self.nodes
        kind = "way string, m int, block int, sums binary"

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _Sums(n)
            for _, m, at, x, cf in (_of_activities if way == "activities" else _of_flows)(batches, shared):
                sums.add(m, at, np.abs(x * cf) if way == "magnitudes" else x * cf)
                while sums.full():
                    yield from given(*sums.taken())
            while sums.of:
                yield from given(*sums.taken())

        def given(m: int, total: np.ndarray, met: np.ndarray) -> Iterator[pa.RecordBatch]:
            total[~met] = np.nan
            for lo in range(0, n, _BLOCK * 16):
                some = [i for i in range(lo, min(lo + _BLOCK * 16, n), _BLOCK) if met[i : i + _BLOCK].any()]
                yield _blocks((way, m, i // _BLOCK, total[i : i + _BLOCK]) for i in some)

        tasks = max(1, min(parallelism(self.spark), self.spark.sparkContext.defaultParallelism))
        return self._rows(b, q, methods).coalesce(tasks).mapInArrow(summed, kind)  # partitions are sorted one by one

    def _together(self, sums: DataFrame) -> DataFrame:
        """sums in order of method, block and way; those of a block lie in one partition."""
        return sums.repartition(parallelism(self.spark), "m", "block").sortWithinPartitions("m", "block", "way")

    def scores(self, b: DataFrame, q: DataFrame, methods: list) -> DataFrame:
        """demand_id, m (place of the method), x, y: score of each demand by way of the activities and by way of its inventory."""
        shared = self.shared
        ways = ("activities", "inventory")
        both = self._together(self.sums(b, q, methods, ways[0]).unionByName(self.sums(b, q, methods, ways[1])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, _, _, first, demand, amount = shared.value

            def out(m: int, block: int, got: dict[str, np.ndarray]) -> pa.RecordBatch:
                v = [got.get(w) for w in ways]
                size = len(next(c for c in v if c is not None))
                x, y = (np.full(size, np.nan) if c is None else c for c in v)
                at = block * _BLOCK + np.arange(size)
                row = slice(first[at[0]], first[at[-1] + 1])
                x, y = (np.repeat(c, np.diff(first[at[0] : at[-1] + 2])) * amount[row] for c in (x, y))
                keep = ~(np.isnan(x) & np.isnan(y))
                x, y = (pa.array(c[keep], mask=np.isnan(c[keep])) for c in (x, y))
                return pa.RecordBatch.from_arrays([pa.array(demand[row][keep]), pa.array(np.full(keep.sum(), m, np.int32)), x, y], ["demand_id", "m", "x", "y"])

            key, got = None, {}
            for way, m, block, v in _merged(batches):
                if key not in (None, (m, block)):
                    yield out(*key, got)
                    got = {}
                key = (m, block)
                got[way] = v
            if key is not None:
                yield out(*key, got)

        return both.mapInArrow(run, f"demand_id {self._demand}, m int, x double, y double")

    def table(self, sums: DataFrame, methods: list) -> np.ndarray:
        """The sums of all tasks as methods by nodes; a method at a time comes to the driver."""
        out = np.zeros((len(methods), self.nodes))
        sums = checkpointed(self._together(sums).mapInArrow(lambda batches: (_blocks([x]) for x in _merged(batches)), sums.schema))
        for m in range(len(methods)):
            for block, cells in zip(*(c.to_pylist() for c in sums.where(F.col("m") == m).select("block", "sums").toArrow().columns), strict=True):
                v = np.frombuffer(cells)
                out[m, block * _BLOCK : block * _BLOCK + len(v)] = np.nan_to_num(v, posinf=np.inf, neginf=-np.inf)
        return out

    def contributions(self, b: DataFrame, q: DataFrame, methods: list, sizes: np.ndarray, totals: np.ndarray | None) -> DataFrame:
        """demand_id, m, row_id, contribution, share (null without totals), abs_share; contributions of 0 are left out."""
        shared, row = self.shared, b.schema["row_id"].dataType.simpleString()
        tables = self.spark.sparkContext.broadcast((sizes, totals))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, _, first, demand, amount = _here(shared)
            sizes, totals = tables.value
            count_of = np.diff(first)
            alone = len(count_of) == len(demand) and (count_of == 1).all()
            for flows, m, at, x, cf in _of_flows(batches, shared):
                for lo in range(0, len(at), _OUT):
                    some = slice(lo, lo + _OUT)
                    node, k, g, y = at[some], m[some], flows[some], x[some] * cf[some]
                    if alone:
                        of = node
                    else:
                        count = count_of[node]
                        of = np.repeat(first[node] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                        node, k, g, y = (np.repeat(c, count) for c in (node, k, g, y))
                    c = y * amount[of]
                    keep = (c != 0) & ~np.isnan(c)
                    if not keep.all():
                        of, node, k, g, y, c = (v[keep] for v in (of, node, k, g, y, c))
                    with np.errstate(divide="ignore", invalid="ignore"):
                        size = np.abs(y) / sizes[k, node]
                        share = pa.nulls(len(c), pa.float64()) if totals is None else pa.array(y / totals[k, node], mask=totals[k, node] == 0)
                    yield pa.RecordBatch.from_arrays([pa.array(demand[of]), pa.array(k.astype(np.int32)), pa.array(g), pa.array(c), share, pa.array(size)], ["demand_id", "m", "row_id", "contribution", "share", "abs_share"])

        return self._rows(b, q, methods).mapInArrow(run, f"demand_id {self._demand}, m int, row_id {row}, contribution double, share double, abs_share double")


def methods_of(q: DataFrame) -> list:
    """The methods, a few, in order."""
    return [r.method for r in q.select("method").distinct().where("method is not null").orderBy("method").collect()]


def named(df: DataFrame, methods: list) -> DataFrame:
    """df with the method instead of its place."""
    return df.withColumn("method", F.element_at(F.array(*[F.lit(x) for x in methods]), F.col("m") + 1)).drop("m")
