"""The system A s = d, solved for many demands at once, or transposed for the scores of all products at once.

Both are one linear recurrence x = b + M x over the graph of consumption. Strong components (activities that need
one another) are condensed first and inverted exactly, so that the rest has no cycle and is done level by level,
without any cutoff. A graph of known, bounded size goes to each worker, where groups (demands or methods) are solved
side by side; a larger one is done in rounds of joins. Components too large to invert are solved by a Krylov method
whose vectors are DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flowloom.operators.graph import components_of, strong_components
from flowloom.session import checkpointed, parallelism

#: Nodes of the largest component that one task inverts; larger ones are solved by the Krylov method.
DENSE = 3_000
#: Edges of the largest graph that workers hold (24 bytes each); larger ones are done in rounds.
HELD_EDGES = 2_000_000
#: Cells of the largest matrix of nodes by groups that a worker fills at once.
_CELLS = 4_000_000
#: Rows that a worker holds of groups that reach little of the graph.
_ROWS = 1_000_000
#: Rounds that one job takes: their exchanges are shared, and lineage is cut once for all.
ROUNDS = 3


class NotConverged(RuntimeError):
    """The Krylov method did not reach its tolerance."""


class SingularSystem(ValueError):
    """A cycle that nets to nothing: no supply, or any supply, would do."""


def _parts(a: DataFrame, producers: DataFrame, cut: bool = False) -> tuple[DataFrame, DataFrame]:
    """Diagonal (product_id, activity_id, made) and consumption (maker, user, input, giver, amount, made, input_made).

    Products whose production nets to 0 have no diagonal. maker is the product of the consuming activity (user), giver
    the activity of the input. cut: the diagonal is kept in the shared checkpoint folder.
    """
    diagonal = a.join(producers, (a.row_id == producers.product_id) & (a.col_id == producers.activity_id)).select("product_id", "activity_id", F.col("value").alias("made"))
    diagonal = checkpointed(diagonal.where("made <> 0")) if cut else diagonal.where("made <> 0")
    by_activity = diagonal.select(F.col("activity_id").alias("col_id"), F.col("product_id").alias("maker"), "made")
    off = a.join(by_activity, "col_id").where("row_id <> maker").select("maker", F.col("col_id").alias("user"), F.col("row_id").alias("input"), (-F.col("value")).alias("amount"), "made")
    made = diagonal.select(F.col("product_id").alias("input"), F.col("activity_id").alias("giver"), F.col("made").alias("input_made"))
    return diagonal, off.join(made, "input")


def _inverted(m: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Inverses of matrices of one size; names: a node of each."""
    try:
        k = np.linalg.inv(m)
    except np.linalg.LinAlgError as e:
        if len(m) > 1:  # which one it is
            return np.concatenate([_inverted(m[i : i + 1], names[i : i + 1]) for i in range(len(m))])
        raise SingularSystem(f"the component of {names[0]} nets to nothing") from e
    bad = ~np.isfinite(k).all((1, 2)) | (np.abs(m).sum(1).max(1) * np.abs(k).sum(1).max(1) > 1e15)
    if bad.any():
        raise SingularSystem(f"the component of {names[bad][0]} nets to nothing")
    return k


def _stacks(comp: np.ndarray, src: np.ndarray, dst: np.ndarray, w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes (components by size) and (I - M)^-1 (components by size by size) of components, those of one size together.

    comp, src, dst, w: the edges inside components, in order of comp.
    """
    if not len(comp):
        return
    first, end = _slices(comp)
    c = np.repeat(np.arange(len(first)), end - first)
    both, of = np.r_[src, dst], np.r_[c, c]
    order = np.lexsort((both, of))
    both, of = both[order], of[order]
    new = np.r_[True, (both[1:] != both[:-1]) | (of[1:] != of[:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    nodes, of = both[new], of[new]
    begin = np.searchsorted(of, np.arange(len(first) + 1))
    size = np.diff(begin)
    s, d = number[: len(src)] - begin[c], number[len(src) :] - begin[c]
    for m in np.unique(size):
        all_of = np.flatnonzero(size == m)
        at_once = max(1, _CELLS // int(m * m))
        for lo in range(0, len(all_of), at_once):
            some = all_of[lo : lo + at_once]
            mine = np.full(len(first), -1)
            mine[some] = np.arange(len(some))
            e = np.flatnonzero(mine[c] >= 0)
            k = np.tile(np.eye(m), (len(some), 1, 1))
            np.subtract.at(k, (mine[c[e]], d[e], s[e]), w[e])
            at = nodes[begin[some][:, None] + np.arange(m)]
            yield at, _inverted(k, at[:, 0])


def _inverses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, into, k of components: (I - M)^-1, given their edges (cs, src, dst, w) in order of cs."""
    for comp, src, dst, w in _whole(batches, ("cs", "src", "dst", "w")):
        for at, k in _stacks(comp, src, dst, w):
            c, i, j = np.nonzero(k)
            yield pa.RecordBatch.from_arrays([pa.array(at[c, j]), pa.array(at[c, i]), pa.array(k[c, i, j])], ["node", "into", "k"])


def _whole(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Columns of many rows at a time; rows of one group (the first column, in order) stay together."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append([b[n].to_numpy(zero_copy_only=False) for n in names])
        rows += b.num_rows
        if rows >= _ROWS // 4 and held[-1][0][-1] != held[0][0][0]:  # all groups but the last are complete
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = _slices(columns[0])[0][-1]
            yield [x[:cut] for x in columns]
            held, rows = [[x[cut:] for x in columns]], len(columns[0]) - cut
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


class Graph:
    """Edges (src, dst, w) in the order in which a recurrence over them is solved."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, w: np.ndarray, on: np.ndarray, comp: np.ndarray, alone: np.ndarray | None = None):
        """alone: further nodes, which may have no edge."""
        self.nodes = np.unique(np.r_[src, dst] if alone is None else np.r_[src, dst, alone])
        s, d = np.searchsorted(self.nodes, src), np.searchsorted(self.nodes, dst)
        n = len(self.nodes)
        unit = np.arange(n)  # what a node is settled with: itself, or its component
        unit[np.searchsorted(self.nodes, on)] = np.searchsorted(self.nodes, comp)
        inner = unit[s] == unit[d]
        #: By level: nodes (components by size) and their inverses.
        self.blocks: dict[int, list] = {}
        level = self._depths(unit[s[~inner]], unit[d[~inner]], n)
        order = np.argsort(unit[s[inner]], kind="stable")
        bs, bd, bw = s[inner][order], d[inner][order], w[inner][order]
        #: By node: its level, the stack of its component (-1: none), the component's place there, and its own place.
        self.level, self.stack, self.row, self.place = level[unit], np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.stacks = [(at, k) for at, k in _stacks(unit[bs], bs, bd, bw)]
        for i, (at, k) in enumerate(self.stacks):
            self.stack[at], self.row[at], self.place[at] = i, np.arange(len(at))[:, None], np.arange(at.shape[1])
            of = self.level[at[:, 0]]
            for at_level in np.unique(of):
                self.blocks.setdefault(int(at_level), []).append((at[of == at_level], k[of == at_level]))
        s, d, w = s[~inner], d[~inner], w[~inner]
        order = np.argsort(s, kind="stable")
        self.into, self.weight, self.first = d[order], w[order], np.searchsorted(s[order], np.arange(n + 1))
        order = np.lexsort((d, level[unit[s]]))
        s, d, w, l = s[order], d[order], w[order], level[unit[s]][order]  # noqa: E741
        self.steps = []
        for lo, hi in zip(*_slices(l), strict=True):
            first, _ = _slices(d[lo:hi])
            self.steps.append((int(l[lo]), s[lo:hi], w[lo:hi, None], first, d[lo:hi][first]))
        self.depth = max([*self.blocks, *(x[0] for x in self.steps)], default=-1) + 1

    @staticmethod
    def _depths(s: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
        """Length of the longest path into each unit."""
        level, degree = np.zeros(n, np.int64), np.bincount(d, minlength=n)
        order = np.argsort(s, kind="stable")
        into, first = d[order], np.searchsorted(s[order], np.arange(n + 1))
        front = np.flatnonzero(degree == 0)
        while len(front):
            size = first[front + 1] - first[front]
            at = np.repeat(first[front] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            reached = into[at]
            np.maximum.at(level, reached, np.repeat(level[front], size) + 1)
            np.subtract.at(degree, reached, 1)
            reached = np.unique(reached)
            front = reached[degree[reached] == 0]
        return level

    def solve(self, x: np.ndarray, met: np.ndarray) -> None:
        """x (nodes by groups) becomes the solution in place; met marks the cells that something reaches."""
        steps = iter(self.steps)
        step = next(steps, None)
        for level in range(self.depth):
            for all_at, all_k in self.blocks.get(level, ()):
                at_once = max(1, _ROWS // (all_at.shape[1] * x.shape[1]))
                for lo in range(0, len(all_at), at_once):
                    at = all_at[lo : lo + at_once]
                    x[at] = all_k[lo : lo + at_once] @ x[at]
                    met[at] = met[at].any(1, keepdims=True)
            if step is not None and step[0] == level:
                _, s, w, first, d = step
                x[d] += np.add.reduceat(x[s] * w, first)
                met[d] |= np.logical_or.reduceat(met[s], first)
                step = next(steps, None)

    def spread(self, g: np.ndarray, node: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Group, node and x of the solution, by way of the nodes that are reached only; None if these are more than `most`."""
        n, todo, out, rows = len(self.nodes), {}, [], 0

        def put(g: np.ndarray, node: np.ndarray, x: np.ndarray) -> None:
            order = np.argsort(self.level[node], kind="stable")
            for lo, hi in zip(*_slices(self.level[node][order]), strict=True):
                todo.setdefault(int(self.level[node[order[lo]]]), []).append((g[order[lo:hi]], node[order[lo:hi]], x[order[lo:hi]]))

        put(g, node, x)
        while todo:
            g, node, x = (np.concatenate(p) for p in zip(*todo.pop(min(todo)), strict=True))
            order = np.argsort(key := g * n + node, kind="stable")
            first, _ = _slices(key[order])
            g, node, x = g[order][first], node[order][first], np.add.reduceat(x[order], first)
            if (self.stack[node] >= 0).any():
                parts = [(g[alone], node[alone], x[alone]) for alone in [self.stack[node] < 0]]
                for i in np.unique(self.stack[node]):
                    if i >= 0:
                        parts += self._settled(i, *(p[self.stack[node] == i] for p in (g, node, x)))
                g, node, x = (np.concatenate(p) for p in zip(*parts, strict=True))
            out.append((g, node, x))
            size = self.first[node + 1] - self.first[node]
            rows += len(g)
            if rows + size.sum() > most:
                return None
            if size.any():
                at = np.repeat(self.first[node] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                put(np.repeat(g, size), self.into[at], np.repeat(x, size) * self.weight[at])
        return tuple(np.concatenate(p) for p in zip(*out, strict=True))

    def _settled(self, i: int, g: np.ndarray, node: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """What arrives at components of stack i, taken through their inverses."""
        nodes, k = self.stacks[i]
        m = nodes.shape[1]
        order = np.lexsort((g, self.row[node]))
        g, node, x = g[order], node[order], x[order]
        row = self.row[node]
        new = np.r_[True, (row[1:] != row[:-1]) | (g[1:] != g[:-1])]
        v = np.zeros((int(new.sum()), m))
        v[np.cumsum(new) - 1, self.place[node]] = x
        g, row = g[new], row[new]
        if m * m <= 64:
            y = (k[row] @ v[:, :, None])[:, :, 0]
        else:
            y = np.concatenate([v[lo:hi] @ k[row[lo]].T for lo, hi in zip(*_slices(row), strict=True)])
        return [(np.repeat(g, m), nodes[row].ravel(), y.ravel())]


def _slices(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of equal values."""
    if not len(v):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(v[1:] != v[:-1]) + 1
    return np.r_[0, cut], np.r_[cut, len(v)]


_graphs: dict[int, Graph] = {}


def _held(shared) -> Graph:
    """The worker's graph, ordered and inverted once."""
    if shared.id not in _graphs:
        _graphs.clear()
        _graphs[shared.id] = Graph(*shared.value)
    return _graphs[shared.id]


class _Shared:
    """A broadcast with the number by which workers remember what they made of it."""

    def __init__(self, broadcast):
        self.id, self._b = uuid4().int, broadcast

    @property
    def value(self):
        return self._b.value


def _solved(graph: Graph, chunks: Iterator[tuple], rows_at_once: int = _ROWS) -> Iterator[tuple]:
    """Names of some groups, and the solution of these: group (its place among the names), node (its place in the graph), x; what came with their chunk.

    chunks: group, node's place, x, anything; rows of one group stand together in one chunk.
    """
    n = len(graph.nodes)
    width = int(np.clip(_CELLS // max(1, n), 1, 256))  # groups that are filled in whole at once
    take, filled, skip = width, 0, 0

    def full(col: np.ndarray, at: np.ndarray, v: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, met = np.zeros((n, groups)), np.zeros((n, groups), bool)
        np.add.at(x, (at, col), v)
        met[at, col] = True
        graph.solve(x, met)
        i, j = np.nonzero(met)
        return j, i, x[i, j]

    for g, at, v, rest in chunks:
        if not len(g):
            continue
        first, end = _slices(g)
        names, groups = g[first], np.repeat(np.arange(len(first)), end - first)
        lo = 0
        while lo < len(names):
            hi = min(lo + (width if filled else take), len(names))
            rows = slice(first[lo], end[hi - 1])
            want = groups[rows] - lo, at[rows], v[rows]
            if filled:
                filled -= 1
                part = full(*want, hi - lo)
            elif (part := graph.spread(*want, min(rows_at_once, max(1000, n * (hi - lo) // 8)))) is not None:
                skip = 0
                if len(part[0]) < rows_at_once // 4:
                    take *= 2
            elif hi - lo > width:
                take = max(width, (hi - lo) // 2)
                continue
            else:  # groups that reach much of the graph: filled in whole, and so are more of the next each time
                skip = filled = min(2 * skip + 1, 31)
                take = width
                part = full(*want, hi - lo)
            yield names[lo:hi], *part, rest
            lo = hi


def _side_by_side(start: DataFrame, shared: _Shared) -> DataFrame:
    """The recurrence with the whole graph in each worker: groups are solved some at a time, each by one task."""
    kind = start.schema["grp"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = _held(shared)
        n = len(graph.nodes)
        apart: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def chunks() -> Iterator[tuple]:
            for g, node, v in _whole(batches, ("grp", "node", "x")):
                at = np.searchsorted(graph.nodes, node)
                known = (at < n) & (graph.nodes[np.minimum(at, n - 1)] == node) if n else np.zeros(len(node), bool)
                if not known.all():  # nodes without any edge keep what they have
                    apart.append((g[~known], node[~known], v[~known]))
                if known.any():
                    yield g[known], at[known], v[known], None

        for names, group, at, v, _ in _solved(graph, chunks()):
            yield pa.RecordBatch.from_arrays([pa.array(names[group]), pa.array(graph.nodes[at]), pa.array(v)], ["grp", "node", "x"])
            while apart:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in apart.pop()], ["grp", "node", "x"])
        while apart:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in apart.pop()], ["grp", "node", "x"])

    rows = start.groupBy("grp", "node").agg(F.sum("x").alias("x")).select("grp", F.col("node").cast("long").alias("node"), "x").repartition(parallelism(start.sparkSession), "grp").sortWithinPartitions("grp")  # few rows, much work: not to be merged
    return rows.mapInArrow(run, f"grp {kind}, node long, x double")


def _counted(edges: DataFrame) -> tuple[DataFrame, int]:
    """Edges (src, dst, w), each once, and how many they are."""
    counted = Observation()
    edges = checkpointed(edges.groupBy("src", "dst").agg(F.sum("w").alias("w")).observe(counted, F.count(F.lit(1)).alias("n")))
    return edges, counted.get["n"]


def _fetched(edges: DataFrame, dense: int) -> tuple[np.ndarray, ...] | None:
    """What Graph takes, of a graph of known size (a larger one never comes to the driver); None if a component has more than `dense` nodes."""
    table = edges.toArrow()
    src, dst, w = (np.asarray(table[c].to_numpy(), t) for c, t in (("src", np.int64), ("dst", np.int64), ("w", float)))
    on, comp = components_of(src, dst)
    if len(comp) and np.unique(comp, return_counts=True)[1].max() > dense:
        return None
    return src, dst, w, on, comp


def recurrence(start: DataFrame, edges: DataFrame, dense: int = DENSE, held: int = HELD_EDGES, tolerance: float = 1e-13, most: int = 400) -> DataFrame:
    """grp, node, x with x = start + the sum over edges (src, dst, w) of w * x(src), for each grp.

    start: grp, node, x; no row of it may be null. Exact up to rounding where no component has more than `dense` nodes; beyond, each group's
    residual falls under `tolerance` of its start (NotConverged after `most` steps). A component that nets to nothing
    raises SingularSystem. Lineage is cut into the shared checkpoint folder. An empty start gives no rows.
    """
    edges, n = _counted(edges)
    if n <= held and (graph := _fetched(edges, dense)) is not None:
        return _side_by_side(start, _Shared(start.sparkSession.sparkContext.broadcast(graph)))
    comps = strong_components(edges)
    if comps is None:
        return _levels(start, edges, None)
    sizes = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest > dense:
        return _krylov(start, edges, tolerance, most)
    s, d = comps.select(F.col("node").alias("src"), F.col("comp").alias("cs")), comps.select(F.col("node").alias("dst"), F.col("comp").alias("cd"))
    marked = checkpointed(edges.join(s, "src", "left").join(d, "dst", "left").withColumn("inner", F.coalesce(F.col("cs") == F.col("cd"), F.lit(False))))
    inner = marked.where("inner").select("cs", "src", "dst", "w").repartition("cs").sortWithinPartitions("cs")
    inverse = checkpointed(inner.mapInArrow(_inverses, "node long, into long, k double"))  # at most `dense` nodes a component
    return _levels(start, marked.where("not inner").select("src", "dst", "w"), inverse)


def _levels(start: DataFrame, edges: DataFrame, inverse: DataFrame | None) -> DataFrame:
    """The recurrence over edges without cycles; `inverse` settles what arrives at the nodes of a component."""

    def settled(b: DataFrame) -> DataFrame:
        if inverse is None:
            return b
        hit = b.join(inverse, "node", "left").select("grp", F.coalesce("into", "node").alias("node"), (F.col("x") * F.coalesce("k", F.lit(1.0))).alias("x"))
        return hit.groupBy("grp", "node").agg(F.sum("x").alias("x"))

    def step(x: DataFrame) -> DataFrame:
        moved = x.join(edges, x.node == edges.src).groupBy("grp", F.col("dst").alias("node")).agg(F.sum(F.col("x") * F.col("w")).alias("x"))
        return settled(moved)

    levels = [checkpointed(settled(start.groupBy("grp", "node").agg(F.sum("x").alias("x"))))]
    frontier = levels[0]
    while True:
        job, at = None, frontier
        for k in range(1, ROUNDS + 1):
            at = step(at)
            one = at.withColumn("k", F.lit(k))
            job = one if job is None else job.unionByName(one)
        seen = Observation()
        job = checkpointed(job.observe(seen, F.count_if(F.col("k") == ROUNDS).alias("n")))
        levels.append(job.drop("k"))
        if not seen.get.get("n"):
            break
        frontier = job.where(F.col("k") == ROUNDS).drop("k")
    total = levels[0]
    for level in levels[1:]:
        total = total.unionByName(level)
    return total.groupBy("grp", "node").agg(F.sum("x").alias("x"))


def _krylov(start: DataFrame, edges: DataFrame, tolerance: float, most: int) -> DataFrame:
    """The recurrence by stabilised bi-conjugate gradients, all groups together; each group has its own step lengths."""

    def through(df: DataFrame, v: str, into: str) -> DataFrame:
        """df with `into` = v less M v."""
        moved = df.where(F.col(v) != 0).join(edges, df.node == edges.src).select("grp", F.col("dst").alias("node"), (F.col(v) * F.col("w")).alias("_m"))
        moved = moved.groupBy("grp", "node").agg(F.sum("_m").alias("_m"))
        names = [c for c in df.columns if c not in ("grp", "node")]
        out = df.join(moved, ["grp", "node"], "full_outer").select("grp", "node", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names], F.coalesce("_m", F.lit(0.0)).alias("_m"))
        return out.withColumn(into, F.col(v) - F.col("_m")).drop("_m")

    def with_dots(df: DataFrame, **dots: tuple[str, str]) -> DataFrame:
        g = df.groupBy("grp").agg(*[F.sum(F.col(a) * F.col(b)).alias(n) for n, (a, b) in dots.items()])
        return df.join(g, "grp")

    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    b = start.groupBy("grp", "node").agg(F.sum("x").alias("b"))
    # several restarts: each takes the residual as its new right side
    state = checkpointed(b.select("grp", "node", F.lit(0.0).alias("x"), F.col("b").alias("r"), F.col("b").alias("h"), F.col("b").alias("p")))
    norms = checkpointed(b.groupBy("grp").agg(F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("nb")))
    for _ in range(most):
        t = with_dots(through(state, "p", "v"), rho=("h", "r"), hv=("h", "v"))
        t = t.withColumn("al", ratio(F.col("rho"), F.col("hv"))).withColumn("s", F.col("r") - F.col("al") * F.col("v"))
        t = checkpointed(t)
        t = with_dots(through(t.select("grp", "node", "x", "h", "p", "v", "s", "al", "rho"), "s", "t"), ts=("t", "s"), tt=("t", "t"))
        scalars = t.groupBy("grp").agg(F.max_by("al", F.abs("al")).alias("al"), F.max_by("rho", F.abs("rho")).alias("rho"))  # rows new to the group have none
        t = t.drop("al", "rho").join(scalars, "grp").withColumn("om", ratio(F.col("ts"), F.col("tt")))
        t = t.withColumn("x", F.col("x") + F.col("al") * F.col("p") + F.col("om") * F.col("s")).withColumn("r", F.col("s") - F.col("om") * F.col("t"))
        t = checkpointed(with_dots(t, new=("h", "r"), rr=("r", "r")).join(norms, "grp"))
        worst = t.agg(F.max(ratio(F.sqrt("rr"), F.col("nb")))).first()[0] or 0.0
        if worst <= tolerance:
            return t.select("grp", "node", "x")
        beta = ratio(F.col("new"), F.col("rho")) * ratio(F.col("al"), F.col("om"))
        fresh = beta == 0  # a breakdown: begin again from the residual
        state = t.withColumn("p", F.col("r") + beta * (F.col("p") - F.col("om") * F.col("v"))).withColumn("h", F.when(fresh, F.col("r")).otherwise(F.col("h")))
        state = checkpointed(state.select("grp", "node", "x", "r", "h", "p"))
    raise NotConverged(f"the residual is {worst} after {most} steps")


def supply(a: DataFrame, producers: DataFrame, demands: DataFrame, dense: int = DENSE) -> DataFrame:
    """demand_id, col_id, supply for each demand.

    a: row_id (product), col_id (activity), value. producers: product_id, activity_id. demands: demand_id,
    product_id, amount. No amount is cut off, however small. Demands for products without a producer, or whose
    production nets to 0, give no rows (`unsolvable` names them).
    """
    diagonal, used = _parts(a, producers)
    n = diagonal.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("p"), F.count_distinct("activity_id").alias("a")).first()
    single = n.n == n.p == n.a  # then activities are the nodes, and the supplies, which are many, need no join to be named
    src, dst, node = ("user", "giver", "activity_id") if single else ("maker", "input", "product_id")
    # one unit of supply of the maker's activity asks for amount / made(input) units of supply of the input's
    edges = used.select(F.col(src).alias("src"), F.col(dst).alias("dst"), (F.col("amount") / F.col("input_made")).alias("w"))
    start = demands.join(diagonal, "product_id").select(F.col("demand_id").alias("grp"), F.col(node).alias("node"), (F.col("amount") / F.col("made")).alias("x"))
    x = recurrence(start, edges, dense)
    if not single:
        x = x.join(diagonal.select(F.col("product_id").alias("node"), "activity_id"), "node").withColumn("node", F.col("activity_id"))
    return x.select(F.col("grp").alias("demand_id"), F.col("node").alias("col_id"), F.col("x").alias("supply"))


def unit_scores(a: DataFrame, producers: DataFrame, per_activity: DataFrame, dense: int = DENSE) -> DataFrame:
    """method, product_id, score of one unit of every product: the transposed system, solved once for each method.

    per_activity: method, col_id, x (what one unit of an activity scores). The work grows with edges times methods,
    not with products times their ancestors.
    """
    diagonal, used = _parts(a, producers)
    edges = used.select(F.col("input").alias("src"), F.col("maker").alias("dst"), (F.col("amount") / F.col("made")).alias("w"))
    start = per_activity.join(diagonal.withColumnRenamed("activity_id", "col_id"), "col_id").select(F.col("method").alias("grp"), F.col("product_id").alias("node"), (F.col("x") / F.col("made")).alias("x"))
    y = recurrence(start, edges, dense)
    return y.select(F.col("grp").alias("method"), F.col("node").alias("product_id"), F.col("x").alias("score"))


def unsolvable(a: DataFrame, producers: DataFrame, demands: DataFrame) -> DataFrame:
    """demand_id, reason of the demands that get no supply: unknown products, or production that nets to 0."""
    diagonal, _ = _parts(a, producers)
    gone = demands.join(diagonal, "product_id", "left_anti").join(producers.select("product_id", "activity_id"), "product_id", "left")
    return gone.select("demand_id", F.when(F.col("activity_id").isNull(), "unknown product").otherwise("nothing is made").alias("reason"))
