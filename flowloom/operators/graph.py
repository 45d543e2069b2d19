"""Reachability, closure and strong components over edges."""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.session import checkpointed


def reachable(edges: DataFrame, starts: DataFrame, most: int = 1000) -> DataFrame:
    """start, node: every node that a start leads to, itself included.

    edges: src, dst. starts: start, node. Breadth first; each round joins the frontier only and drops what is
    known already.
    """
    edges = checkpointed(edges.select("src", "dst").distinct())
    seen = frontier = checkpointed(starts.select("start", "node").distinct())
    for _ in range(most):
        step = frontier.join(edges, frontier.node == edges.src).select("start", edges.dst.alias("node")).distinct()
        frontier = checkpointed(step.join(seen, ["start", "node"], "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = checkpointed(seen.unionByName(frontier))
    raise RuntimeError(f"deeper than {most}")


def _core(src: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
    """Edges between nodes that are entered and left again: what remains when ends are peeled off, layer by layer."""
    keep = np.arange(len(src))
    while len(keep):
        entered, left = np.zeros(n, bool), np.zeros(n, bool)
        entered[dst[keep]], left[src[keep]] = True, True
        both = entered & left
        inside = both[src[keep]] & both[dst[keep]]
        if inside.all():
            break
        keep = keep[inside]
    return keep


def components_of(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that lie on a cycle, and the smallest node of the component of each."""
    nodes, at = np.unique(np.r_[src, dst], return_inverse=True)
    keep = _core(at[: len(src)], at[len(src) :], len(nodes))
    nodes, at = np.unique(np.r_[src[keep], dst[keep]], return_inverse=True)  # what is left of them
    if not len(nodes):
        return nodes, nodes
    s, d = at[: len(keep)], at[len(keep) :]
    order = np.argsort(s, kind="stable")
    s, d = s[order], d[order]
    first = array("q", np.searchsorted(s, np.arange(len(nodes) + 1)).astype(np.int64).tobytes())  # a number takes 8 bytes, not 40
    into = array("q", d.astype(np.int64).tobytes())
    index, low = array("q", [-1]) * len(nodes), array("q", [0]) * len(nodes)
    on, stack, comp, count = bytearray(len(nodes)), [], np.full(len(nodes), -1, np.int64), 0
    for root in np.unique(s).tolist():
        if index[root] >= 0:
            continue
        work = [(root, first[root])]
        index[root] = low[root] = count
        count += 1
        stack.append(root)
        on[root] = True
        while work:
            v, e = work.pop()
            descend = False
            while e < first[v + 1]:
                w = into[e]
                e += 1
                if index[w] < 0:
                    work += [(v, e), (w, first[w])]
                    index[w] = low[w] = count
                    count += 1
                    stack.append(w)
                    on[w] = True
                    descend = True
                    break
                if on[w]:
                    low[v] = min(low[v], index[w])
            if descend:
                continue
            if low[v] == index[v]:
                members = []
                while True:
                    w = stack.pop()
                    on[w] = False
                    members.append(w)
                    if w == v:
                        break
                if len(members) > 1:
                    comp[members] = min(members)
            if work:
                u = work[-1][0]
                low[u] = min(low[u], low[v])
    hit = np.flatnonzero(comp >= 0)
    return nodes[hit], nodes[comp[hit]]


def strong_components(edges: DataFrame) -> DataFrame | None:
    """node, comp (its smallest node) of the nodes that lie on a cycle; None if no node does.

    edges: src, dst (self-loops don't count). In rounds of joins: ends are peeled off; a node that the same smallest
    node leads to and is reached from shares its component.
    """
    e = edges.where("src <> dst").select("src", "dst").distinct()

    def smallest(pairs: DataFrame) -> DataFrame:
        """node, label: the smallest node that leads to each along pairs (src, dst)."""
        at = checkpointed(pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct().withColumn("label", F.col("node")))
        while True:
            told = at.join(pairs, at.node == pairs.src).select(F.col("dst").alias("node"), "label")
            new = checkpointed(at.unionByName(told).groupBy("node").agg(F.min("label").alias("label")))
            moved = not new.join(at, ["node", "label"], "left_anti").isEmpty()
            at = new
            if not moved:
                return at

    rest, n, found = checkpointed(e), -1, None
    while True:
        while True:  # peel
            size = rest.count()
            if size == n or not size:
                break
            n = size
            rest = checkpointed(rest.join(rest.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(rest.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"))
        if not size:
            return found
        ahead = smallest(rest).withColumnRenamed("label", "comp")
        behind = smallest(rest.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumnRenamed("label", "comp")
        same = checkpointed(ahead.join(behind, ["node", "comp"]))
        big = same.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("comp")
        hit = checkpointed(same.join(big, "comp", "left_semi").select("node", "comp"))
        found = hit if found is None else found.unionByName(hit)
        gone = same.select("node")
        rest = checkpointed(rest.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst"))
        n = -1
