"""Parameters of processes: overrides, influence, and formulas evaluated again."""

from __future__ import annotations

import ast
import json
import math
import operator
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.graph import reachable
from flowloom.operators.keep import keep_first, top_per_group
from flowloom.session import checkpointed, parallelism

_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Pow: operator.pow}
_UNARY = {ast.UAdd: operator.pos, ast.USub: operator.neg}
_CALLS = {"sqrt": math.sqrt, "exp": math.exp, "log": math.log, "ln": math.log, "abs": abs, "min": min, "max": max}


#: Overrides (what a user sets, by hand or from a file) that go to every task; more are joined by a shuffle.
BROADCAST_OVERRIDES = 100_000


class FormulaError(ValueError):
    """A formula that can't be read or evaluated."""


class UnknownParameter(ValueError):
    """An override for a parameter that no process defines."""


@lru_cache(maxsize=50_000)
def _parsed(formula: str) -> ast.expr:
    try:
        return ast.parse(formula.replace("^", "**"), mode="eval").body
    except (SyntaxError, ValueError) as e:
        raise FormulaError(f"{formula!r} can't be read") from e


def _value(node: ast.expr, env: dict[str, float]) -> float:
    if isinstance(node, ast.Constant) and isinstance(node.value, int | float) and not isinstance(node.value, bool):
        return float(node.value)
    if isinstance(node, ast.Name):
        if node.id not in env:
            raise FormulaError(f"{node.id} is unknown")
        return env[node.id]
    if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
        left, right = _value(node.left, env), _value(node.right, env)
        if isinstance(node.op, ast.Pow) and abs(right) > 1000:
            raise FormulaError("exponent too large")
        return float(_BINARY[type(node.op)](left, right))
    if isinstance(node, ast.UnaryOp) and type(node.op) in _UNARY:
        return float(_UNARY[type(node.op)](_value(node.operand, env)))
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id.lower() in _CALLS and not node.keywords:
        return float(_CALLS[node.func.id.lower()](*[_value(a, env) for a in node.args]))
    raise FormulaError(f"{ast.dump(node)[:60]} isn't allowed")


def evaluate(formula: str, env: dict[str, float]) -> float:
    """Value of a formula of numbers, names, + - * / ** ^ and a few functions; nothing else is run."""
    try:
        return _value(_parsed(formula), env)
    except (ZeroDivisionError, OverflowError, TypeError, ValueError) as e:
        raise FormulaError(f"{formula!r}: {e}") from e


def environment(inputs: dict[str, float], calculated: list[tuple[str, str]]) -> dict[str, float]:
    """inputs and the calculated parameters, evaluated in the order of what they need. Raises FormulaError for a cycle."""
    env, open_ = dict(inputs), dict(calculated)
    while open_:
        ready = [n for n, f in open_.items() if not (names_in(f) & open_.keys() - {n}) and n not in names_in(f)]
        if not ready:
            raise FormulaError(f"{sorted(open_)} depend on one another")
        for n in ready:
            env[n] = evaluate(open_.pop(n), env)
    return env


@lru_cache(maxsize=50_000)
def names_in(formula: str) -> frozenset[str]:
    return frozenset(re.findall(r"[A-Za-z_]\w*", formula or ""))


def referenced(formula: Column) -> Column:
    """Names in a formula, in the JVM."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(formula, F.lit("")), F.lit(r"([A-Za-z_]\w*)"), F.lit(1)))


def override_plan(parameters: DataFrame, overrides: DataFrame) -> DataFrame:
    """process_code, name, value: which override counts for each input parameter that one reaches.

    parameters: process_code, name, original_name, kind, mf_parent_code. overrides: parameter_name, scope
    (a process or '*'), value, seq. A global override gives way to one of the parent process, that to one of
    the process itself; within these the last one counts. Names are compared without case, in either form.
    """
    p = parameters.where("kind = 'input'")
    user = p.select(F.explode(F.array(F.lower("name"), F.lower("original_name"))).alias("u"), "name").where("u is not null").groupBy("u").agg(F.min("name").alias("name"))
    o = checkpointed(overrides.select(F.lower("parameter_name").alias("u"), "scope", "value", "seq").join(user, "u").drop("u"))
    # names are few and shared by most processes, so parameters are not shuffled by them while the overrides are few
    met = p.select("process_code", "name", "mf_parent_code").join(F.broadcast(o) if o.count() <= BROADCAST_OVERRIDES else o, "name")
    tier = F.when(F.col("scope") == F.col("process_code"), 2).when(F.col("scope") == F.col("mf_parent_code"), 1).when(F.col("scope") == "*", 0)
    every = met.withColumn("tier", tier).where("tier is not null").select("process_code", "name", "value", "tier", "seq")
    return keep_first(every, ["process_code", "name"], [-F.col("tier"), -F.col("seq")]).select("process_code", "name", "value")


def unknown_overrides(parameters: DataFrame, overrides: DataFrame) -> DataFrame:
    """parameter_name, scope, reason of the overrides that reach nothing: unknown, calculated, or not of this process."""
    p = parameters.select(F.lower("name").alias("u"), "process_code", "kind")
    p = p.unionByName(parameters.where("original_name is not null").select(F.lower("original_name").alias("u"), "process_code", "kind"))
    g = p.groupBy("u").agg(F.bool_or(F.col("kind") == "input").alias("is_input"))
    at = p.where("kind = 'input'").select("u", F.col("process_code").alias("scope")).distinct().withColumn("here", F.lit(True))
    o = overrides.withColumn("u", F.lower("parameter_name")).join(g, "u", "left").join(at, ["u", "scope"], "left")
    reason = F.when(F.col("is_input").isNull(), "unknown parameter").when(~F.col("is_input"), "calculated parameter").when((F.col("scope") != "*") & F.col("here").isNull(), "not defined by this process")
    return o.select("parameter_name", "scope", reason.alias("reason")).where("reason is not null")


def influenced(parameters: DataFrame, changed: DataFrame) -> DataFrame:
    """process_code, name of all parameters that the changed ones (process_code, name) reach through formulas."""
    calc = parameters.where("kind = 'calculated'").select("process_code", "name", F.explode(referenced(F.col("formula"))).alias("needs"))
    node = lambda c: F.concat_ws("\u0001", F.col("process_code"), F.col(c))
    edges = calc.select(node("needs").alias("src"), node("name").alias("dst"))
    starts = changed.select(node("name").alias("node")).distinct().select(F.lit(0).alias("start"), "node")
    got = reachable(edges, starts).select(F.split("node", "\u0001").alias("n"))
    return got.select(F.col("n")[0].alias("process_code"), F.col("n")[1].alias("name")).distinct()


def touched(parameters: DataFrame, exchanges: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parameters and formula exchanges of processes that have an override; the rest is never shuffled with them."""
    codes = plan.select("process_code").distinct()
    return parameters.join(codes, "process_code", "left_semi"), exchanges.where("formula is not null").join(codes, "process_code", "left_semi")


def reevaluate(parameters: DataFrame, exchanges: DataFrame, plan: DataFrame, ratio: bool = False) -> DataFrame:
    """process_code, exchange_index, old_amount, new_amount, warning of the exchanges of the processes in the plan.

    exchanges: process_code, exchange_index, formula, amount. New amounts are the formula's value, or, with
    ratio, the old amount times new over baseline value; where the baseline is 0 the amount stays and the
    warning says so, as for formulas that can't be evaluated. Processes without an override aren't touched. What a
    process consists of comes as rows sorted by process, parameters first, so that no process is collected into a row;
    formulas are compiled once a worker.
    """
    p, e = touched(parameters, exchanges, plan)
    none = lambda t: F.lit(None).cast(t)
    p = p.select("process_code", F.when(F.col("kind") == "input", 0).otherwise(1).alias("what"), "name", none("long").alias("exchange_index"), F.col("amount").cast("double").alias("amount"), "formula")
    o = plan.select("process_code", F.lit(2).alias("what"), "name", none("long").alias("exchange_index"), F.col("value").cast("double").alias("amount"), none("string").alias("formula"))
    x = e.select("process_code", F.lit(3).alias("what"), none("string").alias("name"), F.col("exchange_index").cast("long").alias("exchange_index"), F.col("amount").cast("double").alias("amount"), "formula")
    rows = p.unionByName(o).unionByName(x).repartition(parallelism(parameters.sparkSession), "process_code").sortWithinPartitions("process_code", "what")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, at, inputs, plan_, calc, base, new, failed = None, -1, {}, {}, [], {}, {}, None
        for b in batches:
            out: list[tuple] = []
            for process, what, name, index, amount, formula in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if process != code:
                    code, at, inputs, plan_, calc = process, -1, {}, {}, []
                if what == 0:
                    inputs[name] = float(amount or 0.0)
                elif what == 1:
                    calc.append((name, formula))
                elif what == 2:
                    plan_[name] = amount
                else:
                    if at != 3:  # all parameters of the process are known
                        try:
                            failed, base, new = None, environment(inputs, calc) if ratio else {}, environment(inputs | plan_, calc)
                        except FormulaError as error:
                            failed = str(error)[:200]
                    out.append((code, index, *_amounts(formula, amount, base, new, failed, ratio)))
                at = what
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            types = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["process_code", "exchange_index", "old_amount", "new_amount", "warning"])

    return rows.mapInArrow(run, "process_code string, exchange_index long, old_amount double, new_amount double, warning string")


def _amounts(formula: str, amount: float, base: dict, new: dict, failed: str | None, ratio: bool) -> tuple[float, float, str | None]:
    """Old amount, new amount and warning of one exchange."""
    if failed:
        return amount, amount, failed
    try:
        value = evaluate(formula, new)
        if ratio:
            was = evaluate(formula, base)
            if was == 0:
                return amount, amount, "baseline is 0" if value else None
            value = amount * value / was
        return amount, value, None
    except FormulaError as error:
        return amount, amount, str(error)[:200]


def by_position(blocks: DataFrame, datasets: DataFrame) -> DataFrame:
    """position, process_code of each block: the dataset at the same place, checked; raises for any disagreement.

    blocks: position, identifier (null or blank if it has none). datasets: position (parents only, in the order of the
    blocks), code. Both have the same number of rows; an identifier is the code, and a block without one stands for a
    code made up on reading (32 hexadecimal digits).
    """
    b = blocks.select("position", F.nullif(F.trim("identifier"), F.lit("")).alias("identifier"))
    b = b.withColumn("identifier", F.when(~F.col("identifier").isin('""', "''"), F.col("identifier")))
    j = b.withColumn("_b", F.lit(True)).join(datasets.select("position", "code", F.lit(True).alias("_d")), "position", "full_outer")
    made = F.col("code").rlike("^[0-9a-f]{32}$")
    wrong = F.when(F.col("_b").isNull() | F.col("_d").isNull(), "without a partner").when(F.col("identifier").isNotNull() & ~F.col("identifier").eqNullSafe(F.trim("code")), "another identifier").when(F.col("identifier").isNull() & F.col("code").isNotNull() & ~made, "an identifier on one side only")
    bad = j.select("position", wrong.alias("why")).where("why is not null").limit(5).collect()
    if bad:
        raise ValueError(f"blocks and datasets don't stand side by side: {[(r.position, r.why) for r in bad]}")
    return j.select("position", F.col("code").alias("process_code"))


def extracted(block_parameters: DataFrame, codes: DataFrame, children: DataFrame) -> DataFrame:
    """The parameter table: rows of each block under its process, and again under each of its children.

    block_parameters: position, kind, name, original_name, amount, formula. codes: position, process_code
    (by_position). children: code, parent_code; their rows carry mf_parent_code. Blocks without a code are left out.
    """
    rows = block_parameters.join(codes.where("process_code is not null and process_code <> ''"), "position").drop("position")
    rows = rows.withColumn("original_name", F.coalesce("original_name", "name"))
    own = rows.withColumn("mf_parent_code", F.lit(None).cast("string"))
    theirs = rows.join(children.select(F.col("parent_code").alias("process_code"), F.col("code").alias("_c")), "process_code").withColumn("mf_parent_code", F.col("process_code")).withColumn("process_code", F.col("_c")).drop("_c")
    return own.unionByName(theirs.select(*own.columns)).select("process_code", "name", "original_name", "kind", "amount", "formula", "mf_parent_code")


def formula_references(exchanges: DataFrame) -> DataFrame:
    """process_code, exchange_index, formula, names: the formulas of exchanges with the names that they use."""
    return exchanges.where("formula is not null").select("process_code", "exchange_index", "formula", F.array_sort(referenced(F.col("formula"))).alias("names"))


def parameter_summary(parameters: DataFrame) -> DataFrame:
    """name, kind, n_processes, min, max."""
    return parameters.groupBy("name", "kind").agg(F.count_distinct("process_code").alias("n_processes"), F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"))


#: Wanted names in one block; more are taken block by block.
BLOCK_NAMES = 1_000


def close_names(wanted: DataFrame, known: DataFrame, n: int = 3) -> DataFrame:
    """wanted, suggestion, distance: the n known names nearest by edit distance within half of the length.

    The wanted names (what a user mistyped) are asked of every known name, in blocks; nothing is joined. The nearest of
    each are picked by partial windows.
    """
    k = known.select(F.col("name").alias("suggestion"), F.lower("name").alias("_k")).where("suggestion is not null").distinct()
    out, block = None, []

    def near(block: list[str]) -> DataFrame:
        j = k.withColumn("wanted", F.explode(F.from_json(F.lit(json.dumps(block)), "array<string>")))
        most = F.floor(F.greatest(F.length("wanted"), F.length("_k")) / 2)
        j = j.where(F.abs(F.length("wanted") - F.length("_k")) <= most).withColumn("distance", F.levenshtein(F.lower("wanted"), "_k"))
        return top_per_group(j.where(F.col("distance") <= most), ["wanted"], [F.col("distance"), F.col("suggestion")], n).select("wanted", "suggestion", "distance")

    for r in wanted.select("wanted").where("wanted is not null").distinct().toLocalIterator():
        block.append(r.wanted)
        if len(block) == BLOCK_NAMES:
            out, block = near(block) if out is None else out.unionByName(near(block)), []
    if block or out is None:
        out = near(block) if out is None else out.unionByName(near(block))
    return out
