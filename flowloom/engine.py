"""The engine's commands, each one call: DataFrames in, DataFrames out. Everything is a composition of the operators."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators import catalog, cf, export, frame, graph, link, match, matrix, params, registry, report, score, solve, techno
from flowloom.sources import registry as sources


@dataclass(frozen=True)
class Settings:
    """What a run is configured by."""

    databases: tuple[str, ...]  # of flows, the preferred one first
    region_databases: tuple[str, ...] = ()
    power_prefixes: tuple[str, ...] = ("electricity", "market for electricity", "market group for electricity")
    reviewed_suggestions: bool = True  # whether reviewed suggestions link
    transitive_layer: bool = False  # whether the opt-in curated layer is read
    drop_unlinked: bool = False


@dataclass(frozen=True)
class System:
    """The matrices of a linked inventory: A, B, Q, C, and who makes what."""

    a: DataFrame
    b: DataFrame
    q: DataFrame
    corrections: DataFrame | None
    producers: DataFrame


class Engine:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings = spark, settings

    # registries and catalogues

    def build_registry(self, read: Iterable[DataFrame], transitive: Iterable[DataFrame] = ()) -> DataFrame:
        """One registry of all sources in order; the transitive layer only if the settings say so."""
        return sources.build([*read, *(transitive if self.settings.transitive_layer else ())])

    def flows(self, flows: DataFrame, used: list[DataFrame]) -> DataFrame:
        return registry.needed_flows(flows, used)

    def flow_catalog(self, snapshots: list[DataFrame | None]) -> DataFrame:
        return registry.with_bucket(registry.flow_catalog(snapshots), list(self.settings.databases))

    def background_catalog(self, activities: DataFrame, db: str) -> DataFrame:
        return registry.activity_catalog(activities, db)

    def method_factors(self, own: DataFrame, inherited: DataFrame, additions: list[DataFrame], flows: DataFrame, table: DataFrame, synonyms: DataFrame, excluded: DataFrame, exempt: list[str] = ()) -> DataFrame:
        return registry.method_registry(own, inherited, additions, flows, table, synonyms, excluded, list(self.settings.databases), exempt)

    # linking

    def link(self, exchanges: DataFrame, mapping: DataFrame, flows: DataFrame, conversions: DataFrame) -> DataFrame:
        """Biosphere exchanges with target, amount and unit of their best match, regions of water flows included."""
        m = match.tiered_match(exchanges, mapping, flows, conversions, list(self.settings.databases), self.settings.reviewed_suggestions)
        units = flows.select(match.folded("db").alias("t_db"), match.folded("code").alias("t_code"), F.col("unit").alias("t_unit"))
        out = techno.apply_matches(exchanges, m, units, list(self.settings.region_databases))
        return out.where("t_code is not null") if self.settings.drop_unlinked else out

    def link_technosphere(self, exchanges: DataFrame, background: DataFrame, conversions: DataFrame, fixes: DataFrame, redirects: DataFrame) -> DataFrame:
        return techno.techno_match(exchanges, background, conversions, fixes, redirects, list(self.settings.power_prefixes))

    def candidates(self, residual: DataFrame, flows: DataFrame, n: int = 10) -> DataFrame:
        """The n most similar flows of each residual name: what a reviewer is offered."""
        return match.token_candidates(residual, flows, n)

    def coverage(self, exchanges: DataFrame) -> DataFrame:
        return link.coverage(exchanges)

    # scoring

    def system(self, edges: DataFrame, factors: DataFrame, producers: DataFrame, regional: DataFrame | None = None, locations: DataFrame | None = None) -> System:
        """Matrices of a frame: split by allocation, without loops and dangling edges, one producer for each product."""
        f, _ = frame.allocate(edges)
        f = frame.prune(frame.without_self_loops(frame.one_producer(f)))
        a, b = matrix.technosphere_matrix(f), matrix.biosphere_matrix(f)
        q = matrix.characterisation(factors, b)
        c = matrix.regional_correction(b, q, regional, locations) if regional is not None and locations is not None else None
        return System(a, b, q, c, producers)

    def scores(self, s: System, demands: DataFrame) -> DataFrame:
        return score.product_scores(s.a, s.producers, demands, s.b, s.q, s.corrections)

    def skipped(self, s: System, demands: DataFrame) -> DataFrame:
        return solve.unsolvable(s.a, s.producers, demands)

    def decompose(self, s: System, demands: DataFrame) -> dict[str, DataFrame]:
        """Flows, activities and edges behind the scores: one solution, all methods."""
        x = solve.supply(s.a, s.producers, demands)
        return {"flows": score.flow_contributions(x, s.b, s.q), "activities": score.activity_contributions(x, s.b, s.q, s.corrections), "edges": score.edge_contributions(x, s.b, s.q)}

    def reached(self, edges: DataFrame, starts: DataFrame) -> DataFrame:
        return graph.reachable(edges, starts)

    # comparison and export

    def backtest(self, scores: DataFrame, reference: DataFrame, mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Differences and their summary. scores: demand_id, method, score; reference: ref_id, method, reference; mapped: ref_id, key."""
        pairs = reference.join(mapped, "ref_id").join(scores.select(F.col("demand_id").alias("key"), "method", F.col("score").alias("computed")), ["key", "method"], "left")
        d = report.differences(pairs)
        return d, report.summary(d)

    def map_products(self, references: DataFrame, entries: DataFrame) -> DataFrame:
        return report.map_products(references, export.scoreable(entries))

    def compare_factors(self, flows: DataFrame, table: DataFrame) -> DataFrame:
        """Flow by flow: the table's factor beside the registry's, with ratio, gaps and status."""
        return cf.comparison(cf.flow_join(flows, table))

    def export_package(self, s: System, root: str, labels: DataFrame, methods: list[list[str]], extra: dict | None = None) -> dict:
        tables = {"technosphere": s.a, "biosphere": s.b, "factors": s.q, "products": export.product_labels(s.producers.select("product_id"), labels)}
        return export.write_package(root, tables, methods, extra or {})

    def skeleton(self, s: System, background: DataFrame) -> System:
        """The system without the columns of the background (col_id)."""
        return System(matrix.skeleton(s.a, background), matrix.skeleton(s.b, background), s.q, s.corrections, s.producers)

    def review(self, usage: DataFrame, placeholders: DataFrame, flows: DataFrame) -> DataFrame:
        return catalog.review_table(usage, placeholders, flows)

    # parameters

    def with_overrides(self, parameters: DataFrame, exchanges: DataFrame, overrides: DataFrame, ratio: bool = True) -> DataFrame:
        """What overrides change; overrides that reach nothing raise UnknownParameter with what may be meant."""
        lost = params.unknown_overrides(parameters, overrides).limit(5).collect()
        if lost:
            near = params.close_names(self.spark.createDataFrame([(r.parameter_name,) for r in lost], "wanted string"), parameters.select("name").distinct())
            raise params.UnknownParameter(f"{[(r.parameter_name, r.scope, r.reason) for r in lost]}; near: {[(r.wanted, r.suggestion) for r in near.collect()]}")
        return params.reevaluate(parameters, exchanges, params.override_plan(parameters, overrides), ratio)
