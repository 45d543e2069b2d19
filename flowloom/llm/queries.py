"""Queries of the text and matching problems, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.llm.copies import copy_counts, later_copies
from flowloom.llm.leaks import leaked_items, leaked_passages, without_passages
from flowloom.llm.linkage import linked, undecided
from flowloom.llm.quality import not_prose, text_types
from flowloom.llm.tokens import encoded
from flowloom.llm.valuemap import typed_values
from flowloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return typed_values(*[table(spark, root, t) for t in ("context_norm", "flow_synonyms", "context_list", "flow_list")])


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return later_copies(table(spark, root, "flow_records"))


def p4_counts(spark: SparkSession, root: str) -> DataFrame:
    return copy_counts(table(spark, root, "flow_records"))


def _linked(spark: SparkSession, root: str) -> DataFrame:
    return linked(*[table(spark, root, t) for t in ("source_records", "biosphere_catalog", "context_list")])


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return _linked(spark, root).select("source_id", "db", "code").distinct()


def p5_confidence(spark: SparkSession, root: str) -> DataFrame:
    """Every match with its confidence."""
    return _linked(spark, root)


def p5_undecided(spark: SparkSession, root: str) -> DataFrame:
    """Catalogue rows of equally likely substances, between which a record can't be decided."""
    return undecided(*[table(spark, root, t) for t in ("source_records", "biosphere_catalog", "context_list")])


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    return encoded(table(spark, root, "documents"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leaked_items(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p8_passages(spark: SparkSession, root: str) -> DataFrame:
    """Where each leaked passage stands and how many words it has."""
    return leaked_passages(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p8_cleaned(spark: SparkSession, root: str) -> DataFrame:
    """Every document with a leaked passage, cut or dropped by length and coverage."""
    return without_passages(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return not_prose(table(spark, root, "documents"))


def p9_statistics(spark: SparkSession, root: str) -> DataFrame:
    """The statistics and the type of every document."""
    return text_types(table(spark, root, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p3_found, p4_found, p4_counts, p5_found, p5_confidence, p5_undecided, p7_ids, p8_found, p8_passages, p8_cleaned, p9_found, p9_statistics)}

_KEY = "trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_P4 = f"""
with k as (
  select record_id, inventory,
    list_sort(list_filter(list_transform(regexp_split_to_array(coalesce(name, ''), '[,;|/]'), lambda x: {_KEY.format(x='x')}), lambda x: x <> '')) as parts,
    list_sort(list_filter(list_transform(coalesce(categories, []), lambda x: {_KEY.format(x="coalesce(x, '')")}), lambda x: x <> '')) as elements
  from (select distinct record_id, inventory, name, categories from flow_records)),
f as (select record_id, min(record_id) over (partition by inventory, parts, elements) as first_id from k)"""

ORACLE: dict[str, str] = {
    "p4_found": f"{_P4} select distinct first_id, record_id from f where record_id > first_id",
    "p4_counts": f"{_P4} select first_id, count(distinct record_id) as n_copies from f group by 1",
}
