"""Schemas of the tables that the engine reads and writes, declared once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "mapping": "source_kind string, source_name string, source_unit string, source_context array<string>, source_top_bucket string, source_cas string, source_formula string, target_db string, target_code string, target_name string, target_unit string, unit_conversion double, priority_tier int, provenance string, provenance_row string, is_unmatchable boolean, notes string",
    "unit_conversion": "source_unit string, target_unit string, multiplier double, provenance string",
    "unit_alias": "alias string, alias_lower string, canonical string, provenance string",
    "context_norm": "source_context array<string>, target_context array<string>, provenance string",
    "deletion": "name string, code string, kind string, provenance string",
    "edge_label": "source_name string, target_name string, edge_type string, categories array<string>, provenance string",
    "target_index": "code string, name string, name_lower string, unit string, bucket string, categories array<string>, cas string",
    "audit": "process_name string, exchange_name string, exchange_unit string, exchange_bucket string, kind string, new_tier int, new_target_db string, new_target_code string, new_provenance string, prior_tier int, prior_target_db string, prior_target_code string, reason string, unit_conversion double",
    "exchange_long": "output_id long, input_id long, amount double, edge_type string, is_biosphere boolean, allocation_factor double",
    "product_catalog": "database string, code string, name string, type string, unit string, product_id long",
    "activity_catalog": "activity_id long, database string, code string, name string, type string, unit string, location string, reference_product string, product_id long",
    "biosphere_flow": "db string, code string, name string, unit string, bucket string, cas string, categories array<string>",
    "method_cf": "method_slug string, db string, code string, cf double",
    "regional_cf": "method_slug string, db string, code string, location string, cf double",
    "table_cf": "method string, method_unit string, compartment string, sub_compartment string, name string, cas string, cf double, flow_unit string, cf_unit string",
    "parameter": "process_code string, name string, original_name string, kind string, amount double, formula string, mf_parent_code string",
    "override": "parameter_name string, scope string, value double, set_at string, comment string",
    "joined_flow": "code string, database string, name string, categories array<string>, cas string, sp_cf double, ef_cf double, sp_match_provenance string, sp_name string, sp_compartment string, sp_sub_compartment string",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


class SchemaError(ValueError):
    """A frame that lacks a column or has it in another type."""


def assert_schema(df: DataFrame, name: str, optional: tuple[str, ...] = ("allocation_factor",)) -> DataFrame:
    """df as it is, if it has the table's columns in their types (any numeric width passes for numbers)."""
    have = {f.name: f.dataType for f in df.schema}
    for f in schema(name):
        if f.name not in have:
            if f.name in optional:
                continue
            raise SchemaError(f"{name}: column {f.name} is missing")
        if f.dataType != have[f.name] and not (isinstance(f.dataType, T.NumericType) and isinstance(have[f.name], T.NumericType)):
            raise SchemaError(f"{name}: {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df


def conformed(df: DataFrame, name: str) -> DataFrame:
    """df with exactly the table's columns, cast; missing ones are null."""
    from pyspark.sql import functions as F

    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name)])
