"""Names and codes of the change stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change types and their one-letter codes; any other type has none.
OP_CODES = {"insert": "I", "update": "U", "delete": "D", "bootstrap-insert": "I"}


def op_code(change_type: Column) -> Column:
    """I, U or D by exact, case-sensitive match, else NULL."""
    pairs = [F.lit(x) for pair in OP_CODES.items() for x in pair]
    return F.element_at(F.create_map(*pairs), change_type)


# Formats of fact topic names and dimension keys.
def fact_topic(table: Column, op: Column, suffix: str) -> Column:
    """``DWD_{TABLE}_{op}_{suffix}``"""
    return F.concat(F.lit("DWD_"), F.upper(table), F.lit("_"), op, F.lit(f"_{suffix}"))


def dim_space(table: Column) -> Column:
    """``DIM:{TABLE}``, the part of a dimension key before the row id."""
    return F.concat(F.lit("DIM:"), F.upper(table))


def dim_key(space: Column, row_id: Column) -> Column:
    """``DIM:{TABLE}:{id}``"""
    return F.concat(space, F.lit(":"), row_id)


def row_id(data: Column) -> Column:
    """``id`` of a raw JSON row image, as text."""
    return F.get_json_object(data, "$.id")
