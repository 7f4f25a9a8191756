"""Canonical JSON and the ids made from it, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Fields = dict[str, "Column | Fields"]


def canonical_struct(fields: Fields) -> Column:
    """A struct of the fields by name, at every level."""
    parts = ((k, canonical_struct(v) if isinstance(v, dict) else v) for k, v in sorted(fields.items()))
    return F.struct(*(v.alias(k) for k, v in parts))


def canonical_json(fields: Fields) -> Column:
    """Compact JSON with sorted names; null fields are written as null."""
    return F.to_json(canonical_struct(fields), {"ignoreNullFields": "false"})


def content_id(fields: Fields, kind: str = "") -> Column:
    """SHA-256 of the canonical JSON, with a kind before it, so that ids of different kinds differ."""
    digest = F.sha2(canonical_json(fields).cast("binary"), 256)
    return F.concat(F.lit(f"{kind}:"), digest) if kind else digest


def sorted_unique(column: Column) -> Column:
    """A list's different values in order, nulls left out."""
    return F.array_sort(F.array_distinct(F.array_compact(column)))


def distribution(column: Column) -> Column:
    """A list's values and how often each comes, as a map by value."""
    values = sorted_unique(column)
    return F.map_from_arrays(values, F.transform(values, lambda v: F.size(F.filter(column, lambda x: x == v))))
