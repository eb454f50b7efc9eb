"""Masked values are NULL: remaps, masks and rule chains as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lookup(codes: Mapping[int, int] | Mapping[str, int], col: Column) -> Column:
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def remap_strict(col: Column, codes: Mapping) -> Column:
    """The listed codes remapped, all others masked."""
    return _lookup(codes, col)


def remap_keep(col: Column, codes: Mapping) -> Column:
    """The listed codes remapped, all others as they are."""
    return F.coalesce(_lookup(codes, col), col)


def unmask(col: Column, value: int = 0) -> Column:
    return F.coalesce(col, F.lit(value))


def update_mask(col: Column, test: Column) -> Column:
    """col where the test is true, masked elsewhere."""
    return F.when(test, col)


def self_mask(col: Column) -> Column:
    """Zero becomes masked."""
    return F.when(col != 0, col)


def where_set(col: Column, rules: Iterable[tuple[Column, int]]) -> Column:
    """A chain of (test, value); a later rule wins over an earlier one."""
    out = None
    for test, value in reversed(list(rules)):
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return col if out is None else out.otherwise(col)


def blend(base: Column, top: Column) -> Column:
    """top where it is not masked, else base."""
    return F.coalesce(top, base)


def binarize(col: Column, cls: int) -> Column:
    """1 for the class, 0 for others, masked stays masked."""
    return (col == cls).cast("int")


def to_unsigned(col: Column, bits: int) -> Column:
    """Cast that clamps to the unsigned range and truncates."""
    return F.least(F.greatest(col.cast("double"), F.lit(0.0)), F.lit(float(2**bits - 1))).cast("long")


def in_classes(col: Column, classes: Iterable[int]) -> Column:
    return col.isin(*classes)


def clear(scenes: DataFrame, quality: str = "quality") -> DataFrame:
    """Scenes without any quality flag; unknown quality counts as a flag."""
    return scenes.where(F.col(quality) == 0)
