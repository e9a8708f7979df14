"""Expressions over numeric and string arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(as_doubles(left), as_doubles(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    squares = F.aggregate(as_doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x)
    return F.sqrt(squares)


def cosine(left: Column, right: Column, left_norm: Column | None = None, right_norm: Column | None = None) -> Column:
    """Cosine similarity; 0 for a missing or zero vector and for different dimensions."""
    ln = norm(left) if left_norm is None else left_norm
    rn = norm(right) if right_norm is None else right_norm
    usable = (F.size(left) == F.size(right)) & (ln > 0) & (rn > 0)
    return F.coalesce(F.when(usable, dot(left, right) / (ln * rn)), F.lit(0.0))


def skill_set(skills: Column) -> Column:
    """Distinct lower-case entries; null entries are ignored."""
    present = F.filter(skills, lambda s: s.isNotNull())
    return F.array_distinct(F.transform(present, lambda s: F.lower(s)))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two distinct arrays; 0 when either is empty or missing."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    usable = (F.size(left) > 0) & (F.size(right) > 0)
    return F.coalesce(F.when(usable, both.cast("double") / either), F.lit(0.0))
