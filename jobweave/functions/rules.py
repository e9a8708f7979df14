"""Small business rules as expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import fixed


def merge_skills(extracted: Column, listed: Column) -> Column:
    """Extracted then listed skills, duplicates kept; a missing list counts as empty."""
    empty = F.expr("cast(array() as array<string>)")
    return F.concat(F.coalesce(extracted, empty), F.coalesce(listed, empty))


def experience_years(
    level: Column,
    years: Mapping[str, int] = fixed.EXPERIENCE_YEARS,
    default: int = fixed.EXPERIENCE_DEFAULT,
) -> Column:
    out = F.lit(default)
    for name, value in years.items():
        out = F.when(level == name, F.lit(value)).otherwise(out)
    return out


def skill_count(skills: Column) -> Column:
    return F.coalesce(F.array_size(skills), F.lit(0))


def has_salary(low: Column, high: Column) -> Column:
    """Both ends given and non-zero."""
    return F.coalesce((low != 0) & (high != 0), F.lit(False))


def salary_midpoint(low: Column, high: Column) -> Column:
    """Middle of the range, null unless both ends are given and non-zero."""
    return F.when(has_salary(low, high), (low.cast("double") + high.cast("double")) / 2)


def salary_diff_percentage(offered: Column, predicted: Column) -> Column:
    """Gap of an offer to the predicted market salary in percent; null for a zero prediction."""
    return F.try_divide(offered.cast("double") - predicted, predicted.cast("double")) * 100


def rule_salary(skills: Column, years: Column, location: Column) -> Column:
    """Rule-based salary range ``struct(salary_min, salary_max, currency)``. Case-sensitive."""

    def any_of(names: Sequence[str]) -> Column:
        return F.coalesce(F.arrays_overlap(skills, F.array(*[F.lit(n) for n in names])), F.lit(False))

    base = (
        F.lit(fixed.SALARY_BASE)
        + years * F.lit(fixed.SALARY_PER_YEAR)
        + skill_count(skills) * F.lit(fixed.SALARY_PER_SKILL)
        + F.when(any_of(fixed.SALARY_CLOUD_SKILLS), fixed.SALARY_CLOUD_BONUS).otherwise(0.0)
        + F.when(any_of(fixed.SALARY_PYTHON_SKILLS), fixed.SALARY_PYTHON_BONUS).otherwise(0.0)
    )
    factor = F.when(location.contains(fixed.SALARY_CITY), fixed.SALARY_CITY_FACTOR).otherwise(1.0)
    amount = base * factor
    return F.struct(
        (amount * fixed.SALARY_LOW).alias("salary_min"),
        (amount * fixed.SALARY_HIGH).alias("salary_max"),
        F.lit(fixed.SALARY_CURRENCY).alias("currency"),
    )


def to_number(value: Column) -> Column:
    """Number or null, never an error."""
    return value.try_cast("double")


def threshold_label(probability: Column, threshold: float = 0.5) -> Column:
    """1 when the probability is strictly above the threshold."""
    return (probability > F.lit(threshold)).cast("int")


def hash_bits(key: Column) -> Column:
    """60 uniform bits of a key's MD5: the same in every engine and for every partitioning."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")


def hash_percent(key: Column) -> Column:
    return hash_bits(key) % 100
