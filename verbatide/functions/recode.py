"""Casts, dates and class recoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V


def to_number(c: Column, strict: bool = True) -> Column:
    """Text as a double: malformed text raises when ``strict``, else is null."""
    return c.cast("double") if strict else c.try_cast("double")


def to_moment(c: Column, fmt: str | None = None) -> Column:
    return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)


def date_parts(c: Column) -> dict[str, Column]:
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year, month, day)


def day_text(c: Column) -> Column:
    return F.date_format(c, V.DAY_FORMAT)


def polarity(score: Column) -> Column:
    """Sign of a score as a class. Zero, null and NaN are neutral; NaN sorts above zero in Spark,
    so it is tested first."""
    known = score.isNotNull() & ~F.isnan(score)
    return (
        F.when(known & (score < 0), V.NEGATIVE).when(known & (score > 0), V.POSITIVE).otherwise(V.NEUTRAL)
    )


def class_code(name: Column) -> Column:
    """Class name to its text code; anything unknown is neutral."""
    return (
        F.when(name == V.NEGATIVE, V.CLASS_CODES[V.NEGATIVE])
        .when(name == V.POSITIVE, V.CLASS_CODES[V.POSITIVE])
        .otherwise(V.CLASS_CODES[V.NEUTRAL])
    )


def collapse_levels(level: Column) -> Column:
    """Five levels to three classes; unknown and null are neutral."""
    return (
        F.when(level.isin(V.NEGATIVE_LEVELS), V.NEGATIVE)
        .when(level.isin(V.POSITIVE_LEVELS), V.POSITIVE)
        .otherwise(V.NEUTRAL)
    )


def map_codes(c: Column, codes: Mapping[str, int] = V.NUMERIC_CODES) -> Column:
    """Class name to a number by an explicit mapping; a name outside it gives null."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def rename(df: DataFrame, **names: str) -> DataFrame:
    """Rename columns, raising on a missing one instead of passing silently."""
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(names)
