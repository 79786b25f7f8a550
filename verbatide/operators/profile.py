"""Column profiles, samples, duplicates and missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _present(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    floating = isinstance(df.schema[name].dataType, (DoubleType, FloatType))
    return c.isNotNull() & ~F.isnan(c) if floating else c.isNotNull()


def _per_column(df: DataFrame, counts: dict[str, Column], value: str) -> DataFrame:
    """One aggregate pass, then one row per column."""
    wide = df.agg(*[c.alias(name) for name, c in counts.items()])
    return wide.unpivot([], list(counts), "column", value)


def non_null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {n: F.count_if(_present(df, n)) for n in df.columns}, "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column; a floating NaN counts as missing."""
    return _per_column(df, {n: F.count_if(~_present(df, n)) for n in df.columns}, "nulls")


def column_profile(df: DataFrame) -> DataFrame:
    """Column, type and number of present values."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = non_null_counts(df)
    return counts.select("column", F.element_at(types, F.col("column")).alias("dtype"), "non_null")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def schema_text(df: DataFrame) -> str:
    return df.schema.treeString()


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.asc(key)).limit(n)


def last_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n)


def random_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(n)


def has_duplicates(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """One row: does any full row occur twice? ``ignore`` names surrogate ids; nulls are equal."""
    columns = [c for c in df.columns if c not in ignore]
    groups = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.max("_n") > 1, F.lit(False)).alias("any_duplicate"))


def drop_duplicates(df: DataFrame, surrogate: str | None = None) -> DataFrame:
    """Distinct rows. With a ``surrogate`` id, rows equal in all else keep their smallest id.

    A minimum is combined before the shuffle, so a text copied into a third of the rows costs one
    row per task, where a window would bring all copies together.
    """
    if surrogate is None:
        return df.dropDuplicates()
    columns = [c for c in df.columns if c != surrogate]
    return df.groupBy(*columns).agg(F.min(surrogate).alias(surrogate)).select(*df.columns)


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace missing values by the mean of the present ones, lazily, through a scalar subquery."""
    value = F.when(_present(df, column), F.col(column))
    mean = df.agg(F.avg(value)).scalar()
    return df.withColumn(column, F.coalesce(value, mean))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))
