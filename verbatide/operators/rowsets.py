"""Unions, splits, row numbers, sorts and slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.operators.ordering import dense_index
from verbatide.session import materialise

SPLIT_STEPS = 10_000


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column a table lacks is null there."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def union_by_position(*tables: DataFrame) -> DataFrame:
    result = tables[0]
    for table in tables[1:]:
        result = result.union(table)
    return result


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def _cuts(weights: Sequence[float]) -> list[int]:
    total, cuts, upto = sum(weights), [], 0.0
    for weight in weights:
        upto += weight
        cuts.append(round(SPLIT_STEPS * upto / total))
    return cuts


def split_part(step: Column, weights: Sequence[float]) -> Column:
    """Which part a step in ``[0, SPLIT_STEPS)`` falls into."""
    *cuts, _ = _cuts(weights)
    return sum((F.when(step >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))


def key_number(keys: Sequence[str], seed: int) -> Column:
    """32 bits of the MD5 of seed and keys, joined by colons: a number any other engine can take too."""
    joined = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long")


def keyed_split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float], seed: int
) -> list[DataFrame]:
    """A split decided by the key alone: no sort, and the same under any partitioning or rerun."""
    keys = [key] if isinstance(key, str) else list(key)
    part = split_part(key_number(keys, seed) % SPLIT_STEPS, weights)
    return [df.where(part == i) for i in range(len(weights))]


def exact_split(
    df: DataFrame, key: str | Sequence[str], weights: Sequence[float], seed: int, by: str | None = None
) -> list[DataFrame]:
    """A split by a hash of the key whose parts have exactly their shares of the rows, of each value of ``by`` if named.

    The first parts of a class of n rows end at row round(n · share) of its order by hash and key. Where that is, five
    histograms of 4096 steps find, each inside the step of the one before: nothing is sorted and no rows meet
    but those of equal hash at a cut. A missing class is one of its own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    joined = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    number = F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")  # 60 bits
    kind = F.xxhash64(by) if by else F.lit(0).cast("long")
    rows = df.select(F.struct(*df.columns).alias("_row"), kind.alias("_class"), number.alias("_number"))
    shares = [sum(weights[: i + 1]) / sum(weights) for i in range(len(weights) - 1)]
    sizes = rows.groupBy("_class").agg(F.count("*").alias("n"))
    ends = [F.struct(F.lit(i).alias("cut"), F.round(F.col("n") * share).cast("long").alias("left")) for i, share in enumerate(shares)]
    cuts = sizes.select("_class", F.inline(F.array(*ends))).withColumn("prefix", F.lit(0).cast("long")) if shares else None
    for shift in (48, 36, 24, 12, 0) if shares else ():
        met = rows.select("_class", "_number").join(cuts, "_class").where(F.shiftright("_number", shift + 12) == F.col("prefix"))
        steps = met.groupBy("_class", "cut", "left", F.shiftright("_number", shift).alias("step")).agg(F.count("*").alias("m"))
        upto = F.sum("m").over(Window.partitionBy("_class", "cut").orderBy("step"))
        found = steps.withColumn("upto", upto).where(F.col("upto") > F.col("left")).groupBy("_class", "cut")
        found = found.agg(F.min_by(F.struct("step", (F.col("left") - F.col("upto") + F.col("m")).alias("left")), "step").alias("at"))
        cuts = materialise(found.select("_class", "cut", F.col("at.left").alias("left"), F.col("at.step").alias("prefix")))
    if not shares:
        return [df]
    lists = cuts.groupBy("_class").agg(F.collect_list(F.struct("prefix", "left")).alias("_cuts"))
    placed = rows.join(lists, "_class", "left").withColumn("_cuts", F.coalesce("_cuts", F.array().cast("array<struct<prefix:bigint,left:bigint>>")))
    at_cut = F.exists("_cuts", lambda c: c["prefix"] == F.col("_number"))
    rank = F.row_number().over(Window.partitionBy("_class", "_number").orderBy(*[F.col("_row")[k] for k in keys])) - 1
    ranked = placed.where(at_cut).withColumn("_rank", rank)
    ranked = ranked.unionByName(placed.where(~at_cut).withColumn("_rank", F.lit(0)))
    beyond = lambda c: (F.col("_number") > c["prefix"]) | ((F.col("_number") == c["prefix"]) & (F.col("_rank") >= c["left"]))
    part = F.size(F.filter("_cuts", beyond))
    return [ranked.where(part == i).select("_row.*") for i in range(len(weights))]


def nested_holdout(
    train: DataFrame, test: DataFrame, key: str | Sequence[str], seed: int = 5043
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(training, validation, final test): both inputs give up a small part to the final test
    (a tenth of ``train``, a fifth of ``test``); the rest is pooled and split eight to two."""
    big_train, small_train = keyed_split(train, key, [0.9, 0.1], seed)
    big_test, small_test = keyed_split(test, key, [0.8, 0.2], seed)
    pool = union_by_name(big_train, big_test)
    # Another seed, or the second cut would only repeat the first.
    training, validation = keyed_split(pool, key, [0.8, 0.2], seed + 1)
    return training, validation, union_by_name(small_train, small_test)


def with_row_index(df: DataFrame, key: str | Sequence[str], name: str = "index") -> DataFrame:
    """Dense row numbers from zero in key order."""
    keys = [key] if isinstance(key, str) else list(key)
    return dense_index(df, [F.asc(k) for k in keys], name)


def most_frequent(counts: DataFrame, n: str, *ties: str) -> DataFrame:
    """Sort by count, descending, ties by the given columns."""
    return counts.orderBy(F.desc(n), *[F.asc(t) for t in ties])


def top_k(counts: DataFrame, k: int, n: str, *ties: str) -> DataFrame:
    return most_frequent(counts, n, *ties).limit(k)


def rank_slice(counts: DataFrame, first: int, last: int, n: str, *ties: str) -> DataFrame:
    """Ranks ``first`` to ``last``, counted from one."""
    return most_frequent(counts, n, *ties).offset(first - 1).limit(last - first + 1)
