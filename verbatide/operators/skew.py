"""Joining many rows to a lookup table when some keys are very common.

Words follow a steep law: one word may be a third of all rows. A key is *hot* when it holds more
rows than one in ``HOT_SHARE`` of all, and more than ``MIN_ROWS``; by counting there are fewer than ``HOT_SHARE``
hot keys, so the list of them is broadcast under a proven bound. A hot key's rows are dealt over as many
salts as bring each down to that number of rows, and its lookup row is repeated once per salt;
every other key keeps salt zero. One pass over the facts, every row kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 20_000
MIN_ROWS = 1000
COMMON = 65_536  # keys whose entries are broadcast


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    counts: DataFrame | None = None,
    how: str = "inner",
    share: int = HOT_SHARE,
    least: int = MIN_ROWS,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` (unique on ``key``, a column or several), ``how`` being inner or left.

    ``counts(key, n)`` gives each key's number of rows in ``facts``, keys without a lookup row
    included; without it the rows are counted in one partially aggregated pass.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = [key] if isinstance(key, str) else list(key)
    if counts is None:
        counts = facts.groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    rows = F.greatest(F.lit(least), total / share)  # a task's share of a hot key
    hot = counts.where(F.col("n") > rows).select(*keys, F.ceil(F.col("n") / rows).cast("int").alias("_salts"))
    # The salt is a hash of the row, so a rerun task deals its rows the same way. Rows without a key
    # match nothing, but an outer join would bring them all together, so they are dealt too.
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salts = F.when(missing, F.lit(share)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = facts.join(F.broadcast(hot), keys, "left")
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), salts).cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = lookup.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def common_entries(lookup: DataFrame, key: str, counts: DataFrame, most: int = COMMON) -> DataFrame:
    """The ``lookup`` rows of the ``most`` commonest keys of ``counts(key, n)``, small enough to broadcast, with a
    column ``_common``. A common key without an entry has nulls, so that it need not be looked for elsewhere."""
    top = counts.where(F.col(key).isNotNull()).orderBy(F.desc("n"), key).limit(most).select(key, F.lit(True).alias("_common"))
    found = lookup.join(F.broadcast(top.select(key)), key)
    return top.join(F.broadcast(found), key, "left")
