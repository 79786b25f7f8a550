"""Centroid clustering of integer vectors in native expressions.

Vectors are scaled to integers, so every step is exact and the same on any cluster. A round is one pass:
``zip_with`` and ``aggregate`` give a vector's squared distance to each centroid, the centroids being
literal arrays, the smallest struct of an array names the nearest, and one column sum per component, combined
in the tasks, gives the next centroids. The driver sees ``clusters`` rows of sums a round and no vectors; a cluster that
holds a third of all vectors is one row per task after the partial sums.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
COMPONENTS = 64
LARGEST = 1 << 26  # scaled components up to this size keep all distances below 2^63
MOST_COMPONENTS = 90  # columns that generated code sums at once


@dataclass
class Centroids:
    """Centroids of integer components, numbered from 0."""

    vectors: list[list[int]]

    def nearest(self, vector: str) -> Column:
        """Struct (distance, cluster) of the nearest centroid; of equally near ones the smaller number."""
        found = []
        for number, centroid in enumerate(self.vectors):
            apart = F.zip_with(F.col(vector), F.lit(centroid).cast("array<long>"), lambda x, c: (x - c) * (x - c))
            distance = F.aggregate(apart, F.lit(0).cast("long"), lambda total, part: total + part)
            found.append(F.struct(distance.alias("distance"), F.lit(number).alias("cluster")))
        return F.array_min(F.array(*found))

    def digest(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.vectors[number])).encode()).hexdigest()


def scaled_vectors(df: DataFrame, vec_id: str, vector: str, scale: int, components: int) -> DataFrame:
    """(vec_id, v): the rows whose vector has exactly ``components`` finite components, as floor(scale * x)."""
    x = F.col(vector)
    # NaN equals itself in Spark; a missing array or component makes the comparison null or false.
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    kept = df.where((F.size(x) == components) & F.forall(x, finite))
    return kept.select(
        F.col(vec_id).alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> Centroids:
    """The ``clusters`` vectors with the smallest SHA-256 of ``seed:vec_id``; equal ids go by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name, 256).alias("hash"), "v").orderBy("hash", "v").limit(clusters)
    return Centroids([list(r["v"]) for r in rows.collect()])


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    width = len(centroids.vectors[0])
    assigned = vectors.select(centroids.nearest("v")["cluster"].alias("cluster"), *[F.col("v")[i].alias(f"x{i}") for i in range(width)])
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"x{i}") for i in range(width)])
    after = [list(v) for v in centroids.vectors]
    for row in sums.collect():
        after[row["cluster"]] = [row[f"x{i}"] // row["n"] for i in range(width)]
    return Centroids(after)


def cluster_vectors(
    df: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    components: int = COMPONENTS,
    seed: int = 1,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance) of every usable row of ``df``, and the final centroids.

    A row is used when its vector has exactly ``components`` components, none of them null, NaN or infinite;
    others have no row. ``rounds`` times the vectors go to the nearest centroid and the centroids move, then
    the vectors are assigned once more. Ties go to the smaller number. Repeated rows count as often as they
    occur; a null id is kept and hashed as empty text. With fewer usable rows than ``clusters`` each of them is
    a centroid; an empty table gives an empty result and no centroids. Components above 2^26 after
    scaling raise ``ValueError``, since distances would not fit 64 bits. Other columns are not read.
    """
    if not 0 < components <= MOST_COMPONENTS:
        raise ValueError(f"vectors of 1 to {MOST_COMPONENTS} components")
    scratch = Scratch(df.sparkSession, "clusters")
    vectors = scratch.store(scaled_vectors(df, vec_id, vector, scale, components), "vectors")
    size = F.array_max(F.transform("v", lambda x: F.abs(x)))
    if (vectors.agg(F.max(size)).first()[0] or 0) > LARGEST:
        raise ValueError("a component is too large for exact distances")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids.vectors:
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none, centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    best = vectors.select("vec_id", centroids.nearest("v").alias("best"))
    assigned = scratch.store(best.select("vec_id", "best.cluster", "best.distance"), "assigned")
    scratch.drop(vectors)
    return assigned, centroids


def cluster_report(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """``assigned`` with its cluster's and the whole inertia and the SHA-256 of its centroid's components."""
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    count = max(1, len(centroids.vectors))
    place = F.col("cluster") + 1
    each = F.lit([inertia.get(i, 0) for i in range(count)]).cast("array<long>")
    digests = F.lit([centroids.digest(i) for i in range(len(centroids.vectors))] or [""])
    return assigned.withColumns(
        {
            "cluster_inertia": F.element_at(each, place),
            "inertia": F.lit(sum(inertia.values())).cast("long"),
            "centroid_sha256": F.element_at(digests, place),
        }
    )
