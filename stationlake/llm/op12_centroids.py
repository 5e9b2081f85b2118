"""Centroid clustering with built-in expressions only: integer vectors, literal centroids.

Every component becomes floor(64 * x), so sums and distances are whole numbers: results don't
depend on partitions or on the order of additions. The centroids are literal arrays in the
plan (k * components numbers). A vector's distance to each is ``zip_with`` of the squared
differences folded by ``aggregate``; ``array_min`` over structs (distance, number) takes the
nearest one, the smaller number where distances are equal. A round sums the components per
cluster, one column each, in a hash aggregate that combines within each task first, so
a cluster that holds most rows sends one row per task; k rows reach the driver per round.

Kept are vectors of exactly ``DIMENSIONS`` components, none null, NaN or infinite. The kept
vectors with smallest sha256 of ``1:<vec_id>`` are the first centroids, in that order. A
round replaces a centroid by the floor of its vectors' mean; one without vectors stays.

Defined results: null vectors, other lengths and vectors with odd components give no row. A
null vec_id counts as the empty text in the hash; rows that repeat a vec_id are vectors of
their own (equal hashes: by components). Fewer kept vectors than ``k`` give as many clusters;
an empty table gives no rows. Components beyond ``LARGEST`` after scaling would overflow
whole numbers of 64 bits: they raise an error, whatever the session's ANSI setting. Extra
columns aren't read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import stored, table

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LARGEST = 1 << 27


def quantised(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, q (array<bigint>) of the vectors that are kept."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.forall("x", lambda v: F.coalesce((v > float("-inf")) & (v < float("inf")), F.lit(False)))  # NaN is above all
    whole = F.transform("x", lambda v: F.when(F.abs(F.floor(v * scale)) > LARGEST, F.raise_error(
        F.lit("a component is too large for exact whole numbers")).cast("bigint")).otherwise(F.floor(v * scale)))
    return (rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
            .filter((F.size("x") == dimensions) & good).select("vec_id", whole.alias("q")))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """Components of the ``k`` vectors with the smallest hashes (``k`` rows at the driver)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    top = vectors.select(F.sha2(text.cast("binary"), 256).alias("h"), "q").orderBy("h", "q").limit(k)
    return [list(r.q) for r in top.collect()]


def distance(q: Column | str, centroid: list[int]) -> Column:
    """Squared Euclidean distance of an integer vector to a literal centroid."""
    other = F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")
    return F.aggregate(F.zip_with(q, other, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda s, v: s + v)


def nearest(q: Column | str, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; ties go to the smaller number."""
    return F.array_min(F.array(*[F.struct(distance(q, c).alias("distance"), F.lit(i).alias("cluster"))
                                 for i, c in enumerate(centroids)]))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: exact floors of the means (a row per cluster at the driver)."""
    sums = [F.sum(F.get("q", i)).alias(f"s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    for r in (vectors.select(nearest("q", centroids)["cluster"].alias("cluster"), "q")
              .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()):
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(len(sums))]  # Python's floor, also below zero
    return out


def clustered(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS,
              scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) per kept vector, a written table; the final centroids."""
    vectors = stored(quantised(rows, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    best = vectors.select("vec_id", nearest("q", centroids).alias("_best"))
    return stored(best.select("vec_id", "_best.cluster", "_best.distance"), "clusters"), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = clustered(table(spark, sf_dir, "embeddings"))
    inertia = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def by_cluster(values: list, kind: str) -> Column:
        return reduce(lambda c, i: c.when(F.col("cluster") == i, F.lit(values[i]).cast(kind)), range(len(values)),
                      F.when(F.lit(False), F.lit(None).cast(kind)))

    return rows.select(
        "vec_id", "cluster", "distance", by_cluster([inertia.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), by_cluster(digests, "string").alias("centroid_sha256"))
