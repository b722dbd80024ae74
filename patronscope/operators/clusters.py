"""K-means on standardised features, and what follows from the labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.functions import euclidean, nearest_center
from patronscope.operators.ranking import top_per_group
from patronscope.operators.rfm import RFM_COLUMNS, column_stats

Centers = Sequence[Sequence[float]]
Point = tuple[float, ...]
#: Rows from which the first centres are drawn, and steps taken on them.
SAMPLE_ROWS, SAMPLE_STEPS = 10_000, 50


def kmeans_assign(
    scaled: DataFrame, centers: Centers, columns: Sequence[str] = RFM_COLUMNS
) -> DataFrame:
    """Adds ``cluster`` and ``distance``, the nearest centre and how far it is.

    Columns and centres must be in the same units; a tie goes to the lower number.
    """
    nearest = nearest_center([F.col(name) for name in columns], centers)
    return (
        scaled.withColumn("__nearest", nearest)
        .withColumns({"cluster": F.col("__nearest.cluster"), "distance": F.col("__nearest.distance")})
        .drop("__nearest")
    )


def kmeans_step(
    scaled: DataFrame, centers: Centers, columns: Sequence[str] = RFM_COLUMNS
) -> DataFrame:
    """One Lloyd step: assign every row, then move each centre to the mean of its rows.

    A centre without rows stays where it is: all centres enter the same aggregation
    as rows of weight 0.
    """
    assigned = kmeans_assign(scaled, centers, columns).select(
        "cluster", *[F.col(name).cast("double") for name in columns], F.lit(1).alias("__weight")
    )
    start = scaled.sparkSession.range(0, 1, 1, 1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(index).alias("cluster"),
                        *[F.lit(float(c)).alias(n) for c, n in zip(center, columns, strict=True)],
                        F.lit(0).alias("__weight"),
                    )
                    for index, center in enumerate(centers)
                ]
            )
        )
    )
    is_row = F.col("__weight") == 1
    return assigned.unionByName(start).groupBy("cluster").agg(
        F.sum("__weight").alias("members"),
        *[
            F.coalesce(
                F.avg(F.when(is_row, F.col(name))), F.max(F.when(~is_row, F.col(name)))
            ).alias(name)
            for name in columns
        ],
    )


@dataclass(frozen=True)
class ClusterModel:
    """Fitted centres in standardised units with the scaling that led there."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    def standardize(self, features: DataFrame) -> DataFrame:
        return features.withColumns(
            {
                name: (F.col(name) - F.lit(mean)) / F.lit(scale)
                for name, mean, scale in zip(self.columns, self.means, self.scales)
            }
        )

    def original_centers(self) -> list[tuple[float, ...]]:
        return [
            tuple(c * s + m for c, s, m in zip(center, self.scales, self.means))
            for center in self.centers
        ]

    def predict(self, features: DataFrame) -> DataFrame:
        """``features`` in their own units with ``cluster`` added."""
        shifted = [
            (F.col(name) - F.lit(mean)) / F.lit(scale)
            for name, mean, scale in zip(self.columns, self.means, self.scales)
        ]
        return features.withColumn("cluster", nearest_center(shifted, self.centers)["cluster"])


def fit_clusters(
    features: DataFrame,
    k: int = 3,
    seed: int = 42,
    max_iter: int = 300,
    columns: Sequence[str] = RFM_COLUMNS,
    tolerance: float = 1e-4,
    starts: int = 1,
) -> ClusterModel | None:
    """Standardise and run k-means; ``None`` when there is nothing to cluster.

    ``features`` is read once a round: pass a persisted table. The steps of a start end when no
    centre moves by more than ``tolerance``; of several random ``starts`` the one with the smallest
    sum of squared distances counts. Fewer distinct points than ``k`` are that many clusters. Clusters are numbered
    by ascending first column, then by descending second, so that the numbers do not
    depend on the random start.
    """
    stats = column_stats(features, columns).first()
    means = tuple(stats[f"{name}_mean"] for name in columns)
    if means[0] is None:
        return None
    scales = tuple(stats[f"{name}_scale"] for name in columns)
    unordered = ClusterModel(tuple(columns), means, scales, ())
    scaled = unordered.standardize(features).select(*columns)
    centers = lloyd(scaled, start_centers(scaled, k, seed, starts), max_iter, tolerance)
    ordered = sorted(centers, key=lambda c: (c[0], *(-x for x in c[1:2]), *c[2:]))
    return ClusterModel(tuple(columns), means, scales, tuple(ordered))


def start_centers(scaled: DataFrame, k: int, seed: int, starts: int) -> list[list[Point]]:
    """Centres to begin with: k-means++ and Lloyd steps on a sample of ``SAMPLE_ROWS`` rows.

    The sample are the rows with the smallest hashes, whatever the table's partitions. It is
    all that reaches the driver; the steps over all rows follow.
    """
    sample = scaled.orderBy(F.xxhash64(F.lit(seed), *scaled.columns), *scaled.columns).limit(SAMPLE_ROWS)
    points = np.array([tuple(row) for row in sample.collect()], dtype=float)
    out = []
    for start in range(starts):
        random = np.random.default_rng([seed, start])
        centers = points[random.integers(len(points))][None, :]
        while len(centers) < k:
            nearest = _squared(points, centers).min(axis=1)
            if not nearest.any():
                break
            drawn = points[random.choice(len(points), p=nearest / nearest.sum())]
            centers = np.concatenate([centers, drawn[None, :]])
        for _ in range(SAMPLE_STEPS):
            labels = _squared(points, centers).argmin(axis=1)
            members = [points[labels == c] for c in range(len(centers))]
            moved = np.array([m.mean(axis=0) if len(m) else c for m, c in zip(members, centers)])
            if np.array_equal(moved, centers):
                break
            centers = moved
        out.append([tuple(map(float, c)) for c in centers])
    return out


def _squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centers], axis=1)


def lloyd(scaled: DataFrame, starts: list[list[Point]], max_iter: int, tolerance: float) -> list[Point]:
    """Lloyd steps from all starts at once; the centres with the smallest cost.

    A round is one aggregation to one row of sums, counted in place for each start and cluster:
    no row is multiplied. A start takes part until its centres stand still; one that has the centres
    of an earlier start, in the same order, would end where that one does and leaves. A centre
    without rows stays where it is.
    """
    columns = scaled.columns
    moving, best = dict(enumerate(starts)), (float("inf"), starts[0])
    for step in range(max_iter):
        moving = _distinct(moving)
        row = _cluster_sums(scaled, moving).first()
        for i, centers in list(moving.items()):
            new = [
                tuple(x if (mean := row[f"__mean{i}_{c}_{j}"]) is None else mean for j, x in enumerate(center))
                for c, center in enumerate(centers)
            ]
            shift = max(sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5 for a, b in zip(new, centers))
            moving[i] = new
            if shift <= tolerance or step == max_iter - 1:
                del moving[i]
                best = min(best, (row[f"__cost{i}"], new))
        if not moving:
            break
    return best[1]


def _distinct(moving: dict[int, list[Point]]) -> dict[int, list[Point]]:
    """The starts whose centres no earlier start has."""
    first: dict[tuple[Point, ...], int] = {}
    for i, centers in moving.items():
        first.setdefault(tuple(centers), i)
    return {i: moving[i] for i in first.values()}


def _cluster_sums(scaled: DataFrame, moving: dict[int, list[Point]]) -> DataFrame:
    """One row: ``__mean<start>_<cluster>_<column>``, NULL without rows, and ``__cost<start>``.

    A row belongs to its nearest centre, at a tie to the lower number, as in :func:`kmeans_assign`.
    Distances, labels and sums are plain columns in three layers, each computed once for a row.
    """
    columns = scaled.columns
    values = [F.col(name) for name in columns]
    distances = {
        f"__d{i}_{c}": euclidean(values, [F.lit(float(x)) for x in center])
        for i, centers in moving.items()
        for c, center in enumerate(centers)
    }
    labels = {}
    for i, centers in moving.items():
        label, least = F.lit(0), F.col(f"__d{i}_0")
        for c in range(1, len(centers)):
            own = F.col(f"__d{i}_{c}")
            label, least = F.when(own < least, c).otherwise(label), F.least(least, own)
        labels |= {f"__to{i}": label, f"__least{i}": least}
    labelled = scaled.select(*columns, *[d.alias(name) for name, d in distances.items()])
    labelled = labelled.select(*columns, *[x.alias(name) for name, x in labels.items()])
    return labelled.agg(
        *[
            F.avg(F.when(F.col(f"__to{i}") == c, F.col(name))).alias(f"__mean{i}_{c}_{j}")
            for i, centers in moving.items()
            for c in range(len(centers))
            for j, name in enumerate(columns)
        ],
        *[F.sum(F.col(f"__least{i}") * F.col(f"__least{i}")).alias(f"__cost{i}") for i in moving],
    )


def _as_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="__vector").transform(df)


def rfm_clusters(
    features: DataFrame, k: int = 3, seed: int = 42, model: ClusterModel | None = None
) -> DataFrame:
    """``features`` with a ``cluster`` for every user; empty in, empty out."""
    model = model or fit_clusters(features, k, seed)
    if model is None:
        return features.withColumn("cluster", F.lit(None).cast("int"))
    return model.predict(features)


def cluster_centers(features: DataFrame, model: ClusterModel | None) -> DataFrame:
    """One row per cluster: its centre in original units."""
    spark = features.sparkSession
    columns = RFM_COLUMNS if model is None else model.columns
    rows = [] if model is None else [
        (index, *center) for index, center in enumerate(model.original_centers())
    ]
    return spark.createDataFrame(
        rows, ", ".join(["cluster int", *[f"{name} double" for name in columns]])
    )


def silhouette(features: DataFrame, model: ClusterModel) -> DataFrame:
    """Mean silhouette of the clusters, by squared Euclidean distance in scaled units."""
    labelled = model.predict(features).select("cluster", *model.columns)
    vectors = _as_vectors(model.standardize(labelled), model.columns)
    score = ClusteringEvaluator(featuresCol="__vector", predictionCol="cluster").evaluate(vectors)
    return features.sparkSession.createDataFrame([(float(score),)], "silhouette double")


def user_clusters(labelled: DataFrame) -> DataFrame:
    return labelled.select("user_id", "cluster")


def cluster_means(labelled: DataFrame, columns: Sequence[str] = RFM_COLUMNS) -> DataFrame:
    """Mean of each feature per cluster."""
    return labelled.groupBy("cluster").agg(*[F.avg(name).alias(name) for name in columns])


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(F.count("*").alias("members"))


def distance_to_center(
    labelled: DataFrame, k: int, columns: Sequence[str] = RFM_COLUMNS
) -> DataFrame:
    """Adds ``distance`` from each row to the mean of its own cluster.

    The means of the clusters 0 to ``k - 1`` are one row of numbers, used as a scalar
    subquery: nothing is joined. A label outside that range, or none, gives NULL.
    """
    means = labelled.agg(
        *[
            F.avg(F.when(F.col("cluster") == c, F.col(name))).alias(f"{name}_{c}")
            for c in range(k)
            for name in columns
        ]
    )
    # one column, so that the plan has the subquery once and not once for each mean
    one_row = means.select(F.struct(*means.columns)).scalar()
    values = [F.col(name) for name in columns]
    distance = F.lit(None).cast("double")
    for c in range(k):
        own = euclidean(values, [F.col(f"__means.{name}_{c}") for name in columns])
        distance = F.when(F.col("cluster") == c, own).otherwise(distance)
    return labelled.withColumn("__means", one_row).withColumn("distance", distance).drop("__means")


def nearest_to_center(
    labelled: DataFrame, k: int, n: int = 1000, columns: Sequence[str] = RFM_COLUMNS
) -> DataFrame:
    """The ``n`` rows of each cluster nearest to its mean; ties go by ``user_id``."""
    return top_per_group(
        distance_to_center(labelled, k, columns),
        "cluster",
        [F.asc("distance"), F.asc("user_id")],
        n,
    )


def cluster_scatter(
    labelled: DataFrame, k: int, n: int = 1000, columns: Sequence[str] = RFM_COLUMNS
) -> DataFrame:
    """The points to plot: features and cluster of the rows nearest to each centre."""
    return nearest_to_center(labelled, k, n, columns).select(*columns, "cluster")
