"""K-means over the distinct positions, and the tables of the cluster map."""

from typing import NamedTuple

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.arguments import whole_number
from wayposts.functions import center_text, palette_color, prefixed
from wayposts.operators.distinct import distinct_positions
from wayposts.operators.ranking import top_per_group, with_group_size
from wayposts.operators.selection import descending
from wayposts.schema import (
    CENTER_COLOR,
    CENTER_LABEL,
    KMEANS_INIT,
    KMEANS_SEED,
    POSITION,
)
from wayposts.sources.shared_folder import materialize
from wayposts.sources.tables import literal_frame

_ASSIGNED = ("post_id", "latitude", "longitude", "views", "prediction")


class Clusters(NamedTuple):
    """A fitted model and the distinct positions it was fitted to."""

    positions: DataFrame
    model: KMeansModel


class KMeansResult(NamedTuple):
    assignments: DataFrame
    centers: DataFrame
    metrics: DataFrame


def _with_features(positions: DataFrame) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(POSITION), outputCol="features")
    return assembler.transform(positions)


def fit_clusters(posts: DataFrame, k: int = 5, folder: str | None = None) -> Clusters:
    """Fit ``k`` clusters to the distinct positions. Runs Spark jobs.

    The positions are written to ``folder`` first, by default the shared folder: the fit passes
    over them some thirty times, and pairs up passes that must see the same rows even after an
    executor is lost. ``release_tables`` removes them when the clusters are no longer used.
    """
    k = whole_number("k", k, least=2)
    positions = materialize(distinct_positions(posts), "positions", folder)
    if positions.limit(2).count() < 2:
        raise ValueError("k-means needs posts at two or more distinct positions")
    kmeans = KMeans(k=k, seed=KMEANS_SEED, initMode=KMEANS_INIT)
    return Clusters(positions, kmeans.fit(_with_features(positions).select("features")))


def _numbering(model: KMeansModel) -> list[int]:
    """The model's cluster indices in order of latitude, then longitude, of their centres."""
    centers = [tuple(center) for center in model.clusterCenters()]
    return sorted(range(len(centers)), key=centers.__getitem__)


def assign_clusters(clusters: Clusters) -> DataFrame:
    """Each distinct position with the number of its cluster in ``prediction``."""
    number = {index: place for place, index in enumerate(_numbering(clusters.model))}
    numbers = F.array(*[F.lit(number[index]) for index in range(len(number))])
    predicted = clusters.model.transform(_with_features(clusters.positions))
    return predicted.withColumn(
        "prediction", F.element_at(numbers, F.col("prediction") + 1)
    ).select(*_ASSIGNED)


def cluster_centers(clusters: Clusters) -> DataFrame:
    """The centres, numbered as in the assignments: ``cluster, latitude, longitude``."""
    centers = clusters.model.clusterCenters()
    rows = [
        (place, *map(float, centers[index]))
        for place, index in enumerate(_numbering(clusters.model))
    ]
    return literal_frame(
        clusters.positions.sparkSession, rows, "cluster int, latitude double, longitude double"
    )


def silhouette(assignments: DataFrame) -> float:
    """The silhouette of the assignments, by squared distance. Runs Spark jobs."""
    return ClusteringEvaluator().evaluate(_with_features(assignments))


def cluster_metrics(clusters: Clusters) -> DataFrame:
    """One row: the ``k`` asked for, the number of clusters found, the silhouette."""
    found = len(clusters.model.clusterCenters())
    score = silhouette(assign_clusters(clusters))
    return literal_frame(
        clusters.positions.sparkSession,
        [(clusters.model.getOrDefault("k"), found, score)],
        "k int, clusters int, silhouette double",
    )


def kmeans_positions(posts: DataFrame, k: int = 5, folder: str | None = None) -> KMeansResult:
    """The whole query: assignments, centres and metrics from one fit."""
    clusters = fit_clusters(posts, k, folder)
    return KMeansResult(
        assign_clusters(clusters), cluster_centers(clusters), cluster_metrics(clusters)
    )


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("prediction").agg(F.count(F.lit(1)).alias("size"))


def center_markers(centers: DataFrame, assignments: DataFrame) -> DataFrame:
    """The map markers of the centres, with the size of each cluster."""
    sizes = cluster_sizes(assignments).withColumnRenamed("prediction", "cluster")
    counted = centers.join(sizes, "cluster", "left").na.fill(0, ["size"])
    return counted.select(
        "cluster",
        "latitude",
        "longitude",
        F.lit(CENTER_COLOR).alias("color"),
        prefixed(CENTER_LABEL, "cluster").alias("label"),
        center_text("cluster", "size").alias("info"),
    )


def _most_viewed(assignments: DataFrame, n_posts: int) -> DataFrame:
    # Positions without a view count rank first, as they do at the end of an ascending sort.
    order = [F.col("views").desc_nulls_first(), F.col("post_id").asc()]
    views = F.coalesce(descending(F.col("views").cast("long")), F.lit(0))
    numbers = [F.col("views").isNotNull().cast("long"), views, F.col("post_id")]
    columns = assignments.select(*_ASSIGNED)
    return top_per_group(columns, ["prediction"], order, n_posts, name="place", numbers=numbers)


def heat_points(assignments: DataFrame, n_posts: int = 10) -> DataFrame:
    """The ``n_posts`` most viewed positions of each cluster."""
    n_posts = whole_number("n_posts", n_posts)
    return _most_viewed(assignments, n_posts).select(*_ASSIGNED)


def post_markers(assignments: DataFrame, n_posts: int = 10) -> DataFrame:
    """The map markers of the clusters: the less viewed half of the heat points.

    From each cluster's list in ascending order come the first ``n_posts // 2``.
    """
    n_posts = whole_number("n_posts", n_posts)
    viewed = _most_viewed(assignments, n_posts)
    return (
        with_group_size(viewed, ["prediction"], "shown", n_posts)
        .where(F.col("shown") - F.col("place") < n_posts // 2)
        .select(
            *_ASSIGNED,
            palette_color("prediction").alias("color"),
            F.col("prediction").cast("string").alias("label"),
            F.col("views").alias("title"),
        )
    )
