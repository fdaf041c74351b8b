"""Every query and operator, run over whole test tables.

Results are only reshaped to compare well across engines: means and coordinates are rounded to
six places, lists and moments become text, counters become bigint.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import wayposts as wp
from checks import fixtures
from wayposts.functions import alphanumeric, parse_tags
from wayposts.schema import POSITION
from wayposts.sources.shared_folder import materialize

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType):
        column = F.round(column, 6)
    elif isinstance(field.dataType, T.ArrayType):
        column = F.array_join(column, ",")
    elif isinstance(field.dataType, T.TimestampNTZType):
        column = column.cast("string")
    elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
        column = column.cast("bigint")
    return column.alias(field.name)


def _plain_columns(df: DataFrame) -> DataFrame:
    return df.select(*[_plain(field) for field in df.schema])


def _register(name: str, source: Callable, run: Callable[[DataFrame], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_columns(run(source(spark, sf_dir)))

    query.__name__ = name
    _QUERIES[name] = query


def _on(source: Callable, **runs: Callable[[DataFrame], DataFrame]) -> None:
    for name, run in runs.items():
        _register(name, source, run)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# The dataset and its positions
_on(
    fixtures.posts_from_events,
    lat_lon=wp.lat_lon,
    map_points=lambda posts: wp.map_points(posts, 100),
    dataset_shape=wp.dataset_shape,
    preview_posts=wp.preview_posts,
    distinct_owners=wp.distinct_owners,
    distinct_owner_values=wp.distinct_owner_values,
    owner_posts=lambda posts: wp.owner_posts(posts, "u7").select(
        "post_id", "owner", "views", "tags", "datePosted"
    ),
    posts_view=lambda posts: wp.publish(posts).where("`views` > 1000").select("post_id", "views"),
    empty_like=lambda posts: wp.union_posts(wp.empty_like(posts), posts).select(
        "post_id", "owner", "views"
    ),
    global_max=lambda posts: wp.global_max(posts, "views"),
    map_points_many=lambda posts: wp.map_points(posts, 5000),
    preview_posts_many=lambda posts: wp.preview_posts(posts, 2500).select("post_id", "owner"),
    second_highest_views=lambda posts: wp.second_highest(posts, "views"),
    distinct_positions=wp.distinct_positions,
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


_on(_orders, second_highest=lambda orders: wp.second_highest(orders, "o_totalprice"))


def _events_and_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("post_id", "owner", "views", "tags")
    return wp.union_posts(
        fixtures.posts_from_events(spark, sf_dir).select(*columns),
        fixtures.posts_from_documents(spark, sf_dir).select(*columns),
    )


_on(_events_and_documents, union_posts=lambda posts: posts)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet")


_on(
    _customers,
    alphanumeric_names=lambda customers: customers.select(
        "c_custkey", alphanumeric("c_name").alias("name")
    ),
)

# Sketches: the estimates must lie within three standard errors of the exact numbers.
def _sketched_months(posts: DataFrame) -> DataFrame:
    month = F.date_format("day", "yyyy-MM")
    days = materialize(wp.owner_sketches(posts, day=F.to_date("datePosted")), "owner-sketches")
    exact = posts.groupBy(F.date_format(F.to_date("datePosted"), "yyyy-MM").alias("month")).agg(
        (F.count_distinct("owner") + F.max(F.col("owner").isNull().cast("long"))).alias("exact")
    )
    near = F.abs(F.col("owners") - F.col("exact")) <= F.col("exact") * 0.05 + 1
    return (
        wp.united_owners(days, month=month)
        .join(exact, "month")
        .select("month", F.col("exact").alias("owners"), near.alias("near"))
    )


_on(fixtures.posts_from_events, owner_sketch_months=_sketched_months)

# Tags
_on(
    fixtures.posts_from_events,
    tag_list_stats=wp.tag_list_stats,
    explode_tags=wp.explode_tags,
    tag_stats=wp.tag_stats,
    tag_stats_weighted=lambda posts: wp.tag_stats(posts, weighted=True),
    top_tags_by_count=lambda posts: wp.top_tags(posts, 5),
    top_tags_by_mean_views=lambda posts: wp.top_tags(posts, 5, by="mean_views"),
    top_tags_min_count=lambda posts: wp.top_tags(posts, 20, by="mean_views", min_exclusive=3),
    tag_chart_data=lambda posts: wp.tag_chart_data(wp.top_tags(posts, 20)),
)
_on(
    fixtures.posts_from_documents,
    top_words_by_count=lambda posts: wp.top_tags(posts, 50),
    top_words_min_count=lambda posts: wp.top_tags(posts, 50, by="mean_views", min_exclusive=3),
    word_stats=wp.tag_stats,
    word_stats_weighted=lambda posts: wp.tag_stats(posts, weighted=True),
)

# Owners and their routes
_on(
    fixtures.posts_from_events,
    owner_stats=wp.owner_stats,
    owner_popularity=wp.owner_popularity,
    popular_owners=lambda posts: wp.popular_owners(posts, 10),
    active_users_ranked=wp.active_users_ranked,
    owner_tag_list_counts=wp.owner_tag_list_counts,
    owner_top_tag_list=wp.owner_top_tag_list,
    active_users=wp.active_users,
    owner_chart_data=lambda posts: wp.owner_chart_data(wp.active_users(posts)),
    owner_distinct_positions=lambda posts: wp.owner_distinct_positions(posts).select(
        "post_id", "owner", "views", *POSITION
    ),
    owner_route=wp.owner_route,
    route_markers=wp.route_markers,
    route_markers_many=lambda posts: wp.route_markers(posts, 25, 40),
    route_view_counts=lambda posts: wp.owner_view_counts(wp.owner_route(posts, 25, 40)),
    # Beyond the sizes up to which a report is cut, merged or sent to all tasks as a whole
    active_users_long=lambda posts: wp.active_users(posts, 20_000),
    owner_route_long=lambda posts: wp.owner_route(posts, 3, 2_000),
    owner_route_wide=lambda posts: wp.owner_route(posts, 20_000, 5),
    route_markers_long=lambda posts: wp.route_markers(posts, 3, 2_000),
)
_on(
    fixtures.gapped_posts_from_events,
    gapped_distinct_positions=wp.distinct_positions,
    gapped_owner_stats=wp.owner_stats,
    gapped_popular_owners=lambda posts: wp.popular_owners(posts, 20_000),
    gapped_active_users=wp.active_users,
    gapped_owner_route=lambda posts: wp.owner_route(posts, 200, 10).select(
        "owner", "views", "longitude", "dateTaken"
    ),
    gapped_top_tags=wp.top_tags,
)
_on(
    fixtures.posts_in_clusters,
    heat_points_long=lambda posts: wp.heat_points(posts, 1500),
    post_markers_long=lambda posts: wp.post_markers(posts, 1500),
)


# Sources
def _csv_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wp.read_csv_posts(
        spark, fixtures.write_csv(fixtures.raw_posts_from_events(spark, sf_dir))
    )


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.write_csv(fixtures.raw_posts_from_events(spark, sf_dir))
    typed_tags = fixtures.posts_from_events(spark, sf_dir).select("post_id", "tags")
    return wp.load_posts(spark, path, typed_tags)


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = fixtures.posts_from_events(spark, sf_dir)
    broken = posts.withColumn("tags", F.lit(None).cast("array<string>"))
    return wp.repair_column(broken, posts.select("post_id", "tags"))


_on(
    _csv_posts,
    src_csv_posts=lambda raw: raw.select(
        "post_id", "owner", "datePosted", "views", "tags", "latitude", "lastUpdate", "title"
    ),
)
_on(_csv_export, load_posts=lambda posts: posts)
_on(
    fixtures.raw_posts_from_events,
    clean_posts=wp.clean_posts,
    type_posts=wp.type_posts,
    clean_posts_without_ids=lambda raw: wp.clean_posts(raw.drop("post_id")).select(
        "post_id", "title", "views", "lastUpdate"
    ),
    parse_tags=lambda raw: raw.select("post_id", parse_tags("tags").alias("tags")).withColumn(
        "n_tags", F.size("tags")
    ),
)
_on(_repaired, repair_tags=lambda posts: posts.select("post_id", "owner", "tags"))


# Clusters. The five groups of positions lie far apart, so that there is one best clustering.
def _grouped_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.posts_from_embeddings(spark, sf_dir, gap=30)


def _assigned(posts: DataFrame) -> DataFrame:
    return wp.assign_clusters(wp.fit_clusters(posts, 5))


def _center_markers(posts: DataFrame) -> DataFrame:
    clusters = wp.fit_clusters(posts, 5)
    centers = wp.cluster_centers(clusters)
    return wp.center_markers(centers, wp.assign_clusters(clusters))


_on(
    _grouped_positions,
    kmeans_assign=_assigned,
    kmeans_centers=lambda posts: wp.cluster_centers(wp.fit_clusters(posts, 5)),
    kmeans_metrics=lambda posts: wp.kmeans_positions(posts, 5).metrics,
    kmeans_cluster_sizes=lambda posts: wp.cluster_sizes(_assigned(posts)),
    kmeans_center_markers=_center_markers,
    kmeans_heat_points=lambda posts: wp.heat_points(_assigned(posts), 15),
    kmeans_markers=lambda posts: wp.post_markers(_assigned(posts), 15),
)


# The same tables over clusters that are given, not fitted: each label is one.
def _label_metrics(posts: DataFrame) -> DataFrame:
    score = wp.silhouette(posts)
    return wp.cluster_sizes(posts).agg(
        F.count(F.lit(1)).alias("clusters"),
        F.sum("size").alias("posts"),
        F.lit(score).alias("silhouette"),
    )


_on(
    fixtures.posts_from_embeddings,
    label_cluster_sizes=wp.cluster_sizes,
    label_heat_points=lambda posts: wp.heat_points(posts, 20),
    label_markers=lambda posts: wp.post_markers(posts, 75),
    label_silhouette=_label_metrics,
)


# Positions without clear groups: the fit is one of many, but these numbers hold for each.
def _misplaced(posts: DataFrame) -> DataFrame:
    """Distinct positions, those assigned, and those nearer to a centre not their own."""
    clusters = wp.fit_clusters(posts, 8)
    distances = [
        (F.col("latitude") - center.latitude) ** 2 + (F.col("longitude") - center.longitude) ** 2
        for center in wp.cluster_centers(clusters).orderBy("cluster").collect()
    ]
    nearest = F.array_min(F.array(*distances))
    own = F.element_at(F.array(*distances), F.col("prediction") + 1)
    return wp.assign_clusters(clusters).agg(
        F.count(F.lit(1)).alias("assigned"),
        F.sum((own > nearest + 1e-9).cast("int")).alias("misplaced"),
    )


_on(
    fixtures.posts_from_embeddings,
    kmeans_total_assigned=lambda posts: wp.cluster_sizes(_assigned(posts)).agg(
        F.sum("size").alias("assigned")
    ),
    kmeans_nearest_center=_misplaced,
)
_on(fixtures.posts_from_events, kmeans_event_positions=_misplaced)
