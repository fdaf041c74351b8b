"""Analytics over tables of geotagged posts, as Spark DataFrame functions."""

from wayposts.operators.aggregates import (
    distinct_owners,
    explode_tags,
    global_max,
    owner_popularity,
    owner_stats,
    second_highest,
    tag_list_stats,
    tag_stats,
)
from wayposts.operators.distinct import (
    distinct_owner_values,
    distinct_positions,
    empty_like,
    owner_distinct_positions,
    union_posts,
)
from wayposts.operators.joining import repair_column
from wayposts.operators.sketches import owner_sketches, united_owners
from wayposts.plans.charts import owner_chart_data, tag_chart_data
from wayposts.plans.clusters import (
    KMeansResult,
    assign_clusters,
    center_markers,
    cluster_centers,
    cluster_metrics,
    cluster_sizes,
    fit_clusters,
    heat_points,
    kmeans_positions,
    post_markers,
    silhouette,
)
from wayposts.plans.ingest import load_posts
from wayposts.plans.overview import dataset_shape, lat_lon, map_points, preview_posts
from wayposts.plans.owners import (
    active_users,
    active_users_ranked,
    owner_posts,
    owner_tag_list_counts,
    owner_top_tag_list,
    popular_owners,
)
from wayposts.plans.routes import owner_route, owner_view_counts, route_markers
from wayposts.plans.tags import top_tags
from wayposts.schema import POSTS_CSV_SCHEMA, POSTS_SCHEMA
from wayposts.sources.cleaning import clean_posts, type_posts
from wayposts.sources.csv_posts import read_csv_posts
from wayposts.sources.shared_folder import release_tables
from wayposts.sources.tables import literal_frame, publish, save_result
