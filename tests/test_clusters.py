import random

import numpy as np
import pandas as pd
import pytest

import wayposts as wp
from checks import fixtures
from frames import day, posts, tuples
from wayposts.schema import PALETTE

SF_DIR = "/root/testdata/sf0.01"


def _points(spark, *points):
    return posts(spark, *[dict(latitude=x, longitude=y, views=1) for x, y in points])


def _assignments(spark, *rows):
    """(prediction, views) pairs as assignments."""
    values = [(i, float(i), 0.0, views, cluster) for i, (cluster, views) in enumerate(rows, 1)]
    return wp.literal_frame(
        spark, values,
        "post_id long, latitude double, longitude double, views long, prediction int",
    )


@pytest.fixture(scope="module")
def fitted(spark):
    return wp.fit_clusters(fixtures.posts_from_embeddings(spark, SF_DIR), 6)


def test_every_distinct_position_is_assigned_once(spark, fitted):
    table = fixtures.posts_from_embeddings(spark, SF_DIR)
    distinct = table.select("latitude", "longitude").distinct().count()
    sizes = dict(tuples(wp.cluster_sizes(wp.assign_clusters(fitted))))
    assert sum(sizes.values()) == distinct < table.count()
    assert set(sizes) <= set(range(wp.cluster_centers(fitted).count()))


def test_positions_belong_to_the_nearest_centre_and_centres_are_means(spark, fitted):
    centers = np.array([row[1:] for row in sorted(tuples(wp.cluster_centers(fitted)))])
    rows = wp.assign_clusters(fitted).select("latitude", "longitude", "prediction").collect()
    points = np.array([row[:2] for row in rows])
    own = np.array([row[2] for row in rows])
    distances = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (distances[np.arange(len(own)), own] <= distances.min(axis=1) + 1e-9).all()
    for cluster, center in enumerate(centers):
        assert np.allclose(points[own == cluster].mean(axis=0), center, atol=0.02)


def test_silhouette_is_that_of_the_definition(spark, fitted):
    rows = wp.assign_clusters(fitted).select("latitude", "longitude", "prediction").collect()
    points = np.array([row[:2] for row in rows])
    own = np.array([row[2] for row in rows])
    distances = ((points[:, None, :] - points[None]) ** 2).sum(axis=2)
    clusters = np.unique(own)
    scores = []
    for i in range(len(own)):
        sums = {c: distances[i, own == c].sum() for c in clusters}
        inside = sums[own[i]] / ((own == own[i]).sum() - 1)
        other = min(sums[c] / (own == c).sum() for c in clusters if c != own[i])
        scores.append((other - inside) / max(other, inside))
    k, found, score = tuples(wp.cluster_metrics(fitted))[0]
    assert (k, found) == (6, 6)
    assert score == pytest.approx(np.mean(scores), abs=1e-9)


def test_clusters_are_numbered_by_the_place_of_their_centre(fitted):
    rows = tuples(wp.cluster_centers(fitted))
    assert [row[0] for row in rows] == list(range(len(rows)))
    assert [row[1:] for row in rows] == sorted(row[1:] for row in rows)


def test_same_input_gives_the_same_centres(spark, fitted):
    again = wp.fit_clusters(fixtures.posts_from_embeddings(spark, SF_DIR), 6)
    assert tuples(wp.cluster_centers(again)) == tuples(wp.cluster_centers(fitted))


def test_layout_of_the_input_does_not_matter(spark, fitted):
    shuffled = fixtures.posts_from_embeddings(spark, SF_DIR).repartition(5, "views")
    again = wp.fit_clusters(shuffled, 6)
    assert tuples(wp.cluster_centers(again)) == tuples(wp.cluster_centers(fitted))


def test_three_points(spark):
    table = _points(spark, (0.0, 0.0), (1.0, 1.0), (9.0, 9.0))
    two = wp.kmeans_positions(table, 2)
    assert tuples(two.centers) == [(0, 0.5, 0.5), (1, 9.0, 9.0)]
    assert tuples(two.metrics)[0] == (2, 2, pytest.approx(0.6573431, abs=1e-6))
    assert two.assignments.columns == ["post_id", "latitude", "longitude", "views", "prediction"]
    assert [row.prediction for row in two.assignments.orderBy("latitude").collect()] == [0, 0, 1]


@pytest.mark.parametrize("k", [3, 5])
def test_no_more_clusters_than_positions(spark, k):
    result = wp.kmeans_positions(_points(spark, (0.0, 0.0), (1.0, 1.0), (9.0, 9.0)), k)
    assert tuples(result.metrics) == [(k, 3, 0.0)]
    assert result.centers.count() == 3


def test_last_taken_post_stands_for_a_position(spark):
    rows = [
        dict(latitude=1.0, longitude=1.0, views=1, dateTaken=day(1)),
        dict(latitude=1.0, longitude=1.0, views=2, dateTaken=day(2)),
        dict(latitude=1.0, longitude=1.0, views=3, dateTaken=day(2)),
        dict(latitude=2.0, longitude=1.0, views=4),
        dict(latitude=2.0, longitude=None, views=5),
        dict(latitude=None, longitude=1.0, views=6),
        dict(latitude=float("nan"), longitude=1.0, views=7),
        dict(latitude=-0.0, longitude=1.0, views=8, dateTaken=day(1)),
        dict(latitude=0.0, longitude=1.0, views=9, dateTaken=day(0)),
    ]
    kept = wp.distinct_positions(posts(spark, *rows)).collect()
    assert sorted(row.views for row in kept) == [2, 4, 8]


def test_one_position_cannot_be_clustered(spark):
    with pytest.raises(ValueError, match="two or more"):
        wp.kmeans_positions(_points(spark, (1.0, 1.0), (1.0, 1.0)), 2)
    with pytest.raises(ValueError, match="two or more"):
        wp.kmeans_positions(_points(spark), 2)


def test_heat_points_put_missing_views_on_top(spark):
    table = _assignments(spark, (0, 5), (0, None), (0, 9), (0, 1), (1, 2))
    heat = sorted(row.post_id for row in wp.heat_points(table, 2).collect())
    assert heat == [2, 3, 5]


def test_markers_are_the_lower_half(spark):
    table = _assignments(spark, *[(0, 10 * i) for i in range(6)], (21, 1), (21, None), (21, 3))
    markers = [(row.prediction, row.title) for row in wp.post_markers(table, 5).collect()]
    # Of 10..50 the first two; of 1, 3, missing the first two.
    assert sorted(markers) == [(0, 10), (0, 20), (21, 1), (21, 3)]
    row = wp.post_markers(table, 5).where("prediction = 21").first()
    assert (row.color, row.label) == (PALETTE[1], "21")
    assert wp.post_markers(table, 1).count() == 0


@pytest.mark.parametrize("n", [1, 4, 7, 50])
def test_heat_points_and_markers_against_pandas(spark, n):
    chance = random.Random(n)
    views = chance.sample(range(1000), 90)
    rows = [(i % 4, view) for i, view in enumerate(views)] + [(0, None), (2, None)]
    chance.shuffle(rows)
    table = _assignments(spark, *rows)
    heat, markers = set(), set()
    frame = pd.DataFrame(
        {"cluster": [r[0] for r in rows], "views": [r[1] for r in rows]},
        index=range(1, len(rows) + 1),
    )
    for _, cluster in frame.groupby("cluster"):
        top = cluster.sort_values("views").tail(n)
        heat |= set(top.index)
        markers |= set(top.index[: n // 2])
    assert {row.post_id for row in wp.heat_points(table, n).collect()} == heat
    assert {row.post_id for row in wp.post_markers(table, n).collect()} == markers


def test_fewer_posts_than_half_the_limit_are_all_shown(spark):
    assert wp.post_markers(_assignments(spark, (0, 1), (0, 2)), 10).count() == 2


def test_center_markers(spark):
    centers = wp.literal_frame(
        spark, [(0, 1.0, 2.0), (1, 3.0, 4.0)], "cluster int, latitude double, longitude double"
    )
    markers = wp.center_markers(centers, _assignments(spark, (0, 1), (0, 2)))
    assert sorted(tuples(markers)) == [
        (0, 1.0, 2.0, "cyan", "C0", "Centroid of cluster 0 with 2 elements inside"),
        (1, 3.0, 4.0, "cyan", "C1", "Centroid of cluster 1 with 0 elements inside"),
    ]
