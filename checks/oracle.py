"""For each query, SQL over the test tables that gives the same result."""

# The colours given in turn to owners and clusters, and that of the centres.
PALETTE = (
    "red", "orange", "yellow", "green", "blue", "purple", "brown", "pink", "white", "gray",
    "lime", "bisque", "gold", "azure", "indigo", "navy", "aquamarine", "palegreen", "wheat",
    "olive",
)
CENTER_COLOR = "cyan"

_POSTS = """
posts_k as (
  select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events
),
posts as (
  select
    event_id as post_id,
    ts as "datePosted",
    ts - to_hours(k) as "dateTaken",
    cast(null as varchar) as description,
    k % 2 = 0 as "familyFlag",
    k % 3 = 0 as "friendFlag",
    k % 5 = 0 as "hasPeople",
    ts as "lastUpdate",
    case when event_id % 10 = 0 then 'video' else 'photo' end as media,
    case when event_id % 97 = 0 then null else 'u' || user_id end as owner,
    'p' || (k % 10) as "placeId",
    true as "publicFlag",
    case when k % 10 = 9 then null
         when k % 10 = 8 then cast([] as varchar[])
         when k % 4 = 0 then [event_type, 't' || (k % 5), event_type]
         else [event_type, 't' || (k % 5)] end as tags,
    'post ' || event_id as title,
    'http://example.com/' || event_id as url,
    case when event_id % 101 = 0 then null else cast(round(value * 100) as bigint) end as views,
    cast(41 as double) + (k % 10) / cast(20 as double) as latitude,
    cast(12 as double) + (event_id % 7) / cast(20 as double) as longitude,
    cast(k % 16 + 1 as bigint) as accuracy
  from posts_k
)"""

_GAPPED = (
    _POSTS.replace("\nposts as (", "\nplain as (")
    + """,
posts as (
  select * replace (
    case when post_id % 10 = 3 then 'quiet' else owner end as owner,
    case when post_id % 10 <> 3 then views end as views,
    case when post_id % 89 = 0 then null
         when post_id % 83 = 0 then cast('NaN' as double) else latitude end as latitude,
    cast(date_trunc('day', "datePosted") as timestamp) as "datePosted")
  from plain
)"""
)

_DOCUMENTS = """
posts as (
  select doc_id as post_id, source as owner, n_chars as views,
         string_split(lower(text), ' ') as tags
  from documents
)"""

_TAGS = """
lists as (select tags, count(tags) as uses, avg(views) as mean_views from posts group by tags),
listed as (select unnest(tags) as tag, uses, mean_views from lists),
stats as (
  select tag, cast(sum(uses) as bigint) as "count", avg(mean_views) as mean_views
  from listed group by tag
)"""

_WEIGHTED = """
tagged as (select unnest(tags) as tag, views from posts)"""

_OWNERS = """
owners as (
  select owner, count(owner) as num_post, avg(views) as mean_views,
         max("datePosted") as "lastPost"
  from posts group by owner
),
ranked as (
  select *, row_number() over (order by "lastPost" desc nulls last, owner nulls first) as id from owners
),
top_owners as (select * from ranked where id <= {n}),
uses as (
  select owner, tags, count(tags) as tag_uses
  from top_owners join posts using (owner) group by owner, tags
),
best as (
  select * from (
    select *, row_number() over (
      partition by owner order by tag_uses desc, tags asc nulls last) as place
    from uses)
  where place = 1
),
active as (
  select owner, num_post, mean_views, "lastPost", id, tags, tag_uses
  from top_owners join best using (owner)
)"""

_OWNERS, _MANY_OWNERS = _OWNERS.format(n=20), _OWNERS.format(n=20_000)

_POPULAR = """
popular as (
  select owner, cast(sum(views) as bigint) as views from posts group by owner
  order by views desc nulls last, owner nulls first limit {n_users}
),
indexed as (
  select owner, row_number() over (order by views desc nulls last, owner) - 1 as owner_index
  from popular where owner is not null
)"""

_PLACES = """
places as (
  select * from (
    select *, row_number() over (
      partition by owner, latitude, longitude
      order by "dateTaken" desc nulls last, post_id) as copy
    from posts)
  where copy = 1
)"""

_STOPS = (
    _POPULAR
    + ","
    + _PLACES
    + """,
stops as (
  select * from (
    select places.*, owner_index,
           row_number() over (
             partition by owner order by "dateTaken" desc nulls last, post_id) as place
    from places join indexed using (owner))
  where place <= {n_posts}
),
markers as (
  select *, count(*) over (partition by owner) - place + 1 as seq from stops
)"""
)

_RAW = """
raw as (
  select posts.*, version
  from posts, unnest(list_filter(
    [0, case when post_id % 50 = 0 then 1 end, case when post_id % 75 = 0 then 2 end],
    lambda v: v is not null)) as versions(version)
)"""

_POSITIONS = """
located as (
  select
    vec_id + copy * 1000000000 as post_id,
    timestamp '2024-01-01' + to_hours(cast(vec_id % 8760 as int)) + to_days(cast(copy as int))
      as "dateTaken",
    case when vec_id % 41 = 0 then null else (vec_id * 37) % 1000 + copy end as views,
    cast(embedding[1] as double) + (label // 2 - 2) * {gap} as latitude,
    cast(embedding[2] as double) as longitude,
    cast(label as bigint) as prediction
  from embeddings, unnest(case when vec_id % 5 = 0 then [0, 1] else [0] end) as copies(copy)
)"""

# With 30 degrees between the groups, a position's cluster follows from its latitude.
_ASSIGNED = (
    _POSITIONS.format(gap=30)
    + """,
assigned as (
  select post_id, latitude, longitude, views,
         cast(round(latitude / 30) as bigint) + 2 as prediction
  from (
    select *, row_number() over (
      partition by latitude, longitude order by "dateTaken" desc, post_id) as copy
    from located)
  where copy = 1
)"""
)

_GIVEN = _POSITIONS.format(gap=0) + ",\nassigned as (select * from located)"

_SIZES = """
sizes as (select prediction, count(*) as size from assigned group by prediction)"""

_HEAT = """
heat as (
  select *, count(*) over (partition by prediction) as shown from (
    select *, row_number() over (
      partition by prediction order by views desc nulls first, post_id) as place
    from assigned)
  where place <= {n_posts}
)"""

_SILHOUETTE = """
clusters as (
  select prediction as cluster, count(*) as n, sum(latitude) as sx, sum(longitude) as sy,
         sum(latitude * latitude + longitude * longitude) as squares
  from assigned group by prediction
),
distances as (
  select post_id, prediction, cluster, n,
         latitude * latitude + longitude * longitude + squares / n
           - 2 * (latitude * sx + longitude * sy) / n as distance
  from assigned cross join clusters
),
scores as (
  select post_id,
         max(case when cluster = prediction then distance * n / (n - 1) end) as own,
         min(case when cluster <> prediction then distance end) as other
  from distances group by post_id
),
score as (select avg((other - own) / greatest(own, other)) as silhouette from scores)"""


def _text(moment: str) -> str:
    return f"cast({moment} as varchar)"


def _list(tags: str = "tags") -> str:
    return f"array_to_string({tags}, ',')"


def _moments(*names: str) -> str:
    quoted = [f'"{name}"' for name in names]
    return ", ".join(f"{_text(name)} as {name}" for name in quoted)


def _rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 6) as {name}" for name in names)


_POSITION = _rounded("latitude", "longitude")

_ALL_COLUMNS = f"""post_id, {_moments("datePosted", "dateTaken")}, description, "familyFlag",
  "friendFlag", "hasPeople", {_moments("lastUpdate")}, media, owner, "placeId", "publicFlag",
  {_list()} as tags, title, url, views, {_POSITION}, accuracy"""

_COLORS = "[" + ", ".join(f"'{color}'" for color in PALETTE) + "]"


def _color(index: str) -> str:
    return f"{_COLORS}[{index} % {len(PALETTE)} + 1]"


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def _posts(select: str, *parts: str) -> str:
    return _with(_POSTS, *parts) + select


def _documents(select: str, *parts: str) -> str:
    return _with(_DOCUMENTS, *parts) + select


def _gapped(select: str, *parts: str) -> str:
    return _with(_GAPPED, *parts) + select


def _route(n_users: int, n_posts: int, select: str, posts: str = _POSTS) -> str:
    return _with(posts, _STOPS.format(n_users=n_users, n_posts=n_posts)) + select


_ROUTE_COLUMNS = f'owner, views, {_POSITION}, {_moments("dateTaken")}'
_MARKERS = f"""
select {_ROUTE_COLUMNS}, seq, {_color("owner_index")} as color,
  'Post by ' || regexp_replace(owner, '[^\\p{{L}}\\p{{N}}]', '', 'g') || ' '
    || coalesce(regexp_replace(
         strftime("dateTaken", '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', ''), 'null')
    || ' views: ' || coalesce(cast(views as varchar), 'null') as info
from markers"""

_ROUTE = f"select {_ROUTE_COLUMNS} from stops order by owner_index, place"
_STATS = f"""select owner, num_post, round(mean_views, 6) as mean_views,
  {_moments("lastPost")} from owners"""
_ACTIVE = f"""select owner, num_post, round(mean_views, 6) as mean_views,
  {_moments("lastPost")}, id, {_list()} as tags, tag_uses
from active order by id"""
_PLACED = f"""select post_id, {_POSITION}, views from (
  select *, row_number() over (partition by latitude, longitude
    order by "dateTaken" desc nulls last, post_id) as copy from posts)
where copy = 1"""
_CLUSTERED = """
assigned as (
  select post_id, latitude, longitude, views, cast(post_id % 3 as bigint) as prediction
  from posts
)"""

_TAG_REPORT = 'select tag, "count", round(mean_views, 6) as mean_views from stats'
_WEIGHTED_STATS = (
    'select tag, count(*) as "count", round(avg(views), 6) as mean_views from tagged group by tag'
)
_BY_COUNT = ' order by "count" desc, tag limit {n}'
_BY_MEAN = " order by stats.mean_views desc nulls last, tag limit {n}"
_COMPLETE = """owner is not null and views is not null and tags is not null
  and post_id % 103 <> 0 and post_id % 107 <> 0"""

_POINTS = f"select post_id, {_POSITION}, views, prediction from"
_POST_MARKERS = f"""
select post_id, {_POSITION}, views, prediction, {_color("prediction")} as color,
  cast(prediction as varchar) as label, views as title
from heat where shown - place < {{half}}"""

_TYPED_RAW = f"""
select post_id,
  case when post_id % 107 = 0 then null else {_text('"datePosted"')} end as "datePosted",
  {_moments("dateTaken")}, description, "familyFlag", "friendFlag", "hasPeople",
  cast(case when version = 1 then "lastUpdate" - to_hours(1) else "lastUpdate" end as varchar)
    as "lastUpdate",
  media, owner, "placeId", "publicFlag", {_list()} as tags, title, url,
  case when version = 1 then views + 1 else views end as views,
  case when post_id % 103 = 0 then null else round(latitude, 6) end as latitude,
  round(longitude, 6) as longitude, accuracy
from raw"""

_RAW_TEXT = """
select cast(post_id as varchar) as post_id, owner,
  case when post_id % 107 = 0 then 'not a date'
       when post_id % 11 = 3
         then replace(cast("datePosted" + to_hours(8) as varchar), ' ', 'T') || '+08:00'
       else cast("datePosted" as varchar) end as "datePosted",
  case when views is null then 'n/a'
       when version = 1 then cast(views + 1 as varchar)
       when post_id % 3 = 0 then views || '.0'
       when post_id % 13 = 5 then views || 'e0'
       else cast(views as varchar) end as views,
  case when tags is null then 'missing'
       when post_id % 20 = 7 and len(tags) = 0 then '[None,]'
       else '[' || array_to_string(list_transform(tags, lambda t: '''' || t || ''''), ', ')
         || case when post_id % 20 = 7 then ', None]' else ']' end end as tags,
  case when post_id % 103 = 0 then 'unknown' else cast(latitude as varchar) end as latitude,
  cast(case when version = 1 then "lastUpdate" - to_hours(1) else "lastUpdate" end as varchar)
    as "lastUpdate",
  title
from raw"""


def oracle_sql() -> dict[str, str]:
    return {
        # The dataset and its positions
        "lat_lon": _posts(f"select {_POSITION} from posts"),
        "map_points": _posts(f"select {_POSITION} from posts order by post_id limit 100"),
        "map_points_many": _posts(
            f"select {_POSITION} from posts order by post_id limit 5000"
        ),
        "preview_posts_many": _posts(
            "select post_id, owner from posts order by post_id limit 2500"
        ),
        "dataset_shape": _posts(
            "select count(*) as rows, cast(19 as bigint) as columns from posts"
        ),
        "preview_posts": _posts(f"select {_ALL_COLUMNS} from posts order by post_id limit 20"),
        "distinct_owners": _posts(
            """select count(distinct owner) + max(case when owner is null then 1 else 0 end)
                 as owners from posts"""
        ),
        "owner_sketch_months": _posts(
            """select strftime(datePosted, '%Y-%m') as month,
                      count(distinct owner) + max(case when owner is null then 1 else 0 end) as owners,
                      true as near
               from posts group by 1"""
        ),
        "distinct_owner_values": _posts("select distinct owner from posts"),
        "owner_posts": _posts(
            f"""select post_id, owner, views, {_list()} as tags, {_moments("datePosted")}
                from posts where owner = 'u7'"""
        ),
        "posts_view": _posts("select post_id, views from posts where views > 1000"),
        "empty_like": _posts("select post_id, owner, views from posts"),
        "global_max": _posts("select max(views) as views from posts"),
        "second_highest_views": _posts(
            "select max(views) as views from posts where views < (select max(views) from posts)"
        ),
        "second_highest": """select round(max(o_totalprice), 6) as o_totalprice from orders
            where o_totalprice < (select max(o_totalprice) from orders)""",
        "distinct_positions": _posts(_PLACED),
        "union_posts": _posts(
            f"""select post_id, owner, views, {_list()} as tags from posts
                union all
                select doc_id, source, n_chars, {_list("string_split(lower(text), ' ')")}
                from documents"""
        ),
        "alphanumeric_names": """select c_custkey,
            regexp_replace(c_name, '[^\\p{L}\\p{N}]', '', 'g') as name from customer""",
        # Tags
        "tag_list_stats": _posts(
            f"""select {_list()} as tags, count(tags) as "count",
                  round(avg(views), 6) as mean_views
                from posts group by posts.tags"""
        ),
        "explode_tags": _posts("select post_id, unnest(tags) as tag from posts"),
        "tag_stats": _posts(_TAG_REPORT, _TAGS),
        "tag_stats_weighted": _posts(_WEIGHTED_STATS, _WEIGHTED),
        "top_tags_by_count": _posts(_TAG_REPORT + _BY_COUNT.format(n=5), _TAGS),
        "top_tags_by_mean_views": _posts(_TAG_REPORT + _BY_MEAN.format(n=5), _TAGS),
        "top_tags_min_count": _posts(
            _TAG_REPORT + ' where "count" > 3' + _BY_MEAN.format(n=20), _TAGS
        ),
        "tag_chart_data": _posts(
            """select 'count' as chart, tag as label, cast("count" as double) as value from top
               union all
               select 'mean_views', tag, round(mean_views, 6) from top""",
            _TAGS,
            "\ntop as (select * from stats" + _BY_COUNT.format(n=20) + ")",
        ),
        "top_words_by_count": _documents(_TAG_REPORT + _BY_COUNT.format(n=50), _TAGS),
        "top_words_min_count": _documents(
            _TAG_REPORT + ' where "count" > 3' + _BY_MEAN.format(n=50), _TAGS
        ),
        "word_stats": _documents(_TAG_REPORT, _TAGS),
        "word_stats_weighted": _documents(_WEIGHTED_STATS, _WEIGHTED),
        # Owners and their routes
        "owner_stats": _posts(_STATS, _OWNERS),
        "owner_popularity": _posts(
            "select owner, cast(sum(views) as bigint) as views from posts group by owner"
        ),
        "popular_owners": _posts("select * from popular", _POPULAR.format(n_users=10)),
        "active_users_ranked": _posts(
            f"""select owner, num_post, round(mean_views, 6) as mean_views,
                  {_moments("lastPost")}, id from top_owners""",
            _OWNERS,
        ),
        "owner_tag_list_counts": _posts(
            f"select owner, {_list()} as tags, tag_uses from uses", _OWNERS
        ),
        "owner_top_tag_list": _posts(
            f"select owner, {_list()} as tags, tag_uses from best", _OWNERS
        ),
        "active_users": _posts(_ACTIVE, _OWNERS),
        "owner_chart_data": _posts(
            """select 'num_post' as chart, 'U' || id as label, cast(num_post as double) as value
               from active
               union all
               select 'mean_views', 'U' || id, round(mean_views, 6) from active""",
            _OWNERS,
        ),
        "owner_distinct_positions": _posts(
            f"select post_id, owner, views, {_POSITION} from places", _PLACES
        ),
        "owner_route": _route(3, 10, _ROUTE),
        "route_markers": _route(3, 10, _MARKERS),
        "route_markers_many": _route(25, 40, _MARKERS),
        "route_view_counts": _route(
            25, 40, "select owner, count(views) as n_views from stops group by owner"
        ),
        "active_users_long": _posts(_ACTIVE, _MANY_OWNERS),
        "owner_route_long": _route(3, 2_000, _ROUTE),
        "owner_route_wide": _route(20_000, 5, _ROUTE),
        "route_markers_long": _route(3, 2_000, _MARKERS),
        "gapped_distinct_positions": _gapped(
            _PLACED + " and latitude is not null and not isnan(latitude)"
        ),
        "gapped_owner_stats": _gapped(_STATS, _OWNERS),
        "gapped_popular_owners": _gapped(
            "select * from popular", _POPULAR.format(n_users=20_000)
        ),
        "gapped_active_users": _gapped(_ACTIVE, _OWNERS),
        "gapped_owner_route": _route(
            200,
            10,
            f"""select owner, views, round(longitude, 6) as longitude, {_moments("dateTaken")}
                from stops order by owner_index, place""",
            _GAPPED,
        ),
        "gapped_top_tags": _gapped(_TAG_REPORT + _BY_COUNT.format(n=20), _TAGS),
        "heat_points_long": _posts(
            _POINTS + " heat", _CLUSTERED, _HEAT.format(n_posts=1500)
        ),
        "post_markers_long": _posts(
            _POST_MARKERS.format(half=750), _CLUSTERED, _HEAT.format(n_posts=1500)
        ),
        # Sources
        "src_csv_posts": _posts(_RAW_TEXT, _RAW),
        "load_posts": _posts(f"select {_ALL_COLUMNS} from posts where {_COMPLETE}"),
        "clean_posts": _posts(f"select {_ALL_COLUMNS} from posts where {_COMPLETE}"),
        "type_posts": _posts(_TYPED_RAW, _RAW),
        "parse_tags": _posts(
            f"""select cast(post_id as varchar) as post_id, {_list()} as tags,
                  len(tags) + case when post_id % 20 = 7 then 1 else 0 end as n_tags from raw""",
            _RAW,
        ),
        "clean_posts_without_ids": _posts(
            f"""select row_number() over (order by "datePosted", "dateTaken", updated) as post_id,
                  title, views, cast(updated as varchar) as "lastUpdate"
                from (
                  select "datePosted", "dateTaken", title, views + version as views,
                    "lastUpdate" - to_hours(cast(version as int)) as updated
                  from raw where version < 2 and {_COMPLETE})""",
            _RAW,
        ),
        "repair_tags": _posts(f"select post_id, owner, {_list()} as tags from posts"),
        # Clusters
        "kmeans_assign": _with(_ASSIGNED) + _POINTS + " assigned",
        "kmeans_centers": _with(_ASSIGNED)
        + """select prediction as cluster, round(avg(latitude), 6) as latitude,
               round(avg(longitude), 6) as longitude
             from assigned group by prediction""",
        "kmeans_metrics": _with(_ASSIGNED, _SILHOUETTE)
        + """select cast(5 as bigint) as k, (select count(*) from clusters) as clusters,
               round(silhouette, 6) as silhouette from score""",
        "kmeans_cluster_sizes": _with(_ASSIGNED, _SIZES) + "select * from sizes",
        "kmeans_center_markers": _with(_ASSIGNED)
        + f"""select prediction as cluster, round(avg(latitude), 6) as latitude,
               round(avg(longitude), 6) as longitude, '{CENTER_COLOR}' as color,
               'C' || prediction as label,
               'Centroid of cluster ' || prediction || ' with ' || count(*)
                 || ' elements inside' as info
             from assigned group by prediction""",
        "kmeans_heat_points": _with(_ASSIGNED, _HEAT.format(n_posts=15)) + _POINTS + " heat",
        "kmeans_markers": _with(_ASSIGNED, _HEAT.format(n_posts=15))
        + _POST_MARKERS.format(half=7),
        "label_cluster_sizes": _with(_GIVEN, _SIZES) + "select * from sizes",
        "label_heat_points": _with(_GIVEN, _HEAT.format(n_posts=20)) + _POINTS + " heat",
        "label_markers": _with(_GIVEN, _HEAT.format(n_posts=75)) + _POST_MARKERS.format(half=37),
        "label_silhouette": _with(_GIVEN, _SILHOUETTE)
        + """select (select count(*) from clusters) as clusters,
               (select count(*) from assigned) as posts,
               round(silhouette, 6) as silhouette from score""",
        "kmeans_total_assigned": _with(_POSITIONS.format(gap=0))
        + """select count(*) as assigned
             from (select distinct latitude, longitude from located)""",
        "kmeans_nearest_center": _with(_POSITIONS.format(gap=0))
        + """select count(*) as assigned, cast(0 as bigint) as misplaced
             from (select distinct latitude, longitude from located)""",
        "kmeans_event_positions": _posts(
            """select count(*) as assigned, cast(0 as bigint) as misplaced
               from (select distinct latitude, longitude from posts)"""
        ),
    }
