"""The one table the library works on, and the values its map tables share."""

from pyspark.sql import types as T

POST_COLUMNS = (
    ("datePosted", T.TimestampNTZType()),
    ("dateTaken", T.TimestampNTZType()),
    ("description", T.StringType()),
    ("familyFlag", T.BooleanType()),
    ("friendFlag", T.BooleanType()),
    ("hasPeople", T.BooleanType()),
    ("lastUpdate", T.TimestampNTZType()),
    ("media", T.StringType()),
    ("owner", T.StringType()),
    ("placeId", T.StringType()),
    ("publicFlag", T.BooleanType()),
    ("tags", T.ArrayType(T.StringType())),
    ("title", T.StringType()),
    ("url", T.StringType()),
    ("views", T.LongType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("accuracy", T.IntegerType()),
)

# post_id is a unique key (given, or numbered in cleaning): every report that cuts a sorted list uses it (or a
# group key) as the last sort column, so that equal inputs give equal results.
POSTS_SCHEMA = T.StructType(
    [T.StructField("post_id", T.LongType(), False)]
    + [T.StructField(name, kind) for name, kind in POST_COLUMNS]
)

# A CSV export of the table: text throughout, the tag list as "['a', 'b']".
POSTS_CSV_SCHEMA = T.StructType(
    [T.StructField(field.name, T.StringType()) for field in POSTS_SCHEMA]
)

# The columns some query reads. A post without one of them is dropped in cleaning.
REQUIRED_COLUMNS = (
    "post_id",
    "owner",
    "datePosted",
    "dateTaken",
    "views",
    "tags",
    "latitude",
    "longitude",
)

POSITION = ("latitude", "longitude")

# The colours given in turn to owners and clusters on the maps, the texts of the
# markers, and the start of the k-means fit.
PALETTE = (
    "red", "orange", "yellow", "green", "blue", "purple", "brown", "pink", "white", "gray",
    "lime", "bisque", "gold", "azure", "indigo", "navy", "aquamarine", "palegreen", "wheat",
    "olive",
)
CENTER_COLOR = "cyan"
CENTER_TEXT = "Centroid of cluster %d with %d elements inside"
CENTER_LABEL = "C"
POST_TEXT = "Post by %s %s views: %s"
OWNER_LABEL = "U"
KMEANS_SEED = 42
KMEANS_INIT = "k-means||"
