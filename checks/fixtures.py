"""Posts derived from the test tables, whole table by whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayposts.schema import POSTS_SCHEMA
from wayposts.sources.shared_folder import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with null owners, null views, and null, empty and repeating tag lists."""
    # props is {"k": 69}: without the characters of the frame only the number is left.
    events = _table(spark, sf_dir, "events").withColumn(
        "k", F.expr("""cast(translate(props, '{"k: }', '') as int)""")
    )
    return events.selectExpr(
        "event_id as post_id",
        "ts as datePosted",
        "timestampadd(HOUR, -k, ts) as dateTaken",
        "cast(null as string) as description",
        "k % 2 = 0 as familyFlag",
        "k % 3 = 0 as friendFlag",
        "k % 5 = 0 as hasPeople",
        "ts as lastUpdate",
        "if(event_id % 10 = 0, 'video', 'photo') as media",
        "if(event_id % 97 = 0, null, concat('u', cast(user_id as string))) as owner",
        "concat('p', cast(k % 10 as string)) as placeId",
        "true as publicFlag",
        """case when k % 10 = 9 then null
                when k % 10 = 8 then cast(array() as array<string>)
                when k % 4 = 0
                  then array(event_type, concat('t', cast(k % 5 as string)), event_type)
                else array(event_type, concat('t', cast(k % 5 as string))) end as tags""",
        "concat('post ', cast(event_id as string)) as title",
        "concat('http://example.com/', cast(event_id as string)) as url",
        "if(event_id % 101 = 0, null, cast(round(value * 100) as bigint)) as views",
        "cast(41 as double) + (k % 10) / cast(20 as double) as latitude",
        "cast(12 as double) + (event_id % 7) / cast(20 as double) as longitude",
        "cast(k % 16 + 1 as int) as accuracy",
    )


def gapped_posts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts with null and NaN positions, many owners whose last posts are of one
    moment, and an owner without any view count."""
    quiet = F.col("post_id") % 10 == 3
    latitude = F.when(F.col("post_id") % 83 == 0, F.lit(float("nan"))).otherwise(F.col("latitude"))
    return posts_from_events(spark, sf_dir).withColumns(
        {
            "owner": F.when(quiet, "quiet").otherwise(F.col("owner")),
            "views": F.when(~quiet, F.col("views")),
            "latitude": F.when(F.col("post_id") % 89 != 0, latitude),
            "datePosted": F.date_trunc("day", "datePosted").cast("timestamp_ntz"),
        }
    )


def posts_in_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts in three clusters, each of a third of them."""
    return posts_from_events(spark, sf_dir).withColumn(
        "prediction", (F.col("post_id") % 3).cast("int")
    )


def posts_from_embeddings(spark: SparkSession, sf_dir: str, gap: int = 0) -> DataFrame:
    """Positions with later copies of every fifth; ``gap`` degrees between pairs of labels."""
    embeddings = _table(spark, sf_dir, "embeddings")
    copies = F.expr("explode(if(vec_id % 5 = 0, array(0, 1), array(0)))").alias("copy")
    return embeddings.select("*", copies).selectExpr(
        "vec_id + copy * 1000000000 as post_id",
        "timestampadd(DAY, copy, timestampadd(HOUR, cast(vec_id % 8760 as int),"
        " timestamp_ntz'2024-01-01 00:00:00')) as dateTaken",
        "if(vec_id % 41 = 0, null, (vec_id * 37) % 1000 + copy) as views",
        f"cast(embedding[0] as double) + (label div 2 - 2) * {gap} as latitude",
        "cast(embedding[1] as double) as longitude",
        "label as prediction",
    )


def posts_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as tag lists: long ones, some of them many times."""
    return _table(spark, sf_dir, "documents").selectExpr(
        "doc_id as post_id",
        "source as owner",
        "n_chars as views",
        "split(lower(text), ' ') as tags",
    )


def raw_posts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts as text, with values that do not parse, outdated rows and copies.

    Some lists end with a missing element, some moments have a zone, some numbers an exponent.
    Every 50th post has an older version, every 75th an exact copy.
    """
    posts = posts_from_events(spark, sf_dir)
    text = {field.name: F.col(field.name).cast("string") for field in POSTS_SCHEMA}
    text["tags"] = F.expr(
        """case when tags is null then 'missing'
                when post_id % 20 = 7 and size(tags) = 0 then '[None,]'
                else concat('[', array_join(transform(tags, t -> concat('''', t, '''')), ', '),
                            if(post_id % 20 = 7, ', None]', ']')) end"""
    )
    text["views"] = F.expr(
        """case when views is null then 'n/a'
                when version = 1 then cast(views + 1 as string)
                when post_id % 3 = 0 then concat(cast(views as string), '.0')
                when post_id % 13 = 5 then concat(cast(views as string), 'e0')
                else cast(views as string) end"""
    )
    text["latitude"] = F.expr(
        "if(post_id % 103 = 0, 'unknown', cast(latitude as string))"
    )
    text["datePosted"] = F.expr(
        """case when post_id % 107 = 0 then 'not a date'
                when post_id % 11 = 3 then concat(replace(
                  cast(timestampadd(HOUR, 8, datePosted) as string), ' ', 'T'), '+08:00')
                else cast(datePosted as string) end"""
    )
    text["lastUpdate"] = F.expr(
        "cast(if(version = 1, timestampadd(HOUR, -1, lastUpdate), lastUpdate) as string)"
    )
    versions = F.expr(
        """explode(array_compact(array(0, if(post_id % 50 = 0, 1, null),
                                       if(post_id % 75 = 0, 2, null))))"""
    )
    versioned = posts.withColumn("version", versions)
    return versioned.select([text[f.name].alias(f.name) for f in POSTS_SCHEMA])


def write_csv(raw: DataFrame) -> str:
    """Write text posts to a fresh folder of the shared folder; its path.

    The columns come in another order than that of the schema, with one more among them.
    """
    names = sorted(raw.columns, reverse=True)
    raw = raw.select(*names[:5], F.lit("x").alias("license"), *names[5:])
    path = fresh_path(raw.sparkSession, "posts-csv")
    raw.write.csv(path, header=True, escape='"')
    return path
