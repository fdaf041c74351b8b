"""What the queries shuffle on a set of millions of posts, and what the largest task reads.

    python trials/scale.py [millions of posts, default 5] [folder, default a fresh one]

Makes the posts in a fresh folder: a third of them of one owner, who stays at one position half
of the time, the rest of owners of very different sizes. Then runs queries below and just above
every size at which a plan changes, each to its last row, and prints from Spark's event log the
records shuffled and the most that one task read, beside the share of a task of equal parts.
"""

import json
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import wayposts as wp
from wayposts.operators import joining, ranking

PARTS = 64


def session(folder: str) -> SparkSession:
    Path(folder, "events").mkdir(parents=True)
    return (
        SparkSession.builder.master("local[8]")
        .appName("wayposts-scale")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(PARTS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{folder}/events")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )


def make_posts(spark: SparkSession, path: str, rows: int) -> None:
    draw = lambda seed, most: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(most))
    hot = draw(1, 3) == 0
    still = hot & (draw(2, 2) == 0)
    owner = F.when(hot, "hot").otherwise(F.concat(F.lit("o"), F.floor(F.sqrt(draw(3, 4 * rows)))))
    taken = F.timestamp_add("SECOND", draw(4, 10**8), F.lit("2020-01-01").cast("timestamp_ntz"))
    spark.range(rows).select(
        F.col("id").alias("post_id"),
        owner.cast("string").alias("owner"),
        draw(5, 100_000).alias("views"),
        F.array(F.concat(F.lit("t"), draw(6, 300)), F.concat(F.lit("t"), draw(7, 50))).alias("tags"),
        taken.alias("dateTaken"),
        taken.alias("datePosted"),
        F.when(still, 1.0).otherwise(draw(8, 2_000) / 100).alias("latitude"),
        F.when(still, 1.0).otherwise(draw(9, 2_000) / 100).alias("longitude"),
        F.when(hot, 0).otherwise(draw(10, 5)).cast("int").alias("prediction"),
    ).write.parquet(path)


def queries(spark: SparkSession) -> dict:
    limit = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    report, listed = ranking.REPORT_ROWS, joining.BROADCAST_ROWS
    return {
        f"heat_points {limit:,}": lambda p: wp.heat_points(p, limit),
        f"heat_points {limit + 1:,}": lambda p: wp.heat_points(p, limit + 1),
        "heat_points 500,000": lambda p: wp.heat_points(p, 500_000),
        f"map_points {report:,}": lambda p: wp.map_points(p, report),
        f"map_points {report + 1:,}": lambda p: wp.map_points(p, report + 1),
        "map_points 1,900,000": lambda p: wp.map_points(p, 1_900_000),
        f"popular_owners {report:,}": lambda p: wp.popular_owners(p, report),
        f"popular_owners {report + 1:,}": lambda p: wp.popular_owners(p, report + 1),
        f"active_users {listed:,}": lambda p: wp.active_users(p, listed),
        f"active_users {listed + 1:,}": lambda p: wp.active_users(p, listed + 1),
        "active_users 5,000,000": lambda p: wp.active_users(p, 5_000_000),
        "owner_route 3, 10": lambda p: wp.owner_route(p, 3, 10),
        f"owner_route 3, {limit + 1:,}": lambda p: wp.owner_route(p, 3, limit + 1),
        "top_tags 20": lambda p: wp.top_tags(p, 20),
    }


def measured(folder: str, runs: list[tuple[str, float, float]]) -> None:
    stages: dict[str, list] = {name: [0, 0, 0] for name, *_ in runs}
    for log in Path(folder, "events").iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] != "SparkListenerTaskEnd":
                continue
            at = event["Task Info"]["Launch Time"] / 1000
            name = next((n for n, begin, end in runs if begin <= at <= end), None)
            if name:
                metrics = event["Task Metrics"]
                read = metrics["Shuffle Read Metrics"]["Total Records Read"]
                stages[name][0] += metrics["Shuffle Write Metrics"]["Shuffle Records Written"]
                stages[name][1] = max(stages[name][1], read)
    print("| query | seconds | records shuffled | most read by one task |\n| --- | --- | --- | --- |")
    for name, begin, end in runs:
        print(f"| `{name}` | {end - begin:.1f} | {stages[name][0]:,} | {stages[name][1]:,} |")


def main(millions: str = "5", folder: str | None = None) -> None:
    folder = tempfile.mkdtemp(prefix="scale-", dir=folder)
    rows = int(float(millions) * 1_000_000)
    spark = session(folder)
    make_posts(spark, f"{folder}/posts", rows)
    posts = spark.read.parquet(f"{folder}/posts")
    runs = []
    for name, query in queries(spark).items():
        begin = time.time()
        query(posts).write.format("noop").mode("overwrite").save()
        runs.append((name, begin, time.time()))
        time.sleep(0.2)
    wp.release_tables(spark)
    spark.stop()
    print(f"{rows:,} posts, {PARTS} partitions of {rows // PARTS:,} rows on average; in {folder}\n")
    measured(folder, runs)


if __name__ == "__main__":
    main(*sys.argv[1:])
