"""Named tables, tables given in the program, and written results."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def publish(posts: DataFrame, name: str = "posts") -> DataFrame:
    """Make the posts available to SQL under ``name``."""
    posts.createOrReplaceTempView(name)
    return posts.sparkSession.table(name)


def literal_frame(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A short table given in the program.

    As an Arrow table it becomes part of the plan, where Spark knows its size; plain rows
    would go through Python workers on the executors.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [pa.array([row[place] for row in rows]) for place in range(len(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema.names), schema)


def save_result(result: DataFrame, path: str) -> None:
    """Write a chart or map table as parquet."""
    result.write.parquet(path)
