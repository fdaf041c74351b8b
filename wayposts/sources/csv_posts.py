"""Posts from CSV exports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayposts.schema import POSTS_CSV_SCHEMA

# Columns that an export may lack.
OPTIONAL_COLUMNS = ("post_id", "lastUpdate")


def read_csv_posts(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A CSV export with a header line, every column as text, in the order of the schema.

    Columns are found by their names in the header, in any order; others are ignored. An
    export may lack ``post_id`` and ``lastUpdate``, and all its files have the same header.
    ``multiline`` reads texts that hold line breaks; each file is then one task, so a large
    export should come as many files. Without such texts, ``multiline=False`` splits files of
    any size.
    """
    options = dict(header=True, multiLine=multiline, escape='"')
    header = spark.read.csv(path, **options).columns
    missing = [
        name for name in POSTS_CSV_SCHEMA.names if name not in header and name not in OPTIONAL_COLUMNS
    ]
    if missing:
        raise ValueError(f"the export lacks the columns {', '.join(missing)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = spark.read.csv(path, schema=schema, enforceSchema=False, **options)
    return rows.select(*[F.col(name) for name in POSTS_CSV_SCHEMA.names if name in header])
