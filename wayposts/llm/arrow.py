"""Small helpers for functions that map Arrow batches in Python workers."""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Rows of whole texts per Arrow batch, so that a batch of very long texts stays small.
TEXT_ROWS = 500


def map_batches(
    df: DataFrame,
    start: Callable[[], Callable[[dict], dict]],
    schema: str,
    rows: int = TEXT_ROWS,
) -> DataFrame:
    """``df`` through a function from columns to columns, given as dicts of lists.

    ``start`` runs once per task and returns that function, so that what it loads is shared by
    the task's batches. A batch is passed on in pieces of at most ``rows`` rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                made = work({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)
