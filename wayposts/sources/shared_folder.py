"""The folder all executors share, for data that must outlive the loss of any of them."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths of the tables that each application has written.
_written: dict[str, list[str]] = {}
# Paths written by this thread inside the innermost ``settled``.
_steps: ContextVar[list[str] | None] = ContextVar("_steps", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; on a cluster there
    is no safe folder to choose, so that is an error.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="wayposts-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path in the shared folder, or in the one given, that nothing uses yet."""
    return f"{(folder or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Lets Spark delete the shuffle files of a query as soon as it ends."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, or to the one given, and read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name, folder)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (steps := _steps.get()) is not None:
        steps.append(path)
    # what is read from now on is the table, so the shuffles behind it are of no more use
    with _shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, materialized; the tables that were written meanwhile, as steps
    towards it, are deleted."""
    outer, steps = _steps.get(), []
    token = _steps.set(steps)
    try:
        made = materialize(make(), name)
    finally:
        _steps.reset(token)
    if outer is not None:
        outer.append(steps[-1])
    _forget(made.sparkSession, steps[:-1])
    return made


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete those of the tables that are still there."""
    written = _written.get(spark.sparkContext.applicationId, [])
    for path in [path for path in paths if path in written]:
        written.remove(path)
        _delete(spark, path)


def release(table: DataFrame) -> None:
    """Delete a table that ``materialize`` returned, once nothing is read from it any more."""
    spark = table.sparkSession
    written = _written.get(spark.sparkContext.applicationId, [])
    folders = {file.rsplit("/", 2)[-2] for file in table.inputFiles()}
    _forget(spark, [path for path in written if path.rsplit("/", 1)[-1] in folders])


def release_tables(spark: SparkSession) -> None:
    """Delete the tables that this application wrote with ``materialize``.

    Call it when no result that was made from them is used any more.
    """
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
