"""Session for local runs, and durable cut points for long plans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Lists of the tables written since each open ``passing_tables`` began.
_PASSING: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("passing", default=())


def local_session(cpus: int | str = "*", app: str = "grainfold") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="grainfold-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where several branches must see the same rows (range partition
    numbers, for one) and where an iteration would grow the plan.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when a query ends, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Write a result much smaller than its input as a table in the shared folder, and read that.

    It is computed once however often it is used, plans that use it do not grow
    with it, and Spark knows its true size: joins with it are broadcast below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above. What was shuffled to make it is removed.
    """
    path = scratch(df.sparkSession, "table")
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    for held in _PASSING.get():
        held.append(out)
    return out


@contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that ``stored`` writes inside are removed at the end, but for those given to the function that this yields.

    What is returned from inside must read no others, or be stored itself.
    """
    made: list[DataFrame] = []
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    token = _PASSING.set((*_PASSING.get(), made))
    try:
        yield keep
    finally:
        _PASSING.reset(token)
        for table in made:
            if not any(table is k for k in kept):
                discard(table)


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, once nothing is going to read it any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
