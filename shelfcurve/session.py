"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "shelfcurve") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can read and write.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfcurve-"))
    return spark.sparkContext.getCheckpointDir()


_PATHS: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _PATHS.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables of a run at its end, also after a failure.

    Write the result inside the scope, to a path of your own: a lazy result of the run reads
    tables that are gone afterwards.
    """
    paths: list[str] = []
    token = _PATHS.set(paths)
    try:
        yield
    finally:
        _PATHS.reset(token)
        for path in paths:
            spark.sql(f"DROP TABLE IF EXISTS {_table_of(path)}")
            _delete(spark, path)


def _table_of(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


# no dictionary and no compression: the size of the files is that of the rows in memory
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}


def materialise(df: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors and gives the planner a size, so that it can
    choose a broadcast by itself. Parquet keeps column pruning. The planner takes the size of
    the files for that of the rows; where values repeat, they may differ a hundredfold, so what
    a join may broadcast and grows with the input is written ``plain``.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**(PLAIN if plain else {})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def store(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Like ``materialise`` for what ``make`` builds; the tables that were written for it are removed."""
    path = new_path(spark, name)
    with run_scope(spark):
        df = make()
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Remove tables that ``materialise`` returned, once what reads them is written itself."""
    for df in stored:
        _delete(df.sparkSession, df.stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise_buckets(df: DataFrame, columns: str | list[str], buckets: int, name: str, plain: bool = False) -> DataFrame:
    """Like ``materialise``, in hash buckets of ``columns``: what follows by those needs no exchange."""
    path = new_path(df.sparkSession, name)
    df.write.options(**(PLAIN if plain else {})).option("path", path).bucketBy(buckets, columns).saveAsTable(_table_of(path))
    return df.sparkSession.table(_table_of(path))
