"""What the operators of this folder share: readers, code shipping, Arrow helpers."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_SHIPPED = "_shelfcurve_shipped"


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per application.

    Python functions travel by reference, so the executors need the modules. Spark's own
    file server hands out the archive; the temporary file is read by the driver alone.
    """
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    package = Path(__file__).resolve().parent.parent
    sources = sorted(package.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:12]
    archive = Path(tempfile.mkdtemp(prefix="shelfcurve-code-")) / f"{package.name}-{digest}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for p in sources:
            out.write(p, f"{package.name}/{p.relative_to(package)}")
    context.addPyFile(str(archive))
    setattr(context, _SHIPPED, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType | str) -> DataFrame:
    """Apply ``function`` to each Arrow batch; None leaves the batch out."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in slices(batch):
                if (out := function(small)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes each, so that long texts do not add up in memory."""
    step = max(1, batch.num_rows * most // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def texts(batch: pa.RecordBatch, column: str | int = "text") -> list[str]:
    """The texts of a batch; a null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def hex_digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def free_name(df: DataFrame, wish: str = "helper") -> str:
    """A column name that ``df`` does not have, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
