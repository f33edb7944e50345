"""A table of versions: its rows lie in segments, a manifest per version lists them, one rename publishes.

    <path>/segments/<name>/     Parquet files, never changed once written
    <path>/manifest/<version>   JSON: the segments of the version and notes of the writer

A version is what its manifest lists. A writer writes its segments first and then moves the manifest
to its final name, which must not exist: a reader sees the version before or the version after, and
of two writers of one version the second fails. A run that fails on the way leaves segments that no
manifest lists. Segments are listed, never rows, so the manifest goes through the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession


class VersionConflict(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Segment:
    name: str
    schema: str
    tier: int = 0


@dataclass(frozen=True)
class Version:
    number: int = 0
    segments: tuple[Segment, ...] = ()
    notes: dict = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, in order."""
    fs, folder = _hadoop(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of the table, by default the latest; an empty one if there is none."""
    if number is None:
        number = max(versions(spark, path), default=0)
    if number == 0:
        return Version()
    fs, file = _hadoop(spark, f"{path}/manifest/{number:012d}")
    stream = fs.open(file)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, tuple(Segment(**s) for s in found["segments"]), found["notes"])


def write_segment(df: DataFrame, path: str, tier: int = 0) -> Segment:
    """Write rows as a segment that no version lists yet."""
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/segments/{name}")
    return Segment(name, df.schema.json(), tier)


def publish(spark: SparkSession, path: str, after: Version, segments: list[Segment], notes: dict | None = None) -> Version:
    """Publish the version that follows ``after``; fails if another writer has done so."""
    new = Version(after.number + 1, tuple(segments), after.notes | (notes or {}))
    fs, folder = _hadoop(spark, f"{path}/manifest")
    fs.mkdirs(folder)
    _, draft = _hadoop(spark, f"{path}/manifest/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(json.dumps({"segments": [asdict(s) for s in new.segments], "notes": new.notes}).encode())
    finally:
        stream.close()
    _, final = _hadoop(spark, f"{path}/manifest/{new.number:012d}")
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, final, no_overwrite)
    except Exception as error:
        fs.delete(draft, False)
        if new.number in versions(spark, path):
            raise VersionConflict(f"version {new.number} of {path} is there already") from error
        raise
    return new


def read(spark: SparkSession, path: str, at: Version | None = None) -> DataFrame:
    """The rows of a version, by default the latest. Later versions do not change them."""
    at = at or version(spark, path)
    if not at.segments:
        raise FileNotFoundError(f"{path} has no version")
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(at.segments[-1].schema))
    return spark.read.schema(schema).parquet(*[f"{path}/segments/{s.name}" for s in at.segments])


def replace(df: DataFrame, path: str, after: Version | None = None) -> Version:
    """Publish ``df`` as the next version, in place of all rows. ``df`` may read the version before."""
    spark = df.sparkSession
    after = after or version(spark, path)
    return publish(spark, path, after, [write_segment(df, path)])


def remove_unlisted(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete manifests but the last ``keep``, and segments that none of these lists; says how many.

    For a time without writers and without readers of older versions.
    """
    numbers = versions(spark, path)
    for number in numbers[: max(len(numbers) - keep, 0)]:
        fs, file = _hadoop(spark, f"{path}/manifest/{number:012d}")
        fs.delete(file, False)
    listed = {s.name for n in numbers[-keep:] for s in version(spark, path, n).segments}
    fs, folder = _hadoop(spark, f"{path}/segments")
    unlisted = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in listed]
    for segment in unlisted:
        fs.delete(segment, True)
    return len(unlisted)
