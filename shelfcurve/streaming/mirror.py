"""A mirror table that follows a stream of inserts and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcurve.operators.windows import first_per_key
from shelfcurve.sources import versions


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, name_filter: str | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(folder)


FAN = 4  # segments of a tier that are merged into one of the next


def _newest(rows: DataFrame, keys: list[str], newest_first: list) -> DataFrame:
    """The newest row of each key; of rows equal in that order the one that arrived last."""
    return first_per_key(rows, keys, [*newest_first, F.col("_arrived").desc()])


def _full_tier(segments: list[versions.Segment], fan: int) -> int | None:
    """The lowest tier that has ``fan`` segments."""
    tiers = sorted({s.tier for s in segments})
    return next((t for t in tiers if sum(s.tier == t for s in segments) >= fan), None)


def apply_batch(batch: DataFrame, batch_id: int, path: str, source: str, keys: list[str], newest_first: list, fan: int = FAN) -> bool:
    """Add a batch to the mirror as one version; says whether it was new.

    The newest row per key of the batch becomes a segment. A tier with ``fan`` segments is merged into
    one segment of the next tier, so a row is written again once per tier, a mirror of n batches has
    fewer than ``fan`` segments in each of log n tiers, and a read opens no more. The version notes the
    last batch of each ``source``: a batch that comes again is left out.
    """
    spark = batch.sparkSession
    before = versions.version(spark, path)
    if batch_id <= before.notes.get(source, -1):
        return False
    arrived = F.lit(before.number + 1).cast("bigint")
    segments = [*before.segments, versions.write_segment(first_per_key(batch, keys, newest_first).withColumn("_arrived", arrived), path)]
    while (tier := _full_tier(segments, fan)) is not None:
        merged = versions.read(spark, path, versions.Version(before.number, tuple(s for s in segments if s.tier == tier)))
        larger = versions.write_segment(_newest(merged, keys, newest_first), path, tier + 1)
        segments = [*(s for s in segments if s.tier != tier), larger]
    versions.publish(spark, path, before, segments, {source: batch_id})
    return True


def upsert_stream(changes: DataFrame, path: str, checkpoint: str, keys: list[str], newest_first: list, fan: int = FAN):
    """Upsert a stream into the mirror at ``path``; runs until the input is used up.

    The cost of a batch is its own and that of the tiers it fills, not of the mirror.
    """
    query = (
        changes.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, path, checkpoint, keys, newest_first, fan) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_mirror(spark: SparkSession, path: str, keys: list[str], newest_first: list) -> DataFrame:
    """The current row of each key: the newest by ``newest_first``, whenever it arrived.

    Rows that are equal in that order count by their batch, the later one first.
    """
    return _newest(versions.read(spark, path), keys, newest_first).drop("_arrived")


def compact_mirror(spark: SparkSession, path: str, keys: list[str], newest_first: list) -> versions.Version:
    """Publish a version whose rows are the current ones, in one segment."""
    before = versions.version(spark, path)
    whole = _newest(versions.read(spark, path, before), keys, newest_first)
    top = max((s.tier for s in before.segments), default=0) + 1
    return versions.publish(spark, path, before, [versions.write_segment(whole, path, top)])


def append_by_day(stream: DataFrame, path: str, checkpoint: str, day: str):
    """Append a stream to a table partitioned by day; runs until the input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .partitionBy(day)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
