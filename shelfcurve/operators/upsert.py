"""Upsert and staged publish on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcurve.functions.predicates import all_of
from shelfcurve.sources import versions


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source``, which fails while it is read if a key occurs twice. The check is part of the plan.

    A key with a NULL matches nothing, so it may repeat.
    """
    whole = all_of(F.col(k).isNotNull() for k in keys)
    several = whole & (F.count("*").over(Window.partitionBy(*keys)) > 1)
    key = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"the source of an upsert has several rows for {', '.join(keys)} = "), key)
    return source.withColumn("_several", several).where(F.when(F.col("_several"), F.raise_error(message).cast("boolean")).otherwise(True)).drop("_several")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source replace rows of the target with the same key; new keys are added.

    Two rows of the source with one key are an error. The anti-join reads the source's keys only;
    adaptive execution broadcasts them if they are small and splits a hot key of the target if not.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(one_row_per_key(source, keys))


def staged_publish(df: DataFrame, stage_path: str, table_path: str, keys: list[str]) -> DataFrame:
    """Load a stage and merge it into a table of versions, unless there is nothing to publish.

    One rename publishes the merged rows as the table's next version, see ``sources.versions``: who
    reads meanwhile sees the old rows or the new ones, and a failure on the way leaves the old.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(stage_path)
    stage = spark.read.schema(df.schema).parquet(stage_path)
    before = versions.version(spark, table_path)
    if stage.isEmpty():
        return versions.read(spark, table_path, before)
    merged = merge_upsert(versions.read(spark, table_path, before), stage, keys) if before.segments else one_row_per_key(stage, keys)
    return versions.read(spark, table_path, versions.replace(merged, table_path, before))
