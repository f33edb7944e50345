"""Writers for tables, delimited files and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None) -> DataFrame:
    """Replace a table.

    ``partitions`` sets the number of writers; without it adaptive execution decides.
    """
    out = df.repartition(partitions) if partitions else df
    out.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)


def append_partitioned(df: DataFrame, path: str, day: str, merge_schema: bool = True) -> DataFrame:
    """Append to a table partitioned by day; later loads may bring new columns.

    The rows are rebalanced by day rather than hashed by it, so a day with very many rows
    is written by several tasks.
    """
    df.hint("rebalance", day).write.partitionBy(day).mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", merge_schema).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    df.write.option("header", header).option("sep", sep).mode("overwrite").csv(path)
    return path


def move_partitions(source: DataFrame, target_path: str, partition: str) -> DataFrame:
    """Put the partitions of ``source`` in place of the same partitions of the target."""
    (
        source.hint("rebalance", partition)
        .write.partitionBy(partition)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(target_path)
    )
    return source.sparkSession.read.parquet(target_path)


def write_script(pieces: DataFrame, path: str, notebook: str, position: str, piece: str = "piece", buckets: int = 64) -> DataFrame:
    """Write script pieces in hash buckets of notebooks, with notebook and position as columns.

    The number of files follows the buckets, not the notebooks. Inside the buckets the rows are in
    order, and range partitioning splits a bucket that a long notebook makes large.
    """
    bucket = F.pmod(F.xxhash64(notebook), F.lit(buckets)).cast("int").alias("bucket")
    placed = pieces.select(notebook, position, piece, bucket).repartitionByRange(buckets, "bucket", notebook, position)
    placed.sortWithinPartitions("bucket", notebook, position).write.partitionBy("bucket").mode("overwrite").parquet(path)
    return pieces.sparkSession.read.parquet(path)


def read_script(spark: SparkSession, path: str, notebook: str, name, position: str, buckets: int = 64) -> DataFrame:
    """The pieces of one notebook in order; only its bucket is read. ``name`` is a value or a column."""
    wanted = name if isinstance(name, Column) else F.lit(name)
    stored = spark.read.parquet(path)
    wanted = wanted.cast(stored.schema[notebook].dataType)
    return stored.where((F.col("bucket") == F.pmod(F.xxhash64(wanted), F.lit(buckets))) & (F.col(notebook) == wanted)).orderBy(position)
