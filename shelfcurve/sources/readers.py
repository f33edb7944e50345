"""Readers for tables, delimited files, text and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfcurve.functions.text import paragraph_body


def scan_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    where: Column | str | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Read a table by path. Filter and columns reach the file scan."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    df = reader.load(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_positional_csv(
    spark: SparkSession, path: str, schema: T.StructType, header_column: str | None = None, sep: str = ";"
) -> DataFrame:
    """Delimited file without a header option: trim, name and cast the columns by position.

    A header row inside the data is the row whose ``header_column`` holds the column's own
    name. Casts that fail give NULL.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    df = spark.read.option("sep", sep).schema(raw).csv(path)
    df = df.select(*[F.trim(c).alias(c) for c in df.columns])
    if header_column:
        df = df.where(F.lower(header_column) != header_column.lower())
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_bulk_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", line_sep: str = "\n"
) -> DataFrame:
    """Delimited file with given field and row ends, typed by the schema."""
    return spark.read.option("sep", sep).option("lineSep", line_sep).schema(schema).csv(path)


def read_text_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file, without markup lines and empty lines."""
    return pair_lines(spark.read.text(path))


def pair_lines(lines: DataFrame) -> DataFrame:
    """Keep lines of at least two letters that do not start with ``<``."""
    return lines.where((F.length("value") > 1) & ~F.startswith("value", F.lit("<")))


def inline_values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A short literal table with typed columns, e.g. ``"name string, value int"``."""
    return spark.createDataFrame(rows, columns)


def notebook_script(paragraphs: DataFrame, notebook: str, position: str, text: str) -> DataFrame:
    """Paragraphs of notebooks as pieces of a script.

    Written one piece per line in the order of the position, the pieces give the script:
    every piece but the first of a notebook starts with an empty line. A notebook stays
    spread over rows, so its length does not matter.
    """
    kept = paragraphs.select(notebook, position, paragraph_body(F.col(text)).alias("body")).where(
        F.col("body").isNotNull()
    )
    first = kept.groupBy(notebook).agg(F.min(position).alias("first_position"))
    piece = F.when(F.col(position) == F.col("first_position"), F.col("body")).otherwise(
        F.concat(F.lit("\n"), F.col("body"))
    )
    return kept.join(first, notebook).select(notebook, position, piece.alias("piece"))
