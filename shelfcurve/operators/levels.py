"""Rollup levels in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def masked_levels(df: DataFrame, masked: dict[str, Column]) -> DataFrame:
    """One copy of each row per subset of the masked columns.

    ``masked`` maps a column to the value that stands for "all". Bit ``i`` of the new
    column ``level_mask`` tells that masked column ``i`` keeps its own value. The mask
    belongs into the grouping key, since a real value may equal the stand-in.
    """
    names = list(masked)
    masks = F.array(*[F.lit(m) for m in range(2 ** len(names))])
    copies = df.withColumn("level_mask", F.explode(masks))
    replaced = {
        name: F.when(F.col("level_mask").bitwiseAND(1 << i) != 0, F.col(name)).otherwise(masked[name])
        for i, name in enumerate(names)
    }
    return copies.withColumns(replaced)
