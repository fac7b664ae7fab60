"""Surrogate ids without an unpartitioned window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.plans.sizing import materialize


def assign_ids(df: DataFrame, *order: Column | str, column: str = "id_house", start: int = 1) -> DataFrame:
    """Consecutive ids in key order, beginning at ``start``.

    Rows are range-partitioned and sorted by the key, and their place (partition,
    position) is written with them, so that a re-run task cannot see other bounds.
    Offsets are one row per partition and hence safe to broadcast.
    """
    if not order:
        raise ValueError("ids need an order to be repeatable")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Fixed layout of the built-in: partition in the upper bits, position in the lower 33.
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
    return numbered.withColumn(
        column, F.col("_offset") + position + F.lit(start).cast("long")
    ).drop("_place", "_part", "_p", "_offset")
