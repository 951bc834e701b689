"""Places in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.storage import cut


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """df with the place of each row in the order, from 1.

    Rows are dealt by ranges of the order and sorted in their partitions; a row's place is the one in its partition
    added to the sizes of the partitions before. Only a number for each partition reaches the driver.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("__id")))
    part, own = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    if not before:
        return placed.drop("__id").withColumn(name, F.lit(1).cast("long"))
    offsets = df.sparkSession.createDataFrame(before, "__part long, __before long")
    placed = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return placed.withColumn(name, own + F.col("__before") + 1).drop("__id", "__part", "__before")
