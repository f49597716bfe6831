"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.session import shared_folder


def number_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name`` = 1, 2, 3 ... in the order of the unique column ``key``.

    Range partitions are sorted side by side; only the row count of each
    partition goes through the one-task running sum. The partitioned rows are
    checkpointed first, since the range bounds are sampled and a recomputed
    partition could differ from the one that was counted.
    """
    shared_folder(df.sparkSession)
    part, row = "__part", "__row"
    ranged = (
        df.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn(part, F.spark_partition_id())
        # The low 33 bits count the rows of the partition.
        .withColumn(row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    sizes = ranged.groupBy(part).agg(F.count("*").alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    # One row per shuffle partition, so the broadcast cannot grow with the data.
    return (
        ranged.join(F.broadcast(offsets), part)
        .withColumn(name, F.col("__before") + F.col(row) + 1)
        .drop(part, row, "__before")
    )
