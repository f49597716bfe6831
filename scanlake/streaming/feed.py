"""Feed of newly finished documents for an index, each document at most once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def fed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Everything the feed has delivered."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def feed_completed(
    events: DataFrame, key: str, time: str, root: str, checkpoint: str
) -> StreamingQuery:
    """Deliver the first completion of each ``key`` from a stream of ledger events.

    A batch is reduced to one row per key before it meets the earlier
    deliveries, and owns the folder batch=N, so replays replace and never add.
    """
    types = {f.name: f.dataType.simpleString() for f in events.schema}
    schema = f"`{key}` {types[key]}, `{time}` {types[time]}, batch bigint"

    def deliver(batch: DataFrame, batch_id: int) -> None:
        first = batch.groupBy(key).agg(F.min(time).alias(time))
        earlier = fed(batch.sparkSession, root, schema).where(F.col("batch") != batch_id)
        new = first.join(earlier.select(key), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return (
        events.where(F.col("action") == "completed")
        .writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
