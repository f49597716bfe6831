"""Incremental discovery: a stream of new files appended to the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.operators.registering import register_files
from scanlake.options import InputOptions
from scanlake.schemas import LEDGER
from scanlake.session import scratch
from scanlake.sources.files import stream_files


def registered(spark: SparkSession, root: str) -> DataFrame:
    """All ledger rows the stream has registered so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return spark.createDataFrame([], LEDGER).withColumn("batch", F.lit(0).cast("bigint"))
    # StructType.add would change LEDGER itself.
    schema = T.StructType([*LEDGER.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(root)


def register_available(
    spark: SparkSession, options: InputOptions, root: str, checkpoint: str, now: Column
) -> None:
    """Register everything that is new and stop; run it again for later files.

    Each micro-batch owns the folder batch=N and replaces it when replayed, so
    a restart after a crash registers nothing twice. All that is new is one batch,
    so its ids go by path.
    """

    def register(batch: DataFrame, batch_id: int) -> None:
        known = registered(batch.sparkSession, root).where(F.col("batch") != batch_id)
        new = register_files(batch, known, now)
        new.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    with scratch():
        (
            stream_files(spark, options, registered(spark, root), f"{checkpoint}/listed")
            .writeStream.foreachBatch(register)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
