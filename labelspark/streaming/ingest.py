"""Incremental processing: skip what is done, and ingest labels as files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..operators.joins import null_safe_join
from ..schemas import ARRIVAL
from ..session import stage

LABEL_KEY = ["source", "product_id", "version"]

def new_only(labels: DataFrame, done: DataFrame, keys: list[str] = LABEL_KEY) -> DataFrame:
    """Labels whose (source, product, version) has not been processed."""
    return labels.join(done.select(*keys).distinct(), keys, "left_anti").select(*labels.columns)


def _read_sink(spark: SparkSession, sink: str, columns: list[str], schema: T.StructType) -> DataFrame:
    """What the sink holds; nothing before the first batch. Only a missing folder counts as that."""
    try:
        return spark.read.parquet(sink).select(*columns)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], T.StructType([schema[c] for c in columns]))


def first_delivery(batch: DataFrame, done: DataFrame, keys: list[str] = LABEL_KEY) -> DataFrame:
    """Rows of each key's first delivery: the one on record in ``done``, else the smallest in the batch.

    A label is any number of rows, in any number of files and batches, of one delivery. NULL deliveries come first.
    """
    order = F.coalesce(F.col("delivery"), F.lit(-1).cast("bigint"))
    known = done.groupBy(*keys).agg(F.min(order).alias("_known"))
    here = batch.groupBy(*keys).agg(F.min(order).alias("_first"))
    wanted = null_safe_join(here, known, keys, "left").select(*keys, F.coalesce("_known", "_first").alias("_wanted"))
    return null_safe_join(batch, wanted, keys).where(order == F.col("_wanted")).select(*batch.columns)


def stream_labels(
    spark: SparkSession, source: str, sink: str, checkpoint: str,
    process: Callable[[DataFrame], DataFrame], schema: T.StructType = ARRIVAL,
    max_files: int = 1000,
):
    """Ingest label files as they arrive and write the processed rows.

    The first ``delivery`` of a (source, product, version) wins, with all its rows, whichever files and batches they
    come in. Each batch writes its own folder ``batch=N``, replaced when the batch is retried, so a restart leaves no
    duplicates. The accepted keys are kept beside the results: a label without any match counts as delivered.
    Nothing is kept in streaming state; what is done is read from the sink.
    """
    columns = [*LABEL_KEY, "delivery"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        done = _read_sink(own, f"{sink}/keys", columns + ["batch"], T.StructType(
            [*schema.fields, T.StructField("batch", T.IntegerType())]
        )).where(F.col("batch") != batch_id)
        first = stage(first_delivery(batch, done), "delivery")
        process(first).write.mode("overwrite").parquet(f"{sink}/rows/batch={batch_id}")
        first.select(*columns).distinct().write.mode("overwrite").parquet(f"{sink}/keys/batch={batch_id}")

    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        arrivals.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
