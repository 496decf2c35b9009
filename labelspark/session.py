"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_scratch: dict[str, str] = {}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # label texts are long: bound an Arrow batch by bytes rather than by rows alone
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # a malformed row must be dropped even when only some columns are read
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def get_spark(app: str = "labelspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    On a local master without that setting a temporary folder stands in, which goes when the process ends. On a
    cluster the setting is required: executors cannot see each other's or the driver's folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir is not set; master {master} needs a shared folder for staged tables")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="spark-labelspark-")
        atexit.register(shutil.rmtree, _own_scratch[app], ignore_errors=True)
    return _own_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts the lineage with a plain parquet table: it survives lost executors, keeps
    column pruning for its readers and gives Catalyst real sizes to plan joins with.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
