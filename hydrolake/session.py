"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

#: Settings every operator relies on. Joins carry no broadcast hints: Spark
#: compares each side with spark.sql.autoBroadcastJoinThreshold, and AQE does
#: it again with measured sizes, so a side that grows falls back to a shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "hydrolake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the setting is missing (tests, local runs) a temporary folder is
    made and set, so that a cluster never writes to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, never reused."""
    return f"{checkpoint_root(spark)}/hydrolake/{name}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A hand-kept table of a few rows as a local relation.

    Its exact size is known to the optimizer, so joins on it need no hint.
    """
    types = to_arrow_schema(_parse_datatype_string(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=types))
