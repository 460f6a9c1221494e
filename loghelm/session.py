"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(master: str | None = None, app: str = "loghelm", **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, reachable from every executor.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loghelm-"))
        current = sc.getCheckpointDir()
    return current


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder name inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, store in the shared folder, cut the lineage there.

    Used for tables that are read more than once (template tables, score
    tables, offsets); survives the loss of executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parameter_table(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A small table of settings or model parameters from driver values."""
    columns = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(columns, schema=to_arrow_schema(schema)), schema)
