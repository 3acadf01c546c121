"""Session helpers shared by tests, the benchmark and the local oracle check."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "riskweave", cpus: int | str = "*") -> SparkSession:
    """A local session sized for one machine. A cluster job brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.files.minPartitionNum", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="riskweave-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Of sessions on one machine, by application.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``. A
    session on one machine that names none, as in tests, gets a temporary one; a cluster must name
    one, since its executors share no local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        if spark.sparkContext.applicationId not in _own_folders:
            _own_folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="riskweave-ckpt-")
        named = _own_folders[spark.sparkContext.applicationId]
    return named.rstrip("/")


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later stages then start from durable files: a lost executor re-reads them, the plan stays
    small, and file statistics let Spark choose join strategies.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/riskweave/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
