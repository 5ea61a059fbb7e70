"""Session helpers: tables, and cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the directory ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session's ``spark.checkpoint.dir`` names it.

    Only on a single machine, as in tests, a temporary folder is made and set where the setting is absent; on a
    cluster its absence raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="parlance-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/parlance/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read back: later stages don't recompute it,
    and a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def erase(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that no later stage reads."""
    for t in tables:
        remove(t.sparkSession, t._written)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, for sessions whose workers can't import it (one without a wheel installed
    and started in another folder)."""
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="parlance-"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(at / "parlance"), "zip", root.parent, root.name))
