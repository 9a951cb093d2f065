"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they see that folder; else ship it with the job."""
    root, there = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in there.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{there}" if there else root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; in local mode, where that is unset, a temporary one that goes with the session.

    A cluster without that setting raises: its executors have no folder in common that we know of.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="docloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that all executors see (see ``_shared``); whoever asks for it deletes it with ``drop_folder``."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of whatever file system is a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(path) and files.getFileStatus(path).isDirectory()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder (see ``_shared``).

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` its files go when nothing refers to it any more.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(_shared(spark))
    return df.checkpoint(eager=True)
