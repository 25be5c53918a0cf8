"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Application id -> temporary folder, for local sessions without the setting.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a temporary folder that goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="stockaudit-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs a re-read, and readers take the columns they need."""
    folder = new_folder(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
