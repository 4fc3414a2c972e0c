"""Session set-up and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # HotSpot compiles no method above 8000 bytes: wide stages run faster split into operators
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Epoch conversion and date parts must not depend on where the job runs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may leave
    it unset; its folder then goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_folder(spark).rstrip('/')}/starloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with further writer ``options``, and read it back.

    Cuts the lineage with a table that outlives lost executors. Used only where
    two passes must see the very same rows in the very same partitions, or
    where a target is about to be overwritten by rows derived from itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
