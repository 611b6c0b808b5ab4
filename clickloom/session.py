"""Session settings and tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that suit these jobs on a cluster; sizes stay with the deployment.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the default settings; keyword settings use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors share, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own. On a
    cluster a ``file:`` path counts only where ``spark.clickloom.sharedMount``
    says that every machine mounts it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if folder is None:
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="clickloom-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    mounted = spark.conf.get("spark.clickloom.sharedMount", "false") == "true"
    if folder.startswith("file:") and not master.startswith("local") and not mounted:
        raise RuntimeError(
            f"{folder} is a machine's own disk; name a shared store in spark.checkpoint.dir, "
            "or set spark.clickloom.sharedMount=true for a disk that all machines mount"
        )
    return folder.rstrip("/")


def tables_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are, below the shared folder."""
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This fixes the rows and cuts their lineage, and survives lost executors.
    A Parquet table, unlike a checkpoint, lets each reader take its columns
    only and tells the optimizer its size. ``drop_tables`` removes all of them.
    """
    path = f"{tables_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove the given ``written`` tables, or all of this application.

    Results that still read the tables must have been computed before.
    """
    folder = tables_folder(spark)
    names = {p.rsplit("/", 1)[0] for t in tables for p in t.inputFiles()}
    paths = [p for p in names if "/table-" in p] if tables else [folder]
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
