"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# HotSpot never compiles a method over 8,000 bytecodes. Past this limit Spark runs the
# expressions in small generated methods instead of one that stays interpreted, which a
# long rule pack over computed columns would otherwise hit.
JIT_METHOD_LIMIT = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the plans rely on; each is a runtime setting with a safe default."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A session that names none is refused on a cluster, where a folder of the driver's machine
    would lose what executors write. Only in local mode, where driver and executors are one
    process, it gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tamiz-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """The folder of this application's scratch tables."""
    return f"{shared_folder(spark)}/tamiz-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's scratch folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application. Results that have not been written elsewhere may still read them, so it comes last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
