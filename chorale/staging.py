"""Intermediate tables that several later steps read: written once, so plans stay small and lost executors cost little."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def on_one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where the session names none, a temporary one if all runs on this machine, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not on_one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="chorale-"))
    return sc.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """``df`` after a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks_folder(spark: SparkSession, folder: str) -> str | None:
    """``folder`` as a local path, where tasks write what the driver finds: if all runs on this machine, or inside the shared folder; else None."""

    def local(path: str) -> str | None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        return files.makeQualified(at).toUri().getPath() if files.getUri().getScheme() == "file" else None

    found = local(folder)
    if found is None or on_one_machine(spark):
        return found
    shared = local(shared_folder(spark))
    return found if shared is not None and f"{found}/".startswith(f"{shared}/") else None


def write_bytes(spark: SparkSession, path: str, parts) -> str:
    """Write chunks of bytes to a file of any file system that Spark knows; the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        for part in parts:
            for start in range(0, len(part), 8 << 20):
                stream.write(bytearray(part[start : start + (8 << 20)]))
    finally:
        stream.close()
    return path
