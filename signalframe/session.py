"""Session settings the engine relies on, and where intermediate results go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC) and runtime re-planning; sizes stay the cluster's."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("signalframe")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. Where none is named: a folder of this machine in local mode, else an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if named is None and context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "signalframe-checkpoints"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a result used twice is made once and survives lost executors.

    Its files stay until the session's cleaner drops them (spark.cleaner.referenceTracking.cleanCheckpoints) or
    ``drop_checkpoints`` does.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoints(spark: SparkSession) -> None:
    """Delete the checkpoints of this application: what was made from them must have been written by now."""
    at = spark.sparkContext.getCheckpointDir()
    if at is not None:
        remove(spark, at)
        make_folder(spark, at)


# files on whatever file system a path names (local, HDFS, object stores)
def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it isn't there."""
    fs, p = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if it isn't there."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file at once: written aside, flushed to the disks, then renamed over the old one."""
    jvm = spark.sparkContext._jvm
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.hsync()
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(aside), context.makeQualified(p), options)
