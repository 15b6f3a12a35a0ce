"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "prismframe", master: str | None = None, **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; ``settings`` with dots as ``__``."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder stands in only for a local session that has none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="prismframe-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: ends the lineage, survives the loss of executors.

    The table goes when the session ends, or earlier by ``drop_checkpoint``.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    system, place = _file_system(df.sparkSession, path)
    system.deleteOnExit(place)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete a table made by ``shared_checkpoint`` that nothing lazy still reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        system, place = _file_system(df.sparkSession, folder)
        system.delete(place, True)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place
