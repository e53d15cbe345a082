"""Spark session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: naive UTC timestamps, ANSI casts (a bad supervisor
# number must fail, not turn into NULL), AQE for runtime join/partition choices
# and skew splitting, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # target size of a shuffle partition after AQE coalescing
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "fieldreports",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`BASE_CONF` applied.

    ``master`` is only for local runs and tests; on a cluster leave it ``None``
    so the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() returns an existing session unchanged; make the SQL
    # settings hold for it too (static ones such as the UI cannot change).
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this comes from ``spark.checkpoint.dir`` (a shared file
    system). ``fallback`` is only used when that setting is absent, as in tests;
    it is then also installed as the context's checkpoint directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or fallback or ""
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        chosen = configured
    elif fallback is not None:
        chosen = fallback
        if "://" not in chosen:
            os.makedirs(chosen, exist_ok=True)
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; pass a shared folder for intermediate tables"
        )
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(chosen)
    return chosen


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any file system Spark can read."""
    hadoop_path, fs = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder the caller made; a missing one is no error."""
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder; raises where the file system refuses."""
    source_path, fs = _file_system(spark, source)
    if not fs.rename(source_path, _file_system(spark, target)[0]):
        raise OSError(f"cannot rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small UTF-8 file, replacing one of that name."""
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small UTF-8 file."""
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where the folder is missing."""
    hadoop_path, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []
