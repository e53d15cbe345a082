"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreports.session import remove_path

# paths of the tables written inside each open block of temporary_tables
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: ``spark.checkpoint.dir`` where the session names one.

    Only a local session (tests) without that setting gets a temporary folder;
    on a cluster the setting is required.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return named or sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; later steps read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession) -> str:
    """A path for a table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder, or at a ``path`` that no
    :func:`temporary_tables` removes.

    Unlike a checkpoint it keeps no partitioning, so a later join exchanges both
    sides and Spark can split its hot keys.
    """
    if path is None:
        path = new_path(df.sparkSession)
        if _open:
            _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the tables that :func:`stored` writes inside the block.

    What is to outlive the block must not read them: write it with a path of its own.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove_path(spark, path)


def dealt_anew(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly instead of by the key it is grouped by, so that a join
    on that key exchanges both sides and Spark can split a hot key."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*df.columns))


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` is called so."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name
