"""Writers (K1-K5).

* :func:`write_csv_report` - header CSV under a run-stamped folder (K1, K2).
* :func:`write_table_version` - a table is a folder of versions, one per
  as-of date (K3, K5). A rerun for the same date replaces only its own
  version with the same content, so reruns are idempotent.
* :func:`overwrite_partitions` - replace the partitions that rows are given for and
  leave the files of all others alone (K3, K5).
* :func:`append_rows` - insert-only append of rows computed against the
  current version (K4).

Reports and versions are written to a staging folder first and then published: the
folder gets a manifest (its part files and what the run counted) and takes the place
of an earlier one. A writer that fails leaves the earlier one untouched, and several
outputs can be staged before the first is published. A publish that was cut short is
finished or undone by the next one (:func:`recover`).

All paths are meant to be on the shared file system (or object store).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from fieldreports.session import list_names, path_exists, read_text, remove_path, rename_path, write_text

# Fixed value: run stamp in file names (no ':' so it is valid on every file system).
RUN_STAMP = "%Y-%m-%d_%H-%M"


def run_path(base_dir: str, key: str, run_ts: datetime) -> str:
    return f"{base_dir.rstrip('/')}/{key}-{run_ts.strftime(RUN_STAMP)}"


MANIFEST = "_manifest.json"


@dataclass(frozen=True)
class Staged:
    """A written folder that is not yet at its place."""

    path: str
    staging: str


def _beside(path: str, prefix: str, mark: str = "") -> str:
    folder, name = path.rstrip("/").rsplit("/", 1)
    # a name with "=" would count as a partition of the table
    return f"{folder}/_{prefix}-{name.replace('=', '-')}{mark}"


def _stage(df: DataFrame, path: str, write) -> Staged:
    staged = Staged(path, _beside(path, "staging", f"-{uuid.uuid4().hex[:8]}"))
    try:
        write(df.write, staged.staging)
    except BaseException:
        discard(df.sparkSession, [staged])
        raise
    return staged


def stage_csv_report(df: DataFrame, base_dir: str, key: str, run_ts: datetime) -> Staged:
    """Write ``df`` as CSV with a header, to be published as ``{base_dir}/{key}-{stamp}``.

    Every partition writes its own part file, so no task holds the whole
    report; a sorted DataFrame gives part files in sort order.
    """
    return _stage(df, run_path(base_dir, key, run_ts), lambda w, to: w.option("header", True).csv(to))


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    for s in staged:
        remove_path(spark, s.staging)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a publish of ``path`` that was cut short between its two renames."""
    before = _beside(path, "replaced")
    if path_exists(spark, before):
        if path_exists(spark, path):
            remove_path(spark, before)
        else:
            rename_path(spark, before, path)


def publish(spark: SparkSession, staged: Sequence[Staged], counted: Mapping[str, int] | None = None) -> list[str]:
    """Put staged folders at their places, each with a manifest."""
    for s in staged:
        files = [n for n in list_names(spark, s.staging) if n.startswith("part-")]
        write_text(spark, f"{s.staging}/{MANIFEST}", json.dumps({"files": files, "counted": dict(counted or {})}, sort_keys=True))
    for s in staged:
        recover(spark, s.path)
        if path_exists(spark, s.path):
            rename_path(spark, s.path, _beside(s.path, "replaced"))
        rename_path(spark, s.staging, s.path)
        remove_path(spark, _beside(s.path, "replaced"))
    return [s.path for s in staged]


def manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, f"{path}/{MANIFEST}"))


def write_csv_report(df: DataFrame, base_dir: str, key: str, run_ts: datetime) -> str:
    """Stage and publish one CSV report; the folder belongs to this run, a rerun replaces it."""
    return publish(df.sparkSession, [stage_csv_report(df, base_dir, key, run_ts)])[0]


def read_csv_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_table_version(df: DataFrame, table_dir: str, version: str, partition_by: list[str] | None = None) -> str:
    """Write a new version of a table as parquet at ``{table_dir}/v={version}``."""
    path = f"{table_dir.rstrip('/')}/v={version}"
    staged = _stage(df, path, lambda w, to: (w.partitionBy(*partition_by) if partition_by else w).parquet(to))
    return publish(df.sparkSession, [staged])[0]


def overwrite_partitions(df: DataFrame, table_dir: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions of a parquet table that ``df`` has rows for; the files of other partitions stay.

    ``df`` must be read from somewhere else (a run table): it holds the whole new content of
    each of its partitions, so a repeated write gives the same table.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(table_dir)


def append_rows(df: DataFrame, table_dir: str) -> None:
    """Append rows to a parquet table (insert-only upserts append only new keys)."""
    df.write.mode("append").parquet(table_dir)
