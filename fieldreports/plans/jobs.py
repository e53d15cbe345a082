"""The daily jobs, assembled from operators, with their sinks.

    python -m fieldreports.plans.jobs payments --inputs inputs.json --as-of 2024-02-10 --out /shared/reports
    python -m fieldreports.plans.jobs calls    --inputs inputs.json --as-of 2024-02-10 --out /shared/tables/queue
    python -m fieldreports.plans.jobs report   --inputs inputs.json --as-of 2024-02-10 --out /shared/reports
    python -m fieldreports.plans.jobs maintain --inputs inputs.json --as-of 2024-02-10 --out /shared/tables

    python -m fieldreports.plans.jobs queue    --inputs inputs.json --as-of 2024-02-10 --out /shared/tables/queue
    python -m fieldreports.plans.jobs repair   --inputs inputs.json --as-of 2024-02-10 --out /shared/tables/legacy

The old call queue is the ``queue`` entry of ``inputs.json``; ``calls``
writes the new queue as version ``v=<as-of>`` under ``--out``. ``queue`` refreshes a
queue table in place instead: ``--out`` is partitioned by district, and the files of
districts without new entries are neither read nor written. ``repair`` corrects
service dates in a legacy table partitioned by ``code``, in place as well.

``inputs.json`` maps input names to ``{"path": ..., "format": ...}``. The
enriched messages are written once per run as a table in the shared
checkpoint folder; every output of the run reads that table, so lineage is
short and a lost executor only recomputes from the written table. The copy is
removed when the run ends.
"""

from __future__ import annotations

import argparse
import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators import calls as C
from fieldreports.operators import enrich as E
from fieldreports.operators import maintenance as M
from fieldreports.operators import payments as P
from fieldreports.operators import survey as V
from fieldreports.operators.common import assert_unique
from fieldreports.operators.normalize import flatten_survey, normalize_messages
from fieldreports.session import build_session, checkpoint_dir, path_exists, remove_path, write_text
from fieldreports.sinks.writers import (
    discard, overwrite_partitions, publish, stage_csv_report, write_csv_report, write_table_version,
)
from fieldreports.sources import readers as R


@dataclass
class Inputs:
    """Where the landed inputs are. Each entry: ``{"path": str, "format": str}``."""

    raw_messages: dict
    events: dict
    roster: dict
    crosswalk: dict
    survey_responses: dict | None = None
    legacy_messages: dict | None = None
    directory: dict | None = None
    queue: dict | None = None

    @classmethod
    def from_json(cls, path: str) -> "Inputs":
        with open(path) as fh:
            return cls(**json.load(fh))


def _load(spark: SparkSession, spec: dict, schema) -> DataFrame:
    return spark.read.schema(schema).format(spec.get("format", "parquet")).load(spec["path"])


def _fmt(spec: dict, default: str = "parquet") -> str:
    return spec.get("format", default)


def load_inputs(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    """Read every configured input through its reader (declared schemas)."""
    out = {
        "raw": R.read_raw_messages(spark, inputs.raw_messages["path"], _fmt(inputs.raw_messages)),
        "events": R.read_events(spark, inputs.events["path"], _fmt(inputs.events)),
        "roster": R.read_roster(spark, inputs.roster["path"], _fmt(inputs.roster)),
        "crosswalk": R.read_crosswalk(spark, inputs.crosswalk["path"], _fmt(inputs.crosswalk)),
    }
    if inputs.survey_responses:
        spec = inputs.survey_responses
        out["responses"] = R.read_survey_responses(spark, spec["path"], _fmt(spec, "json"))
    if inputs.legacy_messages:
        spec = inputs.legacy_messages
        out["legacy"] = R.read_legacy_messages(spark, spec["path"], _fmt(spec))
    if inputs.directory:
        out["directory"] = _load(spark, inputs.directory, schemas.DIRECTORY)
    if inputs.queue:
        out["queue"] = _load(spark, inputs.queue, schemas.QUEUE)
    return out


def validate_dimensions(roster: DataFrame, crosswalk: DataFrame) -> None:
    """Duplicate numbers would fan reports out; fail instead."""
    assert_unique(crosswalk.where("old_number IS NOT NULL"), ["old_number"], "crosswalk")
    now = E.translate_numbers(roster, crosswalk, "reporting_number", "reporting_number")
    assert_unique(now, ["reporting_number"], "roster after number changes")


class RunTables:
    """Tables of one run in the shared checkpoint folder, removed at the end of the run."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/fieldreports/{run_id}"

    def __enter__(self) -> "RunTables":
        return self

    def __exit__(self, *exc) -> None:
        remove_path(self.spark, self.root)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once; the outputs of the run read it from there."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def enriched(self, data: dict[str, DataFrame]) -> DataFrame:
        validate_dimensions(data["roster"], data["crosswalk"])
        return self.keep("enriched", E.enrich(normalize_messages(data["raw"]), data["events"], data["roster"], data["crosswalk"]))


def run_payments(spark: SparkSession, data: dict[str, DataFrame], as_of: datetime, out_dir: str,
                 run_id: str) -> tuple[str, str]:
    """M7: worker and supervisor payments from one enrichment and one count (A2), sorted by due date."""
    with RunTables(spark, run_id) as tables:
        counts = tables.keep("counts", P.capped_counts(tables.enriched(data), as_of))
        workers = P.sort_payments(P.worker_payments(counts))
        supers = P.sort_payments(P.super_payments(counts))
        return (
            write_csv_report(workers, out_dir, "workers", as_of),
            write_csv_report(supers, out_dir, "supers", as_of),
        )


def run_calls(spark: SparkSession, data: dict[str, DataFrame], as_of: datetime, queue_out: str,
              run_id: str, target: float = C.DEFAULT_TARGET) -> str:
    """Pick reports to verify, then refresh the district queues and the Test queue."""
    with RunTables(spark, run_id) as tables:
        enriched = tables.enriched(data)
        old = data.get("queue")
        if old is None:
            old = spark.createDataFrame([], schemas.QUEUE)
        entries = tables.keep("entries", C.queue_batches(enriched, as_of, target))
        return write_table_version(C.push_entries(old, entries, batches=2), queue_out, as_of.strftime("%Y%m%d"))


def refresh_queue_table(spark: SparkSession, data: dict[str, DataFrame], as_of: datetime, queue_dir: str,
                        run_id: str, target: float = C.DEFAULT_TARGET) -> list[str | None]:
    """Refresh a queue table partitioned by district in place (K3, W4). Returns the districts it wrote.

    Only districts that get entries are read (static partition pruning) and written (dynamic
    overwrite); the list of their names is bounded by the number of partitions, which the
    driver lists anyway. The new content is first written to a folder of the as-of date and
    a marker is set at the end: a run that died goes on from the written content, and a
    second run for the same date pushes nothing twice. An empty district name cannot be
    told from a missing one in a partition, so it counts as missing.
    """
    day = as_of.strftime("%Y%m%d")
    done, staged = f"{queue_dir}/_runs/{day}", f"{queue_dir}/_staged/{day}"
    if path_exists(spark, done):
        return []
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        with RunTables(spark, run_id) as tables:
            entries = tables.keep("entries", C.queue_batches(tables.enriched(data), as_of, target).withColumn(
                "district", F.nullif("district", F.lit(""))))
            names = [r["district"] for r in entries.select("district").distinct().collect()]
            if path_exists(spark, queue_dir):
                old = spark.read.schema(schemas.QUEUE).parquet(queue_dir)
            else:
                old = spark.createDataFrame([], schemas.QUEUE)
            mine = old.where(F.col("district").isin([n for n in names if n is not None])
                             | (F.col("district").isNull() & F.lit(None in names)))
            C.push_entries(mine, entries, batches=2, touched_only=True).write.mode("overwrite").parquet(staged)
    fresh = spark.read.schema(schemas.QUEUE).parquet(staged)
    written = [r["district"] for r in fresh.select("district").distinct().collect()]
    overwrite_partitions(fresh, queue_dir, ["district"])
    write_text(spark, done, run_id)
    remove_path(spark, staged)
    return written


def repair_legacy_table(spark: SparkSession, table_dir: str, run_id: str, partition: str = "code") -> int:
    """Correct the service dates of a legacy table in place (K5): copy-on-write of the partitions
    that hold a wrong date. Returns the number of corrected messages; a second run finds none."""
    legacy = spark.read.schema(schemas.LEGACY_MESSAGE).parquet(table_dir)
    with RunTables(spark, run_id) as tables:
        repairs = tables.keep("repairs", M.date_repairs(legacy, partition))
        found = {r[partition]: r["n"] for r in repairs.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).collect()}
        if found:
            touched = legacy.where(F.col(partition).isin([p for p in found if p is not None])
                                   | (F.col(partition).isNull() & F.lit(None in found)))
            fresh = tables.keep("fresh", M.update_by_key(touched, repairs, ["_id"], ["serviceDate"]))
            overwrite_partitions(fresh, table_dir, [partition])
        return sum(found.values())


def run_report(spark: SparkSession, data: dict[str, DataFrame], out_dir: str, run_ts: datetime,
               run_id: str, roster: DataFrame | None = None) -> tuple[str, str]:
    """K2: reconciled survey report, the report with contact numbers (J11) and the orphan surveys.

    The coverage guard (F8, A9) and the key counts of the merge (J8) are observed while
    the outputs are staged, so they cost no pass of their own. A non-training row whose number
    is missing in ``roster`` (the run's roster after number changes, unless one is given) fails
    the job before anything is published.
    """
    if roster is None:
        roster = E.translate_numbers(data["roster"], data["crosswalk"], "reporting_number", "reporting_number")
    seen, checked = Observation(f"{run_id}-merge"), Observation(f"{run_id}-coverage")
    with RunTables(spark, run_id) as tables:
        survey = tables.keep("survey", V.clean_survey(flatten_survey(data["responses"])))
        messages = tables.enriched(data).observe(seen, V.null_keys().alias("null_merge_keys"), F.count(F.lit(1)).alias("messages"))
        report, orphans = V.reconcile_survey(messages, survey, share=lambda marked: tables.keep("marked", marked))
        report = tables.keep("report", V.with_contact(report, roster).observe(
            checked, V.uncovered().alias("uncovered"), F.count(F.lit(1)).alias("rows")))
        counted = {**seen.get, **checked.get}
        if counted["uncovered"]:
            raise ValueError(f"{counted['uncovered']} report rows from numbers missing in the roster")
        plain = report.drop("_merge", "contact_number", "_covered")
        staged = []
        try:
            for key, df in (("reports", plain), ("orphans", orphans),
                            ("final", report.where("_covered").drop("_merge", "_covered"))):
                staged.append(stage_csv_report(df, out_dir, key, run_ts))
        except BaseException:
            discard(spark, staged)
            raise
        paths = publish(spark, staged, counted)
        return paths[0], paths[1]


def run_maintenance(spark: SparkSession, data: dict[str, DataFrame], out_dir: str, version: str) -> dict[str, str]:
    """Events from legacy flags, worker directory, repaired dates: new table versions."""
    written = {}
    messages = normalize_messages(data["raw"])  # every copy counts: a sender may occur on a later one only
    if "legacy" in data:
        events = M.event_upsert(data["events"], M.flags_to_events(data["legacy"]))
        written["events"] = write_table_version(events, f"{out_dir}/events", version)
        written["service_dates"] = write_table_version(M.repair_dates(data["legacy"]), f"{out_dir}/service_dates", version)
    if "directory" in data:
        found = M.testers(messages, data["roster"], data["crosswalk"])
        directory = M.directory_upsert(data["directory"], data["roster"], found)
        written["directory"] = write_table_version(directory, f"{out_dir}/directory", version)
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fieldreports")
    ap.add_argument("job", choices=["payments", "calls", "queue", "report", "maintain", "repair"])
    ap.add_argument("--inputs", required=True)
    ap.add_argument("--as-of", required=True, help="YYYY-MM-DD; no job reads the wall clock")
    ap.add_argument("--out", required=True)
    ap.add_argument("--target", type=float, default=C.DEFAULT_TARGET)
    args = ap.parse_args(argv)
    as_of = datetime.fromisoformat(args.as_of)
    spark = build_session()
    checkpoint_dir(spark)  # must be configured on the cluster
    data = load_inputs(spark, Inputs.from_json(args.inputs))
    run_id = f"{args.job}-{as_of:%Y%m%d}-{uuid.uuid4().hex[:8]}"
    if args.job == "payments":
        print(run_payments(spark, data, as_of, args.out, run_id))
    elif args.job == "calls":
        print(run_calls(spark, data, as_of, args.out, run_id, args.target))
    elif args.job == "queue":
        print(refresh_queue_table(spark, data, as_of, args.out, run_id, args.target))
    elif args.job == "repair":
        print(repair_legacy_table(spark, args.out, run_id))
    elif args.job == "report":
        print(run_report(spark, data, args.out, as_of, run_id))
    else:
        print(run_maintenance(spark, data, args.out, as_of.strftime("%Y%m%d")))


if __name__ == "__main__":
    main()
