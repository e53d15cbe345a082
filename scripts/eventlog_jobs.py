"""Summarise job times from a Spark event log folder (zstd or plain JSON lines).

    python scripts/eventlog_jobs.py <eventlog dir> [job group]
"""

import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode().splitlines()


def main(folder, group=None):
    jobs = {}
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {})
                jobs[e["Job ID"]] = [e["Submission Time"], None, props.get("spark.jobGroup.id"),
                                     len(e["Stage Infos"]), props.get("spark.job.description", "")]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
    prev = None
    for j, (s, c, g, n, d) in sorted(jobs.items()):
        if group and g != group:
            continue
        gap = s - prev if prev else 0
        print(f"job {j:4d} {c - s:6d} ms  stages={n:2d}  gap-before={gap:5d} ms  {d[:50]}")
        prev = c


if __name__ == "__main__":
    main(*sys.argv[1:])
