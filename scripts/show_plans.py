"""Write the physical plans of the headline queries to PLANS.md.

    python scripts/show_plans.py [sf_dir]

Plans are the adaptive plans before execution (``explain("simple")``),
with long expression lists shortened.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldreports.plans.catalog import QUERIES  # noqa: E402
from fieldreports.session import build_session  # noqa: E402

HEADLINE = ("worker_payments", "enrich", "pick_needed_calls", "queue_refresh", "reconcile_survey", "event_upsert")


def shorten(line: str, width: int = 180) -> str:
    line = re.sub(r"#\d+L?", "", line)
    return line if len(line) <= width else line[: width - 3] + "..."


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "", f"Generated by `scripts/show_plans.py` at `{sf}` (local[8], 16 shuffle partitions).",
           "Lines are shortened; `#id` suffixes removed.", ""]
    for name in HEADLINE:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("simple")
        lines = [shorten(x) for x in buf.getvalue().splitlines() if x.strip()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
