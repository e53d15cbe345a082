"""fieldreports: Spark DataFrame transforms and batch jobs for field-worker visit reports.

Every transform takes and returns a ``DataFrame`` and is built from built-in
``pyspark.sql.functions`` so Catalyst can prune, push down and code-generate it.
Wall-clock time never enters a transform: callers pass ``as_of`` explicitly.
"""

from fieldreports.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
