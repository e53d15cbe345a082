"""Stable message ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldreports.constants import MISSING_FIELD_TEXT


def message_id(og_service_date, patient_name, patient_phone, code) -> Column:
    """md5 hex of the four fields joined without a separator.

    The sender is deliberately not part of the id: the same visit reported
    from two phones is one visit. A NULL field is spelled ``None``.
    """
    parts = [
        F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(MISSING_FIELD_TEXT))
        for c in (og_service_date, patient_name, patient_phone, code)
    ]
    return F.md5(F.concat(*parts))
