"""Date keys shared by queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(column: str) -> Column:
    """Text key such as 1997-04."""
    return F.concat_ws("-", F.year(column).cast("string"), F.lpad(F.month(column).cast("string"), 2, "0"))

