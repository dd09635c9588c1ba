"""Date expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def completed_years(since: Column, as_of: datetime.date) -> Column:
    """Full years between ``since`` and ``as_of``; a 29 February counts on 1 March."""
    return F.timestamp_diff("YEAR", since.cast("timestamp"), F.lit(as_of).cast("timestamp"))


def day_key(moment: Column) -> Column:
    """Calendar day a rate is looked up by."""
    return F.to_date(moment)
