"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(wall_clock: Column | str) -> Column:
    """Microseconds from 1970-01-01 00:00 to a zone-less timestamp."""
    column = F.col(wall_clock) if isinstance(wall_clock, str) else wall_clock
    seconds = F.extract(F.lit("SECOND"), column)  # decimal with microseconds
    return (
        F.unix_date(F.to_date(column)).cast("long") * F.lit(86_400_000_000)
        + F.hour(column).cast("long") * F.lit(3_600_000_000)
        + F.minute(column).cast("long") * F.lit(60_000_000)
        + (seconds * 1_000_000).cast("long")
    )


def wall_clock(moment: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
