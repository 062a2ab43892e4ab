"""Zone-free timestamps and instants.

Casting ``timestamp_ntz`` to ``timestamp`` reads it in the session's zone, which
has skipped and repeated hours.  These helpers read and write it as UTC,
whatever the session's zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MICROS = 86_400_000_000


def ntz_as_utc(c: Column) -> Column:
    """The instant at which a UTC clock shows the zone-free timestamp."""
    return F.concat(c.cast("string"), F.lit("Z")).cast("timestamp")


def utc_as_ntz(c: Column) -> Column:
    """What a UTC clock shows at the instant, as a zone-free timestamp."""
    micros = F.unix_micros(c)
    rest = F.pmod(micros, F.lit(_DAY_MICROS))
    days = ((micros - rest) / F.lit(_DAY_MICROS)).cast("int")
    seconds = rest.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    zero = F.lit(0)
    return (F.expr("timestamp_ntz'1970-01-01 00:00:00'")
            + F.make_dt_interval(days, zero, zero, seconds.cast("decimal(18,6)")))
