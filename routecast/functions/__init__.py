"""Column-level building blocks. Everything here returns a ``Column`` built
from ``pyspark.sql.functions``; nothing leaves the JVM."""

from routecast.functions.timecols import (  # noqa: F401
    add_minutes,
    add_seconds,
    dow0,
    epoch_micros,
    minute_diff,
    ntz,
)
from routecast.functions.mathcols import (  # noqa: F401
    avg_exact,
    dec,
    rate,
    round_half_up_int,
    safe_div,
    strict_greatest,
    strict_least,
)
