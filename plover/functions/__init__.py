"""Column-level functions: all built from ``pyspark.sql.functions``.

Each returns a ``Column`` so it composes inside one projection and stays in
whole-stage codegen.  Text is parsed with ``try_cast``/``try_to_timestamp``
because ANSI mode (on by default in Spark 4) turns a bad cast into an error,
while the reference relied on null-on-failure.
"""

from plover.functions.parse import (  # noqa: F401
    clock_hour,
    clock_text,
    epoch_seconds,
    flight_timestamp,
    is_missing,
    merge_levels,
    net_amount,
    parse_month_year,
    parse_number_text,
    parse_percent,
    parse_tenure,
    parse_timestamp,
    route_name,
)
from plover.functions.labels import label_from_status, label_from_threshold  # noqa: F401
