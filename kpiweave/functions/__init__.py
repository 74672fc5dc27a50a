"""Column-level helpers shared by the models."""

from kpiweave.functions.columns import (  # noqa: F401
    count_where,
    epoch_micros,
    exact_avg,
    instant,
    kst,
    labelled,
    micros_between,
    month_start,
    one_of,
    pct,
    per,
    safe_int,
    safe_long,
    safe_number,
    seconds_between,
    sum_where,
    utc_wall,
    week_start,
    weekday0,
)
