"""Severity levels of monitored metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEVERITY_NAMES = {0: "OK", 1: "WARN", 2: "CRIT"}


def classify(metric: Column, warn: float, crit: float, inclusive: bool = False, low_is_bad: bool = False) -> Column:
    """0, 1 or 2 for OK, WARN or CRIT; the critical limit is tested first."""
    if low_is_bad:
        beyond = (lambda limit: metric <= limit) if inclusive else (lambda limit: metric < limit)
    else:
        beyond = (lambda limit: metric >= limit) if inclusive else (lambda limit: metric > limit)
    return F.when(beyond(crit), 2).when(beyond(warn), 1).otherwise(0)


def classify_band(metric: Column, maximum: Column | float) -> Column:
    """Both ends alarm: below 5 % or above 90 % of the maximum is CRIT, below 10 % or above 80 % is WARN."""
    limit = maximum if isinstance(maximum, Column) else F.lit(maximum)
    return (
        F.when((metric < limit * 0.05) | (metric > limit * 0.9), 2)
        .when((metric < limit * 0.1) | (metric > limit * 0.8), 1)
        .otherwise(0)
    )


def classify_memory(swap_used: Column, swap_total: Column, free: Column) -> Column:
    """Swap against free memory, looked at only when at least 66 % of the swap is in use."""
    pressed = swap_used * 100 >= swap_total * 66
    return (
        F.when(pressed & (swap_used >= free), 2)
        .when(pressed & (swap_used * 100 >= free * 66), 1)
        .otherwise(0)
    )


def severity_name(level: Column) -> Column:
    return F.when(level == 2, "CRIT").when(level == 1, "WARN").otherwise("OK")
