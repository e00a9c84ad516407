"""Column expressions of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels for 0 (Sunday) to 6.
WEEKDAYS = ["CN", "T2", "T3", "T4", "T5", "T6", "T7"]


def weekday_label(day: Column) -> Column:
    """Label of a weekday number; NULL outside 0-6."""
    label = F.when(day == 0, WEEKDAYS[0])
    for number, name in enumerate(WEEKDAYS[1:], start=1):
        label = label.when(day == number, name)
    return label


def share_of_total(count: str) -> Column:
    """Percent of the column's total, one decimal, in decimal arithmetic.

    The frame has one partition, so use it on aggregated rows only.
    """
    return F.expr(f"round({count} * 100.0 / sum({count}) OVER (), 1)")
