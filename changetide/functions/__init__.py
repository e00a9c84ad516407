"""Column expressions shared by the operators."""

from .changes import arrival_order, is_delete, is_upsert, reject_reason, state_order
from .report import share_of_total, weekday_label

__all__ = ["arrival_order", "is_delete", "is_upsert", "reject_reason", "share_of_total",
           "state_order", "weekday_label"]
