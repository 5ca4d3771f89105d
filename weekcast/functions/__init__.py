"""Column expressions: all built-in Spark functions, no Python UDFs."""

from weekcast.functions.dates import week_start, calendar_columns, add_calendar_features
from weekcast.functions.scalars import (
    returns_split, discount_promo, recency_weight, export_quantity, export_id,
    wmape_columns,
)

__all__ = [
    "week_start", "calendar_columns", "add_calendar_features", "returns_split",
    "discount_promo", "recency_weight", "export_quantity", "export_id",
    "wmape_columns",
]
