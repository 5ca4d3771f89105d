"""Run parameters.

Column names, the week anchor, the cut-off and the horizon travel together in
one frozen dataclass so that every operator reads the same values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Fixed values that must equal the reference for equal results.
# Weekday numbers for the week anchor (ISO: Monday = 1).
WEEKDAYS = {"MON": 1, "TUE": 2, "WED": 3, "THU": 4, "FRI": 5, "SAT": 6, "SUN": 7}
# Lags and windows of the weekly feature set.
FEATURE_LAGS = (1, 2, 3, 4, 8, 12, 26)
ACTIVE_SHARE_WINDOWS = (8, 13, 26)
PROMO_THRESHOLD = 0.05
RATIO_EPS = 1e-6
WMAPE_EPS = 1e-9
SMART_BLEND = 0.7
SMART_INACTIVITY_WINDOW = 12
# Model feature list (35 names, order as in the reference).
MODEL_FEATURES = (
    "lag_qty_1", "lag_qty_2", "lag_qty_3", "lag_qty_4", "lag_qty_8", "lag_qty_12", "lag_qty_26",
    "ma_qty_4", "ma_qty_12",
    "std_qty_4", "std_qty_12",
    "diff_qty_1", "ratio_qty_12",
    "n_tx", "week", "month", "quarter", "is_year_end", "is_month_start", "is_month_end",
    "price_u_ma8",
    "freq_store", "avg_qty_store", "freq_product", "avg_qty_product",
    "weeks_since_last_sale", "weeks_since_first_sale", "zero_streak",
    "active_share_8", "active_share_13", "active_share_26",
    "discount_rate", "promo_flag", "is_holiday", "is_bf_cm_week",
)
# Same-week facts (trap R3) and the recency leak (trap R4): the causal model
# reads these replacements instead.
CAUSAL_REPLACEMENTS = {
    "n_tx": "n_tx_lag1",
    "discount_rate": "discount_rate_lag1",
    "promo_flag": "promo_flag_lag1",
    "weeks_since_last_sale": "weeks_since_prev_sale",
}


def to_date(value) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class ForecastConfig:
    """Names and dates of one forecasting run.

    ``cutoff`` splits history (< cutoff) from validation; validation ends
    before ``valid_end``; the target month is ``[target_start, target_end)``.
    Defaults are the reference's calendar: December 2022 validates, January 2023 is forecast.
    """

    store_col: str = "store_id"
    product_col: str = "product_id"
    date_col: str = "txn_date"
    week_col: str = "week_start"
    target_col: str = "qty"
    week_anchor: str = "MON"
    cutoff: dt.date = dt.date(2022, 12, 5)
    valid_end: dt.date = dt.date(2023, 1, 1)
    target_start: dt.date = dt.date(2023, 1, 1)
    target_end: dt.date = dt.date(2023, 2, 1)
    horizon: int = 5
    alpha: float = 0.5
    country: str = "US"
    event_weeks: tuple = (dt.date(2022, 11, 21), dt.date(2022, 11, 28))

    def __post_init__(self):
        # accept ISO strings for every date field
        for k in ("cutoff", "valid_end", "target_start", "target_end"):
            object.__setattr__(self, k, to_date(getattr(self, k)))
        object.__setattr__(self, "event_weeks", tuple(to_date(d) for d in self.event_weeks))
        if self.week_anchor.upper() not in WEEKDAYS:
            raise ValueError(f"unknown week anchor: {self.week_anchor}")

    @property
    def keys(self) -> list[str]:
        return [self.store_col, self.product_col]

    @property
    def anchor_day(self) -> int:
        return WEEKDAYS[self.week_anchor.upper()]

    def with_(self, **kw) -> "ForecastConfig":
        return replace(self, **kw)


DEFAULT = ForecastConfig()
