"""Row-level expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weekcast.config import PROMO_THRESHOLD, WMAPE_EPS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def returns_split(quantity, null_as_zero: bool = True) -> dict[str, Column]:
    """Positive units and returned units of a signed quantity.

    With ``null_as_zero`` a missing quantity counts as 0 (the weekly prepare);
    without it the null survives (the register-based script).
    """
    q = _col(quantity)
    if null_as_zero:
        q = F.coalesce(q, F.lit(0.0))
    return {
        "quantity_return": F.abs(F.least(q, F.lit(0.0))),
        "quantity_pos": F.greatest(q, F.lit(0.0)),
    }


def discount_promo(discount="discount", gross="gross_value") -> dict[str, Column]:
    """discount/gross clipped to [0, 1] (0 when gross <= 0) and the promo flag."""
    g, d = _col(gross), _col(discount)
    rate = F.when(g > 0, F.least(F.greatest(d / g, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    return {"discount_rate": rate, "promo_flag": (rate >= PROMO_THRESHOLD).cast("int")}


def recency_weight(week, cutoff, decay_weeks: float) -> Column:
    """exp(-weeks_before_cutoff / decay) clipped to [1e-3, 1]."""
    weeks = F.greatest(F.datediff(F.lit(cutoff), _col(week)) / F.lit(7.0), F.lit(0.0))
    return F.least(F.greatest(F.exp(-weeks / F.lit(float(decay_weeks))), F.lit(1e-3)), F.lit(1.0))


def export_quantity(pred) -> Column:
    """Non-negative integer units, half-to-even like numpy ``rint``."""
    return F.rint(F.greatest(F.coalesce(_col(pred), F.lit(0.0)), F.lit(0.0))).cast("long")


def export_id(c) -> Column:
    """Integer id for delivery files; missing ids become 0."""
    return F.coalesce(F.expr(f"try_cast({c} AS BIGINT)") if isinstance(c, str) else c.cast("long"),
                      F.lit(0).cast("long"))


def wmape_columns(y="y_true", yhat="y_pred", eps: float = WMAPE_EPS) -> dict[str, Column]:
    """Aggregate expressions: WMAPE over all rows and over rows with y > 0 (A4, A5).

    The positive-only score is null when no row has y > 0.
    """
    y, p = _col(y), _col(yhat)
    err = F.abs(y - p)
    num_all = F.sum(err)
    den_all = F.sum(F.abs(y))
    pos = y > 0
    num_pos = F.sum(F.when(pos, err))
    den_pos = F.sum(F.when(pos, F.abs(y)))
    return {
        "wmape_all": F.coalesce(num_all, F.lit(0.0)) / F.greatest(F.coalesce(den_all, F.lit(0.0)), F.lit(eps)),
        "wmape_pos": F.when(F.count_if(pos) > 0,
                            num_pos / F.greatest(den_pos, F.lit(eps))),
        "rows": F.count(F.lit(1)),
        "positive_rows": F.count_if(pos),
    }
