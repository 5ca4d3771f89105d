"""weekcast — weekly store x product demand forecasting on Spark.

Layout:
  sources/    readers, schema normalisation, test fixtures, sinks
  functions/  column expressions (week bucket, calendar, returns, promo, export)
  operators/  table operators (weekly aggregate, panel, features, quality,
              baselines, evaluation, forecast, learned model)
  plans/      user-facing entry points and the query registry
"""

from weekcast.config import ForecastConfig

__all__ = ["ForecastConfig"]
