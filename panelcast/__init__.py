"""panelcast: panel time-series features and forecasting on PySpark.

Lazy ``DataFrame -> DataFrame`` operators keyed by optional entity columns:
``functions`` (Column expressions), ``operators`` (alignment, features,
stats, quality, monitoring), ``sources`` (files, JSON/HTML, upserts),
``models`` (per-entity linear models, MLlib trees, forecasts, explanations),
``streaming`` (Structured Streaming paths) and ``plans`` (registered queries
over the test tables).
"""

__version__ = "0.1.0"
