"""ebbflow: churn analytics expressed as Spark DataFrame / SQL / ML / Structured Streaming jobs.

Sub-packages
------------
sources    table readers, the mapped fixture tables, sinks
functions  column-expression helpers (coercion, rounding, value maps, bands)
operators  joins, fit/transform feature steps, statistics, exploration,
           data quality, split/folds, evaluation, models, scoring, KNN
plans      compositions of operators into the feature table, predictions and reports
streaming  Structured Streaming scoring
"""

__version__ = "0.1.0"
