"""churnlens: subscriber segmentation and churn analytics on Spark DataFrames.

Every operator takes and returns Spark DataFrames (or Columns) and keeps the
heavy work on the executors.  Fit-like operators return a small frozen object
(levels, names, fitted model) whose ``transform`` is a plain projection.

Layout
------
``functions``  scalar Column expressions (coercion, binning, rounding, bands)
``sources``    scans and sinks (subscriber CSV/parquet, segmented table,
               report tables, model store, the fixture view over the
               driver's tables)
``operators``  profiling, rates, statistics, encoding, split, metrics,
               segmentation, models, explanations, impact, report
``plans``      the registered queries and their DuckDB twins, end-to-end flows
``streaming``  scoring a stream with a fitted model
"""

__version__ = "0.1.0"
