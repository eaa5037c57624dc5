"""tabwright — Spark-native operators for tabular prediction analytics.

Operators take and return DataFrames, carry explicit keys instead of row
positions, and run their core work on Spark SQL expressions, windows,
shuffles and MLlib.  Sub-packages:

* ``sources``   — table readers and writers (CSV/TSV/text/parquet blocks)
* ``functions`` — column-expression helpers (binning, codes, cleaning, text)
* ``operators`` — relational and ML operators (ranks, panels, matching,
  blending, metrics, folds, encoders, text features, model jobs)
* ``plans``     — the registered queries over the driver tables, each with
  its DuckDB oracle statement
"""

__version__ = "0.1.0"
