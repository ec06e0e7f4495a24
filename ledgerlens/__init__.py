"""ledgerlens: transaction-monitoring analytics expressed as Spark DataFrame plans.

Layout
------
sources/    table readers, the derived ``transactions`` view, raw-CSV ingest, sinks
functions/  reusable column expressions (hash buckets, exact sums, guarded ratios)
operators/  split, features, encoding, exploration, quantiles, curves, sweeps, tiers, models
plans/      the named query registry, DuckDB oracle SQL and the staged batch pipeline
streaming/  incremental scoring of new transaction files with fitted batch artifacts
"""

__version__ = "0.1.0"
