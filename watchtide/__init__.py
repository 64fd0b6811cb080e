"""watchtide — Spark-native media-telemetry medallion operators.

Pure operators (``watchtide.operators``) take and return DataFrames and never
touch paths or session configuration; loaders (``watchtide.plans.jobs``,
``watchtide.sources``, ``watchtide.streaming``) do the I/O.
"""

__version__ = "0.1.0"
