"""cadenza — Spark-native operators for labelled feature tables.

Every operator is a function ``DataFrame -> DataFrame`` whose columns are
arguments, so the same code runs on a 6k-row CSV snapshot and on a
multi-terabyte Parquet lake.  Sub-packages:

* ``functions``  column expressions (strip, tokens, hashing, scaling)
* ``sources``    scans with explicit schemas, JSON payload flattening, sinks
* ``operators``  label joins, cleaning, sampling, profiling, metrics, ML
* ``plans``      end-to-end experiments and the driver-table queries
* ``streaming``  incremental landing of payload files (Structured Streaming)
"""

from cadenza.session import get_spark, ensure_checkpoint_dir, materialize

__all__ = ["get_spark", "ensure_checkpoint_dir", "materialize"]
