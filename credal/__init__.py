"""credal — a Spark-first feature-engineering, profiling, evaluation and
monitoring library for tabular risk-scoring data.

Every public operator is a ``DataFrame -> DataFrame`` transformation (or a
``fit(df) -> Params`` / ``transform(df, params) -> DataFrame`` pair) built
from Catalyst expressions, so filters and projections reach the parquet scan
and aggregations run as partial + final hash aggregates.

Layout:
  functions/   scalar Column builders (cleaning, recoding, ratios, metrics)
  operators/   aggregations, joins, preprocessing, profiling, evaluation,
               training, monitoring
  sources/     CSV / JSON Lines / parquet sources and sinks, params store
  plans/       composed view stacks and the demo queries on the driver tables
  streaming/   Structured Streaming versions of the monitoring jobs
"""

__version__ = "0.1.0"
