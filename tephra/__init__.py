"""tephra: hazard-event analytics (fires and earthquakes) on Spark.

Batch and streaming ingest of raw feed payloads, staging relations,
marts, dashboard relations, exports, retention and data-quality checks,
all as ``DataFrame -> DataFrame`` functions over the Spark SQL engine.
"""

__version__ = "0.1.0"
