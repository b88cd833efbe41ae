"""haulwise — route-profitability analytics on Spark.

Layers: ``sources`` (contract, feed, table maintenance), ``functions``
(column helpers, exact quantile), ``operators`` (quality, Silver, Gold,
analysis), ``plans`` (query catalog, layer builds, SQL twins),
``streaming`` (incremental ingest).
"""
