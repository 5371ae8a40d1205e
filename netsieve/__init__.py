"""netsieve: network-flow preparation, sampling, classification and evaluation on Spark.

Subpackages
-----------
sources    file discovery, CSV scans, feature cache, sinks
functions  column expressions: labels, coercion, traffic and time features
operators  positional rank, sampling, splits, fitted preprocessing, models, evaluation
plans      the dict-configured training pipeline and the query catalog
streaming  file-arrival micro-batches and incrementally merged statistics
"""

__all__ = ["session", "fixtures"]
