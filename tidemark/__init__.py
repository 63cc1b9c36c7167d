"""Statement-log analytics on Spark: DataFrame in, DataFrame out."""

from tidemark.session import checkpointed, get_spark, shared_dir, tune

__all__ = ["checkpointed", "get_spark", "shared_dir", "tune"]
