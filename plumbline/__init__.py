"""plumbline — Spark-native entity scoring and location search.

Every operator is a plain function ``op(df, ...) -> DataFrame`` built from
``pyspark.sql`` built-ins, so Catalyst plans it and whole-stage codegen runs
it.  Models (scaler moments, tree nodes, TF-IDF vocabularies) are DataFrames
too.  See README.md for the operator map.
"""

from plumbline.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
