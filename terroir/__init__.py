"""Housing-market analytics on Spark: staging, star schema, measures and report queries."""

from terroir.params import Params

__all__ = ["Params"]
