"""Arbitration of redundant event feeds on Spark.

Several publishers each deliver their own copy of the same events.  The package
keeps the first copy of every event, credits the publisher that delivered it,
ranks publishers over measurement windows and plans the removal of the slowest.
"""

from feedarb.params import ArbitrationParams, RemovalParams

__all__ = ["ArbitrationParams", "RemovalParams"]
