"""adsieve: ad-event validation, dedupe, fraud scoring and campaign analytics on Spark.

Every operator takes and returns DataFrames; batch and Structured Streaming
share the stateless ones. See README.md for the module map.
"""

__version__ = "0.1.0"
