"""barloom — bar analytics on Spark.

OHLCV bars, technical indicators, candle patterns, labels, feature plans,
learning and position/PnL tables, all expressed as Spark DataFrame plans.

Layout
------
sources/    table scans, bar fixtures, resampling, sinks
plans/      the bar frame (sequencing, blocks, halo, block scans) and feature plans
functions/  indicator and pattern builders that return Spark Columns
operators/  table operators: clean-up, joins, aggregates, labels, signals, PnL,
            grouped-map (non-linear) indicators, tabular preprocessing, learning
streaming/  Structured Streaming twins of the batch builders
"""

from barloom.session import get_spark, checkpoint_dir, reliable_checkpoint  # noqa: F401

__version__ = "0.1.0"
