"""tessera: DataFrame operators for star-schema, document, graph and
degree-day time-series analytics, written for Spark's planner.

Sub-packages
------------
sources    readers for regex-delimited text, edge lists, meter readings,
           station tables and HTML result pages
sinks      CSV / text / parquet writers
functions  Column-expression helpers (no Python UDFs)
operators  the analytic operators (quality, relational, documents, graph,
           time series, station panels, models, articles)
plans      the registered queries over the shared test tables
streaming  Structured Streaming form of the hourly/daily resample
"""

__all__ = ["session"]
