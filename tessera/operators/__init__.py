"""Analytic operators: quality, relational, documents, graph, timeseries, stations,
models, articles."""
