"""Incremental (Structured Streaming) runs of existing pipelines."""
