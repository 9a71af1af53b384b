"""All registered queries: ``QUERIES[name](spark, root) -> DataFrame`` and the
matching DuckDB SQL in ``ORACLE[name]`` (absent where SQL cannot express it)."""

from __future__ import annotations

from tessera.plans import articles, documents, energy, files, graph, models, movies, stations

QUERIES = {}
ORACLE = {}
for _module in (movies, documents, files, graph, energy, stations, models, articles):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)

FLAGSHIP = "top_k_per_year"
