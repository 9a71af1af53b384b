"""Training-data operators. Nothing else in the library imports this subpackage;
its registered queries are collected in :mod:`tessera.llm.catalog`."""
