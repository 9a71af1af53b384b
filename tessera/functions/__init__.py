"""Column-expression helpers (calendar labels, degree days, wind chill, haversine,
Python-compatible text functions) and the scalar Student-t quantile."""
