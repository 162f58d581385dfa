"""Registered queries over the driver's test tables, with DuckDB oracles.

The test tables are not registry files, so each query first derives
raw-looking all-string columns from a whole test table (a *stand-in*), then
runs the library operator on it.  Stand-ins are written once as expressions
both engines accept, so the oracle SQL sees exactly the same input.
"""
