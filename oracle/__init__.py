"""Independent DuckDB oracle for the registered queries.

Spark code. It follows the original jobs' formulation (window ``row_number``,
fan-out joins, full outer joins, two-level aggregates) where the Spark plans
use cheaper equivalents, so a parity match also checks those rewrites.
"""
