"""Column functions: every function maps Columns to a Column (no UDFs)."""
