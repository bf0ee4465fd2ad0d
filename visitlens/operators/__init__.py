"""Relational steps of the two marts, each a DataFrame -> DataFrame function."""
