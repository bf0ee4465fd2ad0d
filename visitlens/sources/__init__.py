"""Input registries (catalog, parquet, test-data stand-ins)."""
from visitlens.sources.tables import CatalogTables, ParquetTables, Tables, TestdataTables

__all__ = ["Tables", "CatalogTables", "ParquetTables", "TestdataTables"]
