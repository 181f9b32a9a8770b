from quayside.sources.tables import TableSource, parquet_tables, catalog_tables, scan_alias

__all__ = ["TableSource", "parquet_tables", "catalog_tables", "scan_alias"]
