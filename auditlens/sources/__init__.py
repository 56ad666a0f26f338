from .tables import (Tables, load_catalog_tables, load_parquet_tables, load_test_tables,
                     read_table)

__all__ = ["Tables", "load_catalog_tables", "load_parquet_tables", "load_test_tables", "read_table"]
