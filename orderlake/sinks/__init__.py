"""Writers for the clean table, the rollups and the partitioned datasets."""

from .writers import (object_key, read_file_objects, write_clean_csv, write_file_objects, write_orders_parquet,
                      write_rollup_csv, write_rollup_parquet)

__all__ = ["object_key", "read_file_objects", "write_clean_csv", "write_file_objects", "write_orders_parquet",
           "write_rollup_csv", "write_rollup_parquet"]
