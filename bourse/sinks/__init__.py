"""Writes (SNK-*)."""

from bourse.sinks.tables import (append_rows, bucket_of, market_groups,
                                 partition_view, publish, read_table,
                                 read_rejects, refresh_split, refresh_table,
                                 register_view, rejected, replace_result, route, write_csv,
                                 write_market_partitioned, write_partitioned, write_per_value_files)

__all__ = ["append_rows", "bucket_of", "market_groups", "partition_view",
           "publish", "read_rejects", "read_table", "refresh_split", "refresh_table",
           "register_view", "rejected", "replace_result", "route", "write_csv", "write_market_partitioned",
           "write_partitioned", "write_per_value_files"]
