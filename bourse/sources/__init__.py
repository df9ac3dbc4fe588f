"""Scans of landed files and tables (SRC-*)."""

from bourse.sources.files import (PANDAS_NA_TOKENS, file_order, na_to_null, scan_csv,
                                  scan_csv_positional, scan_history,
                                  scan_json_files, scan_json_records,
                                  scan_symbol_files, scan_table, split_rejects,
                                  tag_json_records)

__all__ = ["PANDAS_NA_TOKENS", "file_order", "na_to_null", "scan_csv", "scan_csv_positional",
           "scan_history", "scan_json_files", "scan_json_records",
           "scan_symbol_files", "scan_table", "split_rejects", "tag_json_records"]
