from .csv import csv_view, read_csv, read_csv_parts, write_csv
from .parts import PART_FILE_PATTERN, check_part_schemas, land, part_footers, part_from_file_name, read_parts, write_parts

__all__ = [
    "PART_FILE_PATTERN",
    "check_part_schemas",
    "csv_view",
    "land",
    "part_footers",
    "part_from_file_name",
    "read_csv",
    "read_csv_parts",
    "read_parts",
    "write_csv",
    "write_parts",
]
