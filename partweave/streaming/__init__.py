from .landing import land_stream, part_row_counts, read_part_stream

__all__ = ["land_stream", "part_row_counts", "read_part_stream"]
