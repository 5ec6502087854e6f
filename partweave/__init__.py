"""partweave: multi-part claims data integration and descriptive analytics on
Spark.

Numbered extracts ("parts") whose IDs overlap are landed, given dense IDs
unique over all parts, foreign keys rewritten inside each part, and bound into
one table each - all as DataFrame plans that partition and shuffle the work.
"""

from .operators.bind import bind, union_parts, write_table
from .operators.broadcast import checked_broadcast
from .operators.columns import cast_ids_by_suffix, rename_orig
from .operators.compact import compact_key_map, key_filter
from .operators.describe import describe_columns, profile_column, row_count
from .operators.ids import (
    DuplicateOwnerKeys,
    assign_ids,
    assign_ids_many,
    check_ids,
    fan_out,
    key_map,
    part_counts,
    part_offsets,
    rebase_ids,
)
from .operators.keys import orphans, rewrite_fk
from .operators.numbering import DuplicateKeys, number_rows
from .operators.parts import missing_parts, part_inventory
from .operators.profiles import from_sketches, profile_table, sketch_columns
from .operators.rollups import code_year_rollup, coverage_count
from .operators.tables import create_table_as, drop_table, expire_versions
from .plans.convert import integrate, land_tables
from .plans.pipeline import Pipeline, run
from .registry import CLAIMS, ForeignKey, Registry
from .session import build_session, stage, stage_alone
from .sources.manifest import land_new_parts, losses, read_landed, read_manifest
from .streaming.ledger import Ledger, rebase_new_parts, rebase_stream

__all__ = [
    "CLAIMS",
    "DuplicateKeys",
    "DuplicateOwnerKeys",
    "ForeignKey",
    "Ledger",
    "Pipeline",
    "Registry",
    "assign_ids",
    "assign_ids_many",
    "bind",
    "build_session",
    "cast_ids_by_suffix",
    "check_ids",
    "checked_broadcast",
    "code_year_rollup",
    "compact_key_map",
    "coverage_count",
    "create_table_as",
    "describe_columns",
    "drop_table",
    "expire_versions",
    "fan_out",
    "from_sketches",
    "integrate",
    "key_filter",
    "key_map",
    "land_new_parts",
    "land_tables",
    "losses",
    "missing_parts",
    "number_rows",
    "orphans",
    "part_counts",
    "part_inventory",
    "part_offsets",
    "profile_column",
    "profile_table",
    "read_landed",
    "read_manifest",
    "rebase_ids",
    "rebase_new_parts",
    "rebase_stream",
    "rename_orig",
    "rewrite_fk",
    "row_count",
    "run",
    "sketch_columns",
    "stage",
    "stage_alone",
    "union_parts",
    "write_table",
]
