"""Type names as a SQL engine reports them in DESCRIBE output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark simple type name -> DuckDB DESCRIBE type name.
SQL_TYPE_NAMES = {
    "boolean": "BOOLEAN",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "binary": "BLOB",
    "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}


def sql_type_name(spark_type: Column) -> Column:
    """Map a column of Spark type names to SQL names; ``decimal(p,s)`` becomes
    ``DECIMAL(p,s)``, anything else is upper-cased."""
    m = F.create_map(*[F.lit(x) for kv in SQL_TYPE_NAMES.items() for x in kv])
    return F.coalesce(m[spark_type], F.upper(spark_type))
