from .scalars import thousands, to_bigint, year_of
from .types import SQL_TYPE_NAMES, sql_type_name

__all__ = ["SQL_TYPE_NAMES", "sql_type_name", "thousands", "to_bigint", "year_of"]
