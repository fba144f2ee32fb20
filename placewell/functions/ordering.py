"""Sort orders in which NULL counts as the largest value.

Spark's own default is the opposite, so every ranking in this package goes
through these helpers: descending puts NULL first, ascending puts it last.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots."""
    return "`" + name.replace("`", "``") + "`"


def tie_columns(df: DataFrame, used: Iterable[str] = ()) -> list[str]:
    """Every further column that can be compared, in schema order.

    Ranking by these last makes the kept row a function of the data alone. A task
    that is run again after a lost executor then keeps the same row.
    """
    skip = {u.lower() for u in used}
    return [
        quoted(f.name) for f in df.schema.fields
        if f.name.lower() not in skip and is_orderable(f.dataType)
    ]
