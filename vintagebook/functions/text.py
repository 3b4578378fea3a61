"""String normalisation and casts that never fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def normalize_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(col))


def safe_cast(c: str | Column, dtype: str | DataType, trim: bool = True) -> Column:
    """``try_cast`` (NULL on bad input) after trimming blanks."""
    col = F.col(c) if isinstance(c, str) else c
    if trim:
        col = F.trim(col.cast("string"))
    return col.try_cast(dtype)
