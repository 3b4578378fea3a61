"""Content hash used to gate upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

HASH_SEPARATOR = "||"


def _as_text(c: Column, dtype=None) -> Column:
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")


def row_hash(cols: Sequence[str | Column], df: DataFrame | None = None) -> Column:
    """sha256 hex of the ``||``-joined text of ``cols`` (NULL -> '').

    Dates and timestamps are rendered as yyyy-MM-dd.  Pass ``df`` so column
    types are known; every part is explicitly cast to string (ANSI-safe).
    """
    types = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
    parts = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        dtype = types.get(c) if isinstance(c, str) else None
        parts.append(F.coalesce(_as_text(col, dtype), F.lit("")))
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
