"""Dates and vintages (``safra`` = INT yyyyMM)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted input patterns, tried in this order (first match wins).
DATE_FORMATS: tuple[str, ...] = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_FIELD_RE = {"yyyy": "[+-]?[0-9]{4,10}", "MM": "[0-9]{1,2}", "dd": "[0-9]{1,2}",
             "HH": "[0-9]{1,2}", "mm": "[0-9]{1,2}", "ss": "[0-9]{1,2}"}


def shape_regex(fmt: str) -> str:
    """A regex every string that ``fmt`` can parse must match (digits per
    field, literal separators).  Used to skip parse attempts that cannot
    succeed: a failed parse costs a caught exception per row."""
    out, i = "^", 0
    while i < len(fmt):
        for tok, rx in _FIELD_RE.items():
            if fmt.startswith(tok, i):
                out += rx
                i += len(tok)
                break
        else:
            ch = fmt[i]
            out += "\\" + ch if ch in "\\.^$|?*+()[]{}/-" else ch
            i += 1
    return out + "$"


def parse_timestamp_multi(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First successful parse among ``formats``; NULL when none matches.

    Each pattern is only tried on strings of its shape, so a value costs one
    parse instead of one failed parse (a thrown exception) per earlier
    pattern; the result is the same as trying every pattern in order."""
    col = _c(c)
    return F.coalesce(*[F.when(col.rlike(shape_regex(f)), F.try_to_timestamp(col, F.lit(f)))
                        for f in formats])


def parse_date_multi(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return F.to_date(parse_timestamp_multi(c, formats))


def safra_of(ts: str | Column) -> Column:
    """Vintage month of a date/timestamp as INT yyyyMM (computed from the parsed value)."""
    t = _c(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def safra_to_date(safra: str | Column) -> Column:
    """First day of the vintage month as DATE."""
    s = _c(safra)
    return F.make_date((s / 100).cast("int"), s % 100, F.lit(1))


def month_index(safra: str | Column) -> Column:
    """year*12 + month: consecutive months differ by one."""
    s = _c(safra).cast("int")
    return F.floor(s / 100).cast("int") * 12 + s % 100


def safra_shift(safra: str | Column, months: int | Column) -> Column:
    """Vintage ``months`` later (negative = earlier); pure integer arithmetic."""
    idx = month_index(safra) - 1 + (months if isinstance(months, Column) else F.lit(int(months)))
    return (F.floor(idx / 12) * 100 + (idx % 12) + 1).cast("int")


def shift_safra_value(safra: int, months: int) -> int:
    """Driver-side twin of :func:`safra_shift` for literal parameters."""
    idx = (safra // 100) * 12 + safra % 100 - 1 + months
    return (idx // 12) * 100 + idx % 12 + 1
