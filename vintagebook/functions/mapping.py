"""Value recoding: CASE maps and the state -> region map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brazilian state codes per macro-region (region -> states).
BRAZIL_STATE_REGIONS: dict[str, tuple[str, ...]] = {
    "SUDESTE": ("SP", "RJ", "MG", "ES"),
    "SUL": ("RS", "SC", "PR"),
    "CENTRO_OESTE": ("GO", "MT", "MS", "DF"),
    "NORDESTE": ("BA", "PE", "CE", "PB", "RN", "AL", "SE", "PI", "MA"),
    "NORTE": ("AM", "PA", "AC", "RO", "RR", "AP", "TO"),
}


def case_map(c: str | Column, groups: Mapping[object, Sequence[object]], default=None) -> Column:
    """CASE WHEN c IN (...) THEN key ... ELSE default END, first group wins."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for key, members in groups.items():
        cond = col.isin(list(members))
        out = F.when(cond, F.lit(key)) if out is None else out.when(cond, F.lit(key))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def state_to_region(c: str | Column,
                    groups: Mapping[str, Sequence[str]] = BRAZIL_STATE_REGIONS) -> Column:
    return case_map(c, groups)
