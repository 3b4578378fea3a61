"""Temporal feature books: recency flags, wide windowed aggregates, window ratios.

A *book* is one row per (entity, safra) with, for every recency window
``uNm`` (the last N months, N+1 calendar months inclusive) and every value
column, the rounded mean / max / min / sample stddev / count of the value
restricted to that window.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import safra_to_date, shift_safra_value

# Window lengths in months and the aggregate prefixes of the book.
DEFAULT_WINDOWS: tuple[int, ...] = (1, 3, 6, 9, 12)
AGGREGATES: tuple[str, ...] = ("med", "max", "min", "std", "qtd")


def window_names(months: Iterable[int] = DEFAULT_WINDOWS) -> list[str]:
    return [f"u{m}m" for m in months]


def distinct_population(df: DataFrame, entity: str | Sequence[str], safra_col: str,
                        safra: int) -> DataFrame:
    """Entities active in ``safra``: SELECT DISTINCT entity, safra WHERE safra = X."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return df.filter(F.col(safra_col) == F.lit(safra)).select(*keys, safra_col).distinct()


def history_range(df: DataFrame, safra_col: str, safra: int, months: int = 12) -> DataFrame:
    """Rows whose vintage lies in [safra - months, safra] (literal bounds -> pruning)."""
    return df.filter(F.col(safra_col).between(shift_safra_value(safra, -months), safra))


def recency_flags(df: DataFrame, entity: str, safra_col: str,
                  months: Iterable[int] = DEFAULT_WINDOWS,
                  anchor: int | None = None) -> DataFrame:
    """Add ``uNm`` 0/1 flags: the row's month lies within N months of the anchor.

    ``anchor=None`` anchors on each entity's own latest month (one window
    partitioned by entity).  With an int ``anchor`` (the reference safra) the
    flags are plain comparisons and need no shuffle; this is equal to the
    per-entity form for every entity active in that safra.
    """
    d = safra_to_date(safra_col)
    if anchor is None:
        top = F.max(d).over(Window.partitionBy(entity))
        flags = [F.when(d.between(F.add_months(top, -m), top), 1).otherwise(0).alias(f"u{m}m")
                 for m in months]
    else:
        flags = [F.when(F.col(safra_col).between(shift_safra_value(anchor, -m), anchor), 1)
                 .otherwise(0).alias(f"u{m}m") for m in months]
    return df.select("*", *flags)


def _agg(kind: str, v: Column) -> Column:
    if kind == "med":
        return F.round(F.avg(v), 2).cast("double")
    if kind == "max":
        return F.round(F.max(v), 2).cast("double")
    if kind == "min":
        return F.round(F.min(v), 2).cast("double")
    if kind == "std":
        return F.round(F.stddev_samp(v), 2).cast("double")
    if kind == "qtd":
        return F.count(v).cast("bigint")
    raise ValueError(kind)


def feature_book_exprs(flags: Sequence[str], values: Sequence[str], suffix: str = "",
                       aggregates: Sequence[str] = AGGREGATES,
                       indicators: Mapping[str, tuple[str, Sequence[str]]] | None = None
                       ) -> list[Column]:
    """Aggregate expressions ``vl_{agg}_{flag}_{value}{suffix}``.

    ``indicators`` maps an indicator column to (alias, accepted values); each
    (indicator, value) adds the same aggregates restricted to rows where the
    indicator equals that value, named ``vl_{agg}_{flag}_{alias}_{val}_{value}{suffix}``.
    """
    out: list[Column] = []
    for flag in flags:
        for value in values:
            masked = F.when(F.col(flag) == 1, F.col(value))
            for kind in aggregates:
                out.append(_agg(kind, masked).alias(f"vl_{kind}_{flag}_{value}{suffix}"))
    for ind, (alias, accepted) in (indicators or {}).items():
        for acc in accepted:
            for flag in flags:
                for value in values:
                    masked = F.when((F.col(flag) == 1) & (F.col(ind) == F.lit(acc)), F.col(value))
                    for kind in aggregates:
                        out.append(_agg(kind, masked)
                                   .alias(f"vl_{kind}_{flag}_{alias}_{acc}_{value}{suffix}"))
    return out


def feature_book(df: DataFrame, keys: Sequence[str], flags: Sequence[str],
                 values: Sequence[str], suffix: str = "",
                 aggregates: Sequence[str] = AGGREGATES,
                 indicators: Mapping[str, tuple[str, Sequence[str]]] | None = None,
                 extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One ``groupBy(keys).agg(...)`` with every windowed aggregate.

    Partial aggregation happens map-side, so a hot entity sends one buffer
    per input partition through the shuffle, never its raw rows.
    """
    exprs = feature_book_exprs(flags, values, suffix, aggregates, indicators)
    return df.groupBy(*keys).agg(*exprs, *extra_aggs)


def temporal_ratios(df: DataFrame, base_prefix: str = "vl_med", ratio_prefix: str = "raz_med",
                    windows: Sequence[str] = tuple(window_names()), suffix: str = "") -> DataFrame:
    """Keep every column and add ``num/den`` for consecutive windows (NULL when den = 0)."""
    cols = set(df.columns)
    ratios = []
    for num_w, den_w in zip(windows[:-1], windows[1:]):
        head = f"{base_prefix}_{num_w}_"
        for c in df.columns:
            if not c.startswith(head):
                continue
            den = f"{base_prefix}_{den_w}_" + c[len(head):]
            if den not in cols:
                continue
            feature = c[len(head):]
            if suffix and feature.endswith(suffix):
                feature = feature[: -len(suffix)]
            # SQL text: one parse per ratio instead of a py4j call per Column node
            ratios.append(f"CASE WHEN `{den}` != 0 THEN `{c}` / `{den}` END"
                          f" AS `{ratio_prefix}_{num_w}_{den_w}_{feature}{suffix}`")
    return df.selectExpr(*[f"`{c}`" for c in df.columns], *ratios)


def book_for_safra(fact: DataFrame, entity: str, safra_col: str, safra: int,
                   values: Sequence[str], suffix: str, group_extra: Sequence[str] = (),
                   months: Sequence[int] = DEFAULT_WINDOWS, ratios: bool = True) -> DataFrame:
    """Book of every entity active in ``safra`` over its 12 preceding months.

    Equal to the literal plan (population = entities active in ``safra``,
    flags anchored on the entity's latest month, one wide GROUP BY,
    population LEFT JOIN) but computed in two levels: see
    :mod:`vintagebook.operators.book_partials`.
    """
    from .book_partials import book_two_level
    return book_two_level(fact, entity, safra_col, [safra], values, suffix, group_extra,
                          months, ratios)


def book_backfill(fact: DataFrame, entity: str, safra_col: str, safras: Sequence[int],
                  values: Sequence[str], suffix: str, group_extra: Sequence[str] = (),
                  months: Sequence[int] = DEFAULT_WINDOWS, ratios: bool = True) -> DataFrame:
    """Books for several reference safras in ONE job: the raw rows are
    aggregated once per (entity, month); only those monthly partials are
    paired with the reference safras."""
    from .book_partials import book_two_level
    return book_two_level(fact, entity, safra_col, safras, values, suffix, group_extra,
                          months, ratios)
