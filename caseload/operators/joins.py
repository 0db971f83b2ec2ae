"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a written table of cells (months times a dimension's groups) that is broadcast, 100 bytes a row or less.
CELL_ROWS = 200_000


def join_cells(left: DataFrame, cells: DataFrame, keys, how: str = "left") -> DataFrame:
    """``null_safe_join`` with a written table of cells, which is broadcast if its rows, counted here, are no more than ``CELL_ROWS``:
    a session's size threshold may lie below what a few thousand cells take, and then the panel would be shuffled by cell."""
    return null_safe_join(left, cells, keys, how, broadcast_right=cells.count() <= CELL_ROWS)


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left", broadcast_right: bool = False) -> DataFrame:
    """Equi-join where a NULL key matches a NULL key (a NULL peer group is its own group).

    ``broadcast_right`` only for right sides with a proven bound (e.g. month x peer-cell
    aggregates: months times a dimension's cardinality, independent of rows per cell)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    if broadcast_right:
        r = F.broadcast(r)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
