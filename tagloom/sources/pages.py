"""Pages by key: the next rows after the last one that was seen, without sorting away those before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of the pages: (column, whether it falls).
Order = Sequence[tuple[str, bool]]


def beyond(order: Order, last: Mapping) -> Column:
    """Rows after the last one of a page in the order, as an OR of comparisons that a scan can use."""
    out = None
    for i in reversed(range(len(order))):
        name, falling = order[i]
        step = F.col(name) < F.lit(last[name]) if falling else F.col(name) > F.lit(last[name])
        out = step if out is None else step | ((F.col(name) == F.lit(last[name])) & out)
    return out


def page(df: DataFrame, order: Order, size: int, last: Mapping | None = None) -> DataFrame:
    """The first ``size`` rows in the order, or those after ``last``, the order's columns of the last row seen.

    The columns tell rows apart and are never null. A page costs a scan of what lies beyond the cursor and its best rows;
    nothing before it is sorted, so the last page is as cheap as the first.
    """
    rows = df if last is None else df.filter(beyond(order, last))
    return rows.orderBy(*[F.col(c).desc() if falling else F.col(c) for c, falling in order]).limit(size)


def cursor(rows: Sequence, order: Order) -> dict | None:
    """The cursor after a page that was collected; None after an empty one."""
    return {c: rows[-1][c] for c, _ in order} if rows else None
