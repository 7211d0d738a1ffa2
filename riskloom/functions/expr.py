"""Row-local expressions shared by the operators.

All helpers build JVM-side expressions (``F.when`` chains, literal maps,
arithmetic), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order (pandas ``select_dtypes(np.number)``)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """String columns in schema order (pandas ``object`` columns)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def yes_no(col: str | Column, yes: str = "Yes", no: str = "No") -> Column:
    """``yes`` -> 1, ``no`` -> 0, anything else (incl. null) -> null."""
    c = _c(col)
    return F.when(c == yes, F.lit(1)).when(c == no, F.lit(0))


def value_map(col: str | Column, mapping: Mapping[str, float],
              unknown: float | None = 0.0) -> Column:
    """Map string levels through a literal map.

    Null stays null; a string missing from the map becomes ``unknown``.
    """
    c = _c(col)
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v)))
                                               for k, v in mapping.items()))
    mapped = lookup[c]
    if unknown is not None:
        mapped = F.coalesce(mapped, F.lit(float(unknown)))
    return F.when(c.isNotNull(), mapped)


def cut(col: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None,
        right: bool = False) -> Column:
    """Bin a numeric column like ``pandas.cut``.

    ``right=False``: bins ``[lo, hi)``; ``right=True``: ``(lo, hi]``.  Values
    outside every bin (including the outer edges on the open side) and nulls
    give null.  Without labels the 0-based bin index is returned.
    """
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = _c(col)
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (c > lo) & (c <= hi) if right else (c >= lo) & (c < hi)
        val = F.lit(labels[i]) if labels is not None else F.lit(i)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def null_skipping_sum(cols: Iterable[str | Column]) -> Column:
    """Row sum that treats null as 0 (pandas ``sum(axis=1)``)."""
    cols = [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols]
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def null_propagating_sum(cols: Iterable[str | Column]) -> Column:
    """Row sum with ``+``: any null makes the result null."""
    cols = [_c(c) for c in cols]
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out
