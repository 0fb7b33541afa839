"""Compute columns once, whatever is filtered on them later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, drop: tuple[str, ...] = (), **columns: str) -> DataFrame:
    """Add SQL expressions as columns that Catalyst will not copy; ``drop`` others.

    Catalyst moves filters below a projection by substituting the projected
    expressions into them, and derives constraints from every alias. For JSON
    parsing or a 364-term score that means computing them over again per
    reference, and planning for minutes. A one-element ``inline`` yields the same
    columns, and the optimizer leaves generators where they are.
    """
    record = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return df.selectExpr(
        all_but(df, {*drop, *columns}), f"inline(array(named_struct({record})))"
    )


def once(df: DataFrame, drop: Sequence[str] = (), **columns: Column) -> DataFrame:
    """The same for columns."""
    kept = [c for c in df.columns if c not in {*drop, *columns}]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def all_but(df: DataFrame, names: set[str] | tuple[str, ...]) -> str:
    """``*`` without the columns of ``names`` that ``df`` has."""
    gone = [c for c in df.columns if c in names]
    return f"* EXCEPT ({', '.join(f'`{c}`' for c in gone)})" if gone else "*"
