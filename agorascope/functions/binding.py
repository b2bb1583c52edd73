"""Evaluate an expensive expression once per row.

The optimiser is free to copy a column's expression into every filter and projection that uses
it, also into the inside of a lambda, where it would run once per array element. These two
forms fix where it runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, as one expression."""
    return F.transform(F.array(value), body)[0]


def named(name: str) -> Column:
    """A column by its name, whatever signs that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_rows(fields: Sequence[str], rows: Sequence[Sequence[Column]]) -> Column:
    """Columns of one row as several rows with the given fields. No name is read as SQL."""
    return F.inline(F.array(*[F.struct(*[value.alias(field) for field, value in zip(fields, row)]) for row in rows]))


def add_kept(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Add a computed column and drop the rows whose value fails ``keep``.

    The same rows as ``withColumn`` and ``where``, but a filter on the new column cannot be
    pushed below its computation and repeat it. The computation stays in a projection of its
    own, where generated code shares common parts.
    """
    return df.withColumn(name, value).withColumn(name, F.explode(F.filter(F.array(name), keep)))
