"""Numeric clean-up and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_or_zero(value: Column, kind: str = "int") -> Column:
    """Dirty numerics as whole numbers; what cannot be read counts as 0."""
    return F.coalesce(value.try_cast(kind), F.lit(0).cast(kind))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null for an empty whole."""
    return F.try_divide(part * 100.0, whole)


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation as an aggregate; null where either side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def bins(value: Column, upper_edges: list, labels: list[str], missing: str) -> Column:
    """Label of the first bin whose inclusive upper edge is not exceeded.

    ``labels`` has one more entry than ``upper_edges`` for the open last bin.
    """
    label = F.when(value.isNull(), missing)
    for edge, name in zip(upper_edges, labels):
        label = label.when(value <= edge, name)
    return label.otherwise(labels[-1])


def label_position(label: Column, labels: list[str]) -> Column:
    """1-based place of a label in its list, 0 for a label outside it."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label).cast("int")
