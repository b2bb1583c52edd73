"""Samples of an exact size, by the smallest hashes of keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.binding import named
from ..functions.sampling import key_fraction

#: Ranges of the hash that rows are counted in.
RANGES = 1 << 16


def exact_sample(df: DataFrame, key: str, n: int, strata: Sequence[str] = (), seed: int = 42, ranges: int = RANGES) -> DataFrame:
    """Exactly ``n`` rows of each stratum, or all if it has fewer: those with the smallest hashes of their keys.

    The choice depends on keys and seed alone, and a sample of fewer rows is part of one of more.
    Rows are counted by range of their hash; these counts add up over partitions, and say which range holds
    the n-th row of a stratum. Rows of lower ranges are in, and only those of that one range, one of ``ranges``, are put in order:
    no task orders a stratum. Ties go to the smaller key, null keys share one hash; null strata are strata.
    """
    if n < 0:
        raise ValueError("a sample has no less than no rows")
    names = [f"__stratum{i}" for i in range(len(strata))]
    hashed = df.withColumns({"__hash": F.coalesce(key_fraction(named(key), seed), F.lit(0.0))})
    hashed = hashed.withColumns({"__range": F.floor(F.col("__hash") * ranges), **{a: named(s) for a, s in zip(names, strata)}})
    counted = hashed.groupBy(*names, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    upto = F.sum("__rows").over(Window.partitionBy(*names).orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = counted.withColumn("__upto", upto)
    # The first range with which the sample is full, and how many rows it still takes.
    full = totals.where((F.col("__upto") >= n) & (F.col("__upto") - F.col("__rows") < max(n, 1)))
    last = full.groupBy(*names).agg(F.min(F.struct(F.col("__range").alias("at"), (n - F.col("__upto") + F.col("__rows")).alias("more"))).alias("__last"))
    last = last.withColumnsRenamed({a: f"{a}_" for a in names})
    same: Column = reduce(and_, [F.col(a).eqNullSafe(F.col(f"{a}_")) for a in names], F.lit(True))
    rows = hashed.join(last, same, "left") if names else hashed.withColumn("__last", last.select("__last").scalar())
    near = rows.where(F.col("__last").isNull() | (F.col("__range") <= F.col("__last.at")))
    order = Window.partitionBy(*names, "__range").orderBy("__hash", named(key))
    chosen = near.withColumn("__place", F.row_number().over(order))
    kept = chosen.where(F.col("__last").isNull() | (F.col("__range") < F.col("__last.at")) | (F.col("__place") <= F.col("__last.more")))
    return kept.select(*[named(c) for c in df.columns])
