"""Joins and ranks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.binding import as_rows, named

HOT_KEYS_MAX = 512
TRACKED = 8192
#: Rows of one key that a task should take, whatever the size of the table.
ROWS_PER_TASK = 1_000_000
#: Tasks over which rows without key are spread.
NULL_SALTS = 256
#: Groups whose cut points (at most SPLITS numbers each) may be sent to all tasks.
GROUPS_BROADCAST_MAX = 10_000
SPLITS = 256


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows, looking at no more than that plus one.

    The guard in front of every ``broadcast`` of a table whose size is not bounded by its
    construction.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the number of ``salts`` that brings each task below it.

    One pass over the key column alone, with a mergeable frequent-items sketch. The result has at most
    HOT_KEYS_MAX rows by construction, so it may be broadcast. A key the sketch misses costs
    balance, never rows.
    """
    sketch = df.agg(F.call_function("approx_top_k", named(key), F.lit(HOT_KEYS_MAX), F.lit(TRACKED)).alias("top"))
    entries = sketch.select(F.explode("top").alias("entry")).where(F.col("entry.count") > rows_per_task)
    return entries.select(
        F.col("entry.item").alias(key), F.ceil(F.col("entry.count") / rows_per_task).cast("int").alias("salts")
    ).where(F.col(key).isNotNull())


def salted_join(
    big: DataFrame, small: DataFrame, key: str, spread: Sequence[str], how: str = "inner", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join on ``key`` in which the rows of hot keys on the big side are spread over as many
    tasks as their number needs, and only their partners on the small side are copied.

    The salt comes from a hash of the ``spread`` columns, which should tell rows of one key apart,
    so a recomputed task salts as before. ``how`` is ``inner`` or ``left`` (big side kept); rows
    without key, which a left join keeps, are spread too.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join keeps rows of the big side: use inner or left")
    marked = F.broadcast(hot_keys(big, key, rows_per_task).withColumnRenamed("salts", "__salts"))
    salts = F.when(F.col(key).isNull(), NULL_SALTS).otherwise(F.coalesce("__salts", F.lit(1)))
    salted_big = big.join(marked, key, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*spread), salts.cast("bigint")).cast("int")
    ).drop("__salts")
    salted_small = small.join(marked, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    ).drop("__salts")
    return salted_big.join(salted_small, [key, "__salt"], how).drop("__salt")


def running_sums(counted: DataFrame, value: str, sums: Sequence[str], descending: bool = False) -> DataFrame:
    """``value`` and ``sums`` of a table with one row per value, with ``<sum>_before`` (over the
    values ranked before) and ``<sum>_total``, without a one-partition window.

    The values fall into ranges cut at sketched quantiles; running sums are taken within each
    range in parallel and shifted by the totals of the ranges before (at most SPLITS + 1 rows).
    Exact, however uneven the sketch.
    """
    cuts = counted.agg(
        F.percentile_approx(value, [i / SPLITS for i in range(1, SPLITS)], 2000).alias("cuts")
    ).scalar()
    # Never null, so that the join below cannot push a null test, and with it the search for the
    # range, down to the rows.
    below = F.coalesce(F.size(F.filter(F.col("__cuts"), lambda c: c < F.col(value))), F.lit(0))
    ranged = counted.withColumn("__cuts", cuts).withColumn("__range", -below if descending else below).drop("__cuts")
    whole = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = ranged.groupBy("__range").agg(*[F.sum(s).alias(f"__{s}") for s in sums]).select(
        "__range",
        *[F.coalesce(F.sum(f"__{s}").over(whole), F.lit(0)).alias(f"__{s}_shift") for s in sums],
        *[F.sum(f"__{s}").over(everything).alias(f"{s}_total") for s in sums],
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumns({f"__{s}_in": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    return running.join(F.broadcast(totals), "__range").select(
        value, *sums, *[(F.col(f"__{s}_in") + F.col(f"__{s}_shift")).alias(f"{s}_before") for s in sums], *[f"{s}_total" for s in sums]
    )


def ranked_histogram(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """Distinct values with their row count ``n``, the rows ranked before them ``before`` and
    all rows ``total``; rows are counted per value first, and not sorted."""
    hist = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return running_sums(hist, value, ["n"], descending).withColumnsRenamed({"n_before": "before", "n_total": "total"})


def grouped_median(df: DataFrame, keys: Sequence[str], values: Sequence[str], splits: int = SPLITS) -> DataFrame:
    """Exact interpolated medians of columns per group, in one lazy plan and one pass over the rows.

    Rows are counted per (group, column, value) first, and all that follows reads the shuffle of
    these counts. A mergeable sketch of a group's distinct values cuts them into ranges; exact
    counts of the ranges (at most ``splits`` for a group) tell the one or two that hold the middle,
    and only within these are values put in order. So a group with as many distinct values as rows isn't ordered
    in one task. Which joins broadcast is left to AQE, which sees the sizes. One output column
    ``<value>_median`` per input column.
    """
    pairs = [(F.lit(v), named(v).cast("double")) for v in values]
    groups = [f"__k{i}" for i in range(len(keys))]
    long = df.select(*[named(k).alias(g) for k, g in zip(keys, groups)], as_rows(("__column", "__value"), pairs))
    group = [*groups, "__column"]
    counted = long.where(F.col("__value").isNotNull()).groupBy(*group, "__value").agg(F.count(F.lit(1)).alias("__n"))
    # Equal values differ in no key but null ones, which join here too.
    same = [F.coalesce(F.col(g).cast("string"), F.lit("")).alias(f"__same{i}") for i, g in enumerate(group)]
    same += [F.col(g).isNull().alias(f"__null{i}") for i, g in enumerate(group)]
    keyed = counted.select("*", *same)
    by = [f"__{kind}{i}" for kind in ("same", "null") for i in range(len(group))]

    # The total keeps the counts in this branch, so that it is the same shuffle as the other's.
    cuts = keyed.groupBy(*by).agg(
        F.percentile_approx("__value", [i / splits for i in range(1, splits)], 2000).alias("__cuts"), F.sum("__n").alias("__all")
    )
    below = F.coalesce(F.size(F.filter(F.col("__cuts"), lambda c: c < F.col("__value"))), F.lit(0))
    ranged = keyed.join(cuts, by).withColumn("__range", below).drop("__cuts")

    upto = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy(*by, "__range").agg(F.sum("__n").alias("__rows"), F.max("__all").alias("__all")).withColumn("__upto", F.sum("__rows").over(upto))
    low, high = F.floor((F.col("__all") + 1) / 2), F.floor((F.col("__all") + 2) / 2)

    def holds(rank: Column, rows: str) -> Column:
        return (F.col("__upto") - F.col(rows) < rank) & (F.col("__upto") >= rank)

    middle = totals.where(holds(low, "__rows") | holds(high, "__rows")).select(*by, "__range", (F.col("__upto") - F.col("__rows")).alias("__shift"))
    kept = ranged.join(middle, [*by, "__range"])
    inside = Window.partitionBy(*by, "__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = kept.withColumn("__upto", F.sum("__n").over(inside) + F.col("__shift"))

    def at(rank: Column, column: str) -> Column:
        return F.max(F.when((F.col("__column") == column) & holds(rank, "__n"), F.col("__value")))

    medians = placed.groupBy(*groups).agg(*[((at(low, v) + at(high, v)) / 2).alias(f"{v}_median") for v in values])
    return medians.withColumnsRenamed(dict(zip(groups, keys)))
