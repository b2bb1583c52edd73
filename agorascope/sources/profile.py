"""What is in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.binding import as_rows, named


def dataset_profile(df: DataFrame, approximate: bool = True) -> DataFrame:
    """Per column: type, rows, nulls, distinct values, minimum and maximum as text.

    One pass over the table. Approximate distinct counts are sketches combined on the map side.
    Exact ones take a second pass, in which the distinct (column, value) pairs are shuffled once.
    """
    if not approximate:
        return _exact(df)
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(df.columns):
        column = named(name)
        measures += [
            F.count_if(column.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(column).alias(f"distinct_{i}"),
            F.min(column).cast("string").alias(f"min_{i}"),
            F.max(column).cast("string").alias(f"max_{i}"),
        ]
    rows = [
        (F.lit(name), F.lit(kind), *[F.col(f"{measure}_{i}") for measure in ("nulls", "distinct", "min", "max")])
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    fields = ("column_name", "column_type", "n_nulls", "n_distinct", "min_value", "max_value")
    return df.agg(*measures).select("n_rows", as_rows(fields, rows))


def _exact(df: DataFrame) -> DataFrame:
    """The profile with distinct values counted."""
    values = F.array(*[
        F.struct(F.lit(name).alias("column_name"), named(name).cast("string").alias("value")) for name in df.columns
    ])
    pairs = df.select(F.inline(values)).where(F.col("value").isNotNull()).distinct()
    counted = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    rough = dataset_profile(df)
    columns = [F.coalesce("n", F.lit(0)).alias(c) if c == "n_distinct" else F.col(c) for c in rough.columns]
    return rough.join(F.broadcast(counted), "column_name", "left").select(*columns)  # a row for each column
