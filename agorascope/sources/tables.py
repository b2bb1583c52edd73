"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class UnreadablePath(ValueError):
    """A table path that does not exist or cannot be read."""


def read_table(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, base: str | None = None) -> DataFrame:
    """A parquet table from one folder, a glob, or several paths read as one table.

    With a schema no footer has to be opened to infer one; Hive partition columns in the path
    stay visible and prune files. Only the columns later used are read. ``base`` is the table's
    folder where the paths are some of its partitions.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    reader = reader if base is None else reader.option("basePath", base)
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        raise UnreadablePath(f"cannot read table at {', '.join(paths)}: {error.getCondition()}") from error


def write_by_month(df: DataFrame, path: str, day: str = "date", rebalance: bool = True) -> None:
    """Overwrite a parquet table partitioned by yyyy and mm.

    Rebalancing gathers each month's rows so that files are few, and lets AQE split a month that
    holds most of the rows over many tasks. Turn it off when the input already lies by month.
    """
    dated = df.withColumn("yyyy", F.date_format(day, "yyyy")).withColumn("mm", F.date_format(day, "MM"))
    placed = dated.hint("rebalance", "yyyy", "mm") if rebalance else dated
    placed.write.mode("overwrite").partitionBy("yyyy", "mm").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a table in buckets of ``key``, ordered by it, one file each, and return it from the catalog.

    Tables with the same key and number of buckets are joined and grouped by it where they lie. Rows
    are dealt once, as the buckets are; choose their number so that one fits a task.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` wrote, in a session whose catalog doesn't know it yet."""
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet "
        f"CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key)}) INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(quoted(name))


def export_csv(df: DataFrame, path: str) -> None:
    """Write a small aggregate as one CSV file with a header. Not for row-level tables."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
