"""Long lists per key as pieces of bounded length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def collect_in_chunks(df: DataFrame, key: str, value: str, size: int = 1000, alias: str = "values",
                      sep: str = ",") -> DataFrame:
    """(key, chunk, ``alias``): the distinct values of each key in order, ``size`` to a text.

    No task and no value holds a whole key. The distinct rows are range-partitioned by (key, value)
    and fixed by a checkpoint, so a hot key lies in as many partitions as its rows fill; a value's
    number in its key is its number in the partition plus the counts of the key's partitions before
    (as many rows as the key has partitions). A chunk is then a group of at most ``size`` rows.
    NULL values are left out.
    """
    checkpoint_dir(df.sparkSession)
    rows = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    fixed = rows.repartitionByRange(key, value).select(key, value, F.spark_partition_id().alias("_part")).checkpoint()
    counts = fixed.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(key).alias("_key"), F.col("_part").alias("_p"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = fixed.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p")))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy(value))
    numbered = placed.select(key, value, F.floor((F.col("_before") + inside - 1) / size).cast("long").alias("chunk"))
    return numbered.groupBy(key, "chunk").agg(
        F.array_join(F.array_sort(F.collect_list(value)), sep).alias(alias))
