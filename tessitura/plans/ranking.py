"""A rank over a whole table without a single task: sort by range, number inside each range, add the ranges before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.tables import written


def global_rank(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """rows with their place in order, from 1; order must have no ties.

    The rows are dealt to ranges once and written with their range's number: dealing them anew would draw other bounds,
    and a row's place in its range would be added to the sizes of other ranges.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    local = placed.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return local.join(F.broadcast(before), "_p").withColumn(name, (F.col("_r") + F.col("_before")).cast("int")).drop("_p", "_r", "_before")
