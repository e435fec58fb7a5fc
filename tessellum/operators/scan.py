"""Running values over long groups: computed in chunks of bounded size, with what the chunks before hand over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a chunk in units of the order column, so at most so many rows of distinct whole numbers.
CHUNK = 50_000


def nearest(df: DataFrame, values: dict[str, Column], order: str, group: str, after: bool = False) -> DataFrame:
    """df with, for each name, the value of the nearest row before (or after) in the group for which it isn't null.

    Groups are cut into chunks of the order column, which holds whole numbers; each chunk is scanned by itself, and one row
    for each chunk carries values over. A group of any size is so spread over tasks. Null where there is no such row.

    df is read twice, so where several of these follow one another, write it in between (session.materialize): the plan doubles
    with each.
    """
    names = list(values)
    rows = df.withColumn("__chunk", F.floor(F.col(order) / CHUNK)).withColumns({f"__v_{n}": v for n, v in values.items()})
    along = F.desc if after else F.asc
    local = Window.partitionBy(group, "__chunk").orderBy(along(order)).rowsBetween(Window.unboundedPreceding, -1)
    pick = F.min_by if after else F.max_by
    ends = rows.groupBy(group, "__chunk").agg(*[pick(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col(order))).alias(f"__e_{n}") for n in names])
    across = Window.partitionBy(group).orderBy(along("__chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(group, "__chunk", *[F.last(f"__e_{n}", True).over(across).alias(f"__c_{n}") for n in names])
    out = rows.withColumns({f"__l_{n}": F.last(f"__v_{n}", True).over(local) for n in names}).join(carried, [group, "__chunk"])
    return out.withColumns({n: F.coalesce(f"__l_{n}", f"__c_{n}") for n in names}).drop("__chunk", *[f"__{k}_{n}" for k in "vcl" for n in names])


def running_sum(df: DataFrame, value: Column, name: str, order: str, group: str) -> DataFrame:
    """df with the sum of a value over the group up to and with each row, in chunks as of nearest."""
    rows = df.withColumn("__chunk", F.floor(F.col(order) / CHUNK)).withColumn("__v", value)
    local = Window.partitionBy(group, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(group, "__chunk").agg(F.sum("__v").alias("__s"))
    before = sums.select(group, "__chunk", F.coalesce(F.sum("__s").over(across), F.lit(0)).alias("__before"))
    return rows.withColumn(name, F.sum("__v").over(local)).join(before, [group, "__chunk"]).withColumn(name, F.col(name) + F.col("__before")).drop("__chunk", "__v", "__before")
