"""The word table: scans, tidying, filters, page selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.schema import BLOCK_TYPES, SPAN_TYPES, WORD_COLUMNS

ORDER = ("fileid", "word_idx")


def known_label(label: Column, types: tuple[str, ...]) -> Column:
    """The label if it is spelled as the vocabulary has it, else O."""
    return F.when(label.rlike(rf"^(?:O|I|[BI]-(?:{'|'.join(types)}))\z"), label).otherwise("O")


def tidy_words(df: DataFrame) -> DataFrame:
    """Each word once, by (fileid, page, word_idx), with seg and span, its labels as the vocabulary has them or O.

    The one exchange is by (fileid, page), so that page-wise windows and joins after it need none and a file of any size is
    spread over its pages. Rows without a key are left out; null text becomes empty. Of rows with one key any one counts, as
    they are deliveries of the same word.
    """
    rows = df.where("fileid IS NOT NULL AND page IS NOT NULL AND word_idx IS NOT NULL")
    rows = rows.select(*ORDER, F.coalesce("text", F.lit("")).alias("text"), *WORD_COLUMNS[3:], known_label(F.col("segment"), BLOCK_TYPES).alias("seg"), known_label(F.col("sequence"), SPAN_TYPES).alias("span"))
    return rows.repartition("fileid", "page").dropDuplicates(["fileid", "page", "word_idx"])


def on_page(df: DataFrame) -> DataFrame:
    """Words that lie wholly on their page."""
    return df.where("x0 >= 0 AND top >= 0 AND x1 <= page_width AND bottom <= page_height")


def select_pages(df: DataFrame, pages: list[int]) -> DataFrame:
    """Words of the pages asked for; page_rank is the page's place in the list. Pages under 1 count as 1."""
    wanted = [max(1, p) for p in pages]
    return df.where(F.col("page").isin(wanted)).withColumn("page_rank", F.array_position(F.array(*map(F.lit, wanted)), F.col("page")))


def outside_tables(df: DataFrame, label: str = "seg") -> DataFrame:
    """Words whose block label names no Tableau and whose tags name no Table."""
    return df.where(~F.coalesce(F.contains(F.col(label), F.lit("Tableau")), F.lit(False)) & ~F.coalesce(F.contains(F.col("tagstack"), F.lit("Table")), F.lit(False)))


def split_label(label: Column) -> tuple[Column, Column]:
    """(prefix, type) of a label, cut at its first dash; the type of a bare label is empty."""
    return F.substring_index(label, "-", 1), F.when(F.contains(label, F.lit("-")), F.regexp_replace(label, r"^[^-]*-", "")).otherwise("")


def page_offsets(df: DataFrame, count: Column, doc: str = "fileid", page: str = "page", alias: str = "offset") -> DataFrame:
    """(doc, page, alias): the sum of count over the pages before. One row a page, so that no window holds a whole file of words."""
    pages = df.groupBy(doc, page).agg(F.sum(count).alias("__n"))
    before = Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    return pages.select(doc, page, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(alias))


def running_count(df: DataFrame, flag: Column, name: str, order: str = "word_idx", doc: str = "fileid", page: str = "page") -> DataFrame:
    """df with the number of rows up to and with this one, in the whole document, for which flag holds.

    Counted within each page, plus the count of the pages before; pages follow one another in the order.
    """
    one = F.when(flag, 1).otherwise(0)
    local = Window.partitionBy(doc, page).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(one).over(local)).join(page_offsets(df, one, doc, page, "__before"), [doc, page]).withColumn(name, F.col(name) + F.col("__before")).drop("__before")


def numbered(df: DataFrame, order: list[str], name: str = "ref") -> DataFrame:
    """df with the place of each row in the order of the columns, from 0, like enumerate.

    Rows are range-partitioned and numbered within each partition; the counts of the partitions before, one row each, are added.
    The rows are written once between, so that both readings see one partitioning. The order has to tell rows apart.
    """
    from tessellum.session import materialize

    rows = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    local = Window.partitionBy("__part").orderBy(*order)
    rows = materialize(rows.withColumn("__at", F.row_number().over(local)), "numbered")
    sums = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sums.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(offsets, "__part").withColumn(name, F.col("__at") + F.col("__before") - 1).drop("__part", "__at", "__before")
