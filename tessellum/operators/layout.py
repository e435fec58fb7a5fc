"""Lines and layout of words on a page, boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ("fileid", "page")


def break_lines(df: DataFrame) -> DataFrame:
    """df with line, a running number in the page: a new line where a word starts no further right and lower than the one before.

    The first word is compared with the page's origin, so a page may begin with line 1.
    """
    w = Window.partitionBy(*PAGE).orderBy("word_idx")
    dx, dy = F.col("x0") - F.coalesce(F.lag("x0").over(w), F.lit(0)), F.col("top") - F.coalesce(F.lag("top").over(w), F.lit(0))
    breaks = F.when((dx <= 0) & (dy > 0), 1).otherwise(0)
    return df.withColumn("__break", breaks).withColumn("line", F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__break")


def line_table(df: DataFrame) -> DataFrame:
    """One row for each line of a df with lines: size, edges, gap to the line before and indent against it."""
    lines = df.groupBy(*PAGE, "line").agg(
        F.count("*").alias("n_words"),
        F.max(F.col("bottom") - F.col("top")).alias("height"),
        F.min_by("x0", "word_idx").alias("left"),
        F.max_by("x1", "word_idx").alias("right"),
        F.min("top").alias("top"),
        F.max("bottom").alias("bottom"),
        F.min_by("page_height", "word_idx").alias("page_height"),
    )
    w = Window.partitionBy(*PAGE).orderBy("line")
    return lines.withColumns({"gap": F.col("top") - F.coalesce(F.lag("bottom").over(w), F.lit(0)), "indent": F.col("left") - F.coalesce(F.lag("left").over(w), F.col("left"))})


def with_line_stats(df: DataFrame) -> DataFrame:
    """Words with their line's figures, prefixed line_, and first and last flags."""
    words = break_lines(df)
    lines = line_table(words).drop("n_words", "right")
    lines = lines.select(*PAGE, "line", *[F.col(c).alias(f"line_{c}") for c in lines.columns if c not in (*PAGE, "line")])
    w = Window.partitionBy(*PAGE, "line")
    ends = words.withColumns({"first_word": F.col("word_idx") == F.min("word_idx").over(w), "last_word": F.col("word_idx") == F.max("word_idx").over(w)})
    return ends.join(lines, [*PAGE, "line"])


def contains_box(outer: str, inner: str) -> Column:
    """Whether one box lies in another, edges included. Names are prefixes of x0, top, x1, bottom."""
    o, i = (lambda c: F.col(f"{outer}{c}")), (lambda c: F.col(f"{inner}{c}"))
    return (i("x0") >= o("x0")) & (i("top") >= o("top")) & (i("x1") <= o("x1")) & (i("bottom") <= o("bottom"))


def overlaps(a: str, b: str) -> Column:
    """Whether two boxes share an area; touching edges don't count."""
    p, q = (lambda c: F.col(f"{a}{c}")), (lambda c: F.col(f"{b}{c}"))
    return (p("x0") < q("x1")) & (q("x0") < p("x1")) & (p("top") < q("bottom")) & (q("top") < p("bottom"))


def flip(box: tuple[Column, Column, Column, Column], page_height: Column) -> tuple[Column, Column, Column, Column]:
    """A bottom-up box (x0, y0, x1, y1) as top-down (x0, top, x1, bottom)."""
    x0, y0, x1, y1 = box
    return x0, page_height - y1, x1, page_height - y0
