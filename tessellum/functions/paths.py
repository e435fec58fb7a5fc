"""Relative paths, computed on the paths' text alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(path: Column) -> Column:
    """The steps of a path as an array; empty ones and single dots are none, a step back undoes a step before it."""
    steps = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))

    def add(acc: Column, x: Column) -> Column:
        back = (x == "..") & (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")) != "..")
        return F.when(back, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(steps, F.array().cast("array<string>"), add)


def relative(path: Column, start: Column) -> Column:
    """The path as seen from the folder start, both relative to the same place; '.' for the folder itself."""
    p, s = parts(path), parts(start)
    same = F.transform(F.arrays_zip(p.alias("p"), s.alias("s")), lambda x: x["p"].eqNullSafe(x["s"]))
    common = F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)).cast("int")
    back = F.array_repeat(F.lit(".."), F.size(s) - common)
    out = F.array_join(F.concat(back, F.slice(p, common + 1, F.size(p))), "/")
    return F.when(out == "", ".").otherwise(out)
