"""One consistent form for text that looks the same but is made of different characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fold import compositions, mark_order, pairs

#: Text of these characters alone, without outer spaces, is in the consistent form: ASCII, composed Latin letters, usual signs.
PLAIN = r"[!-~À-ÖØ-öø-ÿŒœŸ«»°²³½‘’“”–—…•]+( +[!-~À-ÖØ-öø-ÿŒœŸ«»°²³½‘’“”–—…•]+)*+"


def table(pairs: dict[str, str]) -> Column:
    """A constant map of strings; one literal, so that the plan stays small."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in pairs.items())), F.lit("\x02"), F.lit("\x01"))


def composed(piece: Column) -> Column:
    """A letter with its marks, the marks in canonical order and composed with the letter as far as they can be."""
    whole, apart, order = table(compositions()), table({v: k for k, v in compositions().items()}), table(mark_order())
    letter = F.substring(piece, 1, 1)
    full = F.concat(F.coalesce(F.try_element_at(apart, letter), letter), F.substr(piece, F.lit(2), F.length(piece)))
    marks = F.filter(F.split(F.substr(full, F.lit(2), F.length(full)), ""), lambda m: m != "")
    ranked = F.array_sort(F.transform(marks, lambda m, i: F.struct(F.coalesce(F.try_element_at(order, m), F.lit("000")).alias("c"), i.alias("i"), m.alias("m"))))
    sorted_ = F.concat(F.substring(full, 1, 1), F.array_join(F.transform(ranked, lambda x: x["m"]), ""))
    first = F.try_element_at(whole, F.substring(sorted_, 1, 2))
    return F.coalesce(F.try_element_at(whole, sorted_), F.concat(first, F.substr(sorted_, F.lit(3), F.length(sorted_))), sorted_)


def mapped(text: Column) -> Column:
    """The text with look-alike letters, widths and spaces replaced, invisible characters and outer spaces removed, accents composed.

    Built-in expressions only. A letter with marks that have no composed form keeps the marks, in canonical order. A word all of
    whose letters are Cyrillic or Armenian, some of them like no Latin letter, is a word of that script and keeps its letters.
    """
    chars, plain, several, hidden = pairs()
    latin = lambda x: F.translate(x, chars + hidden, plain)  # noqa: E731 - characters without a counterpart are removed
    alike = "".join(c for c in chars if "\u0370" < c < "\u0590")
    own = rf"[\p{{IsCyrillic}}\p{{IsArmenian}}&&[^{alike}]]"
    words = F.regexp_extract_all(text, F.lit(r"(?s)([\p{L}\p{M}]+|[^\p{L}\p{M}]+)"), F.lit(1))
    foreign = lambda x: x.rlike(r"^(?:[\p{IsCyrillic}\p{M}]+|[\p{IsArmenian}\p{M}]+)$") & x.rlike(own)
    out = F.when(text.rlike(own), F.array_join(F.transform(words, lambda x: F.when(foreign(x), x).otherwise(latin(x))), "")).otherwise(latin(text))
    pieces = F.regexp_extract_all(out, F.lit(r"(?s)(\P{M}\p{M}*|\p{M}+)"), F.lit(1))
    whole = F.array_join(F.transform(pieces, lambda x: F.coalesce(F.try_element_at(table(several), x), F.when(x.rlike(r"\p{M}"), composed(x)), x)), "")
    return F.btrim(F.when(out.rlike("[\\p{M}" + "".join(sorted(several)) + "]"), whole).otherwise(out))


def consistent_form(df: DataFrame, text: str, collation: str = "UNICODE", out: str = "canonical") -> DataFrame:
    """Rows of df with the consistent form of the text column in the new column out.

    The distinct values are mapped, the mapped forms grouped under the accent- and case-sensitive Unicode collation, which
    also equates what mapping left different in code points alone, and of each class the shortest form with the fewest loose
    marks, least in code points on a tie, is the canonical member. It is joined back by value to the rows that are not plain
    already; a value of many rows is split by adaptive execution like any other hot key.

    Null stays null, empty and blank text becomes empty. Repeated rows are kept. out replaces a column of that name.
    """
    value, form = "__value", "__form"
    rows = df.drop(out) if out in df.columns and out != text else df
    plain = F.col(text).rlike(f"^(?:{PLAIN})?\\z") | F.col(text).isNull()
    forms = rows.where(~plain).select(F.col(text).alias(value)).distinct().withColumn(form, mapped(F.col(value)))
    # A plain value is its own form; of these, only such as other values map to take part in choosing.
    seen = forms.select(form).distinct()
    rank = F.struct(F.length(F.regexp_replace(form, r"\P{M}", "")), F.length(form), F.col(form))
    chosen = seen.withColumn("__best", F.min(rank).over(Window.partitionBy(F.collate(F.col(form), collation)))).select(form, F.col("__best").getField(form).alias(out))
    table = forms.join(chosen, form).select(value, out)
    odd = rows.where(~plain).join(table, F.col(text) == F.col(value), "left").drop(value)
    return rows.where(plain).withColumn(out, F.col(text)).unionByName(odd)
