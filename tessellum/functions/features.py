"""Features of words as arrays of key=value strings, and the label transforms they are trained on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.functions.text import BULLETS, PUNCTUATION, is_alpha, is_numeric, is_title, is_upper, true_false
from tessellum.operators.layout import PAGE, with_line_stats
from tessellum.operators.words import split_label
from tessellum.schema import WORD_COLUMNS

# Block types that are headings.
HEADINGS = ("Article", "Chapitre", "Section", "SousSection", "Titre")


def pair(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}="), F.coalesce(value.cast("string"), F.lit("")))


def flag(c: Column) -> Column:
    return F.when(c, "1").otherwise("0")


def text_columns(plus: bool) -> list[Column]:
    t, font = F.col("text"), F.lower(F.coalesce("fontname", F.lit("")))
    line = [true_false(F.array_contains("__first_line", w)) for w in ("table", "chapitre", "annexe")]
    style = [pair("rgb", F.col("rgb")), pair("bold", true_false(F.contains(font, F.lit("bold")))), pair("italic", true_false(F.contains(font, F.lit("italic"))))]
    return [
        pair("lower", F.lower(t)),
        pair("uppercase", true_false(is_upper(t))),
        pair("title", true_false(is_title(t))),
        pair("punc", true_false(t.rlike(f"^{PUNCTUATION}+\\z"))),
        pair("endpunc", true_false(t.rlike(f"^.*{PUNCTUATION}\\z"))),
        pair("multipunc", true_false(t.rlike(f"^{PUNCTUATION}{{4,}}\\z"))),
        pair("numeric", true_false(is_numeric(t))),
        *(style if plus else []),
        *[pair(f"head:{k}", v) for k, v in zip(("table", "chapitre", "annexe"), line, strict=True)],
    ]


def bullets() -> Column:
    """The kinds of list marker a word is, in order; several may hold."""
    return F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.lit(f"bullet={k}")) for k, p in BULLETS.items()]))


def with_first_line(df: DataFrame) -> DataFrame:
    """Words with __first_line, the small-letter words of the page's first line: those before top changes."""
    w = Window.partitionBy(*PAGE).orderBy("word_idx")
    first = df.withColumn("__changed", F.when(F.col("top") != F.first("top").over(w), 1).otherwise(0)).withColumn("__changed", F.max("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    heads = F.collect_set(F.when((F.col("__changed") == 0) & F.lower("text").isin("table", "chapitre", "annexe"), F.lower("text"))).over(Window.partitionBy(*PAGE))
    return first.withColumn("__first_line", heads).drop("__changed")


def text_features(df: DataFrame) -> DataFrame:
    return with_first_line(df).withColumn("features", F.concat(F.array(*text_columns(False)), bullets())).drop("__first_line")


def text_plus_features(df: DataFrame) -> DataFrame:
    return with_first_line(df).withColumn("features", F.concat(F.array(*text_columns(True)), bullets())).drop("__first_line")


def layout_features(df: DataFrame) -> DataFrame:
    rows = with_line_stats(df)
    below = F.col("line_page_height") - F.col("line_bottom")
    array = F.array(pair("first", flag(F.col("first_word"))), pair("last", flag(F.col("last_word"))), pair("line:height", F.col("line_height")), pair("line:left", F.col("line_left")), pair("line:top", F.col("line_top")), pair("line:bottom", below), pair("line:gap", F.col("line_gap")), pair("line:indent", F.col("line_indent")))
    return rows.withColumn("features", array).drop("line", "first_word", "last_word", *[c for c in rows.columns if c.startswith("line_")])


def structure_features(df: DataFrame) -> DataFrame:
    tags = F.split(F.coalesce("tagstack", F.lit("Span")), ";")
    array = F.array(pair("toc", flag(F.array_contains(tags, "TOCI"))), pair("mctag", F.coalesce("mctag", F.lit("P"))), pair("header", true_false(F.exists(tags, lambda x: F.startswith(x, F.lit("H"))))))
    return df.withColumn("features", array)


def literal_features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", F.array(*[pair(c, F.col(c)) for c in WORD_COLUMNS if c in df.columns]))


def label_features(df: DataFrame) -> DataFrame:
    """Features for finding titles and numbers of whole documents."""
    t, font = F.col("text"), F.lower(F.coalesce("fontname", F.lit("")))
    array = F.array(F.lit("bias"), pair("lower", F.lower(t)), pair("reg", true_false(F.lower(t) == "règlement")), pair("n", true_false(t.rlike("^[Nn]"))), pair("alpha", true_false(is_alpha(t))), pair("numdash", true_false(t.rlike(r"^[\p{Nd}-]"))), pair("bold", true_false(F.contains(font, F.lit("bold")))), pair("size", F.col("bottom") - F.col("top")))
    return df.withColumn("features", array)


def together(*parts: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """The features of several functions one after the other; they stay on the rows, so nothing is joined."""

    def run(df: DataFrame) -> DataFrame:
        out = df
        for k, part in enumerate(parts):
            out = part(out).withColumnRenamed("features", f"__f{k}")
        names = [f"__f{k}" for k in range(len(parts))]
        return out.withColumn("features", F.concat(*names)).drop(*names)

    return run


FEATURES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "literal": literal_features,
    "text": text_features,
    "text+": text_plus_features,
    "layout": layout_features,
    "text+layout": together(text_plus_features, layout_features),
    "structure": structure_features,
    "text+layout+structure": together(text_plus_features, layout_features, structure_features),
    "label": label_features,
}


def page_features(df: DataFrame, kind: str = "text+layout+structure", n: int = 2) -> DataFrame:
    """Words with features: a bias, the word's own and, up to n - 1 words away on its page, those of its neighbours without a colon."""
    own = FEATURES[kind](df)
    w = Window.partitionBy(*PAGE).orderBy("word_idx")

    def near(column: Column, sign: str) -> Column:
        return F.transform(F.filter(F.coalesce(column, F.array().cast("array<string>")), lambda x: ~F.contains(x, F.lit(":"))), lambda x: F.concat(F.lit(f"{sign}:"), x))

    parts = [x for m in range(1, n) for x in (near(F.lead("features", m).over(w), f"+{m}"), near(F.lag("features", m).over(w), f"-{m}"))]
    return own.withColumn("features", F.concat(F.array(F.lit("bias")), F.col("features"), *parts))


def transform_label(label: Column, kind: str) -> Column:
    """A label as a model is trained on it: literal, bonly (I without type), tonly (headings alone) or iobonly; others are literal."""
    bio, name = split_label(label)
    if kind == "bonly":
        return F.when(name == "", label).when(bio == "I", "I").otherwise(label)
    if kind == "tonly":
        return F.when((name == "") | name.isin(*HEADINGS), label).otherwise("O")
    return bio if kind == "iobonly" else label
