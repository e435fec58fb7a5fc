"""Counts and scores of labels against a reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.operators.words import split_label


def label_counts(df: DataFrame, label: str, least: int = 1) -> DataFrame:
    """(label, n) of the labels that occur at least so often."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def ratio(a: Column, b: Column) -> Column:
    """A quotient that is 0 where nothing is to be divided by."""
    return F.when(b != 0, a / b).otherwise(0.0)


def confusion(df: DataFrame, truth: str, guess: str, *by: str) -> DataFrame:
    """(by, label, tp, fp, fn): counts of each label, from one pass over the pairs of labels that occur together."""
    pairs = df.groupBy(*by, F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count("*").alias("n"))
    one = lambda label, tp, fp, fn: F.struct(label.alias("label"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    zero, n = F.lit(0).cast("bigint"), F.col("n")
    each = F.when(F.col("t") == F.col("g"), F.array(one(F.col("t"), n, zero, zero))).otherwise(F.array(one(F.col("t"), zero, zero, n), one(F.col("g"), zero, n, zero)))
    return pairs.select(*by, F.inline(each)).groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def scores(counts: DataFrame, *by: str) -> DataFrame:
    """Precision, recall, F1 and support of each label."""
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(*by, "label", p.alias("precision"), r.alias("recall"), ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"), (F.col("tp") + F.col("fn")).alias("support"), "tp", "fp", "fn")


def report(df: DataFrame, truth: str, guess: str, labels: Column | None = None) -> DataFrame:
    """Scores of the labels for which the condition on label holds, with the micro, macro and weighted averages over them."""
    each = scores(confusion(df, truth, guess).where(labels if labels is not None else F.lit(True)))
    tp, fp, fn = (F.sum(c) for c in ("tp", "fp", "fn"))
    weight = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    whole = each.agg(
        F.struct(ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1")).alias("micro avg"),
        F.struct(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")]).alias("macro avg"),
        F.struct(*[weight(c).alias(c) for c in ("precision", "recall", "f1")]).alias("weighted avg"),
        F.coalesce(F.sum("support"), F.lit(0)).alias("support"),
    )
    averages = whole.select("support", F.inline(F.array(*[F.struct(F.lit(k).alias("label"), F.col(f"{k}.precision"), F.col(f"{k}.recall"), F.col(f"{k}.f1")) for k in ("micro avg", "macro avg", "weighted avg")])))
    return each.drop("tp", "fp", "fn").unionByName(averages)


def fold_scores(df: DataFrame, truth: str, guess: str, fold: str, folds: int, labels: Column | None = None) -> DataFrame:
    """F1 of each label by fold (columns fold_1 to fold_k) with their average, and ALL, the mean of each fold's labels."""
    each = scores(confusion(df, truth, guess, fold).where(labels if labels is not None else F.lit(True)), fold)
    every = each.select(fold, "label", "f1").unionByName(each.groupBy(fold).agg(F.avg("f1").alias("f1")).withColumn("label", F.lit("ALL")))
    wide = every.groupBy("label").agg(F.avg("f1").alias("average"), *[F.max(F.when(F.col(fold) == k, F.col("f1"))).alias(f"fold_{k + 1}") for k in range(folds)])
    return wide


def vote(df: DataFrame, keys: tuple[str, ...], label: str, fold: str) -> DataFrame:
    """The label most folds give; of equally frequent ones that of the first fold. df has a row for each fold and word."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("n"), F.min(fold).alias("first"))
    return counts.groupBy(*keys).agg(F.max_by(label, F.struct("n", -F.col("first"))).alias("label"))


# Classes of a public layout collection by block type.
LAYOUT_CLASSES = {
    "Pied": "Page-footer",
    "Tete": "Page-header",
    "Liste": "List-item",
    "Chapitre": "Section-header",
    "Section": "Section-header",
    "SousSection": "Section-header",
    "Annexe": "Section-header",
    "Article": "Section-header",
    "Alinea": "Text",
}


def layout_class(label: Column) -> Column:
    """A label with its type as a class of the layout collection; O for types that have none and for bare labels."""
    bio, name = split_label(label)
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in LAYOUT_CLASSES.items() for x in kv]), name)
    return F.coalesce(F.concat(bio, F.lit("-"), found), F.lit("O"))


def label_order(label: Column) -> list[Column]:
    """What labels are sorted by: their type, then their prefix."""
    bio, name = split_label(label)
    return [name, bio]
