"""Blocks of labelled words, and work on the labels themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.operators.words import running_count, split_label

BOX = ("x0", "top", "x1", "bottom")


def join_words(text: str = "text", order: str = "word_idx") -> Column:
    """Aggregate: the words of a group in order, with spaces."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")


def group_blocks(df: DataFrame, label: str = "seg") -> DataFrame:
    """One row for each block: fileid, bloc, type, text, page, n_words, first_idx, last_idx and the hull of its words.

    B and O open a block, I continues whatever there is; the block has the first type that its words name. Words labelled O
    belong to no block, and blocks without a type are left out. A label with another prefix is an error.
    """
    bio, name = split_label(F.col(label))
    ok = F.when(bio.isin("B", "I", "O"), bio).otherwise(F.raise_error(F.concat(F.lit("not a label: "), F.coalesce(F.col(label), F.lit("null")))))
    rows = running_count(df.withColumns({"__bio": ok, "__name": name}), F.col("__bio").isin("B", "O"), "bloc")
    rows = rows.where("__bio != 'O'")
    typed = F.min_by("__name", F.when(F.col("__name") != "", F.col("word_idx")))
    blocks = rows.groupBy("fileid", "bloc").agg(
        F.when(F.max("__name") != "", typed).alias("type"),
        join_words().alias("text"),
        F.min_by("page", "word_idx").alias("page"),
        F.count("*").alias("n_words"),
        F.min("word_idx").alias("first_idx"),
        F.max("word_idx").alias("last_idx"),
        F.min("x0").alias("x0"),
        F.min("top").alias("top"),
        F.max("x1").alias("x1"),
        F.max("bottom").alias("bottom"),
    )
    return blocks.where("type IS NOT NULL")


def image_name(extension: str = "jpg") -> Column:
    """The file name of a block's picture: its page and box."""
    return F.concat(F.lit("page"), F.col("page"), F.lit("-"), F.concat_ws(",", *[F.col(c) for c in BOX]), F.lit(f".{extension}"))


def metadata(spans: DataFrame) -> DataFrame:
    """(fileid, meta) of the blocks of span labels: type to texts in order."""
    by_type = spans.groupBy("fileid", "type").agg(F.transform(F.array_sort(F.collect_list(F.struct("first_idx", "text"))), lambda x: x["text"]).alias("texts"))
    return by_type.groupBy("fileid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "texts")))).alias("meta"))


def name_bare_labels(df: DataFrame, label: str = "seg") -> DataFrame:
    """df with spread: a bare I as I- and the type of the row before; the document's first word is left as it is.

    The type before is found in the page, and for a page that begins with bare ones in the pages before it.
    """
    bio, name = split_label(F.col(label))
    bare = F.col(label) == "I"
    w = Window.partitionBy("fileid", "page").orderBy("word_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("__named", F.when(~bare, F.struct(name.alias("name")))).withColumn("__last", F.last("__named", True).over(w))
    pages = rows.groupBy("fileid", "page").agg(F.max_by("__named", F.when(F.col("__named").isNotNull(), F.col("word_idx"))).alias("__tail"), F.min("word_idx").alias("__first"))
    before = Window.partitionBy("fileid").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("fileid", "page", F.last("__tail", True).over(before).alias("__prior"), (F.min("__first").over(Window.partitionBy("fileid"))).alias("__start"))
    out = rows.join(pages, ["fileid", "page"])
    found = F.coalesce(F.col("__last")["name"], F.col("__prior")["name"], F.lit(""))
    return out.withColumn("spread", F.when(bare & (F.col("word_idx") != F.col("__start")), F.concat(F.lit("I-"), found)).otherwise(F.col(label))).drop("__named", "__last", "__prior", "__start")


def lint(df: DataFrame, label: str = "seg") -> DataFrame:
    """Faults within blocks: an I of another type than the word before it, and a list marker inside of a Liste."""
    bio, name = split_label(F.col(label))
    rows = df.withColumns({"__bio": bio, "__name": name})
    w = Window.partitionBy("fileid", "page").orderBy("word_idx")
    before_bio, before = F.lag("__bio").over(w), F.lag("__name").over(w)
    changed = (F.col("__bio") == "I") & (F.col("__name") != "") & before_bio.isin("B", "I") & (before != "") & (before != F.col("__name"))
    marker = (F.col(label) == "I-Liste") & F.col("text").rlike(r"^(?:[0-9]+[).°]|[a-zA-Z][).]|[•-])$")
    rows = rows.withColumns({"__changed": changed, "__marker": marker, "__was": before})
    fault = F.when(F.col("__changed"), F.concat(F.lit("type "), F.col("__was"), F.lit(" to "), F.col("__name"))).when(F.col("__marker"), F.lit("marker in a list item"))
    return rows.withColumn("fault", fault).where("fault IS NOT NULL").select("fileid", "page", "word_idx", F.col(label).alias("label"), "text", "fault")


def retokenize(df: DataFrame, tokens: Column, label: str = "seg", drop: bool = False) -> DataFrame:
    """One row for each token of a word; tokens is an array column. word_id numbers the words, token_id the tokens of a word.

    Tokens after a word's first continue its block: B becomes I. With drop they are left out. A word without tokens has no row.
    """
    rows = df.select("*", F.col("word_idx").alias("word_id"), F.posexplode(tokens).alias("token_id", "token"))
    if drop:
        return rows.where("token_id = 0")
    return rows.withColumn(label, F.when((F.col("token_id") > 0) & F.startswith(F.col(label), F.lit("B-")), F.concat(F.lit("I-"), F.substring(F.col(label), F.lit(3), F.length(label)))).otherwise(F.col(label)))


def detokenize(df: DataFrame) -> DataFrame:
    """The first token of each word, without the helper columns."""
    return df.where("token_id = 0").drop("word_id", "token_id", "token")


def first_and_last_page(df: DataFrame) -> DataFrame:
    """Words of the first and the last page of a document. Pages are compared as one row each."""
    ends = df.groupBy("fileid").agg(F.min("page").alias("__a"), F.max("page").alias("__b"))
    return df.join(ends, "fileid").where("page = __a OR page = __b").drop("__a", "__b")


def page_runs(df: DataFrame) -> DataFrame:
    """df with page_run: which page of its file, in reading order, a word is on, from 1.

    Pages of different files never merge, even where files follow one another with equal page numbers.
    """
    pages = df.groupBy("fileid", "page").agg(F.min("word_idx").alias("__first"))
    w = Window.partitionBy("fileid").orderBy("__first")
    return df.join(pages.withColumn("page_run", F.row_number().over(w)).drop("__first"), ["fileid", "page"])


def update_tags(new: DataFrame, old: DataFrame, keys: tuple[str, ...], label: str = "seg", last: Column | None = None) -> DataFrame:
    """new with its empty labels filled from old rows of equal keys, else O. Of several old rows the greatest by last counts."""
    known = old.groupBy(*keys).agg(F.max_by(label, F.col("word_idx") if last is None else last).alias("__old"))
    return new.join(known, list(keys), "left").withColumn(label, F.coalesce(F.nullif(F.col(label), F.lit("")), F.col("__old"), F.lit("O"))).drop("__old")


def lint_report(df: DataFrame, label: str = "seg") -> DataFrame:
    """(fileid, first_idx, page, type, text, first_line, last_line, n_faults) of the blocks with faults (of lint).

    Lines count from 2, as the first is the header, and by the words of blocks alone.
    """
    from tessellum.operators.scan import running_sum

    blocks = running_sum(group_blocks(df, label), F.col("n_words"), "__upto", "first_idx", "fileid")
    numbered = running_count(df.withColumn("__bio", split_label(F.col(label))[0]), F.col("__bio").isin("B", "O"), "bloc").select("fileid", "word_idx", "bloc")
    counts = lint(df, label).select("fileid", "word_idx").join(numbered, ["fileid", "word_idx"]).groupBy("fileid", "bloc").agg(F.count("*").alias("n_faults"))
    first = (F.col("__upto") - F.col("n_words") + 2).cast("bigint")
    return blocks.join(counts, ["fileid", "bloc"]).select("fileid", "first_idx", "page", "type", "text", first.alias("first_line"), (first + F.col("n_words")).alias("last_line"), "n_faults")
