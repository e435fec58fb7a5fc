"""Readers and writers of word files, record files and folders of pages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.schema import WORD_COLUMNS, WORD_INTS

# The columns whose missing values are written as empty strings.
BLANK_COLUMNS = ("mcid", "sequence", "segment", "fontname", "tagstack")
WORDS = "path string, fileid string, word_idx bigint, " + ", ".join(f"{c} {'int' if c in WORD_INTS else 'string'}" for c in WORD_COLUMNS)


def whole(text: str | None) -> int | None:
    """The whole number of 32 bits that a field stands for, with one sign at most; null for anything else."""
    digits = (text or "").strip()
    unsigned = digits[1:] if digits[:1] in ("-", "+") else digits
    if not unsigned.isdecimal() or len(unsigned) > 4000:
        return None
    n = int(digits)
    return n if -(1 << 31) <= n < 1 << 31 else None


def parse_files(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over (path, content): the rows of each CSV file with their place in it."""
    import csv
    import io

    names = [c.split()[0] for c in WORDS.split(", ")]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            reader = csv.DictReader(io.StringIO(bytes(content).decode("utf-8-sig"), newline=""))
            file = path.rsplit("/", 1)[-1]
            stem = file[: -len(".csv")] if file.lower().endswith(".csv") else file
            rows = []
            for k, row in enumerate(reader):
                value = lambda c, row=row: whole(row.get(c)) if c in WORD_INTS else row.get(c)
                rows.append((path, stem, k, *[value(c) for c in WORD_COLUMNS]))
                if len(rows) >= 50_000:
                    yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in WORD_INTS})
                    rows = []
            yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in WORD_INTS})


def read_words(spark: SparkSession, *paths: str) -> DataFrame:
    """The words of CSV files or folders of them, each file read whole by one task so that word_idx is the place in it.

    Columns that a file lacks are null, others are left out; a mark at the file's start is skipped. Files are spread over
    tasks by size. The reader needs the header line.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path", "content").mapInPandas(parse_files, WORDS)


def write_words(df: DataFrame, path: str) -> None:
    """The word columns as CSV files with a header, in order of file and place; other columns are left out."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in BLANK_COLUMNS else F.col(c) for c in WORD_COLUMNS]
    df.repartitionByRange("fileid", "word_idx").sortWithinPartitions("fileid", "word_idx").select(*blank).write.mode("overwrite").option("emptyValue", "").csv(path, header=True)


def hex_digit(v: Column) -> Column:
    return F.lower(F.hex(F.floor(F.least(v, F.lit(0.999)) * 16).cast("int")))


def colour(components: Column) -> Column:
    """A colour's components, from 0 to 1, as #rgb or #rgba; one component is a grey, none or another number is black."""
    n = F.size(components)
    digits = F.array_join(F.transform(components, hex_digit), "")
    return F.when(components.isNull() | (n == 0), "#000").when(n == 1, F.concat(F.lit("#"), F.repeat(hex_digit(components[0]), 3))).when(n.isin(3, 4), F.concat(F.lit("#"), digits)).otherwise("#000")


def describe_words(words: DataFrame, chars: DataFrame, tags: DataFrame) -> DataFrame:
    """Words with what their first character tells: colour, content mark and its tags, font; places rounded to whole points.

    chars has fileid, page, char_idx, x0, top, colour, mcid, mctag, fontname; the last of characters at one place counts. tags has
    fileid, mcid, tagstack. Rounding is half to even. Words whose place no character has get empty strings, but no rgb or mctag.
    """
    key = ["fileid", "page", "x0", "top"]
    last = chars.groupBy(*key).agg(F.max_by(F.struct("colour", "mcid", "mctag", "fontname"), "char_idx").alias("c"))
    rows = words.join(last, key, "left").withColumns({"rgb": F.when(F.col("c").isNotNull(), colour(F.col("c.colour"))), "mcid": F.col("c.mcid"), "mctag": F.col("c.mctag"), "fontname": F.coalesce(F.col("c.fontname"), F.lit(""))}).drop("c")
    out = rows.join(tags, ["fileid", "mcid"], "left").withColumn("tagstack", F.coalesce("tagstack", F.lit("")))
    return out.withColumns({c: F.bround(F.col(c)).cast("int") for c in ("x0", "x1", "top", "bottom", "doctop", "page_width", "page_height") if c in out.columns})


def read_pdfs(spark: SparkSession, parser, *paths: str) -> DataFrame:
    """Words of PDF files by a parser of (path, bytes) into words as dicts, in reading order; no parser comes with the library.

    What a word lacks is null; path, fileid (the file's name) and word_idx (the place) are filled in where the parser gives none.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(list(paths))
    names = [c.split()[0] for c in WORDS.split(", ")]

    def frame(rows: list[dict]) -> pd.DataFrame:
        columns = {c: [r.get(c) for r in rows] for c in names}
        return pd.DataFrame({c: pd.array(v, dtype="Int64") if c in WORD_INTS else pd.Series(v, dtype=object) for c, v in columns.items()})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                stem, rows = path.rsplit("/", 1)[-1][: -len(".pdf")], []
                for k, word in enumerate(parser(path, bytes(content))):
                    rows.append({"path": path, "fileid": stem, "word_idx": k} | dict(word))
                    if len(rows) >= 50_000:
                        yield frame(rows)
                        rows = []
                yield frame(rows)

    return files.select("path", "content").mapInPandas(run, WORDS)


def read_images(spark: SparkSession, *paths: str) -> DataFrame:
    """Blocks from JSON files, each an array of them: path, type, page, text, links and the box.

    The text is of the block's words. A block without a box or page of its own has the hull and the page of its words.
    """
    word = "struct<text:string,page:int,x0:double,top:double,x1:double,bottom:double>"
    schema = f"type string, _page_number int, _bbox array<double>, contenu array<{word}>, liens array<struct<start:int,`end`:int,href:string,alt:string>>"
    rows = spark.read.schema(schema).json(list(paths), multiLine=True).select(F.col("_metadata.file_path").alias("path"), "*")
    of_words = lambda c, most: (F.array_max if most else F.array_min)(F.transform("contenu", lambda w: w[c]))
    box = [F.bround(F.coalesce(F.get("_bbox", F.lit(i)), of_words(c, i > 1))).cast("int").alias(c) for i, c in enumerate(("x0", "top", "x1", "bottom"))]
    text = F.array_join(F.transform(F.coalesce("contenu", F.array().cast(f"array<{word}>")), lambda w: w["text"]), " ")
    return rows.select("path", "type", F.coalesce("_page_number", F.get("contenu", F.lit(0))["page"]).alias("page"), text.alias("text"), "liens", *box)


def document_urls(text: DataFrame, column: str = "value") -> DataFrame:
    """(name, url, modified) of JSON objects of documents by name; names with %20 are also given with spaces."""
    parsed = text.select(F.explode(F.from_json(column, "map<string,struct<url:string,modified:string>>")).alias("name", "x"))
    rows = parsed.select("name", "x.url", "x.modified")
    return rows.unionByName(rows.where(F.contains("name", F.lit("%20"))).withColumn("name", F.replace("name", F.lit("%20"), F.lit(" "))))


def named_parser(name: str):
    """The function that module:function names."""
    import importlib

    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)
