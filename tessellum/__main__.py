"""python -m tessellum COMMAND: the stages over folders of word CSV files."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum import pipeline
from tessellum.operators import crf, export, iob, objects, search, structure
from tessellum.operators.words import select_pages, tidy_words
from tessellum.sources import fetch, files


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tessellum", description=__doc__)
    sub = out.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, model: bool = False, words: bool = True) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        if words:
            p.add_argument("words", help="CSV files of words, or a folder of them")
        if model:
            p.add_argument("model", help="file of a trained chain")
        p.add_argument("out", help="folder or file to write")
        return p

    train = add("train", "train a chain on labelled words")
    train.add_argument("--label", default="seg", choices=("seg", "span"))
    train.add_argument("--features", default="text+layout+structure")
    train.add_argument("--pages", type=int, default=300)
    add("segment", "label blocks", model=True).add_argument("--pages", type=int, nargs="*")
    add("label", "label titles and numbers on first and last pages", model=True)
    add("html", "documents as HTML")
    add("json", "documents as JSON").add_argument("--documents", help="JSON file of documents by name, with their addresses")
    add("extract", "documents, their elements and lists of these as a folder of pages").add_argument("--documents", help="JSON file of documents by name, with their addresses")
    convert = sub.add_parser("convert", help="words of PDF files as CSV, by a parser that is named")
    convert.add_argument("pdf", help="PDF files, or a folder of them")
    convert.add_argument("out", help="folder to write")
    convert.add_argument("--parser", required=True, help="module:function of (path, bytes) that gives rows of words")
    convert.add_argument("--pages", type=int, nargs="*")
    download = sub.add_parser("download", help="fetch the files that a page lists and that are new")
    download.add_argument("page", help="a page of links, saved as HTML")
    download.add_argument("out", help="folder that all executors share; its list of files is index.json")
    download.add_argument("--url", required=True, help="the address of the page")
    download.add_argument("--section", help="take the lists under headings like this")
    download.add_argument("--exclude", nargs="*", default=[], help="patterns of addresses to leave out")
    download.add_argument("--extensions", nargs="*", default=[".pdf"])
    add("annotate", "rectangles to draw on pages, as CSV")
    add("index", "an index of the elements, as a folder of tables").add_argument("--documents", help="JSON file of documents by name, with their addresses")
    find = sub.add_parser("search", help="search an index")
    find.add_argument("index")
    find.add_argument("terms", nargs="+")
    find.add_argument("-n", type=int, default=10)
    find.add_argument("-v", "--ville", default=None)
    return out


def known_documents(spark: SparkSession, path: str | None) -> DataFrame:
    """(fileid, pdf) of a JSON file of documents by name; none without a file."""
    if not path:
        return spark.createDataFrame([], "fileid string, pdf string")
    rows = files.document_urls(spark.read.text(path, wholetext=True))
    return rows.select(F.regexp_replace("name", r"(?i)\.pdf\z", "").alias("fileid"), F.col("url").alias("pdf"))


def labelled(words: DataFrame, found: DataFrame, column: str) -> DataFrame:
    return words.drop(column).join(found.withColumnRenamed("predicted", column), ["fileid", "page", "word_idx"])


def run(args: argparse.Namespace, spark: SparkSession) -> DataFrame | None:
    """Run one command; search gives its hits."""
    if args.command == "search":
        asked = spark.createDataFrame([(0, " ".join(args.terms))], "query_id int, q string")
        return search.search_index(search.read_index(spark, args.index), asked, args.ville, args.n, syntax=True).orderBy("hit_rank").select("url", "titre", "pdf", "score")
    if args.command == "convert":
        made = files.read_pdfs(spark, files.named_parser(args.parser), args.pdf)
        files.write_words(select_pages(made, args.pages).drop("page_rank") if args.pages else made, args.out)
        return None
    if args.command == "download":
        fetch.download(spark, args.page, args.url, args.out, args.section, tuple(args.exclude), tuple(args.extensions))
        return None
    raw = files.read_words(spark, args.words)
    words = tidy_words(raw)
    if args.command == "train":
        kind = "label" if args.label == "span" else args.features
        crf.save(crf.train(words, args.label, kind, max_pages=args.pages), args.out)
    elif args.command == "segment":
        chosen = select_pages(raw, args.pages).drop("page_rank") if args.pages else raw
        files.write_words(labelled(chosen, crf.label_pages(tidy_words(chosen), crf.load(args.model)), "segment"), args.out)
    elif args.command == "label":
        files.write_words(labelled(raw, crf.label_ends(words, crf.load(args.model)), "sequence"), args.out)
    elif args.command == "html":
        pipeline.pages(words).write.mode("overwrite").parquet(args.out)
    elif args.command == "extract":
        export.write_pages(pipeline.page_tree(words, known_documents(spark, args.documents)), args.out)
    elif args.command == "json":
        parts = pipeline.analyse(words)
        found = pipeline.resolved_links(parts["blocks"], parts["elements"], parts["documents"])
        whole = export.documents_json(structure.with_pdf(parts["documents"], known_documents(spark, args.documents)), parts["elements"], parts["blocks"], found)
        whole.write.mode("overwrite").json(args.out)
    elif args.command == "annotate":
        sizes = words.groupBy("fileid", "page").agg(F.min("page_height").alias("page_height"))
        objects.annotations(iob.group_blocks(words).join(sizes, ["fileid", "page"])).write.mode("overwrite").csv(args.out, header=True)
    elif args.command == "index":
        parts = pipeline.analyse(words)
        search.write_index(pipeline.search_documents(parts["elements"], parts["blocks"], known_documents(spark, args.documents)), args.out)
    return None


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tessellum").getOrCreate()
    if (hits := run(args, spark)) is not None:
        for r in hits.toLocalIterator():
            print(f"{r['score']:.4f}\t{r['url']}\t{r['pdf'] or ''}\t{r['titre']}")


if __name__ == "__main__":
    main(sys.argv[1:])
