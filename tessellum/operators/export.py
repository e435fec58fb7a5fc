"""Documents as JSON, and the registry of all documents of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.operators.structure import ancestor_paths, find_parents
from tessellum.schema import LEVELS


def elements_json(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """(doc, json): the elements of each document as nested objects, each with its children in sub, in order.

    Built from the deepest level up: the children of one parent are joined to one array, five times at most, as there are no
    more levels. A parent's children are in one row then, like in the result.
    """
    paths = ancestor_paths(df, order, doc).select(doc, order, (F.size("path") / 2).cast("int").alias("depth"))
    rows = find_parents(df, order, doc).join(paths, [doc, order])
    body = F.to_json(F.struct("type", F.coalesce("titre", F.lit("")).alias("titre"), F.coalesce("numero", F.lit("")).alias("numero"), "debut", "fin", "page"), {"ignoreNullFields": "false"})
    rows = rows.select(doc, F.col(order).alias("at"), "parent", "depth", F.substring(body, F.lit(1), F.length(body) - 1).alias("body"))
    below: DataFrame | None = None
    for depth in range(len(LEVELS) - 1, 0, -1):
        here = rows.where(F.col("depth") == depth)
        if below is None:
            whole = here.withColumn("json", F.concat("body", F.lit(',"sub":[]}')))
        else:
            whole = here.join(below.withColumnRenamed("parent", "at"), [doc, "at"], "left").withColumn("json", F.concat("body", F.lit(',"sub":['), F.coalesce("subs", F.lit("")), F.lit("]}")))
        below = whole.groupBy(doc, "parent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "json"))), lambda x: x["json"]), ",").alias("subs"))
    return below.select(doc, F.concat(F.lit("["), "subs", F.lit("]")).alias("json"))


def run_registry(docs: DataFrame, urls: DataFrame) -> DataFrame:
    """One row with the run's documents by file and the addresses its links led to, sorted, as JSON.

    docs has fileid, numero, titre, pdf; urls has url. Made for the list of documents of one run; it comes in one row.
    """
    entry = F.struct("fileid", F.struct("numero", "titre", "pdf"))
    listed = docs.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("docs"))
    seen = urls.where("url IS NOT NULL").select("url").distinct().agg(F.array_sort(F.collect_list("url")).alias("urls"))
    return listed.withColumn("k", F.lit(1)).join(seen.withColumn("k", F.lit(1)), "k").select(F.to_json(F.struct("docs", "urls")).alias("json"))


def write_pages(df: DataFrame, folder: str, path: str = "page_path", html: str = "html") -> None:
    """Write each page to a file of its path below a folder that all executors reach. A page written again is replaced."""

    def write(rows) -> None:
        import os

        for r in rows:
            if r[path] is None or r[html] is None:
                continue
            target = os.path.join(folder, r[path])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.{os.getpid()}.part"
            with open(part, "w", encoding="utf-8") as f:
                f.write(r[html])
            os.replace(part, target)

    df.select(path, html).foreachPartition(write)


def redirect_page(target: str) -> str:
    """A page that leads on to another."""
    return f'<!DOCTYPE html><html><head><meta http-equiv="refresh" content="0; url={target}"></head><body><a href="{target}">{target}</a></body></html>'


def pdf_link(url, page):
    """Column: a link to a page of the document's PDF; empty without an address."""
    return F.when(url.isNotNull(), F.concat(F.lit('<a target="_blank" href="'), url, F.lit("#page="), F.coalesce(page.cast("string"), F.lit("1")), F.lit('">PDF</a>'))).otherwise("")


def documents_json(documents: DataFrame, elements: DataFrame, blocks: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(fileid, json): whole documents with fileid, meta, paliers, contenu and pdfurl.

    documents has fileid and meta (of metadata), maybe pdf; elements those of analyse; blocks the contents, those of types that
    are no levels; links (fileid, first_idx, links). A document is one row then, like in the result.
    """
    from tessellum.schema import LEVELS as levels

    tree = elements_json(elements).select("fileid", F.col("json").alias("tree"))
    rows = blocks.where(~F.col("type").isin(*levels))
    rows = rows.join(links, ["fileid", "first_idx"], "left") if links is not None else rows.withColumn("links", F.lit(None).cast("array<struct<start:int,end:int,href:string>>"))
    block = F.to_json(F.struct("type", F.col("text").alias("contenu"), F.coalesce("links", F.array().cast("array<struct<start:int,end:int,href:string>>")).alias("liens"), F.array("x0", "top", "x1", "bottom").alias("_bbox"), F.col("page").alias("_page_number")), {"ignoreNullFields": "false"})
    contents = rows.groupBy("fileid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_idx", block.alias("json")))), lambda x: x["json"]), ",").alias("contents"))
    meta = F.coalesce(F.to_json("meta"), F.lit("{}"))
    pdf = F.coalesce(F.substring(F.to_json(F.array("pdf")), 2, 1 << 20), F.lit("null]")) if "pdf" in documents.columns else F.lit("null]")
    # The array's brackets go, so that an address is escaped as JSON wants it.
    address = F.regexp_replace(pdf, r"\]\z", "")
    head = F.substring(F.to_json(F.struct("fileid")), 2, 1 << 20)
    out = documents.join(tree, "fileid", "left").join(contents, "fileid", "left")
    return out.select("fileid", F.concat(F.lit("{"), F.regexp_replace(head, r"\}\z", ""), F.lit(',"meta":'), meta, F.lit(',"paliers":{"Document":'), F.coalesce("tree", F.lit("[]")), F.lit('},"contenu":['), F.coalesce("contents", F.lit("")), F.lit('],"pdfurl":'), address, F.lit("}")).alias("json"))


def downloads_json(files: DataFrame) -> DataFrame:
    """(json): name to address and time of change of the files of a download (name, url, modified), by name, as the list kept beside them."""
    part = F.struct("name", F.struct("url", "modified").alias("x"))
    return files.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(part)))).alias("json"))
