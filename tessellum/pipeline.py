"""The stages of a document's way, from labelled words to pages and an index, put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.operators import iob, links, render, structure
from tessellum.operators.scan import nearest, running_sum
from tessellum.schema import LEVELS
from tessellum.session import materialize


def analyse(words: DataFrame) -> dict[str, DataFrame]:
    """blocks, elements and documents of labelled words (of tidy_words). Each is written once, as later stages read it many times.

    elements has el_id, the place of the heading's first word, with number, title, debut (contents before it), fin, parent and
    path. documents has the number and title found in span labels, Document and '' where there are none.
    """
    grouped = materialize(iob.group_blocks(words), "blocks")
    numbered = structure.extract_numbers(grouped, "text", "first_idx", heading=F.col("type").isin(*LEVELS)).withColumnRenamed("numero_extrait", "numero")
    counted = materialize(running_sum(numbered, F.when(F.col("type").isin(*LEVELS), 0).otherwise(1), "debut", "first_idx", "fileid"), "blocks")
    heads = counted.where(F.col("type").isin(*LEVELS)).select("fileid", F.col("first_idx").alias("el_id"), "type", F.col("titre_nu").alias("titre"), "numero", F.col("debut").cast("int").alias("debut"), "page")
    placed = materialize(structure.find_parents(structure.close_intervals(heads)), "elements")
    elements = materialize(structure.ancestor_paths(placed).withColumnRenamed("fin_calcule", "fin"), "elements")
    meta = iob.metadata(iob.group_blocks(words, "span"))
    first = lambda k, default: F.coalesce(F.get(F.try_element_at("meta", F.lit(k)), F.lit(0)), F.lit(default))
    docs = words.select("fileid").distinct().join(meta, "fileid", "left").select("fileid", first("Titre", "Document").alias("t"), first("Numero", "").alias("n"), "meta")
    number, title = structure.document_title(F.col("t"))
    documents = docs.select("fileid", F.coalesce(number, F.col("n")).alias("numero"), title.alias("titre"), "meta")
    return {"blocks": counted.drop("debut"), "elements": elements, "documents": materialize(documents, "documents")}


def zone_pages(elements: DataFrame, documents: DataFrame) -> DataFrame:
    """(code, url) of the zones, by the first document called one of zonage that has any."""
    found = structure.zones(elements)
    named = documents.where(F.contains(F.lower("titre"), F.lit("zonage"))).select("fileid")
    first = found.join(named, "fileid", "left_semi").agg(F.min("fileid").alias("fileid"))
    return found.where("kind = 'milieu'").join(F.broadcast(first), "fileid", "left_semi").select("code", "url")


def resolve(refs: DataFrame, elements: DataFrame, documents: DataFrame) -> DataFrame:
    """refs (of references, with srcpath) with href: the address of the law that is cited, else the zone's page, else the by-law's or section's."""
    register = documents.select(F.col("fileid").alias("docpath"), "numero", "titre", F.col("fileid").alias("ord"))
    found = links.resolve_internal(refs.withColumn("cite", F.coalesce("alt", "quote")), register, elements, "cite")
    found = links.resolve_zone(found, zone_pages(elements, documents), "cite")
    return found.withColumn("href", F.coalesce(links.resolve_external(F.col("cite")), "zone_href", "href")).drop("zone_href")


def resolved_links(blocks: DataFrame, elements: DataFrame, documents: DataFrame) -> DataFrame:
    """(fileid, first_idx, links): the references in contents with the addresses they lead to from their document's page, in order."""
    contents = blocks.where(~F.col("type").isin(*LEVELS))
    refs = links.references(contents, "text", "fileid", "first_idx").withColumn("srcpath", F.lit("."))
    link = F.struct(F.col("start"), F.col("stop").alias("end"), "href")
    return resolve(refs, elements, documents).groupBy("fileid", "first_idx").agg(F.array_sort(F.collect_list(link)).alias("links"))


def pages(words: DataFrame) -> DataFrame:
    """(fileid, html): every document as one page with its references resolved."""
    parts = analyse(words)
    return render.document_html(parts["blocks"], resolved_links(parts["blocks"], parts["elements"], parts["documents"]))


def open_elements(blocks: DataFrame) -> DataFrame:
    """blocks with within, the places of the elements whose intervals hold a block, the highest first; a heading's own is its last."""
    at, lvl = F.col("first_idx"), structure.level(F.col("type"))
    names = [f"__last{k}" for k in range(len(LEVELS))]
    rows = nearest(blocks, {n: F.when(lvl == k, at) for k, n in enumerate(names)}, "first_idx", "fileid")
    last = [F.when(lvl == k, at).otherwise(F.col(n)) for k, n in enumerate(names)]
    # An element is open until the next one of its level or a higher one.
    still = [F.when(x > F.greatest(F.lit(-1), F.lit(-1), *last[:k]), x) for k, x in enumerate(last)]
    return rows.withColumn("within", F.array_compact(F.array(*still))).drop(*names)


#: Before the title, between it and the contents, and after them.
PAGE = ('<!DOCTYPE html>\n<html lang="fr"><head><meta charset="UTF-8"><title>', '</title></head><body><div class="container"><h1 id="header">', '</h1><div id="body">', "</div></div></body></html>\n")


def page_tree(words: DataFrame, addresses: DataFrame | None = None) -> DataFrame:
    """(page_path, html): the list of documents, each document as one page, a page for each of its elements with all below it,
    and the lists of elements.

    addresses has fileid and pdf; pages of documents that have one lead to it, those of elements to their page of it. Articles and annexes are listed by document, of the other types those right below the document. Of elements with one path
    the last counts.
    """
    parts = analyse(words)
    blocks, elements, documents = parts["blocks"], parts["elements"], parts["documents"]
    last = structure.page_paths(elements).groupBy("fileid", "page_path").agg(F.max("el_id").alias("on"), F.max_by("titre", "el_id").alias("name"), F.max_by("page", "el_id").alias("at_page"))
    whole = documents.select("fileid", F.concat("fileid", F.lit("/index.html")).alias("page_path"), F.lit(-1).cast("bigint").alias("on"), F.col("titre").alias("name"), F.lit(None).cast("int").alias("at_page"))
    # The file is passed through an expression, as Spark 4.1 may take a union of parts that are split alike for split itself.
    every = materialize(whole.unionByName(last.withColumn("fileid", F.concat("fileid", F.lit("")))), "page-list")
    inner = F.expr("substring(page_path, length(fileid) + 2, length(page_path) - length(fileid) - 12)")
    every = every.withColumn("srcpath", F.coalesce(F.nullif(inner, F.lit("")), F.lit(".")))
    placed = materialize(open_elements(render.outline_events(blocks)).withColumn("on", F.explode(F.concat(F.array(F.lit(-1).cast("bigint")), "within"))), "placed")
    rows = placed.join(every, ["fileid", "on"])
    contents = blocks.where(~F.col("type").isin(*LEVELS))
    refs = links.references(contents, "text", "fileid", "first_idx").join(rows.select("fileid", "first_idx", "on", "srcpath"), ["fileid", "first_idx"])
    link = F.struct(F.col("start"), F.col("stop").alias("end"), "href")
    linked = resolve(refs, elements, documents).groupBy("fileid", "on", "first_idx").agg(F.array_sort(F.collect_list(link)).alias("links"))
    own = F.col("first_idx") == F.col("on")
    back = F.when(F.col("srcpath") == ".", "img").otherwise(F.concat(F.repeat(F.lit("../"), F.size(F.split("srcpath", "/"))), F.lit("img")))
    body = render.nested_html(rows.where(F.col("shown") | own).join(linked, ["fileid", "on", "first_idx"], "left"), F.col("links"), ["fileid", "on"], own, back)
    addresses = words.sparkSession.createDataFrame([], "fileid string, pdf string") if addresses is None else addresses
    titled = structure.with_pdf(documents, addresses).select("fileid", F.col("titre").alias("doc_titre"), F.col("numero").alias("doc_numero"), "pdf")
    named = F.when(F.col("doc_titre") == "Document", F.col("name")).when(F.col("doc_numero") != "", F.concat("doc_numero", F.lit(" "), "doc_titre")).otherwise(F.col("doc_titre"))
    made = every.join(body, ["fileid", "on"], "left").join(titled, "fileid")
    address = F.when(F.col("at_page").isNull(), F.col("pdf")).otherwise(F.concat("pdf", F.lit("#page="), F.col("at_page").cast("string")))
    banner = F.concat(F.coalesce(named, F.lit("")), F.when(address.isNull(), "").otherwise(F.concat(F.lit(' (<a target="_blank" href="'), address, F.lit('">PDF</a>)'))))
    pages = made.select("page_path", wrapped(F.coalesce("name", F.lit("")), banner, F.coalesce("html", F.lit(""))).alias("html"))
    return pages.union(section_pages(elements, documents)).union(documents_page(elements, documents, addresses))


def documents_page(elements: DataFrame, documents: DataFrame, addresses: DataFrame) -> DataFrame:
    """(page_path, html): the one list of all documents, above their folders."""
    linked = structure.with_pdf(documents.drop("page"), addresses)
    title = F.lit("Règlements")
    listed = structure.documents_list(linked, structure.outline_html(elements))
    return listed.select(F.lit("index.html").alias("page_path"), wrapped(title, title, F.col("html")).alias("html"))


def section_pages(elements: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_path, html): the lists of a document's articles and annexes, and of the elements of other types right below it."""
    listed = elements.where(F.col("type").isin("Article", "Annexe") | F.col("parent").isNull())
    title, number = F.coalesce("titre", F.lit("")), F.coalesce("numero", F.lit(""))
    unknown = F.startswith(number, F.lit("_"))
    shown = F.when(title != "", title).otherwise(F.concat("type", F.when(unknown, F.lit(" (numéro inconnu)")).otherwise(F.concat(F.lit(" "), number))))
    item = F.concat(F.lit("<li>"), F.when(unknown, "").otherwise(F.concat(F.lit('<span class="number">'), number, F.lit("</span>"))), F.lit('<a href="'), number, F.lit('/index.html" class="title">'), shown, F.lit("</a></li>"))
    lists = listed.groupBy("fileid", "type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("el_id", item.alias("html")))), lambda x: x["html"]), "").alias("items"))
    doc = documents.select("fileid", F.when(F.col("titre") == "Document", F.col("fileid")).otherwise(F.col("titre")).alias("doc_titre"))
    name = F.concat("doc_titre", F.lit(": "), "type", F.lit("s"))
    return lists.join(doc, "fileid").select(F.concat_ws("/", "fileid", "type", F.lit("index.html")).alias("page_path"), wrapped(name, name, F.concat(F.lit("<ul>"), "items", F.lit("</ul>"))).alias("html"))


def wrapped(title: Column, banner: Column, body: Column) -> Column:
    """A whole page."""
    return F.concat(F.lit(PAGE[0]), title, F.lit(PAGE[1]), banner, F.lit(PAGE[2]), body, F.lit(PAGE[3]))


def search_documents(elements: DataFrame, blocks: DataFrame, addresses: DataFrame | None = None) -> DataFrame:
    """(ref, url, titre, texte, and pdf where addresses has fileid and pdf): each element with all contents of its interval, those of the elements below it too, to be indexed."""
    contents = open_elements(blocks).where(F.col("type").isin(*[t for t, tag in render.BLOCK_TAGS.items() if tag]))
    inside = contents.select("fileid", F.explode("within").alias("el_id"), "first_idx", "text")
    texts = inside.groupBy("fileid", "el_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_idx", "text"))), lambda x: x["text"]), "\n\n").alias("texte"))
    e = structure.page_paths(elements)
    title = structure.display_title(F.col("type"), F.col("numero"), F.col("titre"))
    rows = e.join(texts, ["fileid", "el_id"], "left")
    pdf = ["pdf"] if addresses is not None else []
    rows = structure.with_pdf(rows, addresses) if pdf else rows
    return rows.select(F.xxhash64("fileid", "el_id").alias("ref"), F.col("page_path").alias("url"), title.alias("titre"), F.coalesce("texte", F.lit("")).alias("texte"), *pdf)
