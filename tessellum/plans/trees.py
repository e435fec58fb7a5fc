"""Queries over tag trees, pictures, lists of documents and what else is put together from several tables; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.operators import export, iob, metrics, objects, structure
from tessellum.operators.words import numbered
from tessellum.plans import document, outline
from tessellum.plans.registry import Registry
from tessellum.tables import table

query = Registry(words=document.WORDS, blocks=document.sql_blocks("seg"), els=outline.ELEMENTS, paths=outline.PATHS, title=outline.TITLE)


def tag_tree(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, marks and words of the tag trees that the words' tag stacks tell of: a branch for each content mark."""
    words = document.tidy(spark, d).where("mcid IS NOT NULL AND tagstack IS NOT NULL AND tagstack != ''")
    stacks = words.groupBy("fileid", "mcid").agg(F.max("tagstack").alias("tagstack"), F.min("page").alias("page"))
    branch = stacks.select("fileid", "mcid", "page", F.posexplode(F.split("tagstack", ";")).alias("k", "tag"), F.size(F.split("tagstack", ";")).alias("n"))
    name = lambda k: F.concat_ws(":", F.col("mcid").cast("string"), k.cast("string"))
    box = F.when(F.col("mcid") % 5 == 0, F.array(F.lit(10.0), F.lit(20.0), F.lit(110.0) + F.col("mcid"), F.lit(220.0)))
    nodes = branch.select("fileid", name(F.col("k")).alias("node"), F.when(F.col("k") > 0, name(F.col("k") - 1)).alias("parent"), "tag", box.alias("box"))
    marks = words.select("fileid", "page", "mcid").distinct().join(stacks.select("fileid", "mcid", F.size(F.split("tagstack", ";")).alias("n")), ["fileid", "mcid"])
    return nodes, marks.select("fileid", name(F.col("n") - 1).alias("node"), "page", "mcid"), words


@query(
    """WITH {words}, marked AS (SELECT * FROM words WHERE mcid IS NOT NULL AND tagstack <> ''), stacks AS (SELECT fileid, mcid, string_split(max(tagstack), ';') AS s FROM marked GROUP BY ALL),
  outer_ AS (SELECT fileid, mcid, list_filter(s, lambda t: t IN ('Table', 'Figure'))[1] AS tag, list_min(list_filter([list_position(s, 'Table'), list_position(s, 'Figure')], lambda x: x > 0)) - 1 AS k FROM stacks),
  heights AS (SELECT fileid, page, min(page_height) AS h FROM words GROUP BY ALL),
  hulls AS (SELECT o.fileid, w.page, o.mcid, o.k, o.tag, min(w.x0) AS x0, min(w.top) AS top, max(w.x1) AS x1, max(w.bottom) AS bottom FROM outer_ o JOIN marked w USING (fileid, mcid) WHERE o.tag IS NOT NULL GROUP BY ALL)
  SELECT u.fileid, u.page, mcid || ':' || k AS node, CASE tag WHEN 'Table' THEN 'Tableau' ELSE tag END AS type, CASE WHEN mcid % 5 = 0 THEN 10 ELSE x0 END AS x0, CASE WHEN mcid % 5 = 0 THEN h - 220 ELSE top END AS top, CASE WHEN mcid % 5 = 0 THEN 110 + mcid ELSE x1 END AS x1, CASE WHEN mcid % 5 = 0 THEN h - 20 ELSE bottom END AS bottom
  FROM hulls u JOIN heights s ON s.fileid = u.fileid AND s.page = u.page"""
)
def tree_objects(spark, d):
    nodes, marks, words = tag_tree(spark, d)
    sizes = document.tidy(spark, d).groupBy("fileid", "page").agg(F.min("page_height").alias("page_height"))
    return objects.tree_objects(nodes, marks, words, sizes)


@query(
    """WITH {words}, {blocks}, sized AS (SELECT b.*, s.w, s.h FROM blocks b JOIN (SELECT fileid, page, min(page_width) AS w, min(page_height) AS h FROM words GROUP BY ALL) s USING (fileid, page) WHERE type IN ('Tableau', 'Figure')),
  cut_boxes AS (SELECT fileid, page, first_idx, greatest(x0 - 20, 0) AS x0, greatest(top - 20, 0) AS top, least(x1, w) AS x1, least(bottom, h) AS bottom, 'page' || page || '-' || concat_ws(',', x0 - 20, top - 20, x1, bottom) || '.jpg' AS img FROM sized)
  SELECT fileid, page, count(*) AS n, string_agg(img, ' ' ORDER BY first_idx) AS pictures FROM cut_boxes WHERE x1 > x0 AND bottom > top GROUP BY ALL"""
)
def page_pictures(spark, d):
    """Pictures by page; their boxes are wider to the left and the top, so that some go over the page's edge."""
    words = document.tidy(spark, d)
    sizes = words.groupBy("fileid", "page").agg(F.min("page_width").alias("page_width"), F.min("page_height").alias("page_height"))
    wider = iob.group_blocks(words).withColumns({"x0": F.col("x0") - 20, "top": F.col("top") - 20})
    return objects.page_pictures(wider.join(sizes, ["fileid", "page"]))


@query("WITH {words} SELECT label, CAST(row_number() OVER (ORDER BY CASE WHEN contains(label, '-') THEN regexp_replace(label, '^[^-]*-', '') ELSE '' END, split_part(label, '-', 1)) AS INTEGER) AS place FROM (SELECT DISTINCT seg AS label FROM words)")
def label_sort(spark, d):
    """The labels that occur, by type, then prefix."""
    labels = document.tidy(spark, d).select(F.col("seg").alias("label")).distinct()
    ranked = labels.agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(metrics.label_order(F.col("label")))], "label"))).alias("x"))
    return ranked.select(F.posexplode("x").alias("at", "x")).select("x.label", (F.col("at") + 1).alias("place"))


@query("WITH {els} SELECT fileid, type, count(*) AS n, string_agg(coalesce(numero, '') || '@' || debut, ' ' ORDER BY el_id) AS elements FROM els GROUP BY ALL")
def paliers(spark, d):
    """The elements of each level of a document in order."""
    one = lambda x: F.concat(F.coalesce(x["numero"], F.lit("")), F.lit("@"), x["debut"])
    return structure.by_level(outline.tidy(spark, d)).withColumn("elements", F.array_join(F.transform("elements", one), " "))


@query("WITH {els}, docs AS (SELECT fileid, max(pdf) AS pdf FROM bylaws GROUP BY fileid) SELECT e.fileid, e.el_id, d.pdf || '#page=' || coalesce(CAST(e.page AS VARCHAR), '1') AS pdf, CASE WHEN d.pdf IS NULL THEN '' ELSE '<a target=\"_blank\" href=\"' || d.pdf || '#page=' || coalesce(CAST(e.page AS VARCHAR), '1') || '\">PDF</a>' END AS link FROM els e LEFT JOIN docs d USING (fileid)")
def element_pdf(spark, d):
    """The address and the link of each element's page in its document's PDF."""
    docs = table(spark, d, "bylaws").select("fileid", "pdf")
    rows = structure.with_pdf(outline.tidy(spark, d), docs)
    return rows.select("fileid", "el_id", "pdf", export.pdf_link(F.regexp_replace("pdf", "#page=.*$", ""), F.col("page")).alias("link"))


@query(
    """WITH {paths}, deep AS (SELECT *, CAST(len(path) / 2 AS INTEGER) AS depth, {title} AS label FROM paths), looked AS (SELECT *, coalesce(lead(depth) OVER (PARTITION BY fileid ORDER BY el_id), 1) AS nxt,
    '<a href="' || fileid || '/' || array_to_string(CASE WHEN type IN ('Article', 'Annexe') THEN [type, coalesce(numero, '')] ELSE path END, '/') || '/index.html">' || label || '</a>' AS link FROM deep),
  marked AS (SELECT *, CASE WHEN nxt <= depth THEN '<li class="leaf ' || type || '">' || link || '</li>' ELSE '<li class="node ' || type || '"><details><summary>' || label || '</summary><ul><li>' || link || '</li>' END || repeat('</ul></details></li>', greatest(depth - nxt, 0)) AS html FROM looked),
  outlines AS (SELECT fileid, string_agg(html, '' ORDER BY el_id) AS html FROM marked GROUP BY fileid),
  docs AS (SELECT fileid, max(numero) AS numero, max(titre) AS titre, max(pdf) AS pdf FROM bylaws WHERE fileid IS NOT NULL GROUP BY fileid),
  named AS (SELECT *, CASE WHEN coalesce(numero, '') = '' THEN coalesce(titre, '') ELSE numero || ': ' || coalesce(titre, '') END AS name FROM docs),
  entries AS (SELECT n.fileid, array_to_string(list_transform(regexp_extract_all(name, '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 20, '0') ELSE x END), '') AS k,
    '<li class="node Document"><details id="' || n.fileid || '"><summary>' || name || '</summary><ul><li class="text"><a target="_blank" href="' || n.fileid || '/index.html">Texte intégral</a>' || CASE WHEN pdf IS NULL THEN '' ELSE ' (<a target="_blank" href="' || pdf || '">PDF</a>)' END || '</li>' || coalesce(html, '') || '</ul></details></li>' AS entry FROM named n LEFT JOIN outlines o USING (fileid))
  SELECT '<ul id="body">' || string_agg(entry, '' ORDER BY k COLLATE "C", fileid COLLATE "C", entry) || '</ul>' AS html FROM entries"""
)
def documents_list(spark, d):
    """The one list of all documents."""
    docs = table(spark, d, "bylaws").where("fileid IS NOT NULL").groupBy("fileid").agg(*[F.max(c).alias(c) for c in ("numero", "titre", "pdf")])
    return structure.documents_list(docs, structure.outline_html(outline.tidy(spark, d)))


@query(
    """WITH {words}, {blocks}, lines AS (SELECT *, CAST(coalesce(sum(n_words) OVER (PARTITION BY fileid ORDER BY first_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + 2 AS first_line FROM blocks),
  seen AS (SELECT *, lag(bio) OVER (PARTITION BY fileid, page ORDER BY word_idx) AS was_bio, lag(name) OVER (PARTITION BY fileid, page ORDER BY word_idx) AS was FROM opened),
  faults AS (SELECT fileid, b FROM seen WHERE (bio = 'I' AND name <> '' AND was_bio IN ('B', 'I') AND was <> '' AND was <> name) OR (seg = 'I-Liste' AND regexp_matches(text, '^(?:[0-9]+[).°]|[a-zA-Z][).]|[•-])$')))
  SELECT fileid, first_idx, page, type, text, first_line, first_line + n_words AS last_line, n_faults FROM lines JOIN (SELECT fileid, b AS bloc, count(*) AS n_faults FROM faults GROUP BY ALL) USING (fileid, bloc)"""
)
def lint_report(spark, d):
    """The blocks with faults and the lines of the word file they are on."""
    return iob.lint_report(document.tidy(spark, d))


@query("SELECT url, row_number() OVER (ORDER BY url COLLATE \"C\") - 1 AS ref FROM (SELECT DISTINCT url FROM index_docs WHERE url IS NOT NULL)")
def numbered_pages(spark, d):
    """The pages to be indexed with running numbers."""
    pages = table(spark, d, "index_docs").where("url IS NOT NULL").select("url").distinct()
    return numbered(pages, ["url"])


@query("WITH {words}, {blocks}, {els}, docs AS (SELECT DISTINCT fileid FROM words UNION SELECT DISTINCT fileid FROM els) SELECT fileid, (SELECT count(*) FROM els e WHERE e.fileid = d.fileid) AS n_elements, (SELECT count(*) FROM blocks b WHERE b.fileid = d.fileid AND b.type NOT IN ('Annexe', 'Chapitre', 'Section', 'SousSection', 'Article')) AS n_blocks, (SELECT arg_min(text, first_idx) FROM blocks b WHERE b.fileid = d.fileid AND b.type NOT IN ('Annexe', 'Chapitre', 'Section', 'SousSection', 'Article')) AS first_text, 'a\"b' AS pdf FROM docs d")
def document_json(spark, d):
    """Whole documents as JSON, read back: their elements and blocks counted, and the first block's text."""
    els, blocks = outline.tidy(spark, d), iob.group_blocks(document.tidy(spark, d))
    docs = blocks.select("fileid").union(document.tidy(spark, d).select("fileid")).union(els.select("fileid")).distinct().withColumns({"meta": F.lit(None).cast("map<string,array<string>>"), "pdf": F.lit('a"b')})
    rows = export.documents_json(docs, els, blocks).select("fileid", "json")
    n = F.size(F.regexp_extract_all(F.get_json_object("json", "$.paliers"), F.lit('"type":'), F.lit(0)))
    parsed = F.from_json(F.get_json_object("json", "$.contenu"), "array<struct<type:string,contenu:string>>")
    return rows.select("fileid", n.cast("bigint").alias("n_elements"), F.size(parsed).cast("bigint").alias("n_blocks"), F.get(parsed, F.lit(0))["contenu"].alias("first_text"), F.get_json_object("json", "$.pdfurl").alias("pdf"))


def queries() -> dict[str, object]:
    return query.queries


def oracle_sql() -> dict[str, str]:
    return query.sql
