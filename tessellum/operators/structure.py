"""The outline of documents: numbers of headings, intervals, parents, paths, titles, zones, tables of contents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.operators.scan import nearest, running_sum
from tessellum.schema import LEVELS
from tessellum.session import materialize

# How the numbers of headings are written. S is white space of any kind, D a digit.
S, D = r"[\s\p{Z}\x85]", r"\p{Nd}"
AFTER_NUMBER = rf"(?:\.|{S}*[:—–-]| )"
HEADING_WORD = "(?:article|chapitre|section|sous-section|titre|annexe)"
#: Leading number: group 1 dotted, 2 whole, 3 a letter or Roman; it must be followed by a separator there.
LEADING = rf"^(?:(?i:{HEADING_WORD}))?{S}*(?:((?:{D}+\.)+{D}+){AFTER_NUMBER}?|({D}+){AFTER_NUMBER}?|([A-Z]|[XIV]+){AFTER_NUMBER}){S}*"
#: Trailing number, group 2, after group 1.
TRAILING = rf"(?s)^((?:.*[^\p{{L}}\p{{N}}_])?)({D}+){AFTER_NUMBER}{S}*\z"
BY_NUMBER = r"(?i:num[ée]ro)\s+([0-9][A-Z0-9-]+)"
BY_WORD = r"(?i:r[èe]glement)\s+([0-9][A-Z0-9-]+)"
AT_END = r"^.*?(\b[0-9]+-[0-9]+-[A-Z]+)\z"


def level(kind: Column) -> Column:
    """0 for a document to 5 for an article; null for other types."""
    return F.try_element_at(F.create_map(*[x for k, t in enumerate(LEVELS) for x in (F.lit(t), F.lit(k))]), kind)


def extract_numbers(df: DataFrame, titre: str = "titre", order: str = "el_id", doc: str = "fileid", heading: Column | None = None) -> DataFrame:
    """df with numero and the title without it: a leading number, else a trailing one, else _k, where k counts the document's such headings.

    The word for the type may be left out, so A priori has the number A. Null titles are numbered like empty ones. Rows for
    which the condition heading doesn't hold get nulls and don't count.
    """
    counts = F.lit(True) if heading is None else F.coalesce(heading, F.lit(False))
    t = F.coalesce(F.col(titre), F.lit(""))
    lead, trail = F.regexp_extract(t, LEADING, 0), F.regexp_extract(t, TRAILING, 2)
    number = F.when(lead != "", F.concat(*[F.regexp_extract(t, LEADING, g) for g in (1, 2, 3)])).when(trail != "", trail)
    rest = F.when(lead != "", F.substring(t, F.length(lead) + 1, F.length(t))).when(trail != "", F.regexp_extract(t, TRAILING, 1)).otherwise(t)
    rows = df.withColumns({"__n": number, "titre_nu": rest})
    rows = running_sum(rows, F.when(counts & F.col("__n").isNull(), 1).otherwise(0), "__unknown", order, doc)
    made = F.concat(F.lit("_"), (F.col("__unknown") - 1).cast("string"))
    return rows.withColumns({"numero_extrait": F.when(counts, F.coalesce("__n", made)), "titre_nu": F.when(counts, F.col("titre_nu"))}).drop("__n", "__unknown")


def close_intervals(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """df with fin_calcule, the start of the next element of the same or a higher level, -1 where none follows."""
    lvl = level(F.col("type"))
    rows = nearest(df, {f"__next{k}": F.when(lvl <= k, F.col("debut")) for k in range(len(LEVELS))}, order, doc, after=True)
    ends = [F.when(lvl == k, F.col(f"__next{k}")) for k in range(len(LEVELS))]
    return rows.withColumn("fin_calcule", F.coalesce(*ends, F.lit(-1))).drop(*[f"__next{k}" for k in range(len(LEVELS))])


def find_parents(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """df with parent: the order of the last element before of a higher level, null under the document itself."""
    lvl = level(F.col("type"))
    rows = nearest(df, {f"__up{k}": F.when(lvl < k, F.col(order)) for k in range(1, len(LEVELS))}, order, doc)
    parents = [F.when(lvl == k, F.col(f"__up{k}")) for k in range(1, len(LEVELS))]
    return rows.withColumn("parent", F.coalesce(*parents)).drop(*[f"__up{k}" for k in range(1, len(LEVELS))])


def ancestor_paths(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """df with path: the type and number of each ancestor from the top, as an array, then its own.

    Levels rise by one a step at least, so an element has at most five ancestors below the document. Each is the last
    element before of its level that no higher one has closed: windows again, no join.
    """
    step = F.struct(F.col(order).alias("at"), F.col("__lvl").alias("lvl"), F.array("type", F.coalesce("numero", F.lit(""))).alias("name"))
    rows = df.withColumn("__lvl", level(F.col("type")))
    names = [f"__last{k}" for k in range(1, len(LEVELS))]
    rows = nearest(rows, {n: F.when(F.col("__lvl") == k, step) for k, n in enumerate(names, 1)}, order, doc)
    rows = rows.withColumn("__last", F.array(*names)).drop(*names)

    def up(acc: Column, x: Column) -> Column:
        """From the lowest level up: an element is an ancestor if it stands before every lower one taken and is of a higher level."""
        take = x.isNotNull() & (x["lvl"] < acc["lvl"]) & (x["at"] < acc["at"])
        return F.struct(F.when(take, x["at"]).otherwise(acc["at"]).alias("at"), F.when(take, x["lvl"]).otherwise(acc["lvl"]).alias("lvl"), F.when(take, F.concat(x["name"], acc["names"])).otherwise(acc["names"]).alias("names"))

    # The nearest open ancestor is the latest of a higher level, so candidates are taken from the latest to the first.
    by_time = F.reverse(F.array_sort(F.filter("__last", lambda x: x.isNotNull())))
    start = F.struct(F.col(order).alias("at"), F.col("__lvl").alias("lvl"), F.array("type", F.coalesce("numero", F.lit(""))).alias("names"))
    return rows.withColumn("path", F.aggregate(by_time, start, up, lambda acc: acc["names"])).drop("__lvl", "__last")


def document_title(titre: Column) -> tuple[Column, Column]:
    """(number, title) of a document from its title: after the word number, after the word by-law, or at its end; else null."""
    first = [F.regexp_extract(titre, p, 0) for p in (BY_NUMBER, BY_WORD, AT_END)]
    number = [F.regexp_extract(titre, p, 1) for p in (BY_NUMBER, BY_WORD, AT_END)]
    at = lambda x: F.instr(titre, x)
    cut = lambda x: F.concat(F.substring(titre, F.lit(1), at(x) - 1), F.substring(titre, at(x) + F.length(x), F.length(titre)))
    after = F.substring(first[1], F.lit(1), F.length(first[1]) - F.length(number[1]))
    by_word = F.replace(titre, first[1], after)
    title = F.when(first[0] != "", cut(first[0])).when(first[1] != "", by_word).when(number[2] != "", F.substring(titre, F.lit(1), F.length(titre) - F.length(number[2]))).otherwise(titre)
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in number]), title


def natural_key(text: Column) -> Column:
    """A sort key in which numbers inside of a text count by value, as one string: digits padded to 20.

    A number of more digits has a colon, which sorts after digits, and its count of digits, padded to 10, before them.
    """
    parts = F.regexp_extract_all(text, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def key(x: Column) -> Column:
        bare = F.ltrim(x, F.lit("0"))
        return F.when(F.length(bare) > 20, F.concat(F.lit(":"), F.lpad(F.length(bare).cast("string"), 10, "0"), bare)).otherwise(F.lpad(bare, 20, "0"))

    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), key(x)).otherwise(x)), "")


def display_title(kind: Column, numero: Column, titre: Column) -> Column:
    """Type, number and title of an element for lists; a made-up number is hidden, an empty title leaves type and number."""
    hidden = numero.isNull() | (numero == "") | F.startswith(numero, F.lit("_"))
    head = F.when(hidden, kind).otherwise(F.concat(kind, F.lit(" "), numero))
    title = F.coalesce(titre, F.lit(""))
    return F.when(title == "", head).when(hidden, title).otherwise(F.concat(head, F.lit(": "), title))


def zones(df: DataFrame, order: str = "el_id", doc: str = "fileid", chapter: str = "milieux et zones") -> DataFrame:
    """(doc, kind, code, titre, url) of the first chapter named so: categories from its sections, zones from their subsections.

    Sections named dispositions are passed over with what is below them. The last of equal codes counts.
    """
    rows = materialize(find_parents(df, order, doc), "parents")
    title = F.lower(F.coalesce("titre", F.lit("")))
    top = rows.where((F.col("type") == "Chapitre") & F.contains(title, F.lit(chapter))).groupBy(doc).agg(F.min(F.struct(order, "numero")).alias("c"))
    child = rows.select(doc, F.col(order).alias("id"), "parent", "type", "titre", F.coalesce("numero", F.lit("")).alias("n"))
    s = child.join(top, doc).where(F.col("parent") == F.col(f"c.{order}")).where(~F.contains(F.lower(F.coalesce("titre", F.lit(""))), F.lit("dispositions")))
    s = s.select(doc, "id", F.concat_ws("/", F.col(doc), F.lit("Chapitre"), F.coalesce("c.numero", F.lit("")), "type", "n").alias("url"), "titre")
    below = child.select(doc, F.col("id").alias("sub"), F.col("parent").alias("id"), F.col("titre").alias("sub_titre"), F.concat_ws("/", "type", "n").alias("tail"))
    sub = s.join(below, [doc, "id"]).select(doc, F.lit("milieu").alias("kind"), F.col("sub").alias("id"), F.regexp_extract("sub_titre", r"^\s*(\S+)[-–—\s]+(.*)", 1).alias("code"), F.regexp_extract("sub_titre", r"^\s*(\S+)[-–—\s]+(.*)", 2).alias("titre"), F.concat_ws("/", "url", "tail").alias("url"))
    cat = s.select(doc, F.lit("categorie_milieu").alias("kind"), "id", F.regexp_extract("titre", r"^\s*(\S+)\s*[-–—]\s*(.*)", 1).alias("code"), F.regexp_extract("titre", r"^\s*(\S+)\s*[-–—]\s*(.*)", 2).alias("titre"), "url")
    # The file is passed through an expression, as Spark 4.1 may take a union of parts that are split alike for split itself.
    both = cat.unionByName(sub.withColumn(doc, F.concat(doc, F.lit("")))).where("code != ''")
    return both.groupBy(doc, "kind", "code").agg(F.max(F.struct("id", "titre", "url")).alias("x")).select(doc, "kind", "code", "x.titre", "x.url")


def contents_tree(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """df with opens and closes, the mark-up before and after each element in a nested list of the document's outline."""
    rows = nearest(ancestor_paths(df, order, doc).withColumn("depth", (F.size("path") / 2).cast("int")), {"__after": F.col("depth")}, order, doc, after=True)
    after = F.coalesce("__after", F.lit(1))
    leaf = after <= F.col("depth")
    label = display_title(F.col("type"), F.col("numero"), F.col("titre"))
    flat = F.when(F.col("type").isin("Article", "Annexe"), F.array("type", F.coalesce("numero", F.lit("")))).otherwise(F.col("path"))
    href = F.concat_ws("/", F.col(doc), F.array_join(flat, "/"), F.lit("index.html"))
    link = F.concat(F.lit('<a href="'), href, F.lit('">'), label, F.lit("</a>"))
    opens = F.when(leaf, F.concat(F.lit('<li class="leaf '), F.col("type"), F.lit('">'), link, F.lit("</li>"))).otherwise(F.concat(F.lit('<li class="node '), F.col("type"), F.lit('"><details><summary>'), label, F.lit("</summary><ul><li>"), link, F.lit("</li>")))
    closes = F.when(F.col("depth") > after, F.repeat(F.lit("</ul></details></li>"), F.col("depth") - after)).otherwise("")
    return rows.withColumns({"opens": opens, "closes": closes}).drop("__after")


def outline_html(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """(doc, html): the outline of each document as a nested list."""
    rows = contents_tree(df, order, doc)
    part = F.struct(F.col(order).alias("at"), F.concat("opens", "closes").alias("html"))
    return rows.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["html"]), "").alias("html"))


def section_index(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """(doc, parent, type, n, titles): the elements below each parent by type, in order."""
    rows = find_parents(df, order, doc)
    label = display_title(F.col("type"), F.col("numero"), F.col("titre"))
    part = F.struct(F.col(order).alias("at"), label.alias("t"))
    return rows.groupBy(doc, "parent", "type").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["t"]), "|").alias("titles"))


def page_paths(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """df with page_path, where the element's own page is written: articles and annexes flat under the document, others by their path."""
    rows = ancestor_paths(df, order, doc)
    own = F.array("type", F.coalesce("numero", F.lit("")))
    return rows.withColumn("page_path", F.concat_ws("/", F.col(doc), F.array_join(F.when(F.col("type").isin("Article", "Annexe"), own).otherwise(F.col("path")), "/"), F.lit("index.html")))


def tag_paths(nodes: DataFrame, doc: str = "fileid", node: str = "node", parent: str = "parent", tag: str = "tag", sep: str = ";") -> DataFrame:
    """(doc, node, tagstack): the tags from the root of a tree down to each node. Nodes without a root that ends are left out.

    Joined level by level, as deep as the deepest node; each step moves only the level found last.
    """
    below = nodes.select(doc, F.col(parent).alias("__up"), F.col(node).alias("__node"), F.col(tag).alias("__tag"))
    found = [below.where("__up IS NULL").select(doc, F.col("__node").alias(node), F.col("__tag").alias("tagstack"))]
    while True:
        last = found[-1].withColumnRenamed(node, "__up")
        step = materialize(last.join(below, [doc, "__up"]).select(doc, F.col("__node").alias(node), F.concat_ws(sep, "tagstack", "__tag").alias("tagstack")), "tag-paths")
        if step.isEmpty():
            return reduce(DataFrame.unionByName, found)
        found.append(step)


def by_level(df: DataFrame, order: str = "el_id", doc: str = "fileid") -> DataFrame:
    """(doc, type, n, elements): the elements of each level of a document in order, as an array of structs."""
    part = F.struct(F.col(order).alias("at"), "titre", "numero", "debut", "fin", "page")
    return df.groupBy(doc, "type").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(part)).alias("elements"))


def with_pdf(df: DataFrame, docs: DataFrame, doc: str = "fileid") -> DataFrame:
    """df with pdf, the address of the document's PDF at the page of the row (column page, if df has it); null without one.

    docs has the document and pdf; the greatest address of a document counts.
    """
    known = docs.groupBy(doc).agg(F.max("pdf").alias("__pdf"))
    at = F.concat(F.lit("#page="), F.coalesce(F.col("page").cast("string"), F.lit("1"))) if "page" in df.columns else F.lit("")
    return df.join(known, doc, "left").withColumn("pdf", F.concat("__pdf", at)).drop("__pdf")


def sort_title(numero: Column, titre: Column) -> Column:
    """What documents are listed by: number and title, or the title alone."""
    title = F.coalesce(titre, F.lit(""))
    return F.when(numero.isNull() | (numero == ""), title).otherwise(F.concat(numero, F.lit(": "), title))


def documents_list(docs: DataFrame, outlines: DataFrame, doc: str = "fileid") -> DataFrame:
    """(html): the list of all documents by natural order of number and title, each with its outline and its PDF, in one row.

    docs has the document, numero, titre and pdf; outlines (of outline_html) the document and html. The list is one page, so it is
    made in one task, like any page; it grows with the documents' outlines.
    """
    name = sort_title(F.col("numero"), F.col("titre"))
    pdf = F.when(F.col("pdf").isNotNull(), F.concat(F.lit(' (<a target="_blank" href="'), "pdf", F.lit('">PDF</a>)'))).otherwise("")
    text = F.concat(F.lit('<ul><li class="text"><a target="_blank" href="'), doc, F.lit('/index.html">Texte intégral</a>'), pdf, F.lit("</li>"))
    entry = F.concat(F.lit('<li class="node Document"><details id="'), doc, F.lit('"><summary>'), name, F.lit("</summary>"), text, F.coalesce("html", F.lit("")), F.lit("</ul></details></li>"))
    rows = docs.join(outlines.select(doc, "html"), doc, "left").select(natural_key(name).alias("k"), doc, entry.alias("entry"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", doc, "entry"))), lambda x: x["entry"]), "")
    return rows.agg(F.concat(F.lit('<ul id="body">'), whole, F.lit("</ul>")).alias("html"))
