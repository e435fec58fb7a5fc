"""Documents as HTML: blocks with their links, and elements around them, by sorting the events of their intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.operators.iob import image_name
from tessellum.operators.scan import nearest
from tessellum.schema import LEVELS

# The tags of blocks and elements.
BLOCK_TAGS = {"Tete": "", "Pied": "", "TOC": "", "Tableau": "img", "Figure": "img", "Liste": "li", "Titre": "h4", "Alinea": "p", "Amendement": "p"}
ELEMENT_TAGS = {"Document": "body", "Annexe": "section", "Chapitre": "section", "Section": "section", "SousSection": "section", "Article": "article"}
HEADER_TAGS = {"Document": "h1", "Annexe": "h1", "Chapitre": "h1", "Section": "h2", "SousSection": "h3", "Article": "h4"}


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def splice(text: Column, links: Column) -> Column:
    """A text with its links put in; links are structs of start, end, href in order. A null href leaves the words as they are."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("html"))

    def add(acc: Column, x: Column) -> Column:
        words = F.substr(text, x["start"] + 1, x["end"] - x["start"])
        link = F.when(x["href"].isNull(), words).otherwise(F.concat(F.lit('<a target="_blank" href="'), x["href"], F.lit('">'), words, F.lit("</a>")))
        return F.struct(x["end"].alias("at"), F.concat(acc["html"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), link).alias("html"))

    return F.aggregate(F.coalesce(links, F.array().cast("array<struct<start:int,end:int,href:string>>")), zero, add, lambda acc: F.concat(acc["html"], F.substr(text, acc["at"] + 1, F.length(text))))


def block_html(kind: Column, text: Column, links: Column, image_dir: str | Column = ".") -> Column:
    """HTML of a block; nothing for page heads, feet and contents, a picture for tables and figures. Text is not escaped.

    A type that is no block's is an error. Pictures are named by the columns page, x0, top, x1, bottom.
    """
    tag = lookup(BLOCK_TAGS, kind)
    folder = F.concat(image_dir, F.lit("/")) if isinstance(image_dir, Column) else F.lit("" if image_dir == "." else image_dir + "/")
    picture = F.concat(F.lit('<img alt="'), text, F.lit('" src="'), folder, image_name(), F.lit('"><br>'))
    body = F.concat(F.lit("<"), tag, F.lit(">"), splice(text, links), F.lit("</"), tag, F.lit(">"))
    return F.when(tag.isNull(), F.raise_error(F.concat(F.lit("no block type: "), kind))).when(tag == "", "").when(tag == "img", picture).otherwise(body)


def outline_events(blocks: DataFrame) -> DataFrame:
    """The blocks with level (null for contents), fin_seq and shown; their place in the document is first_idx.

    fin_seq is the place of the next heading of the same or a higher level, null at the end. A heading is shown if content
    follows it before its parent ends; contents always are.
    """
    lvl = F.try_element_at(F.create_map(*[x for k, t in enumerate(LEVELS) for x in (F.lit(t), F.lit(k))]), F.col("type"))
    rows = blocks.withColumn("level", lvl)
    heads, at = range(len(LEVELS)), F.col("first_idx")
    ahead = {f"__next{k}": F.when(F.col("level") <= k, at) for k in heads} | {"__content": F.when(F.col("level").isNull(), at)}
    rows = nearest(rows, ahead, "first_idx", "fileid", after=True)
    rows = rows.withColumn("fin_seq", F.coalesce(*[F.when(F.col("level") == k, F.col(f"__next{k}")) for k in heads]))
    # The last element before of a higher level is the parent.
    step = F.struct(at.alias("seq"), F.col("fin_seq").alias("fin"))
    rows = nearest(rows, {f"__up{k}": F.when(F.col("level") < k, step) for k in heads if k}, "first_idx", "fileid")
    parent = F.coalesce(*[F.when(F.col("level") == k, F.col(f"__up{k}")) for k in heads if k])
    inside = F.col("__content").isNotNull() & (parent.isNull() | parent["fin"].isNull() | (F.col("__content") < parent["fin"]))
    return rows.withColumn("shown", F.col("level").isNull() | inside).drop("__content", *[f"__next{k}" for k in heads], *[f"__up{k}" for k in heads])


def document_html(blocks: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(fileid, html) of whole documents from their blocks (of group_blocks, with numero and titre_nu where headings have them).

    links has fileid, first_idx and links, an array of start, end, href.
    """
    rows = outline_events(blocks if links is None else blocks.join(links, ["fileid", "first_idx"], "left"))
    linked = F.col("links") if links is not None else F.lit(None).cast("array<struct<start:int,end:int,href:string>>")
    return nested_html(rows.where("shown"), linked, ["fileid"])


def nested_html(rows: DataFrame, linked: Column, page: list[str], root: Column | None = None, image_dir: str | Column = ".") -> DataFrame:
    """(page, html) of rows of outline_events, grouped by the columns of a page.

    Each heading opens an element before itself and closes it before the next of its level or higher; sorting opens, contents
    and closes by place and level gives the nested text without recursion. A heading for which root holds has no anchor.
    """
    tag, head = lookup(ELEMENT_TAGS, F.col("type")), lookup(HEADER_TAGS, F.col("type"))
    number = F.coalesce("numero", F.lit(""))
    level = F.when(~F.startswith(number, F.lit("_")), F.concat(F.lit('<span class="level">'), F.col("type"), F.lit('</span><span class="number">'), number, F.lit("</span>"))).otherwise("")
    anchored = number != "" if root is None else (number != "") & ~root
    anchor = F.when(anchored, F.concat(F.lit('<a class="anchor" name="'), F.col("type"), F.lit("/"), number, F.lit('"></a>'))).otherwise("")
    header = F.when(F.col("titre_nu") != "", F.concat(F.lit("<"), head, F.lit(' class="header">'), level, F.lit('<span class="title">'), F.col("titre_nu"), F.lit("</span></"), head, F.lit(">"))).otherwise("")
    opens = F.concat(F.lit("<"), tag, F.lit(' class="'), F.col("type"), F.lit('">'), anchor, header)
    event = lambda at, order, depth, html: F.struct(at.alias("at"), order.alias("order"), depth.alias("depth"), html.alias("html"))
    none = F.lit((1 << 62))
    own = event(F.col("first_idx"), F.lit(1), F.lit(0), F.when(F.col("level").isNull(), block_html(F.col("type"), F.col("text"), linked, image_dir)).otherwise(opens))
    close = F.when(F.col("level").isNotNull(), event(F.coalesce("fin_seq", none), F.lit(0), -F.col("level"), F.concat(F.lit("</"), tag, F.lit(">"))))
    events = rows.select(*page, F.inline(F.array_compact(F.array(own, close))))
    part = F.struct("at", "order", "depth", "html")
    return events.groupBy(*page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["html"]), "").alias("html"))
