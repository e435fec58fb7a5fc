"""Flat tables of nested document records, with parent-child links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.session import materialize

#: Levels below the first that one projection unrolls. The outline has six; deeper records take another projection each.
UNROLLED = 8

ELEMENT = {"type": "string", "titre": "string", "numero": "string", "debut": "int", "fin": "int", "page": "int"}
WORD = {"text": "string", "page": "int", "x0": "int", "x1": "int", "top": "int", "bottom": "int"}
LINK = {"start": "int", "end": "int", "alt": "string", "href": "string"}
BOX = ("x0", "top", "x1", "bottom")


def items(node: Column, path: str) -> Column:
    """The list at a path of a variant: a lone object counts as a list of one, anything else that is no list as none."""
    lone = F.when(F.try_variant_get(node, path, "map<string,variant>").isNotNull(), F.array(F.try_variant_get(node, path, "variant")))
    return F.coalesce(F.try_variant_get(node, path, "array<variant>"), lone, F.array().cast("array<variant>"))


def is_object(node: Column) -> Column:
    return F.try_variant_get(node, "$", "map<string,variant>").isNotNull()


def numbered(found: Column, parent: Column, step: str, keep) -> Column:
    """Items with their path, their parent's and their place in the list; those that keep rejects only count as places."""
    named = F.transform(found, lambda x, i: F.struct(F.concat(parent, F.lit(step), i.cast("string")).alias("path"), parent.alias("parent"), i.alias("place"), x.alias("node")))
    return F.filter(named, lambda s: keep(s["node"]))


def fields(node: Column, types: dict[str, str]) -> list[Column]:
    return [F.try_variant_get(node, f"$.{k}", t).alias(k) for k, t in types.items()]


def unroll(df: DataFrame, first: Column) -> DataFrame:
    """df with the elements of a first level and UNROLLED levels of sub below in elements, and what is deeper in deeper."""
    out = df.withColumn("__l0", first)
    for k in range(UNROLLED):
        below = F.transform(F.col(f"__l{k}"), lambda e: numbered(items(e["node"], "$.sub"), e["path"], "/sub/", is_object))
        out = out.withColumn(f"__l{k + 1}", F.flatten(below))
    rows = F.transform(F.concat(*[F.col(f"__l{k}") for k in range(UNROLLED)]), lambda e: F.struct(e["path"].alias("path"), e["parent"].alias("parent"), e["place"].alias("place"), *fields(e["node"], ELEMENT)))
    deeper = F.transform(F.col(f"__l{UNROLLED}"), lambda e: F.struct(e["path"].alias("path"), e["parent"].alias("parent"), e["place"].alias("place"), F.to_json(e["node"]).alias("node")))
    return out.withColumn("elements", rows).withColumn("deeper", deeper).drop(*[f"__l{k}" for k in range(UNROLLED + 1)])


def contents(node: Column) -> tuple[Column, Column, Column]:
    """The blocks, words and links of a record as arrays of flat rows."""
    blocks = numbered(items(node, "$.contenu"), F.lit("contenu"), "/", is_object)
    number = lambda b, i: F.try_variant_get(b["node"], f"$._bbox[{i}]", "int")
    flat = F.transform(blocks, lambda b: F.struct(b["path"].alias("path"), b["place"].alias("place"), F.try_variant_get(b["node"], "$.type", "string").alias("type"), F.try_variant_get(b["node"], "$._page_number", "int").alias("page"), *[number(b, i).alias(k) for i, k in enumerate(BOX)]))
    some = lambda n: ~F.is_variant_null(n)
    words = F.flatten(F.transform(blocks, lambda b: numbered(items(b["node"], "$.contenu"), b["path"], "/contenu/", is_object)))
    links = F.flatten(F.transform(blocks, lambda b: numbered(items(b["node"], "$.liens"), b["path"], "/liens/", some)))
    either = lambda n: [F.coalesce(F.try_variant_get(n, f"$.{k}", t), F.try_variant_get(n, f"$[{i}]", t)).alias(k) for i, (k, t) in enumerate(LINK.items())]
    row = lambda x, values: F.struct(x["path"].alias("path"), x["parent"].alias("parent"), x["place"].alias("place"), *values)
    return flat, F.transform(words, lambda w: row(w, fields(w["node"], WORD))), F.transform(links, lambda x: row(x, either(x["node"])))


def flatten_records(df: DataFrame, key: str = "fileid", record: str = "record", newest: str = "loaded_at") -> dict[str, DataFrame]:
    """The tables elements, blocks, words and links of JSON document records, each with the record's key.

    Rows have path, parent (path of the row they hang under, null for the first elements) and place (in the parent's list).
    Elements hang under paliers/Document/0 and down through sub, whatever the depth; blocks are contenu/i, their words
    contenu/i/contenu/j and links contenu/i/liens/j. Nested transforms attach the paths, flatten combines the lists, one
    inline for each table makes the rows; the arrays are written once, so that a record is parsed once for all tables.

    A lone object counts as a list of one; missing, null and empty lists have no rows; entries that are no objects keep their
    place but have no row (links may also be lists of start, end, alt, href). Of the records of one key the newest counts, the
    greatest text on a tie; a null key is replaced by the record's own fileid. Null and unparsable records have no rows. An
    empty table gives empty ones; other columns of df are not read.
    """
    source = df.select(F.coalesce(F.col(key), F.get_json_object(record, "$.fileid")).alias("key"), F.col(newest).alias("at"), F.col(record).alias("record"))
    last = source.groupBy("key", F.when(F.col("key").isNull(), F.xxhash64("record")).alias("own")).agg(F.max(F.struct("at", "record")).alias("x"))
    parsed = last.select("key", F.try_parse_json(F.col("x.record")).alias("node")).where("node IS NOT NULL")
    roots = numbered(items(F.col("node"), "$.paliers.Document"), F.lit("paliers/Document"), "/", is_object)
    first = F.transform(F.slice(roots, 1, 1), lambda e: F.struct(e["path"].alias("path"), F.lit(None).cast("string").alias("parent"), e["place"].alias("place"), e["node"].alias("node")))
    blocks, words, links = contents(F.col("node"))
    arrays = materialize(unroll(parsed.withColumns({"blocks": blocks, "words": words, "links": links}), first).drop("node"), "records")

    def rows(of: DataFrame, array: str) -> DataFrame:
        return of.select(F.col("key").alias(key), F.inline(array))

    elements, rest = [rows(arrays, "elements")], rows(arrays, "deeper")
    while not rest.isEmpty():
        again = rest.select(F.col(key).alias("key"), F.array(F.struct("path", "parent", "place", F.parse_json("node").alias("node"))).alias("first"))
        more = materialize(unroll(again, F.col("first")).drop("first"), "records")
        elements.append(rows(more, "elements"))
        rest = rows(more, "deeper")
    return {"elements": reduce(DataFrame.unionByName, elements)} | {t: rows(arrays, t) for t in ("blocks", "words", "links")}
