"""Boxes on pages: overlaps, words in boxes, merging, reading order, annotations, tree objects."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.operators.layout import contains_box, overlaps

BOX = ("x0", "top", "x1", "bottom")
MERGED = "fileid string, page int, place int, type string, text string, x0 int, top int, x1 int, bottom int, n_merged int"


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("fileid", "page")) -> DataFrame:
    return df.select(*keep, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keep])


def overlapping_pairs(boxes: DataFrame, box_id: str = "box") -> DataFrame:
    """Pairs of boxes of one page that share an area, each once, the smaller id first. Joined by page, so a page's boxes meet only each other."""
    a, b = prefixed(boxes, "a_"), prefixed(boxes, "b_")
    return a.join(b, ["fileid", "page"]).where((F.col(f"a_{box_id}") < F.col(f"b_{box_id}")) & overlaps("a_", "b_"))


def contained_words(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Words with each box of their page that holds them wholly, columns prefixed b_."""
    inner = prefixed(words, "w_")
    return inner.join(prefixed(boxes, "b_"), ["fileid", "page"]).where(contains_box("b_", "w_"))


def share_inside(word: str = "w_", box: str = "b_") -> Column:
    """The share of a word's area that lies in a box; 0 for a word without area."""
    w, b = (lambda c: F.col(f"{word}{c}")), (lambda c: F.col(f"{box}{c}"))
    width = F.greatest(F.least(w("x1"), b("x1")) - F.greatest(w("x0"), b("x0")), F.lit(0))
    height = F.greatest(F.least(w("bottom"), b("bottom")) - F.greatest(w("top"), b("top")), F.lit(0))
    area = (w("x1") - w("x0")) * (w("bottom") - w("top"))
    return F.when(area > 0, width * height / area).otherwise(0.0)


def best_boxes(words: DataFrame, boxes: DataFrame, least: float = 0.5, box_id: str = "box") -> DataFrame:
    """Words with the box that holds most of their area, if more than least of it; the first box on a tie. Other words have a null box."""
    inside = prefixed(words.select("fileid", "page", "word_idx", *BOX), "w_").join(prefixed(boxes, "b_"), ["fileid", "page"]).withColumn("share", share_inside())
    best = inside.where(F.col("share") > least).groupBy("fileid", "page", F.col("w_word_idx").alias("word_idx"))
    found = best.agg(F.max_by(F.struct(F.col(f"b_{box_id}").alias("box"), F.col("b_type").alias("type"), "share"), F.struct("share", -F.col(f"b_{box_id}"))).alias("x"))
    return words.join(found, ["fileid", "page", "word_idx"], "left").withColumns({"box": F.col("x.box"), "box_type": F.col("x.type"), "share": F.col("x.share")}).drop("x")


def box_labels(df: DataFrame) -> DataFrame:
    """df (of best_boxes) with box_label: B- where the box changes on the page, I- within it, O outside of boxes."""
    w = Window.partitionBy("fileid", "page").orderBy("word_idx")
    same = F.col("box").eqNullSafe(F.lag("box").over(w))
    return df.withColumn("box_label", F.when(F.col("box").isNull(), "O").otherwise(F.concat(F.when(same, "I-").otherwise("B-"), F.col("box_type"))))


def meet(a: list[int], b: list[int]) -> bool:
    return a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]


def merge_boxes(boxes: list[tuple]) -> list[tuple]:
    """The boxes of one page, (place, type, text, x0, top, x1, bottom), with those that overlap merged until none do."""
    area = lambda r: (r[5] - r[3]) * (r[6] - r[4])
    done: list[tuple[int, list, list[int]]] = []
    for r in sorted(boxes, key=lambda r: (-area(r), r[0])):
        place, parts, box = r[0], [r], [r[3], r[4], r[5], r[6]]
        # What a box meets joins it; it may then meet others.
        while (k := next((k for k, x in enumerate(done) if meet(box, x[2])), None)) is not None:
            other = done.pop(k)
            place, parts = other[0], other[1] + parts
            box = [min(box[0], other[2][0]), min(box[1], other[2][1]), max(box[2], other[2][2]), max(box[3], other[2][3])]
        done.append((place, parts, box))
    out = []
    for place, parts, box in sorted(done, key=lambda x: x[0]):
        kinds = [p[1] for p in parts]
        kind = kinds[0] if len(kinds) == 1 else "Tableau" if "Tableau" in kinds else "Figure"
        out.append((place, kind, " ".join(p[2] for p in parts if p[2]), *box, len(parts)))
    return out


def merge_sorted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over partitions sorted by page: pages are merged one after the other as they stream by."""
    names = [c.split()[0] for c in MERGED.split(", ")]
    page, held = None, []
    for pdf in batches:
        rows = []
        for key, *box in zip(zip(pdf["fileid"], pdf["page"], strict=True), *[pdf[c].tolist() for c in ("place", "type", "text", *BOX)], strict=True):
            if key != page:
                rows += [(*page, *x) for x in merge_boxes(held)] if held else []
                page, held = key, []
            held.append(tuple(box))
        yield pd.DataFrame(rows, columns=names)
    if held:
        yield pd.DataFrame([(*page, *x) for x in merge_boxes(held)], columns=names)


def merge_overlaps(boxes: DataFrame) -> DataFrame:
    """Boxes of each page, overlapping ones merged to their hull until none overlap.

    A merged box is a Tableau if one of its members is, else a Figure, whatever they were; its text is theirs, the largest
    member first, its place that of the group the box joined. boxes has fileid, page, place, type, text and the box. Only
    the boxes of one page are held at a time.
    """
    rows = boxes.select("fileid", "page", "place", "type", F.coalesce("text", F.lit("")).alias("text"), *BOX).where("fileid IS NOT NULL AND page IS NOT NULL")
    return rows.repartition("fileid", "page").sortWithinPartitions("fileid", "page", "place").mapInPandas(merge_sorted, MERGED)


def reading_order(blocks: DataFrame, images: DataFrame, merge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The blocks of pages with the images put among them, place numbering them: by top, left, bottom and right edge on pages with images.

    Images on pages without blocks are left out. merge works on the pages with images, e.g. merge_overlaps.
    """
    columns = ["fileid", "page", "type", "text", *BOX]
    all_rows = blocks.select(*columns, F.col("first_idx").cast("bigint").alias("__at"), F.lit(0).alias("__img")).unionByName(images.select(*columns, F.lit(None).cast("bigint").alias("__at"), F.lit(1).alias("__img")))
    page = Window.partitionBy("fileid", "page")
    rows = all_rows.withColumns({"__mixed": F.max("__img").over(page) == 1, "__text": F.min("__img").over(page) == 0}).where("__text")
    by_place = [F.when(F.col("__mixed"), F.col(c)) for c in ("top", "x0", "bottom", "x1")]
    rows = rows.withColumn("place", F.row_number().over(page.orderBy(*by_place, "__at")))
    if merge is None:
        return rows.select(*columns, "place")
    return merge(rows.where("__mixed").select(*columns, "place")).select(*columns, "place").unionByName(rows.where("NOT __mixed").select(*columns, "place"))


def annotations(blocks: DataFrame, pad: int = 1) -> DataFrame:
    """Rectangles to draw on a page, its origin at the bottom left: x, y, w, h, each side pad wider. blocks has page_height."""
    return blocks.select("fileid", "page", "type", (F.col("x0") - pad).alias("x"), (F.col("page_height") - F.col("bottom") - pad).alias("y"), (F.col("x1") - F.col("x0") + 2 * pad).alias("w"), (F.col("bottom") - F.col("top") + 2 * pad).alias("h"))


def scale_boxes(boxes: DataFrame, side: int, longest: bool = True) -> DataFrame:
    """Boxes of a detector's picture, whose longest (or shortest) side has so many pixels, in points of the page."""
    by = (F.greatest if longest else F.least)("page_width", "page_height") / F.lit(float(side))
    return boxes.withColumns({c: F.bround(F.col(c) * by).cast("int") for c in BOX})


def detector_order(boxes: DataFrame, by: str = "box_rank") -> DataFrame:
    """boxes with their rank on the page: topmost, leftmost, tallest, widest first."""
    w = Window.partitionBy("fileid", "page").orderBy("top", "x0", F.desc(F.col("bottom") - F.col("top")), F.desc(F.col("x1") - F.col("x0")), F.desc("type"))
    return boxes.withColumn(by, F.row_number().over(w))


def clamp_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes cut to their page; those without an area left are dropped."""
    cut = boxes.withColumns({"x0": F.greatest("x0", F.lit(0)), "top": F.greatest("top", F.lit(0)), "x1": F.least("x1", "page_width"), "bottom": F.least("bottom", "page_height")})
    return cut.where("x1 > x0 AND bottom > top")


def tagged_objects(words: DataFrame, wanted: tuple[str, ...] = ("Table", "Figure")) -> DataFrame:
    """(fileid, page, type, box, n_words) of tables and figures by the tags of words: runs of words on a page below the same outermost wanted tag."""
    stack = F.split(F.coalesce("tagstack", F.lit("")), ";")
    outer = F.get(F.filter(stack, lambda t: t.isin(*wanted)), F.lit(0))
    w = Window.partitionBy("fileid", "page").orderBy("word_idx")
    rows = words.withColumn("type", outer)
    rows = rows.withColumn("__new", F.when(F.col("type").eqNullSafe(F.lag("type").over(w)), 0).otherwise(1))
    rows = rows.withColumn("__run", F.sum("__new").over(w)).where("type IS NOT NULL")
    hull = [F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom")]
    return rows.groupBy("fileid", "page", "__run", "type").agg(*hull, F.count("*").alias("n_words")).drop("__run")


def tree_objects(nodes: DataFrame, marks: DataFrame, things: DataFrame, sizes: DataFrame | None = None, labels: dict[str, str] | None = None, wanted: tuple[str, ...] = ("Table", "Figure")) -> DataFrame:
    """(fileid, page, node, type, x0, top, x1, bottom) of the outermost wanted nodes of tag trees, one for each page they are on.

    nodes has fileid, node, parent, tag and box, the node's own box counted from the page's foot (an array, null if it has none);
    marks the content marks of each node (fileid, node, page, mcid), things what stands on pages under a mark (fileid, page,
    mcid and the box), sizes the page_height of pages with boxes of their own. A node below a wanted one is part of it. The box is the
    node's own, else the hull of what its marks and those below it hold on the page, else -1 four times. labels maps tags to
    types and leaves out those it hasn't; without it a Table is a Tableau.
    """
    from tessellum.session import materialize

    below = nodes.select("fileid", F.col("parent").alias("__up"), "node", "tag", "box")
    hit = F.col("tag").isin(*wanted)
    outer = lambda top: F.coalesce(top, F.when(hit, F.struct("node", "tag", "box")))
    level = materialize(below.where("__up IS NULL").select("fileid", "node", outer(F.lit(None).cast("struct<node:string,tag:string,box:array<double>>")).alias("top")), "tree")
    found = level.where("top IS NOT NULL")
    while not level.isEmpty():
        last = level.select("fileid", F.col("node").alias("__up"), "top")
        level = materialize(last.join(below, ["fileid", "__up"]).select("fileid", "node", outer(F.col("top")).alias("top")), "tree")
        found = found.union(level.where("top IS NOT NULL"))
    on = found.join(marks.select("fileid", "node", "page", "mcid"), ["fileid", "node"]).select("fileid", F.col("top.node").alias("node"), "top.tag", "top.box", "page", "mcid").distinct()
    hull = [F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom")]
    held = on.join(things.select("fileid", "page", "mcid", *BOX), ["fileid", "page", "mcid"], "left")
    rows = held.groupBy("fileid", "node", "tag", "page").agg(F.first("box").alias("box"), *hull)
    own = F.lit(False)
    if sizes is not None:
        rows = rows.join(sizes.select("fileid", "page", "page_height"), ["fileid", "page"], "left")
        own = F.col("box").isNotNull()
    given = {"x0": F.col("box")[0], "x1": F.col("box")[2]}
    if sizes is not None:
        given |= {"top": F.col("page_height") - F.col("box")[3], "bottom": F.col("page_height") - F.col("box")[1]}
    names = {"Table": "Tableau"} | {t: t for t in wanted if t != "Table"} if labels is None else labels
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("tag"))
    box = [F.coalesce(F.bround(F.when(own, given[c])).cast("int") if c in given else F.lit(None).cast("int"), F.bround(F.col(c)).cast("int"), F.lit(-1)).alias(c) for c in BOX]
    return rows.select("fileid", "page", "node", kind.alias("type"), *box).where("type IS NOT NULL")


def page_pictures(blocks: DataFrame) -> DataFrame:
    """(fileid, page, n, pictures): the files of the pictures to cut from each page, by its tables and figures in order.

    Boxes are cut to the page (page_width, page_height); those without an area have no picture.
    """
    from tessellum.operators.iob import image_name

    named = clamp_boxes(blocks.where("type IN ('Tableau', 'Figure')").withColumn("__name", image_name()))
    part = F.struct("first_idx", F.col("__name").alias("name"))
    return named.groupBy("fileid", "page").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["name"]), " ").alias("pictures"))


#: Named box finders that need no model; vision models register themselves here.
DETECTORS: dict[str, Callable[..., DataFrame]] = {"none": lambda words: tagged_objects(words).limit(0), "tags": tagged_objects}


def detector(name: str) -> Callable[..., DataFrame]:
    """The detector of that name; an unknown one is an error."""
    if name not in DETECTORS:
        raise KeyError(f"no detector {name}; there are {sorted(DETECTORS)}")
    return DETECTORS[name]
