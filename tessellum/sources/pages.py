"""Web pages: links, addresses, text, and what has changed since it was fetched last."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements that have no end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Tree(HTMLParser):
    """A page as nested lists: (tag, attributes, children)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = ("", {}, [])
        self.open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = (tag, {k: v or "" for k, v in attrs}, [])
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        self.open[-1][2].append(data)


def walk(node) -> Iterator[tuple]:
    """All elements below a node in document order."""
    stack = [iter(node[2])]
    while stack:
        for x in stack[-1]:
            if not isinstance(x, str):
                yield x
                stack.append(iter(x[2]))
                break
        else:
            stack.pop()


def classes(node) -> list[str]:
    return node[1].get("class", "").split()


def text_of(node, skip=lambda x: False) -> str:
    """Text below a node without what skip names; of a picture, its description."""
    out, stack = [], [iter(node[2])]
    while stack:
        for x in stack[-1]:
            if isinstance(x, str):
                out.append(x)
            elif skip(x) or x[0] in ("script", "style"):
                continue
            elif x[0] == "img":
                out.append(x[1].get("alt", ""))
            else:
                stack.append(iter(x[2]))
                break
        else:
            stack.pop()
    return "".join(out)


def body_text(html: str) -> str:
    """The text of a page without the headers inside of its body division, pictures by their description, blank lines single."""
    tree = Tree(html)
    body = next((x for x in walk(tree.root) if x[0] == "div" and x[1].get("id") == "body"), None)
    headers = {id(x) for x in walk(body) if "header" in classes(x)} if body else set()
    return re.sub("\n\n+", "\n\n", text_of(tree.root, lambda x: id(x) in headers).strip())


def index_entries(html: str) -> list[tuple[str, str]]:
    """(url, title) of the pages that an outline lists: nodes but those of whole documents, then leaves."""
    nodes, leaves = [], []
    for x in walk(Tree(html).root):
        if x[0] != "li":
            continue
        link = next((y for y in walk(x) if y[0] == "a" and "href" in y[1]), None)
        if "node" in classes(x) and "Document" not in classes(x) and link:
            summary = next((y for y in walk(x) if y[0] == "summary"), None)
            if summary:
                nodes.append((link[1]["href"], text_of(summary)))
        if "leaf" in classes(x) and link:
            leaves.append((link[1]["href"], text_of(link)))
    return nodes + leaves


def section_links(html: str, section: str) -> list[str]:
    """Addresses listed in the first list after each second-level heading that matches."""
    out, after = [], False
    for x in walk(Tree(html).root):
        if x[0] == "h2":
            after = after or bool(re.search(section, text_of(x), re.I))
        elif x[0] == "ul" and after:
            out += [y[1]["href"] for li in walk(x) if li[0] == "li" for y in [next((a for a in walk(li) if a[0] == "a"), None)] if y and "href" in y[1]]
            after = False
    return out


def page_links(html: str) -> list[str]:
    """Addresses of all links of a page, in order."""
    return [x[1]["href"] for x in walk(Tree(html).root) if x[0] == "a" and "href" in x[1]]


def per_page(pages: DataFrame, function, schema: str, key: str = "url", html: str = "html") -> DataFrame:
    """Rows that a function of a page's HTML gives, each a tuple, with the page's key. Null pages have none."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, *[c.split()[0] for c in schema.split(", ")]]
        for pdf in batches:
            yield pd.DataFrame([(k, *row) for k, h in zip(pdf[key], pdf[html], strict=True) for row in function(h)], columns=names)

    return pages.where(F.col(html).isNotNull()).select(key, html).mapInPandas(run, f"{key} string, {schema}")


def page_texts(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    return per_page(pages, lambda h: [(body_text(h),)], "texte string", key, html)


def page_index(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    return per_page(pages, index_entries, "href string, titre string", key, html)


def collect_pages(outlines: DataFrame, pages: DataFrame, city: str | None = None) -> DataFrame:
    """(url, titre, texte) of the pages that outlines list, joined to their HTML by address; with a city's name before the address."""
    listed = page_index(outlines).select("href", "titre").distinct()
    texts = page_texts(pages.join(listed.select(F.col("href").alias("url")).distinct(), "url", "left_semi"))
    url = F.col("url") if city is None else F.concat_ws("/", F.lit(city), F.col("url"))
    return listed.join(texts, F.col("href") == F.col("url")).select(url.alias("url"), "titre", "texte")


def all_links(html: Column) -> Column:
    """Addresses of all links of a page, as an array."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"'>]*)[\"']"), F.lit(1))


def suffix(path: Column) -> Column:
    """What follows the last dot of a path's last step, with the dot, in small letters."""
    return F.regexp_extract(F.lower(path), r"[^/](\.[^./]*)$", 1)


def wanted(path: Column, extensions: tuple[str, ...]) -> Column:
    """Whether a path ends in one of the extensions, given with or without their dot."""
    s = suffix(path)
    return s.isin(*extensions) | F.ltrim(s, F.lit(".")).isin(*[e for e in extensions if e])


def excluded(path: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | path.rlike(p)
    return out


def absolute(path: Column, base: Column) -> Column:
    """A path as an address of the site that base is on; addresses with a host stay. What follows the path is dropped."""
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.when(path.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/]"), path).otherwise(F.concat(host, F.regexp_extract(path, r"^([^?#]*)", 1)))


def downloads(links: DataFrame, path: str = "path", base: str = "base", order: str = "place") -> DataFrame:
    """(name, url): the files to fetch by name; of several links to one name the last counts."""
    name = F.regexp_extract(F.regexp_extract(F.col(path), r"^([^?#]*)", 1), r"([^/]*)/?$", 1)
    return links.select(name.alias("name"), absolute(F.col(path), F.col(base)).alias("url"), order).groupBy("name").agg(F.max_by("url", order).alias("url"))


def changed(fetched: DataFrame, offered: DataFrame, key: str = "name", stamp: str = "modified") -> DataFrame:
    """What is offered and was not fetched yet, or has been modified since; rows without a stamp count as modified."""
    old = fetched.groupBy(key).agg(F.max(stamp).alias("__old"))
    return offered.join(old, key, "left").where(F.col("__old").isNull() | F.col(stamp).isNull() | (F.col(stamp) > F.col("__old"))).drop("__old")


def prefer(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of first, and those of second whose key it hasn't."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))
