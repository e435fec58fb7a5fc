"""Fetching the files that a page lists, if they are new since the last time."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.operators.export import downloads_json
from tessellum.sources import files, pages

FETCHED = "name string, url string, modified string, status int"


def http_get(url: str, modified: str | None) -> tuple[int, str | None, bytes]:
    """(status, time of change, content) of an address; 304 and no content if it hasn't changed since."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"If-Modified-Since": modified} if modified else {}), timeout=60) as r:
            return r.status, r.headers.get("Last-Modified"), r.read()
    except HTTPError as e:
        return e.code, None, b""


def fetch_files(offered: DataFrame, folder: str, get: Callable[[str, str | None], tuple[int, str | None, bytes]] = http_get) -> DataFrame:
    """(name, url, modified, status): files of offered (name, url, modified as known) fetched into a folder all executors share.

    A file is written whole and then renamed, so that a task that runs again harms none. Files that haven't changed (304) and
    those whose address fails keep what is there.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, url, modified in zip(pdf["name"], pdf["url"], pdf["modified"], strict=True):
                status, changed, content = get(url, modified)
                if 200 <= status < 300:
                    part = os.path.join(folder, f".{name}.{os.getpid()}.part")
                    with open(part, "wb") as f:
                        f.write(content)
                    os.replace(part, os.path.join(folder, name))
                rows.append((name, url, changed if 200 <= status < 300 else modified, status))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")])

    return offered.select("name", "url", "modified").mapInPandas(run, FETCHED)


def download(spark: SparkSession, page: str, url: str, folder: str, section: str | None = None, exclude: tuple[str, ...] = (), extensions: tuple[str, ...] = (".pdf",), get=http_get) -> None:
    """Fetch what a saved page of links lists: all links with the wanted endings, or the lists under headings like section."""
    html = spark.read.text(page, wholetext=True).select(F.lit(url).alias("url"), F.col("value").alias("html"))
    found = pages.per_page(html, lambda h: [(x, k) for k, x in enumerate(pages.section_links(h, section) if section else pages.page_links(h))], "path string, place int")
    kept = found.where(pages.wanted(F.regexp_extract("path", r"^([^?#]*)", 1), extensions) & ~pages.excluded(F.col("path"), exclude))
    offered = pages.downloads(kept.withColumnRenamed("url", "base"))
    os.makedirs(folder, exist_ok=True)
    listed = os.path.join(folder, "index.json")
    old = files.document_urls(spark.read.text(listed, wholetext=True)).select("name", "modified") if os.path.exists(listed) else spark.createDataFrame([], "name string, modified string")
    asked = offered.join(old.groupBy("name").agg(F.max("modified").alias("modified")), "name", "left")
    done = fetch_files(asked.repartition("name"), folder, get).where("status < 400").select("name", "url", "modified")
    text = downloads_json(done).first()["json"]
    with open(listed, "w", encoding="utf-8") as f:
        f.write(text)
