import json
import os
import posixpath
import re

import pytest
from pyspark.sql import functions as F

from tessellum import pipeline, session
from tessellum.__main__ import parser, run
from tessellum.operators import crf, export, objects, search, structure
from tessellum.operators.words import numbered, tidy_words
from tessellum.sources import fetch, files
from tests.test_pipeline import folder  # noqa: F401

NODES = [("a", None, "Document", None), ("b", "a", "Table", None), ("c", "b", "Figure", None), ("d", "a", "P", None), ("e", "a", "Figure", [10.0, 20.0, 30.0, 50.0]), ("f", "a", "Figure", None), ("g", None, "Table", None)]


@pytest.fixture(scope="module")
def tree(spark):
    nodes = spark.createDataFrame([("x", *n) for n in NODES], "fileid string, node string, parent string, tag string, box array<double>")
    marks = spark.createDataFrame([("x", "b", 1, 0), ("x", "c", 1, 1), ("x", "c", 2, 2), ("x", "d", 1, 3), ("x", "e", 2, 4), ("x", "f", 3, 9)], "fileid string, node string, page int, mcid int")
    things = spark.createDataFrame([("x", 1, 0, 5, 6, 7, 8), ("x", 1, 1, 1, 9, 4, 30), ("x", 2, 2, 2, 2, 3, 3), ("x", 1, 3, 0, 0, 99, 99), ("x", 2, 1, 0, 0, 99, 99)], "fileid string, page int, mcid int, x0 int, top int, x1 int, bottom int")
    sizes = spark.createDataFrame([("x", p, 100) for p in (1, 2, 3)], "fileid string, page int, page_height int")
    return nodes, marks, things, sizes


def test_outermost_objects_of_a_tree(tree):
    rows = {tuple(r)[1:] for r in objects.tree_objects(*tree).collect()}
    assert rows == {(1, "b", "Tableau", 1, 6, 7, 30), (2, "b", "Tableau", 2, 2, 3, 3), (2, "e", "Figure", 10, 50, 30, 80), (3, "f", "Figure", -1, -1, -1, -1)}


def test_labels_are_mapped_or_left_out(tree):
    rows = {(r["node"], r["type"]) for r in objects.tree_objects(*tree, labels={"Figure": "Image"}).collect()}
    assert rows == {("e", "Image"), ("f", "Image")}
    assert objects.tree_objects(tree[0].limit(0), *tree[1:]).count() == 0


def test_pictures_of_pages(spark):
    rows = [("x", 1, 5, "Figure", -5, 0, 10, 10), ("x", 1, 2, "Tableau", 0, 0, 700, 9), ("x", 1, 9, "Figure", 650, 0, 700, 9), ("x", 2, 1, "Alinea", 0, 0, 9, 9)]
    df = spark.createDataFrame(rows, "fileid string, page int, first_idx int, type string, x0 int, top int, x1 int, bottom int").withColumns({"page_width": F.lit(600), "page_height": F.lit(800)})
    assert [tuple(r) for r in objects.page_pictures(df).collect()] == [("x", 1, 2, "page1-0,0,700,9.jpg page1--5,0,10,10.jpg")]


def test_running_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    assert all(r["ref"] == r["k"] for r in numbered(df, ["k"]).collect())
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_pdf_addresses(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), ("b", 1)], "fileid string, page int")
    docs = spark.createDataFrame([("a", "u"), ("a", None), ("b", None)], "fileid string, pdf string")
    assert sorted((r["fileid"], r["pdf"] or "") for r in structure.with_pdf(df, docs).collect()) == [("a", "u#page=1"), ("a", "u#page=3"), ("b", "")]


def test_every_link_of_the_pages_arrives(spark, folder):  # noqa: F811
    words = tidy_words(files.read_words(spark, folder))
    pages = {r["page_path"]: r["html"] for r in pipeline.page_tree(words, spark.createDataFrame([("doc", "http://x/doc.pdf")], "fileid string, pdf string")).collect()}
    assert "index.html" in pages and "doc/Article/2/index.html" in pages
    for path, html in pages.items():
        for href in re.findall(r'href="([^"]*)"', html):
            if not href.startswith("http"):
                target, _, anchor = posixpath.normpath(posixpath.join(posixpath.dirname(path), href)).partition("#")
                assert target in pages, (path, href)
                assert not anchor or f'id="{anchor}"' in pages[target]
    assert "http://x/doc.pdf#page=1" in pages["doc/Article/2/index.html"] and 'href="http://x/doc.pdf"' in pages["doc/index.html"]
    parts = pipeline.analyse(words)
    assert {r["url"] for r in pipeline.search_documents(parts["elements"], parts["blocks"]).collect()} <= set(pages)


def test_whole_documents_as_json(spark, folder, tmp_path):  # noqa: F811
    (tmp_path / "d.json").write_text(json.dumps({"doc.pdf": {"url": 'http://x/"d".pdf'}}))
    run(parser().parse_args(["json", folder, str(tmp_path / "out"), "--documents", str(tmp_path / "d.json")]), spark)
    doc = json.loads(spark.read.json(str(tmp_path / "out")).collect()[0]["json"])
    assert doc["fileid"] == "doc" and doc["pdfurl"] == 'http://x/"d".pdf' and [e["numero"] for e in doc["paliers"]["Document"][0]["sub"]] == ["1", "2"]
    assert [b["type"] for b in doc["contenu"]] == ["Titre", "Alinea", "Liste", "Pied"] and doc["contenu"][1]["liens"][0]["href"] == "Article/2/index.html"
    assert doc["meta"]["Titre"] == ["Règlement de zonage numéro 12-3"]


def test_download_and_convert(spark, tmp_path):
    page = tmp_path / "page.html"
    page.write_text('<a href="/d/a.pdf">a</a><a href="b.txt">b</a><h2>Urbanisme</h2><ul><li><a href="/d/c.PDF?x">c</a></li></ul><a href="/d/zonage.pdf">z</a>')
    calls = tmp_path / "calls"
    calls.mkdir()

    def get(url, modified):
        name = url.rsplit("/", 1)[-1]
        (calls / f"{name}-{modified}").write_text("")
        return (304, None, b"") if modified else (404, None, b"") if name == "a.pdf" else (200, "Mon", b"content of " + name.encode())

    out = tmp_path / "files"
    for _ in range(2):
        fetch.download(spark, str(page), "https://v.example/list?x=1", str(out), exclude=("zonage",), get=get)
        assert json.loads((out / "index.json").read_text()) == {"c.PDF": {"url": "https://v.example/d/c.PDF", "modified": "Mon"}}
    assert sorted(os.listdir(out)) == ["c.PDF", "index.json"] and (out / "c.PDF").read_bytes() == b"content of c.PDF"
    assert sorted(os.listdir(calls)) == ["a.pdf-None", "c.PDF-Mon", "c.PDF-None"]
    fetch.download(spark, str(page), "https://v.example/", str(tmp_path / "some"), section="urbanisme", get=get)
    assert os.path.exists(tmp_path / "some" / "c.PDF")
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    run(parser().parse_args(["convert", str(tmp_path), str(tmp_path / "words"), "--parser", "tests.test_trees:two_words", "--pages", "2"]), spark)
    assert [r["text"] for r in spark.read.csv(str(tmp_path / "words"), header=True).collect()] == ["deux"]


def two_words(path, content):
    return ({"text": t, "page": k + 1} for k, t in enumerate(("un", "deux")))


def test_shards_folds_and_votes(spark):
    rows = [(f"f{i % 8}", 1 + i // 40, i, "Article" if i % 5 == 0 else "mot", "B-Article" if i % 5 == 0 else "I-Article") for i in range(240)]
    df = spark.createDataFrame(rows, "fileid string, page int, word_idx bigint, text string, seg string").withColumns({c: F.lit(None).cast("string") for c in ("fontname", "rgb", "mctag", "tagstack", "sequence", "segment")} | {c: F.lit(1) for c in ("page_width", "page_height", "x0", "x1", "top", "bottom", "doctop", "mcid")})
    chain = crf.train(df, kind="text", epochs=3, shards=3)
    found = crf.label_pages(df, chain).join(df, ["fileid", "page", "word_idx"])
    assert found.where("predicted = seg").count() > 200
    chains = crf.fold_chains(df, 3, kind="text", epochs=2, max_pages=40)
    crossed = crf.cross_label(df, chains)
    assert crossed.count() == 240 and crossed.select("fileid", "fold").distinct().count() == 8
    assert crf.vote_labels(df, chains).join(df, ["fileid", "page", "word_idx"]).where("predicted = seg").count() > 200
    assert crf.grid(df, [{"kind": "text", "epochs": 1, "max_pages": 20}], folds=2).count() == 1


def test_written_tables_can_be_cleared(spark):
    df = session.materialize(spark.range(3), "some")
    path = df.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path) and session.clear_materialized(spark) > 0 and not os.path.exists(path)


def test_lists_of_documents_are_escaped_by_nobody_and_sorted(spark):
    docs = spark.createDataFrame([("b", "10", "x", None), ("a", "9", "y", "u"), ("c", None, "Z", None)], "fileid string, numero string, titre string, pdf string")
    html = structure.documents_list(docs, spark.createDataFrame([], "fileid string, html string")).collect()[0]["html"]
    assert re.findall(r"<summary>([^<]*)", html) == ["9: y", "10: x", "Z"] and html.count("PDF") == 1
    assert export.downloads_json(spark.createDataFrame([("n", "u", None)], "name string, url string, modified string")).collect()[0]["json"] == '{"n":{"url":"u"}}'
    assert search.cities(spark.createDataFrame([("v/x",), ("_idx/y",), (None,)], "url string")).collect()[0]["ville"] == "v"
