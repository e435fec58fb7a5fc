import json
from datetime import datetime

from pyspark.sql import functions as F

from tessellum.schema import WORD_COLUMNS
from tessellum.sources import files, pages


def test_word_files_round_trip(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "b.csv").write_text("﻿sequence,segment,text,page,x0,extra\nO,B-Titre,\"a,\"\"b\",1,7,z\n,I-Titre,é,x,,z\n", encoding="utf-8")
    (tmp_path / "in" / "sub" / "a.csv").write_text("segment,text,sequence\nO,seul,\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    df = files.read_words(spark, str(tmp_path / "in"))
    rows = df.orderBy("fileid", "word_idx").collect()
    assert [(r["fileid"], r["word_idx"], r["text"], r["page"], r["x0"], r["fontname"]) for r in rows] == [("a", 0, "seul", None, None, None), ("b", 0, 'a,"b', 1, 7, None), ("b", 1, "é", None, None, None)]
    files.write_words(df, str(tmp_path / "out"))
    again = spark.read.csv(str(tmp_path / "out"), header=True)
    assert tuple(again.columns) == WORD_COLUMNS and again.count() == 3


def test_images_and_urls(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps([{"type": "Tableau", "contenu": [], "_bbox": [1.5, 2.5, 30, 40], "_page_number": 4}]))
    r = files.read_images(spark, str(tmp_path / "i.json")).collect()[0]
    assert (r["type"], r["page"], r["x0"], r["top"], r["bottom"]) == ("Tableau", 4, 2, 2, 40)
    text = spark.createDataFrame([(json.dumps({"a%20b.pdf": {"url": "u"}, "c.pdf": {"url": "v", "modified": "m"}}),)], "value string")
    assert sorted(x["name"] for x in files.document_urls(text).collect()) == ["a b.pdf", "a%20b.pdf", "c.pdf"]


def test_colours(spark):
    df = spark.createDataFrame([([0.0],), ([1.0],), ([0.5, 0.0, 1.0],), ([0.1, 0.2, 0.3, 0.4],), ([],), (None,), ([0.1, 0.2],)], "c array<double>")
    assert [r[0] for r in df.select(files.colour(F.col("c"))).collect()] == ["#000", "#fff", "#80f", "#1346", "#000", "#000", "#000"]


def test_page_text():
    html = "<html><h1>Titre</h1><div id='body'><p class='header'>non</p>\n\n\n<p>oui &amp; <img alt='plan'><br>fin</p><script>x</script></div></html>"
    assert pages.body_text(html) == "Titre\n\noui & planfin"


def test_outline_entries():
    html = '<li class="node Document"><details><summary>Tout</summary><a href="d">d</a></details></li><li class="node Chapitre"><details><summary>Un</summary><ul><li><a href="u">x</a></li><li class="leaf Article"><a href="a">Art</a></li></ul></details></li>'
    assert pages.index_entries(html) == [("u", "Un"), ("a", "Art")]
    assert pages.index_entries("<ul><li class='leaf'>") == []


def test_links_below_headings():
    html = "<h2>Autre</h2><ul><li><a href='n'>n</a></li></ul><h2>Plan d'urbanisme</h2><p><ul><li><a href='o'>o</a><li>x</ul><ul><li><a href='n'>"
    assert pages.section_links(html, "URBANISME") == ["o"]


def test_addresses(spark):
    df = spark.createDataFrame([("/a/b.PDF?x",), ("http://x.y/z.pdf",), ("//h/z",), ("c.html#f",), (None,)], "p string")
    got = df.select(pages.absolute(F.col("p"), F.lit("https://site/index.html?q")).alias("u"), pages.wanted(F.col("p"), ("pdf", ".html")).alias("w")).collect()
    assert [(r["u"], r["w"]) for r in got][:4] == [("https://site/a/b.PDF", False), ("http://x.y/z.pdf", True), ("//h/z", False), ("https://sitec.html", False)]


def test_collect_pages(spark):
    outline = spark.createDataFrame([("i", '<li class="leaf"><a href="a">A</a></li><li class="leaf"><a href="b">B</a></li>')], "url string, html string")
    html = spark.createDataFrame([("a", "<div id='body'>texte</div>"), ("z", "<p>autre")], "url string, html string")
    assert [tuple(r) for r in pages.collect_pages(outline, html, "ville").collect()] == [("ville/a", "A", "texte")]


def test_changed_and_preferred(spark):
    t = datetime(2024, 1, 1)
    old = spark.createDataFrame([("a", t), ("b", t), ("c", None)], "name string, modified timestamp_ntz")
    new = spark.createDataFrame([("a", t), ("b", datetime(2024, 2, 1)), ("c", t), ("d", None)], "name string, modified timestamp_ntz")
    assert sorted(r["name"] for r in pages.changed(old, new).collect()) == ["b", "c", "d"]
    assert sorted(r["name"] for r in pages.prefer(old, new, "name").collect()) == ["a", "b", "c", "d"]


def test_whole_numbers():
    assert [files.whole(x) for x in ("7", " -7 ", "+7", "²", "--5", "", None, "1.5", "x", "٣", "2147483647", "2147483648", "9" * 5000)] == [7, -7, 7, None, None, None, None, None, None, 3, 2147483647, None, None]


def test_blocks_with_words_and_links(spark, tmp_path):
    words = [{"text": "un", "page": 2, "x0": 5, "top": 6, "x1": 9, "bottom": 10}, {"text": "deux", "page": 2, "x0": 1, "top": 7, "x1": 4, "bottom": 30}]
    (tmp_path / "i.json").write_text(json.dumps([{"type": "Alinea", "contenu": words, "liens": [{"start": 0, "end": 2, "href": "u"}]}]))
    r = files.read_images(spark, str(tmp_path / "i.json")).collect()[0]
    assert (r["text"], r["page"], r["x0"], r["top"], r["x1"], r["bottom"], r["liens"][0]["href"]) == ("un deux", 2, 1, 6, 9, 30, "u")
