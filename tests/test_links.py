import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessellum.functions.paths import relative
from tessellum.operators import links, render

SITE = links.LAW_SITE


def column(spark, rows, *columns):
    df = spark.createDataFrame([(x,) if not isinstance(x, tuple) else x for x in rows])
    return [tuple(r) for r in df.select(*columns).collect()]


def test_lists_are_spelled_out(spark):
    text = "Voir les articles 12, 13.1 et 14 du règlement de zonage 1314-2, l'annexe B et le RÈGLEMENT SQ-12-3."
    refs = [(r["quote"], r["alt"]) for r in links.references(spark.createDataFrame([(1, text)], "id int, t string"), "t", "id").orderBy("start").collect()]
    assert refs == [("12", "article 12 du règlement de zonage"), ("13.1", "article 13.1 du règlement de zonage"), ("14", "article 14 du règlement de zonage"), ("RÈGLEMENT SQ-12-3.", None)]


def test_zones_and_laws(spark):
    text = "Les types de milieux T1.2 et T3.1 de la loi sur les cités et villes ; le code civil"
    refs = [(r["quote"], r["alt"]) for r in links.references(spark.createDataFrame([(1, text)], "id int, t string"), "t", "id").orderBy("start").collect()]
    assert refs == [("T1.2", "types de milieux T1.2 de la loi sur les cités et villes"), ("T3.1", "types de milieux T3.1 de la loi sur les cités et villes"), ("code civil", None)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["article 5", "articles 1, 2 et 3", " du ", "règlement 12-3", "loi ", "é 👍", ", ", " ", "chapitre XI"]), max_size=8))
def test_offsets_point_at_the_words(spark, parts):
    text = "".join(parts)
    for r in links.references(spark.createDataFrame([(1, text)], "id int, t string"), "t", "id").collect():
        assert text[r["start"] : r["stop"]] == r["quote"] != ""


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "rien")], "id int, t string")
    assert links.references(df, "t", "id").count() == 0


@pytest.mark.parametrize(
    ("text", "url"),
    [
        ("article 23 de la Loi sur le bâti (R.L.R.Q., c. B-1)", f"{SITE}/lc/B-1#se:23"),
        ("l'article 3.1 de la Loi (L.R.Q., c. A-2.1)", f"{SITE}/lc/A-2.1#se:3_1"),
        ("Règlement sur les eaux (c. Q-2, r. 22)", f"{SITE}/rc/Q-2,%20r.%2022%20"),
        ("le Code\ncivil", f"{SITE}/lc/CCQ-1991"),
        ("Loi sur les cités et villes", f"{SITE}/lc/C-19"),
        ("Article 5 de la Loi sur l'urbanisme", f"{SITE}/lc/A-19.1"),
        ("Loi sur la qualité de l'environnement (chapitre Q-2)", f"{SITE}/lc/Q-2"),
        ("le règlement 12", None),
    ],
)
def test_laws(spark, text, url):
    assert column(spark, [text], links.resolve_external(F.col("_1"))) == [(url,)]


@pytest.mark.parametrize(("title", "normal"), [("Règlement sur les PIIA", "plans d'implantation et d'intégration architecturale"), ("RÈGLEMENT DE  zonage (codifié)", "zonage"), ("Règlement relatif aux permis, certificats.", "permis certificats"), ("« L’art »", "l'art"), ("", "")])
def test_titles(spark, title, normal):
    assert column(spark, [title], links.normalize_title(F.col("_1"))) == [(normal,)]


@pytest.fixture(scope="module")
def register(spark):
    rows = [("zonage", "1314-2", "Règlement de zonage", 1), ("lotissement", "20.1", "Règlement de lotissement", 2), ("permis", None, "Règlement sur les permis et certificats", 3), ("vieux", "20.1", "Lotissement ancien", 0)]
    return spark.createDataFrame(rows, "docpath string, numero string, titre string, ord int")


@pytest.mark.parametrize(
    ("text", "src", "href"),
    [
        ("article 5 du règlement 1314-2", ".", "../zonage/Article/5/index.html"),
        ("règlement de zonage", "Article/2", "../../../index.html#zonage"),
        ("Règlement numéro 20.1.", ".", "../index.html#lotissement"),
        ("le règlement sur les permis et certificats", ".", "../index.html#permis"),
        ("règlement inconnu 99", ".", None),
        ("article 12", "Chapitre/3/Section/4", "../../../../Article/12/index.html"),
        ("section 5", "Chapitre/3/Section/4", "../5/index.html"),
        ("sous-section 2 de la section 5 du chapitre 9", "Chapitre/3", "../9/Section/5/SousSection/2/index.html"),
        ("rien du tout", ".", None),
    ],
)
def test_internal(spark, register, text, src, href):
    df = spark.createDataFrame([(text, src)], "text string, srcpath string")
    assert [r["href"] for r in links.resolve_internal(df, register).collect()] == [href]


@pytest.mark.parametrize(("path", "start"), [("a/b", "a"), ("a/b", "a/c/d"), ("../x/y", "a/b"), ("a", "a"), ("a/./b//c", "a/b"), ("b/../c", "."), ("x", ".")])
def test_relative_paths(spark, path, start):
    assert column(spark, [(path, start)], relative(F.col("_1"), F.col("_2"))) == [(os.path.relpath(path, start),)]


def test_links_in_html(spark):
    rows = [("Alinea", "un deux trois", [(3, 7, "u"), (8, 13, None)])]
    df = spark.createDataFrame(rows, "type string, text string, liens array<struct<start:int,end:int,href:string>>").withColumns({c: F.lit(1) for c in ("page", "x0", "top", "x1", "bottom")})
    assert [r[0] for r in df.select(render.block_html(F.col("type"), F.col("text"), F.col("liens"))).collect()] == ['<p>un <a target="_blank" href="u">deux</a> trois</p>']


def test_pictures_and_unknown_types(spark):
    df = spark.createDataFrame([("Figure", "x", 3, 1, 2, 30, 40), ("Tete", "x", 3, 1, 2, 30, 40)], "type string, text string, page int, x0 int, top int, x1 int, bottom int")
    none = F.lit(None).cast("array<struct<start:int,end:int,href:string>>")
    html = [r[0] for r in df.select(render.block_html(F.col("type"), F.col("text"), none, "img")).collect()]
    assert html == ['<img alt="x" src="img/page3-1,2,30,40.jpg"><br>', ""]
    with pytest.raises(Exception, match="no block type"):
        df.withColumn("type", F.lit("Zut")).select(render.block_html(F.col("type"), F.col("text"), none)).collect()


def test_titles_inside_texts(spark):
    names = ["zonage", "les plans", "plans d'ensemble du centre", "gestion des eaux de pluie", "b", "eaux usées", "règles de construction du quartier sud", "construction du quartier", "x y z"]
    texts = ["au zonage", "des surzonages", "selon les plans d'ensemble du centre, puis", "gestion des eaux de pluie et eaux usées", "règles de construction du quartier sud", "ax y zb", "", "y"]
    titles = spark.createDataFrame([(n, n, k) for k, n in enumerate(names)], "__title string, __path string, __ord int")
    rows = links.titles_inside(spark.createDataFrame([(t,) for t in texts], "__norm string"), titles).collect()
    assert sorted((r["__norm"], r["__title"]) for r in rows) == sorted((t, n) for t in texts for n in names if n in t)
    assert links.titles_inside(spark.createDataFrame([("a b c",)], "__norm string"), titles.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("la Loi sur les élections (chapitre E-2.2)", []),
        ("la Loi sur les élections (RLRQ, c. E-2.2), art. 3", ["Loi sur les élections (RLRQ, c. E-2.2)"]),
        ("Code de procédure (L. R. Q., c. C-25)", ["Code de procédure (L. R. Q., c. C-25)"]),
        ("règlement relatif aux permis et les certificats", ["règlement relatif aux permis et les certificats"]),
        ("règlement sur les plans d’implantation et d'intégration architecturale", ["règlement sur les plans d’implantation et d'intégration architecturale"]),
        ("règlement concernant le bruit 99-12 et", ["règlement concernant le bruit 99-12"]),
        ("l'article 3 de la section 2 du chapitre 5 du code civil", ["article 3 de la section 2 du chapitre 5 du code civil"]),
        ("le sous-article 4", ["article 4"]),
        ("sections 3 ou 4", ["3", "4"]),
    ],
)
def test_grammar(spark, text, found):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert [r["quote"] for r in links.references(df, "t", "id").orderBy("start").collect()] == found
