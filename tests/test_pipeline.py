import csv
import json
import os

import pytest

from tessellum import pipeline
from tessellum.__main__ import parser, run
from tessellum.operators.words import tidy_words
from tessellum.schema import LEVELS, WORD_COLUMNS
from tessellum.sources import files

LINES = [
    ("B-Titre", "Titre", "Règlement de zonage numéro 12-3"),
    ("B-Chapitre", "", "Chapitre I Dispositions"),
    ("B-Article", "", "Article 1 Objet"),
    ("B-Alinea", "", "Le présent article 2 complète le règlement de zonage."),
    ("B-Article", "", "Article 2 Piscines"),
    ("B-Liste", "", "a) selon l'article 5 de la Loi sur les cités et villes;"),
    ("B-Pied", "", "page 1"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("words")
    with open(d / "doc.csv", "w", newline="") as f:
        out = csv.DictWriter(f, WORD_COLUMNS)
        out.writeheader()
        for y, (label, span, text) in enumerate(LINES):
            for k, w in enumerate(text.split()):
                out.writerow({"sequence": (("B-" if k == 0 else "I-") + span) if span else "O", "segment": label if k == 0 else "I" + label[1:], "text": w, "page": 1, "page_width": 612, "page_height": 792, "fontname": "F", "rgb": "#000", "x0": 10 * k, "x1": 10 * k + 9, "top": 20 * y, "bottom": 20 * y + 10, "doctop": 20 * y, "mcid": k, "mctag": "P", "tagstack": "Document;P"})
    return str(d)


def test_pages(spark, folder):
    parts = pipeline.analyse(tidy_words(files.read_words(spark, folder)))
    doc = parts["documents"].collect()[0]
    assert (doc["numero"], doc["titre"]) == ("12-3", "Règlement de zonage ")
    rows = parts["elements"].orderBy("el_id").collect()
    assert [(r["type"], r["numero"], r["debut"], r["fin"], "/".join(r["path"])) for r in rows] == [("Chapitre", "I", 1, -1, "Chapitre/I"), ("Article", "1", 1, 2, "Chapitre/I/Article/1"), ("Article", "2", 2, -1, "Chapitre/I/Article/2")]
    html = pipeline.pages(tidy_words(files.read_words(spark, folder))).collect()[0]["html"]
    assert '<p>Le présent <a target="_blank" href="Article/2/index.html">article 2</a> complète le <a target="_blank" href="../index.html#doc">règlement de zonage</a>.</p>' in html
    assert 'href="https://www.legisquebec.gouv.qc.ca/fr/document/lc/C-19#se:5"' in html
    assert html.count("<article") == html.count("</article>") == 2 and "page 1" not in html


def test_elements_are_indexed_with_what_is_below_them(spark, folder):
    parts = pipeline.analyse(tidy_words(files.read_words(spark, folder)))
    texts = {r["url"]: r["texte"] for r in pipeline.search_documents(parts["elements"], parts["blocks"]).collect()}
    one, two = LINES[3][2], LINES[5][2]
    assert texts == {"doc/Chapitre/I/index.html": f"{one}\n\n{two}", "doc/Article/1/index.html": one, "doc/Article/2/index.html": two}


def test_open_elements(spark):
    types = ["Alinea", "Chapitre", "Article", "Alinea", "Section", "Alinea", "SousSection", "Article", "Liste", "Section", "Alinea", "Annexe", "Alinea"]
    rows = spark.createDataFrame([("d", k, t) for k, t in enumerate(types)], "fileid string, first_idx bigint, type string")
    found = [r["within"] for r in pipeline.open_elements(rows).orderBy("first_idx").collect()]
    stack, want = [], []
    for k, t in enumerate(types):
        if t in LEVELS:
            stack = [x for x in stack if LEVELS.index(types[x]) < LEVELS.index(t)] + [k]
        want.append(list(stack))
    assert found == want


def test_commands(spark, folder, tmp_path):
    go = lambda *a: run(parser().parse_args([str(x) for x in a]), spark)
    go("extract", folder, tmp_path / "pages")
    assert os.path.exists(tmp_path / "pages" / "doc" / "index.html")
    go("json", folder, tmp_path / "json")
    tree = json.loads(spark.read.json(str(tmp_path / "json")).collect()[0]["json"])
    assert [e["numero"] for e in tree["paliers"]["Document"][0]["sub"]] == ["1", "2"]
    go("html", folder, tmp_path / "html")
    go("annotate", folder, tmp_path / "boxes")
    assert spark.read.csv(str(tmp_path / "boxes"), header=True).count() == len(LINES)
    go("index", folder, tmp_path / "index")
    assert [r["url"] for r in go("search", tmp_path / "index", "piscine").collect()] == ["doc/Article/2/index.html"]
    assert go("search", tmp_path / "index", "piscine", "-v", "autre").count() == 0
    go("train", folder, tmp_path / "m.npz", "--pages", 5)
    go("segment", folder, tmp_path / "m.npz", tmp_path / "out", "--pages", 1)
    again = spark.read.csv(str(tmp_path / "out"), header=True)
    assert again.columns == list(WORD_COLUMNS) and again.count() == sum(len(x[2].split()) for x in LINES)
    go("train", folder, tmp_path / "s.npz", "--label", "span")
    go("label", folder, tmp_path / "s.npz", tmp_path / "out2")
    assert spark.read.csv(str(tmp_path / "out2"), header=True).count() == again.count()
