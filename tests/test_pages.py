import csv
import re

import pytest

from tessellum import pipeline
from tessellum.__main__ import parser, run
from tessellum.operators.words import tidy_words
from tessellum.schema import WORD_COLUMNS
from tessellum.sources import files

LINES = [
    ("B-Titre", "Titre", "Règlement de zonage numéro 12-3"),
    ("B-Chapitre", "", "Chapitre 2 Milieux et zones"),
    ("B-Section", "", "Section 1 T3 - Milieux périurbains"),
    ("B-SousSection", "", "Sous-section 4 T3.3 - Périurbain"),
    ("B-Alinea", "", "Les types de milieux T3.3 et T9.9, le type de milieu T3.3 du règlement de zonage."),
]


@pytest.fixture(scope="module")
def words(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("words")
    with open(d / "doc.csv", "w", newline="") as f:
        out = csv.DictWriter(f, WORD_COLUMNS)
        out.writeheader()
        for y, (label, span, text) in enumerate(LINES):
            for k, w in enumerate(text.split()):
                out.writerow({"sequence": (("B-" if k == 0 else "I-") + span) if span else "O", "segment": label if k == 0 else "I" + label[1:], "text": w, "page": 1, "page_width": 612, "page_height": 792, "fontname": "F", "rgb": "#000", "x0": 10 * k, "x1": 10 * k + 9, "top": 20 * y, "bottom": 20 * y + 10, "doctop": 20 * y, "mcid": k, "mctag": "P", "tagstack": "Document;P"})
    return str(d)


def test_zones_come_between_laws_and_bylaws(spark, words):
    html = pipeline.pages(tidy_words(files.read_words(spark, words))).collect()[0]["html"]
    page = '<a target="_blank" href="../doc/Chapitre/2/Section/1/SousSection/4/index.html">'
    assert f"Les types de milieux {page}T3.3</a> et T9.9, le {page}type de milieu T3.3 du règlement de zonage</a>." in html


def test_each_element_has_a_page(spark, words, tmp_path):
    run(parser().parse_args(["extract", words, str(tmp_path)]), spark)
    section, below = "doc/Chapitre/2/Section/1", "doc/Chapitre/2/Section/1/SousSection/4"
    found = {str(p.relative_to(tmp_path).parent): p.read_text(encoding="utf-8") for p in tmp_path.rglob("*.html")}
    listed = found.pop(".")  # the list of documents, above their folders
    assert 'id="doc"' in listed and all(f'href="{x}/index.html"' in listed for x in ("doc", "doc/Chapitre/2", section, below))
    assert set(found) == {"doc", "doc/Chapitre", "doc/Chapitre/2", section, below}
    assert '<a href="2/index.html" class="title">Milieux et zones</a>' in found["doc/Chapitre"]
    assert all("T3.3</a> et T9.9" in found[x] for x in ("doc", "doc/Chapitre/2", section, below))
    assert '<section class="Section"><h2' in found[section] and 'name="SousSection/4"' in found[section] and 'class="Chapitre"' not in found[section]
    assert all(html.count("<section") == html.count("</section>") for html in found.values())
    for path, html in found.items():
        hrefs = re.findall(r'target="_blank" href="([^"#]*)"', html)
        assert len(hrefs) == 2 and all((tmp_path / path / x).resolve() == tmp_path / below / "index.html" for x in hrefs) or path == "doc/Chapitre"
