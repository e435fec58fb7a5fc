import json

import pytest

from tessellum.operators.nested import UNROLLED, flatten_records


def deep(n):
    el = {"type": "Article", "titre": "x"}
    for _ in range(n):
        el = {"type": "Section", "sub": [el]}
    return {"paliers": {"Document": [el]}}


RECORDS = [
    ("a", 1, {"paliers": {"Document": {"type": "Document", "sub": {"type": "Annexe", "page": "3", "sub": [{"type": "Article"}, None, 5, {"type": "Article", "sub": []}]}}, "Autre": [{"sub": [{}]}]}, "contenu": [{"type": "Alinea", "_bbox": [1, 2, 3, 4], "_page_number": 7, "contenu": [{"text": "mot", "x0": 1}, None], "liens": [{"start": 0, "end": 3, "href": "h"}, [4, 7, "alt", None], None]}, {"liens": {"start": 1, "end": 2}}, {"liens": None}, 3]}),
    ("a", 0, {"paliers": {"Document": [{"sub": [{}, {}, {}, {}]}]}}),
    ("b", 1, deep(2 * UNROLLED + 3)),
    ("c", 1, {"paliers": None, "contenu": {"contenu": {"text": "seul"}}}),
    (None, 1, {"fileid": "d", "paliers": {"Document": [{"sub": [{"titre": "é"}]}]}}),
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(k, json.dumps(r), at, "x") for k, at, r in RECORDS] + [("e", "{bad", 1, "x"), ("f", None, 1, "x"), ("g", "[]", 1, "x")]
    rows.append(rows[0])
    return {k: v.collect() for k, v in flatten_records(spark.createDataFrame(rows, "fileid string, record string, loaded_at int, path string")).items()}


def links(rows, key):
    return sorted((r["parent"], r["path"]) for r in rows if r["fileid"] == key and r["parent"])


def test_elements(tables):
    top = "paliers/Document/0"
    assert links(tables["elements"], "a") == [(top, f"{top}/sub/0"), (f"{top}/sub/0", f"{top}/sub/0/sub/0"), (f"{top}/sub/0", f"{top}/sub/0/sub/3")]
    assert [r["page"] for r in tables["elements"] if r["fileid"] == "a" and r["type"] == "Annexe"] == [3]
    assert [r["titre"] for r in tables["elements"] if r["fileid"] == "d" and r["titre"]] == ["é"]


def test_any_depth(tables):
    b = links(tables["elements"], "b")
    assert len(b) == 2 * UNROLLED + 3 and max(p.count("/sub/") for _, p in b) == 2 * UNROLLED + 3


def test_blocks_words_links(tables):
    assert links(tables["links"], "a") == [("contenu/0", "contenu/0/liens/0"), ("contenu/0", "contenu/0/liens/1"), ("contenu/1", "contenu/1/liens/0")]
    second = next(r for r in tables["links"] if r["path"] == "contenu/0/liens/1")
    assert (second["start"], second["end"], second["alt"], second["href"]) == (4, 7, "alt", None)
    assert [(r["path"], r["text"]) for r in tables["words"] if r["fileid"] in "ac"] in ([("contenu/0/contenu/0", "mot"), ("contenu/0/contenu/0", "seul")], [("contenu/0/contenu/0", "seul"), ("contenu/0/contenu/0", "mot")])
    block = next(r for r in tables["blocks"] if r["fileid"] == "a" and r["place"] == 0)
    assert (block["page"], block["x0"], block["bottom"]) == (7, 1, 4)


def test_empty(spark):
    assert all(t.count() == 0 for t in flatten_records(spark.createDataFrame([], "fileid string, record string, loaded_at int")).values())
