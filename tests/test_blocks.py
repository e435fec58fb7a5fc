import random

import pytest
from pyspark.sql import functions as F

from tessellum.operators import iob, objects, structure
from tessellum.operators.layout import break_lines
from tessellum.schema import LEVELS


def words(spark, labels, per_page=7, file="f"):
    rows = [(file, i, f"m{i}", i // per_page + 1, 10 * (i % 5), 10 * (i % 5) + 8, 10 * (i // 5), 10 * (i // 5) + 9, lab) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, "fileid string, word_idx bigint, text string, page int, x0 int, x1 int, top int, bottom int, seg string")


def plain_blocks(labels):
    out, cur = [], None
    for i, lab in enumerate(labels):
        bio, _, name = lab.partition("-")
        if bio in "BO":
            cur = {"type": "", "words": []}
            out.append(cur)
        if bio == "O":
            continue
        if cur is None:
            cur = {"type": "", "words": []}
            out.append(cur)
        cur["type"] = cur["type"] or name
        cur["words"].append(f"m{i}")
    return [(b["type"], " ".join(b["words"])) for b in out if b["type"]]


@pytest.mark.parametrize("seed", range(4))
def test_blocks_equal_the_plain_rule(spark, seed):
    rng = random.Random(seed)
    labels = [rng.choice(["B-Titre", "I-Titre", "I", "O", "B-Alinea", "I-Alinea", "B"]) for _ in range(60)]
    got = iob.group_blocks(words(spark, labels)).orderBy("first_idx").collect()
    assert [(r["type"], r["text"]) for r in got] == plain_blocks(labels)


def test_a_label_that_is_none_is_an_error(spark):
    with pytest.raises(Exception, match="not a label"):
        iob.group_blocks(words(spark, ["B-Titre", ""])).collect()


def test_spread(spark):
    labels = ["I", "I", "B-Titre", "I", "I", "I", "I", "I", "I", "I", "I", "O", "I"]
    got = [r["spread"] for r in iob.name_bare_labels(words(spark, labels, 3)).orderBy("word_idx").collect()]
    assert got == ["I", "I-", "B-Titre", *["I-Titre"] * 8, "O", "I-"]


def test_retokenize_and_back(spark):
    df = words(spark, ["B-Titre", "I-Titre", "O"])
    tokens = iob.retokenize(df, F.array(F.lit("a"), F.lit("b")))
    assert [r["seg"] for r in tokens.orderBy("word_idx", "token_id").collect()] == ["B-Titre", "I-Titre", "I-Titre", "I-Titre", "O", "O"]
    assert sorted(iob.detokenize(tokens).collect()) == sorted(df.collect())
    assert iob.retokenize(df, F.array(F.lit("a"), F.lit("b")), drop=True).count() == 3


def test_lines(spark):
    lines = [r["line"] for r in break_lines(words(spark, ["O"] * 12, 100)).orderBy("word_idx").collect()]
    assert lines == [0] * 5 + [1] * 5 + [2] * 2


def tree(kinds):
    """(parent, end) of elements by walking, one after the other."""
    out, open_ = [], []
    for i, k in enumerate(kinds):
        lvl = LEVELS.index(k)
        while open_ and LEVELS.index(kinds[open_[-1]]) >= lvl:
            out[open_.pop()][1] = i
        out.append([open_[-1] if open_ else None, -1])
        open_.append(i)
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed", range(4))
def test_outline_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    kinds = [rng.choice(LEVELS[1:]) for _ in range(50)]
    df = spark.createDataFrame([("f", i, k, f"t{i}", str(i), i) for i, k in enumerate(kinds)], "fileid string, el_id bigint, type string, titre string, numero string, debut int")
    rows = structure.ancestor_paths(structure.find_parents(structure.close_intervals(df))).orderBy("el_id").collect()
    want = tree(kinds)
    assert [(r["parent"], r["fin_calcule"]) for r in rows] == want
    for i, r in enumerate(rows):
        up, path = i, []
        while up is not None:
            path = [kinds[up], str(up), *path]
            up = want[up][0]
        assert r["path"] == path


@pytest.mark.parametrize(
    ("titre", "numero", "rest"),
    [("Article 12.3 Marges", "12.3", "Marges"), ("CHAPITRE IV : Zones", "IV", "Zones"), ("12 mars", "12", "mars"), ("A priori", "A", "priori"), ("Annexe B - Plans", "B", "Plans"), ("Plan de la zone 7 - ", "7", "Plan de la zone "), ("Terminologie", "_0", "Terminologie"), (None, "_0", ""), ("", "_0", "")],
)
def test_numbers_of_headings(spark, titre, numero, rest):
    df = spark.createDataFrame([("f", 1, titre)], "fileid string, el_id bigint, titre string")
    r = structure.extract_numbers(df).collect()[0]
    assert (r["numero_extrait"], r["titre_nu"]) == (numero, rest)


def plain_merge(boxes):
    groups = [[b] for b in boxes]
    hull = lambda g: (min(b[3] for b in g), min(b[4] for b in g), max(b[5] for b in g), max(b[6] for b in g))
    while True:
        for i in range(len(groups)):
            for j in range(i):
                if objects.meet(list(hull(groups[i])), list(hull(groups[j]))):
                    groups[j] += groups.pop(i)
                    break
            else:
                continue
            break
        else:
            return sorted(hull(g) for g in groups)


def test_merged_boxes_are_the_only_partition():
    rng = random.Random(8)
    for _ in range(200):
        boxes = [(k, rng.choice(["Tableau", "Alinea"]), f"t{k}", x, y, x + rng.randint(1, 30), y + rng.randint(1, 30)) for k in range(rng.randint(1, 12)) for x, y in [(rng.randint(0, 90), rng.randint(0, 90))]]
        got = objects.merge_boxes(boxes)
        assert sorted(x[3:7] for x in got) == plain_merge(boxes)
        assert sum(x[7] for x in got) == len(boxes)
