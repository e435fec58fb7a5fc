import random
import time

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tessellum.llm.fold import bare
from tessellum.llm.leaks import WORD, Index, Item, find_leaks, myers, myers_many, words

VOCABULARY = [f"mot{i}" for i in range(40)]


def distance_to_part(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=20), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 5))
def test_myers(p, t, most):
    assert myers(p, t, most) == min(distance_to_part(p, t), most + 1)


def brute(docs, items, window, budget):
    out = {}
    for d, text in docs:
        dw = words(text)
        for i, item in items:
            iw = words(item)
            best = min((distance_to_part(iw[s : s + window], dw) for s in range(len(iw) - window + 1)), default=99)
            longest = max((k for a in range(len(iw)) for b in range(len(dw)) for k in [run(iw, a, dw, b)]), default=0)
            if best <= budget:
                out[d, i] = best, longest
    return out


def run(x, a, y, b):
    k = 0
    while a + k < len(x) and b + k < len(y) and x[a + k] == y[b + k]:
        k += 1
    return k


def test_equals_brute_force(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(3, 30)))) for i in range(8)]
    docs = []
    for d in range(40):
        w = rng.choices(VOCABULARY, k=rng.randint(0, 30))
        if d % 2:
            src = words(items[rng.randrange(8)][1])
            a = rng.randrange(len(src))
            part = src[a : a + rng.randint(4, 20)]
            for _ in range(rng.randint(0, 2)):
                if part:
                    k = rng.randrange(len(part))
                    part[k : k + 1] = rng.choice([[], ["autre"], [part[k], "autre"]])
            w = w[:5] + part + w[5:]
        docs.append((d, " ".join(w)))
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=9, budget=1).collect()
    want = brute(docs, items, 9, 1)
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == {k: v[0] for k, v in want.items()}
    for r in got:
        if (longest := want[r["doc_id"], r["item_id"]][1]) >= 4:
            assert r["run_words"] == longest
    blocks = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=9, budget=1, block_chars=60).collect()
    assert sorted(blocks) == sorted(got)


def test_altered_passages(spark):
    item = "Le quai flottant du lac Drusilot ne saurait empiéter sur la digue en pierre de Quesisonne, quand le niveau dépasse"
    altered = item.upper().replace("A", "А").replace(" ", "\n ").replace("É", "É​")
    docs = spark.createDataFrame([(1, altered, "x"), (2, None, "x"), (3, "", "x"), (None, item, "x"), (4, item, "x"), (5, item[:40], "x")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "trop court"), (None, item)], "item_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"], r["run_words"]) for r in find_leaks(docs, items).collect()) == [(1, 7, 20), (4, 7, 20)]
    assert find_leaks(docs, items.limit(0)).count() == 0 and find_leaks(docs.limit(0), items).count() == 0


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=7, max_size=7), st.lists(st.integers(0, 3), min_size=9, max_size=9)), min_size=1, max_size=9), st.integers(0, 4))
def test_myers_of_many_pairs(pairs, most):
    got = myers_many(np.array([p for p, _ in pairs]), np.array([t for _, t in pairs]), most)
    assert got.tolist() == [myers(p, t, most) for p, t in pairs]


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_words_are_those_of_the_folded_text(text):
    assert words(text) == WORD.findall(bare(text))


@given(st.lists(st.integers(1, 3), min_size=1, max_size=40), st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_longest_common_run(x, y):
    want = max(run(x, a, y, b) for a in range(len(x)) for b in range(len(y)))
    assert Item(0, x, 5, 2).longest([np.array(y)]) == want


def test_repeated_words_take_linear_time():
    index = Index([(1, "zéro " * 400), (2, " ".join(f"zéro {'zéro ' * 8}{k}" for k in range(40)))], 15, 1)
    list(index.find_all(["zéro " * 20]))
    t = time.process_time()
    assert list(index.find_all(["zéro " * 4000]))[0] == (0, 1, 400, 0, 386, 0)
    assert time.process_time() - t < 1
    small, doc = "a a a a b a a a a a a c a a a a", "a a a b a a a a a a d a a a a a c a a a"
    got = list(Index([(1, small)], 9, 1).find_all([doc]))
    assert [(x[1], x[3], x[2]) for x in got] == [(1, *brute([(0, doc)], [(1, small)], 9, 1)[0, 1])]


def test_one_edit_is_always_found(spark):
    rng = random.Random(9)
    item = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(300):
        s, at, kind = rng.randrange(45), rng.randrange(15), k % 3
        part = item[s : s + 15]
        part[at : at + (kind != 2)] = ["neu"] * (kind != 1)
        docs.append((k, " ".join([*rng.choices(VOCABULARY, k=rng.randrange(9)), *part, *rng.choices(VOCABULARY, k=4)])))
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    assert {r["doc_id"] for r in got.collect()} == set(range(300))
