import math
import random

import pytest
from pyspark.sql import functions as F

from tessellum.operators import search


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(4)
    words = [f"mot{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, f"u/{k}", " ".join(rng.choices(words, weights, k=2)), " ".join(rng.choices(words, weights, k=rng.randint(0, 40))), 0) for k in range(400)]
    docs += [(5, "u/old", "zzz", "zzz", -1), (None, "n", "t", "t", 0), (900, None, None, None, 0)]
    return search.index_tables(spark.createDataFrame(docs, "ref bigint, url string, titre string, texte string, at int"), newest="at")


def test_pruned_search_finds_the_same(spark, index):
    rng = random.Random(5)
    asks = [(q, f"mot{rng.randrange(60)}") for q in range(60) for _ in range(rng.randint(1, 6))] + [(99, "nulle")]
    asked = spark.createDataFrame(asks, "query_id int, term string")
    for k in (1, 3, 10, 200):
        rows = lambda s, k=k: sorted((r["query_id"], r["hit_rank"], r["ref"], r["score"]) for r in search.top_hits(s, k).collect())
        assert rows(search.score(index["weighed"], asked, index["bounds"], k)) == rows(search.score(index["weighed"], asked))
    # Few rare words beside a very common one: the lists of the common word are not read.
    rare = spark.createDataFrame([(q, t) for q in range(9) for t in (f"mot{50 + q}", "mot0", "mot1")], "query_id int, term string")
    weighed = index["weighed"].withColumn("impact", F.col("impact") * F.when(F.col("term").isin("mot0", "mot1"), 0.01).otherwise(1.0))
    for k in (1, 2):
        rows = lambda s, k=k: sorted((r["query_id"], r["hit_rank"], r["ref"], r["score"]) for r in search.top_hits(s, k).collect())
        assert rows(search.score(weighed, rare, search.bounds(weighed), k)) == rows(search.score(weighed, rare))


def test_bounds_are_the_greatest_impacts(index):
    sums = {}
    for r in index["weighed"].collect():
        sums.setdefault(r["term"], {}).setdefault(r["ref"], []).append(r["impact"])
    for r in index["bounds"].collect():
        want = sorted((sum(x) for x in sums[r["term"]].values()), reverse=True)[: search.DEPTH]
        assert all(math.isclose(a, b) for a, b in zip(r["top"], want, strict=True))


def test_newest_row_counts(index):
    stored = {r["ref"]: r["url"] for r in index["documents"].collect()}
    assert stored[5] == "u/5" and None not in stored and index["weighed"].where("term = 'zzz'").count() == 0


def test_syntax(spark):
    docs = spark.createDataFrame([(1, "a", "Piscine", "clôture haute"), (2, "b", "Clôture", "piscine et zone"), (3, "c", "Zonage", "zones")], "ref bigint, url string, titre string, texte string")
    index = search.index_tables(docs)
    find = lambda q: {r["ref"] for r in search.search_index(index, spark.createDataFrame([(0, q)], "query_id int, q string"), syntax=True).collect()}
    assert find("piscine") == {1, 2} and find("titre:piscine") == {1} and find("piscine -zone") == {1}
    assert find("+piscine +zone") == {2} and find("zon*") == {2, 3} and find("*tur") == {1, 2} and find("+absent piscine") == set()
    assert find("+xyz* piscine") == set() and find("") == set() and find("-zone") == set() and find("piscine^0.5 zone^9.5") == {1, 2, 3}


def test_written_index(spark, index, tmp_path):
    docs = index["documents"].withColumn("at", F.lit(0))
    search.write_index(docs, str(tmp_path / "i"))
    asks = spark.createDataFrame([(0, "mot3 mot9"), (1, "mot50")], "query_id int, q string")
    rows = lambda ix, *a: sorted(tuple(r) for r in search.search_index(ix, asks, *a).select("query_id", "hit_rank", "ref", "score").collect())
    read = search.read_index(spark, str(tmp_path / "i"))
    assert rows(read) == rows(index) and rows(read, "u/1") == rows(index, "u/1") != []
    empty = search.index_tables(docs.limit(0))
    assert rows(empty) == []
