import random

from tessellum.operators import ranking, search
from tessellum.plans import corpus


def test_no_pair_beyond_the_best_leaves_a_group(spark, sf_dir, monkeypatch):
    seen = []
    top_hits = search.top_hits
    monkeypatch.setattr(search, "top_hits", lambda scores, k=10: seen.append((scores, k)) or top_hits(scores, k))
    hits = corpus.bm25_topk(spark, sf_dir).count()
    (scores, k), asked = seen[0], corpus.asked(spark, sf_dir).select("query_id").distinct().count()
    assert hits <= scores.count() <= k * asked  # one group at this size; every pair with a score came here before


def test_no_pair_beyond_the_best_of_a_city_leaves_a_group(spark, sf_dir, monkeypatch):
    seen = []
    top_hits = search.top_hits
    monkeypatch.setattr(search, "top_hits", lambda scores, k=10: seen.append((scores, k)) or top_hits(scores, k))
    hits = corpus.search_prefix(spark, sf_dir).collect()
    (scores, k), asked = seen[0], corpus.asked(spark, sf_dir).select("query_id").distinct().count()
    assert k == 5 and len(hits) <= scores.count() <= k * asked and all(r["url"].startswith("valmoret/") for r in hits)


def test_groups_and_blocks_find_the_same(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"mot{k}" for k in range(50)]
    weights = [1 / (k + 1) for k in range(50)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(0, 30))) for _ in range(300)]
    rows = [(k, f"u/{k}", " ".join(rng.choices(words, weights, k=2)), texts[k % 300], 0) for k in range(400)]  # equal documents, too
    rows += [(1000 + k, "v", "seul", "mot0 mot1", 0) for k in range(90)] + [(2000, None, None, None, 0), (7, "old", "zzz", "zzz", -1)]
    stored, terms = search.stored_documents(spark.createDataFrame(rows, "ref bigint, url string, titre string, texte string, at int"), newest="at")
    index = search.index_of_stored(stored, terms)
    asks = [(f"q{q}", f"mot{rng.randrange(50)}") for q in range(90) for _ in range(rng.randint(1, 7))] + [("x", "seul"), ("y", "nulle"), ("z", "mot0"), ("z", "mot1"), ("z", "mot0")]
    asked = spark.createDataFrame(asks, "query_id string, term string")
    found = lambda s, k: sorted((r["query_id"], r["hit_rank"], r["ref"], round(r["score"], 6)) for r in search.top_hits(s, k).collect())
    for k, docs, queries, tile, block in ((1, 60, 30, 7, 64), (10, 100, 1000, 16, 64), (200, 10_000, 50, 2048, 4096)):
        for name, x in (("GROUP_DOCS", docs), ("GROUP_QUERIES", queries), ("TILE", tile), ("BLOCK", block)):
            monkeypatch.setattr(ranking, name, x)
        assert found(ranking.batch_scores(terms, asked, search.BOOSTS, k), k) == found(search.score(index["weighed"], asked), k)
    among = stored.where("url LIKE 'u/1%'")
    near = search.score(index["weighed"], asked).join(among.select("ref"), "ref", "left_semi")
    assert found(ranking.batch_scores(terms, asked, search.BOOSTS, 5, among), 5) == found(near, 5)
    nothing = search.stored_documents(stored.limit(0))[1]
    assert found(ranking.batch_scores(nothing, asked, search.BOOSTS), 10) == found(ranking.batch_scores(terms, asked.limit(0), search.BOOSTS), 10) == []
