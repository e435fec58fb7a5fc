import random
from collections import Counter

import pytest

from tessellum.llm.mixture import VOCABULARY, encoder_of, mix_sources, pivot, settle


def test_settle_keeps_mass_and_expectation():
    rng = random.Random(1)
    for p, q in ((0.3, 0.4), (0.7, 0.8), (0.5, 0.5), (0.2, 0.8)):
        n, first = 20_000, 0.0
        for _ in range(n):
            a, b = settle(p, q, rng.random())
            assert abs(a + b - p - q) < 1e-9 and (min(abs(a), abs(1 - a)) < 1e-9 or min(abs(b), abs(1 - b)) < 1e-9)
            first += a
        assert abs(first / n - p) < 0.02


def test_pivot_keeps_the_count():
    rng = random.Random(2)
    done, held, rest = pivot([0.37] * 1000, [rng.random() for _ in range(1000)])
    assert len(done) == 1000 and abs(sum(done) + (rest if held is not None else 0) - 370) < 1e-6


def test_sizes_stay_near_their_expectation():
    rng = random.Random(4)
    for _ in range(200):
        sizes = sorted((int(rng.paretovariate(1)) for _ in range(300)), reverse=True)
        p = rng.random()
        done, held, rest = pivot([p] * 300, [rng.random() for _ in range(300)])
        assert abs(sum(n * t for n, t in zip(done, sizes, strict=True)) + (rest * sizes[held] if held is not None else 0) - p * sum(sizes)) <= sizes[0]


@pytest.fixture(scope="module")
def mixture(spark):
    rng = random.Random(3)
    rows = [(i, "a" if i % 3 else "b", " ".join(["texte"] * rng.randint(1, 60)), "z") for i in range(600)]
    rows += [(1000, None, "sans source", "z"), (1001, "c", None, "z"), (1002, "c", "", "z"), (None, "a", "x", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, tokens string").repartition(7, "doc_id")
    targets = [(1, "a", 0.5, 1, 0.2), (1, "b", 0.5, 3, 0.2), (2, "a", 0.2, 1, 1.5), (2, "b", 0.7, 5, 1.5), (2, "c", 0.05, 2, 1.5), (2, "d", 0.05, 2, 1.5), (2, "d", 0.05, 2, 1.5)]
    t = spark.createDataFrame(targets, "mix_id int, source string, target_share double, max_uses int, budget_ratio double")
    return docs, t, [x.collect() for x in mix_sources(docs, t, fan_in=3, leaf=50)]


def test_shares_and_caps(mixture):
    _, _, (chosen, report) = mixture
    caps = {(r["mix_id"], r["source"]): r for r in report}
    assert len(report) == 6 and len({(r["mix_id"], r["doc_id"]) for r in chosen}) == len(chosen)
    for r in chosen:
        assert 1 <= r["uses"] <= caps[r["mix_id"], r["source"]]["max_uses"]
    used = Counter()
    for r in chosen:
        used[r["mix_id"], r["source"]] += r["tokens"] * r["uses"]
    for key, r in caps.items():
        assert used[key] == r["used_tokens"]
        assert r["short"] == (r["target_tokens"] > r["max_uses"] * r["source_tokens"])
        goal = min(r["target_tokens"], r["max_uses"] * r["source_tokens"])
        assert abs(r["used_tokens"] - goal) <= max(150, 0.05 * goal)
    assert {k for k, r in caps.items() if r["short"]} >= {(2, "c"), (2, "d")}


@pytest.mark.parametrize("partitions", [1, 2, 5, 50])
def test_same_in_any_partitioning(mixture, partitions):
    docs, t, (chosen, _) = mixture
    again = mix_sources(docs.repartition(partitions), t, fan_in=3, leaf=50)[0].collect()
    assert sorted(again) == sorted(chosen)


def test_empty(mixture):
    docs, t, _ = mixture
    assert mix_sources(docs, t.limit(0))[0].count() == 0
    chosen, report = mix_sources(docs.limit(0), t)
    assert chosen.count() == 0 and report.count() == 6


def test_tokens():
    with open(VOCABULARY, "rb") as f:
        e = encoder_of(f.read())
    text = "L'île <|endoftext|> 12\n\n中文  "
    assert e.decode(e.encode_ordinary(text)) == text
