import random

from pyspark.sql import functions as F

from tessellum.operators import scan


def test_chunks_make_no_difference(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), i, rng.choice([None, None, i])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i bigint, v bigint").repartition(4)
    want = {}
    for g in "ab":
        own = [r for r in rows if r[0] == g]
        for k, (_, i, _v) in enumerate(own):
            before = next((x[2] for x in reversed(own[:k]) if x[2] is not None), None)
            after = next((x[2] for x in own[k + 1 :] if x[2] is not None), None)
            want[i] = (before, after, sum(x[2] or 0 for x in own[: k + 1]))
    for chunk in (7, 64, 10_000):
        monkeypatch.setattr(scan, "CHUNK", chunk)
        out = scan.nearest(df, {"b": F.col("v")}, "i", "g")
        out = scan.nearest(out, {"a": F.col("v")}, "i", "g", after=True)
        out = scan.running_sum(out, F.coalesce("v", F.lit(0)), "s", "i", "g")
        assert {r["i"]: (r["b"], r["a"], r["s"]) for r in out.collect()} == want
