import json
import os

from pyspark.sql import functions as F

from tessellum.operators import crf, export, iob, metrics
from tessellum.operators.words import tidy_words
from tessellum.streaming import words as stream
from tessellum.tables import table


def test_tree_as_json(spark):
    kinds = ["Chapitre", "Section", "Article", "Article", "Chapitre", "Article"]
    df = spark.createDataFrame([("f", i, k, None if i == 1 else f'"{i}"', str(i), i, -1, 1) for i, k in enumerate(kinds)], "fileid string, el_id bigint, type string, titre string, numero string, debut int, fin int, page int")
    tree = json.loads(export.elements_json(df).collect()[0]["json"])
    shape = lambda e: (e["numero"], [shape(x) for x in e["sub"]])
    assert [shape(e) for e in tree] == [("0", [("1", [("2", []), ("3", [])])]), ("4", [("5", [])])]
    assert tree[0]["sub"][0]["titre"] == "" and tree[0]["titre"] == '"0"'


def test_registry_and_pages(spark, tmp_path):
    docs = spark.createDataFrame([("b", "1", "B", None), ("a", None, "A", "u")], "fileid string, numero string, titre string, pdf string")
    got = json.loads(export.run_registry(docs, spark.createDataFrame([("z",), ("y",), ("z",), (None,)], "url string")).collect()[0]["json"])
    assert list(got["docs"]) == ["a", "b"] and got["urls"] == ["y", "z"]
    export.write_pages(spark.createDataFrame([("x/y/index.html", "é"), (None, "n")], "page_path string, html string"), str(tmp_path))
    assert (tmp_path / "x/y/index.html").read_text() == "é" and os.listdir(tmp_path / "x/y") == ["index.html"]


def test_streams(spark, sf_dir, tmp_path):
    rows = table(spark, sf_dir, "word_rows")
    rows.repartition(3, "fileid").write.parquet(str(tmp_path / "in"))
    source = stream.read_stream(spark, str(tmp_path / "in"), rows.schema, 1)
    blocks = lambda df: iob.group_blocks(tidy_words(df))
    q = stream.run_batches(source, blocks, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    whole = blocks(rows).select("fileid", "first_idx", "text")
    got = spark.read.parquet(str(tmp_path / "out")).select("fileid", "first_idx", "text")
    assert sorted(got.collect()) == sorted(whole.collect())
    once = stream.deduplicated(source).writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    once.awaitTermination(120)
    assert spark.table("once").count() == rows.select("fileid", "page", "word_idx").distinct().count()
    counts = stream.label_counts(source).writeStream.format("memory").queryName("counts").outputMode("update").trigger(availableNow=True).start()
    counts.awaitTermination(120)
    last = spark.table("counts").groupBy("start", "label").agg(F.max("n").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == rows.count()


def test_chain_learns(spark):
    rows = []
    for f in range(12):
        for i in range(40):
            head = i % 10 == 0
            rows.append((f"f{f}", i // 20 + 1, i, "Titre" if head else f"mot{i % 7}", "Gras-Bold" if head else "Fin", "#000", i, i + 5, 10 * (i // 5), 10 * (i // 5) + 9, 792, None, "", "B-Titre" if head else "B-Alinea" if i % 10 == 1 else "I-Alinea"))
    schema = "fileid string, page int, word_idx bigint, text string, fontname string, rgb string, x0 int, x1 int, top int, bottom int, page_height int, mctag string, tagstack string, seg string"
    df = spark.createDataFrame(rows, schema)
    seen = F.col("fileid").isin("f3", "f7")
    chain = crf.train(df.where(~seen), max_pages=18, epochs=12)
    found = crf.label_pages(df.where(seen), chain).join(df, ["fileid", "page", "word_idx"])
    scores = {r["label"]: r["f1"] for r in metrics.report(found, "seg", "predicted").collect()}
    assert scores["macro avg"] > 0.95
    again = crf.train(df.where(~seen), max_pages=18, epochs=12)
    assert (again.state == chain.state).all() and crf.explain(chain, spark).count() > 0
    nothing = crf.train(df.limit(0))
    assert nothing.labels == ["O"]
