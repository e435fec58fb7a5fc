from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessellum.operators import structure
from tessellum.plans import document


def test_crf_decode_labels_every_word(spark, sf_dir):
    keys = ["fileid", "page", "word_idx"]
    found, words = entry.queries()["crf_decode"](spark, sf_dir).select(keys), document.tidy(spark, sf_dir).select(keys)
    assert found.exceptAll(words).isEmpty() and words.exceptAll(found).isEmpty()


def test_linked_html_has_every_block(spark, sf_dir):
    linked, plain = (entry.queries()[q](spark, sf_dir).select("fileid", "first_idx") for q in ("linked_html", "bloc_html"))
    assert linked.exceptAll(plain).isEmpty() and plain.exceptAll(linked).isEmpty()


def test_natural_key_of_long_numbers(spark):
    numbers = [0, 7, 10, 10**19, 10**20 - 1, 10**20, 10**20 + 1, 10**20 + 2, 3 * 10**20, 10**21, 10**25 + 1, 10**25 + 2]
    rows = spark.createDataFrame([(k, f"n {'0' * (k % 3)}{x} b") for k, x in enumerate(numbers)], "k int, t string")
    keys = [r["s"] for r in rows.select("k", structure.natural_key(F.col("t")).alias("s")).orderBy("k").collect()]
    assert keys == sorted(set(keys))
