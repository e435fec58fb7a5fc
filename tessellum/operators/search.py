"""A full-text index with ranked search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessellum.functions.text import fold
from tessellum.session import materialize

# French words too common to index.
STOP_WORDS = tuple(
    "à ai aie aient aies ait as au aura aurai auraient aurais aurait auras aurez auriez aurions aurons auront aux avaient avais avait avec avez aviez avions avons ayant ayez ayons c ce ceci cela celà ces cet cette d dans de des du elle en es est et étaient étais était étant été étée étées étés êtes étiez étions eu eue eues eûmes eurent eus eusse eussent eusses eussiez eussions eut eût eûtes eux fûmes furent fus fusse fussent fusses fussiez fussions fut fût fûtes ici il ils j je l la le les leur leurs lui m ma mais me même mes moi mon n ne nos notre nous on ont ou par pas pour qu que quel quelle quelles quels qui s sa sans se sera serai seraient serais serait seras serez seriez serions serons seront ses si soi soient sois soit sommes son sont soyez soyons suis sur t ta te tes toi ton tu un une vos votre vous y".split()
)
# Endings of inflected words, the longest first, and the least length of what is left.
ENDINGS = ("issements", "issement", "atrices", "ateurs", "ations", "ements", "atrice", "ateur", "ation", "ement", "euses", "ances", "ences", "euse", "ance", "ence", "ives", "ites", "ive", "ifs", "ees", "ant", "ent", "ite", "eux", "aux", "es", "ee", "er", "ez", "if", "al", "s", "e")
STEM_CHARS = 4


def tokens(text: Column) -> Column:
    """Index terms of a text: words of letters and digits without common ones, accents folded and endings cut."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*STOP_WORDS))
    return F.transform(words, lambda w: stem(fold(w)))


def stem(word: Column) -> Column:
    """A light stem: the longest listed ending cut that leaves enough of the word. Words with digits stay."""
    return F.regexp_replace(word, rf"^([a-z]{{{STEM_CHARS},}}?)(?:{'|'.join(ENDINGS)})$", "$1")


def latest(docs: DataFrame, ref: str = "ref", by: str | None = None) -> DataFrame:
    """Each document once: the row that is the greatest by the column of that name, then by its texts."""
    others = [c for c in docs.columns if c not in (ref, by)]
    order = ([by] if by else []) + others
    return docs.where(F.col(ref).isNotNull()).groupBy(ref).agg(F.max(F.struct(*order)).alias("__x")).select(ref, *[F.col(f"__x.{c}") for c in others])


def build_index(docs: DataFrame, ref: str = "ref", fields: dict[str, float] | None = None, newest: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, terms, fields): term, field, ref, tf, length; term, df; field, boost, n_docs, mean_length.

    fields maps columns to boosts, a title counting twice by default. Terms are counted in each document first, so that the
    exchange by term moves a row for each document's term and a term in all documents is only a key like others in partial sums.
    The terms of the documents are written once, as all three tables are read from them. Of rows with one ref the newest counts
    by the column of that name, then the one with the greatest texts.
    """
    fields = fields or {"titre": 2.0, "texte": 1.0}
    return index_once(latest(docs.select(ref, *([newest] if newest else []), *fields), ref, newest), ref, fields)


def document_terms(rows: DataFrame, ref: str, fields: dict[str, float]) -> DataFrame:
    """(ref, parts) of documents that are there once each, written once: for each field a struct of its name and its terms."""
    of = [F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("terms")) for f in fields]
    return materialize(rows.select(F.col(ref).alias("ref"), F.array(*of).alias("parts")), "terms")


def index_once(rows: DataFrame, ref: str, fields: dict[str, float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """build_index of documents that are there once each."""
    return index_of_terms(document_terms(rows, ref, fields), fields)


def index_of_terms(terms: DataFrame, fields: dict[str, float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """build_index of document_terms."""
    split = terms.select("ref", F.inline("parts")).withColumn("length", F.size("terms"))
    one = split.select("ref", "field", "length", F.explode("terms").alias("term"))
    postings = one.groupBy("ref", "field", "term").agg(F.count("*").alias("tf"), F.first("length").alias("length"))
    terms = postings.groupBy("ref", "term").agg(F.lit(1).alias("n")).groupBy("term").agg(F.sum("n").alias("df"))
    boost = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    stats = split.groupBy("field").agg(F.count("*").alias("n_docs"), F.avg("length").alias("mean_length")).withColumn("boost", F.element_at(boost, F.col("field")))
    return postings, terms, stats


def impacts(postings: DataFrame, terms: DataFrame, stats: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(term, field, ref, impact): what a term in a field gives a document's score by BM25, which no query changes."""
    n = F.col("n_docs")
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.greatest(F.col("mean_length"), F.lit(1e-9))))
    return postings.join(terms, "term").join(stats, "field").select("term", "field", "ref", (F.col("boost") * idf * tf).alias("impact"))


#: How many of a term's greatest impacts are kept; searches for more hits than that are not pruned.
DEPTH = 100
#: Sums are compared with this margin, as they are rounded to 6 digits in the end.
MARGIN = 1e-5


def bounds(weighed: DataFrame) -> DataFrame:
    """(term, df, top): the documents of each term and its greatest impacts, all fields together, the greatest first.

    Ranks are taken in two steps, so that the documents of a term in all of them are ranked in many tasks first.
    """
    rows = weighed.groupBy("term", "ref").agg(F.sum("impact").alias("impact")).withColumn("part", F.pmod(F.xxhash64("ref"), F.lit(64)))
    greatest = lambda c: F.slice(F.sort_array(c, asc=False), 1, DEPTH)
    parts = rows.groupBy("term", "part").agg(F.count("*").alias("n"), greatest(F.collect_list("impact")).alias("some"))
    return parts.groupBy("term").agg(F.sum("n").alias("df"), greatest(F.flatten(F.collect_list("some"))).alias("top"))


#: Rows of asked terms that go to all executors; more of them are joined like any table.
BROADCAST_ROWS = 1_000_000


def summed(weighed: DataFrame, asked: DataFrame, *kept: str) -> DataFrame:
    """(query_id, ref, s and the kept columns of asked): the impacts of the asked terms summed by query and document.

    The lists of the asked terms are spread by document, so that all of a document's terms are in one task and pairs of
    queries and documents, which are many more than either, are summed where they arise.
    """
    few = asked.count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda x: x)
    # The number is named, as adaptive execution would take few tasks for lists that are small before they meet the queries.
    n = int(weighed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = weighed.join(small(asked.select("term").distinct()), "term", "left_semi").repartition(n, "ref").groupBy("ref", "term").agg(F.sum("impact").alias("impact"))
    return lists.join(small(asked), "term").groupBy("query_id", "ref").agg(F.sum("impact").alias("s"), *[F.first(c).alias(c) for c in kept])


def score(weighed: DataFrame, asked: DataFrame, limits: DataFrame | None = None, k: int = 10) -> DataFrame:
    """(query_id, ref, score): the summed impacts of a query's terms, of all documents that may be among its k best.

    asked has query_id and term, as tokens gives them. With limits (of bounds) documents are left out that cannot be: a query's
    k-th score is at least the k-th impact of any of its terms. Terms whose greatest impacts together stay below that make no
    document one of the best by themselves, so only the lists of the other terms are read; of the documents found there, those
    that even the greatest impacts of the rest would not lift to it go, and for those left the rest is looked up. Queries are
    cut so only where it saves more than half of their lists, and of all lists; the results are the same either way.
    """
    asked = asked.select("query_id", "term").distinct()
    if limits is None or k > DEPTH:
        return summed(weighed, materialize(asked, "asked")).select("query_id", "ref", F.round("s", 6).alias("score"))
    known = asked.join(limits, "term").select("query_id", "term", "df", F.get("top", F.lit(0)).alias("most"), F.coalesce(F.get("top", F.lit(k - 1)), F.lit(0.0)).alias("kth"))
    w = Window.partitionBy("query_id")
    below = F.sum("most").over(w.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0))
    plan = known.withColumns({"floor": F.max("kth").over(w) - MARGIN, "weak": below < F.max("kth").over(w) - MARGIN})
    saves = 2 * F.coalesce(F.sum(F.when(F.col("weak"), F.col("df"))).over(w), F.lit(0)) > F.sum("df").over(w)
    plan = plan.withColumn("needed", ~(F.col("weak") & saves))
    plan = materialize(plan.withColumn("rest", F.coalesce(F.sum(F.when(~F.col("needed"), F.col("most"))).over(w), F.lit(0.0))), "search-plan")
    rows = plan.agg(F.sum("df").alias("all"), F.sum(F.when(~F.col("needed"), F.col("df"))).alias("saved")).first()
    if 2 * (rows["saved"] or 0) <= (rows["all"] or 0):
        return summed(weighed, plan.select("query_id", "term")).select("query_id", "ref", F.round("s", 6).alias("score"))
    found = summed(weighed, plan.where("needed").select("query_id", "term", "floor", "rest"), "floor", "rest").where("s + rest >= floor").select("query_id", "ref", "s")
    left = plan.where("NOT needed").select("query_id", "term")
    others = found.select("query_id", "ref").join(left, "query_id").join(weighed, ["term", "ref"]).groupBy("query_id", "ref").agg(F.sum("impact").alias("more"))
    return found.join(others, ["query_id", "ref"], "left").select("query_id", "ref", F.round(F.col("s") + F.coalesce("more", F.lit(0.0)), 6).alias("score"))


def top_hits(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each query by score, then by ref, with hit_rank from 1; each task passes on no more than k a query."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "ref")
    return scores.withColumn("hit_rank", F.row_number().over(w)).where(F.col("hit_rank") <= k)


CLAUSE = r"^([+-]?)(?:([A-Za-z_]+):)?(.*?)(?:\^([0-9]+(?:\.[0-9]+)?))?$"


def clauses(queries: DataFrame, vocabulary: DataFrame, q: str = "q") -> DataFrame:
    """(query_id, clause, must, field, boost, term) of queries in the search syntax; vocabulary has term.

    Words stand between spaces: +word has to be there, -word must not, field:word looks in one field, word^2 counts twice, and *
    stands for any letters. A word with * is compared with the terms of the index as it is, without its accents; others
    go the way of texts. must is 1, -1 or 0.
    """
    part = lambda g: F.regexp_extract("raw", CLAUSE, g)
    rows = queries.select("query_id", F.posexplode(F.filter(F.split(F.coalesce(q, F.lit("")), r"\s+"), lambda x: x != "")).alias("clause", "raw"))
    rows = rows.select("query_id", "clause", F.when(part(1) == "+", 1).when(part(1) == "-", -1).otherwise(0).alias("must"), F.nullif(part(2), F.lit("")).alias("field"), F.coalesce(F.try_to_number(F.nullif(part(4), F.lit("")), F.lit("999999.999999")).cast("double"), F.lit(1.0)).alias("boost"), part(3).alias("word"))
    wild = F.contains("word", F.lit("*"))
    kept = ["query_id", "clause", "must", "field", "boost"]
    plain = rows.where(~wild).select(*kept, F.explode_outer(tokens(F.col("word"))).alias("term"))
    # Joined by the first letter; a word that begins with * has none, and every term also stands under no letter.
    pattern = F.replace(fold(F.col("word")), F.lit("*"), F.lit("%"))
    asked = rows.where(wild).withColumn("pattern", pattern).withColumn("letter", F.when(F.startswith("pattern", F.lit("%")), "").otherwise(F.left("pattern", F.lit(1))))
    terms = vocabulary.select("term", F.explode(F.array(F.left("term", F.lit(1)), F.lit(""))).alias("letter"))
    found = asked.join(terms, "letter").where(F.expr("term LIKE pattern")).select(*kept, "term")
    none = asked.select(*kept, F.lit(None).cast("string").alias("term"))  # a clause stays one, even where no term fits
    return plain.unionByName(found).unionByName(none)


def score_clauses(weighed: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, ref, score) of the documents that hold every +word and no -word, and any word at all; asked is of clauses."""
    needed = asked.where("must = 1").groupBy("query_id").agg(F.count_distinct("clause").alias("needed"))
    hits = asked.where("term IS NOT NULL").join(weighed.withColumnRenamed("field", "in_field"), "term").where("field IS NULL OR field = in_field")
    each = hits.groupBy("query_id", "ref", "clause", "must").agg(F.sum(F.col("boost") * F.col("impact")).alias("s"))
    sums = each.groupBy("query_id", "ref").agg(F.sum(F.when(F.col("must") >= 0, F.col("s"))).alias("s"), F.sum(F.when(F.col("must") == 1, 1).otherwise(0)).alias("has"), F.max(F.when(F.col("must") < 0, 1).otherwise(0)).alias("barred"))
    rows = sums.where("barred = 0 AND s IS NOT NULL").join(needed, "query_id", "left").where("has = coalesce(needed, 0)")
    return rows.select("query_id", "ref", F.round("s", 6).alias("score"))


INDEX_TABLES = ("documents", "weighed", "bounds")
#: The fields of stored documents with their boosts.
BOOSTS = {"titre": 2.0, "texte": 1.0}


def stored_documents(docs: DataFrame, ref: str = "ref", newest: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored documents and their document_terms."""
    stored = materialize(latest(docs, ref, newest).withColumnRenamed(ref, "ref"), "stored")
    return stored, document_terms(stored, "ref", BOOSTS)


def index_tables(docs: DataFrame, ref: str = "ref", newest: str | None = None) -> dict[str, DataFrame]:
    """What searches need: the stored documents, the impacts of terms and their bounds."""
    return index_of_stored(*stored_documents(docs, ref, newest))


def index_of_stored(stored: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    """index_tables of stored_documents."""
    weighed = materialize(impacts(*index_of_terms(terms, BOOSTS)), "impacts")
    return {"documents": stored, "weighed": weighed, "bounds": bounds(weighed)}


def write_index(docs: DataFrame, folder: str, ref: str = "ref", newest: str | None = None) -> None:
    """Write an index; impacts lie in order of terms, so that a search reads only the row groups of the terms it asks for."""
    tables = index_tables(docs, ref, newest)
    tables["weighed"].repartitionByRange("term", "ref").sortWithinPartitions("term", "ref").write.mode("overwrite").parquet(f"{folder}/weighed")
    tables["bounds"].repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/bounds")
    tables["documents"].write.mode("overwrite").parquet(f"{folder}/documents")


def read_index(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{t}") for t in INDEX_TABLES}


def search_index(index: dict[str, DataFrame], queries: DataFrame, prefix: str | None = None, k: int = 10, syntax: bool = False) -> DataFrame:
    """Ranked hits with the documents' url and titre; queries has query_id and q. A prefix keeps hits whose url starts so, before the limit.

    With syntax q is read as clauses says, else as words any of which a document may hold.
    """
    weighed, stored = index["weighed"], index["documents"].select("ref", "url", "titre", *[c for c in ("pdf",) if c in index["documents"].columns])
    if syntax:
        scores = score_clauses(weighed, clauses(queries, index["bounds"].select("term")))
    else:
        asked = queries.select("query_id", F.explode(tokens(F.col("q"))).alias("term"))
        # The bounds hold for all documents, so a search in some of them takes every hit.
        scores = score(weighed, asked, None if prefix else index["bounds"], k)
    if prefix:
        scores = scores.join(stored.where(F.startswith(F.col("url"), F.lit(prefix))).select("ref"), "ref", "left_semi")
    return top_hits(scores, k).join(stored, "ref")


def search(docs: DataFrame, queries: DataFrame, prefix: str | None = None, k: int = 10, ref: str = "ref", newest: str | None = None, syntax: bool = False) -> DataFrame:
    """search_index over an index of docs made for this search."""
    return search_index(index_tables(docs, ref, newest), queries, prefix, k, syntax)


def cities(docs: DataFrame, url: str = "url") -> DataFrame:
    """The cities of the indexed pages: the first steps of their addresses."""
    return docs.select(F.split(F.col(url), "/")[0].alias("ville")).where("ville IS NOT NULL AND ville != '_idx'").distinct()
