"""Queries of this subpackage over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessellum.tables import table

from .canon import consistent_form
from .fold import pairs
from .leaks import find_leaks
from .mixture import mix_sources
from .runs import TYPES, collapse_runs
from .sentences import split_sentences
from .split import split_oversized


#: The gap in p1_timed: an eighth of the words or so are saved later after the word before.
GAP_US = 2_800_000
#: White space as Python and Unicode know it, for both regular expression engines.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def word_runs(spark: SparkSession, d: str) -> DataFrame:
    return collapse_runs(table(spark, d, "word_rows"), "fileid", "word_idx", "saved_at")


def p1_timed(spark: SparkSession, d: str) -> DataFrame:
    """Runs that also end where a word was saved more than the gap after the one before."""
    runs = collapse_runs(table(spark, d, "word_rows"), "fileid", "word_idx", "saved_at", max_gap_us=GAP_US)
    return runs.select("kind", F.col("entity").alias("fileid"), "label", F.col("first_idx").alias("first_word_idx"), F.col("last_idx").alias("last_word_idx"), F.col("n").alias("n_words"), "duration_us")


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    return word_runs(spark, d).select("kind", F.col("entity").alias("fileid"), "label", F.col("first_idx").alias("first_word_idx"), F.col("last_idx").alias("last_word_idx"), F.col("n").alias("n_words"), "duration_us")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_runs(spark, d).where("n_words >= 2").select("kind", "fileid", "first_word_idx", "last_word_idx")


def texts_and_titles(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "word_rows").select(F.lit("word_rows").alias("tab"), "fileid", F.col("word_idx").alias("idx"), "text")
    titles = table(spark, d, "elements").select(F.lit("elements").alias("tab"), "fileid", F.col("el_id").alias("idx"), F.col("titre").alias("text"))
    return words.unionByName(titles)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return consistent_form(texts_and_titles(spark, d), "text").where(F.col("text") != F.col("canonical")).select("tab", "fileid", "idx").distinct()


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent forms with the number of rows and of spellings of each."""
    forms = consistent_form(texts_and_titles(spark, d), "text").groupBy("tab", "canonical", "text").agg(F.count("*").alias("n"))
    return forms.where("canonical IS NOT NULL").groupBy("tab", "canonical").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_spellings"))


def pieces_of(spark: SparkSession, d: str, keep_text: bool = True) -> DataFrame:
    limits = table(spark, d, "split_limits")

    def of(tab: str, item: str, newest: str) -> DataFrame:
        limit = lambda c: limits.where(F.col("tab") == tab).agg(F.min(c)).scalar()
        out = split_oversized(table(spark, d, tab), item, "texte", limit("max_chars"), limit("overlap_chars"), newest, keep_text)
        return out.select(F.lit(tab).alias("tab"), "*", limit("max_chars").alias("max_chars"))

    return of("index_docs", "ref", "indexed_at").unionByName(of("search_results", "hit_id", "searched_at"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces_of(spark, d).select("tab", "item_id", "piece", "start_pos", "end_pos", "shared", "text")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    items = pieces_of(spark, d, keep_text=False).where("piece = 0 AND item_chars > max_chars")
    kinds = F.when(F.col("item_run") > F.col("max_chars"), F.array(F.lit("oversized"), F.lit("unbroken"))).otherwise(F.array(F.lit("oversized")))
    return items.select("tab", "item_id", F.explode(kinds).alias("kind"))


def p4_cover(spark: SparkSession, d: str) -> DataFrame:
    """For each item: the text put together again from its pieces (as a hash), its pieces over the limit and those that share too much."""
    limits = table(spark, d, "split_limits").groupBy("tab").agg(F.min("overlap_chars").alias("overlap_chars"))
    rows = pieces_of(spark, d).join(F.broadcast(limits.limit(1000)), "tab")
    over, shares = F.length("text") > F.col("max_chars"), F.col("shared") > F.col("overlap_chars")
    part = F.struct("piece", F.substr("text", F.col("shared") + 1, F.length("text")).alias("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["text"]), "")
    count = lambda c: F.sum(c.cast("bigint"))
    return rows.groupBy("tab", "item_id").agg(F.md5(whole).alias("texte_md5"), count(over).alias("over_limit"), count(shares).alias("over_overlap"))


def p6_planted(spark: SparkSession, d: str) -> DataFrame:
    """15 words from the middle of each test item with one edit: the item is found by each, so the recall of altered passages is 1."""
    words = F.filter(F.split("text", r"[^\p{L}\p{N}]+"), lambda w: w != "")
    items = table(spark, d, "eval_items").select("item_id", words.alias("w")).where(F.size("w") >= 15).withColumn("at", F.floor((F.size("w") - 15) / 2).cast("int") + 1)
    cut = lambda a, n: F.slice("w", F.col("at") + a, F.lit(n))
    edits = {"lost": F.concat(cut(0, 5), cut(6, 9)), "added": F.concat(cut(0, 8), F.array(F.lit("qwxz")), cut(8, 7)), "changed": F.concat(cut(0, 11), F.array(F.lit("qwxz")), cut(12, 3))}
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.array_join(v, " ").alias("text")) for k, v in edits.items()])
    docs = items.select("item_id", F.inline(kinds)).select((F.col("item_id") * 4 + F.when(F.col("kind") == "lost", 1).when(F.col("kind") == "added", 2).otherwise(3)).alias("doc_id"), "text")
    found = find_leaks(docs, table(spark, d, "eval_items"))
    kind = F.element_at(F.array(F.lit("lost"), F.lit("added"), F.lit("changed")), F.pmod("doc_id", F.lit(4)).cast("int"))
    return found.where(F.col("item_id") == F.floor(F.col("doc_id") / 4)).select("item_id", kind.alias("kind"), F.col("distance").cast("bigint"))


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_leaks(spark, d).where("run_words >= 15").select("doc_id", "item_id").distinct()


def p7_chosen(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_shares(spark, d).where("short").select("mix_id", "source")


def p7_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of each source's part in each mix: uses over max_uses, sums that don't add up, tokens further from the target than rounding whole documents allows."""
    chosen, report = mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    rows = chosen.groupBy("mix_id", "source").agg(F.sum(F.expr("tokens * uses")).alias("tokens"), F.max("uses").alias("most"), F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))
    goal = F.least(F.col("target_tokens"), F.col("max_uses") * F.col("source_tokens"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    return report.join(rows, ["mix_id", "source"], "left").select(
        "mix_id", "source",
        flag(F.col("most") > F.col("max_uses")).alias("over_uses"),
        (flag(F.coalesce("tokens", F.lit(0)) != F.col("used_tokens")) + flag(F.col("n") != F.col("ids"))).alias("sums"),
        flag(F.abs(F.col("used_tokens") - goal) > F.col("most_off")).alias("off_target"),
    )


def p8_cover(spark: SparkSession, d: str) -> DataFrame:
    """For each document: characters in its sentences other than white space, and sentences that overlap or have white space outside."""
    rows = split_sentences(table(spark, d, "documents"), keep_text=True)
    order = Window.partitionBy("doc_id").orderBy("start_pos", "end_pos")
    bad = (F.col("start_pos") < F.lag("end_pos", 1, 0).over(order)) | F.col("sentence").rlike(f"^{SPACE}|{SPACE}\\z") | (F.length("sentence") != F.col("end_pos") - F.col("start_pos"))
    rows = rows.select("doc_id", F.length(F.regexp_replace("sentence", SPACE, "")).alias("n"), bad.alias("bad"))
    return rows.groupBy("doc_id").agg(F.sum("n").cast("bigint").alias("n_chars"), F.sum(F.col("bad").cast("bigint")).alias("faults"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return split_sentences(table(spark, d, "documents")).select("doc_id", F.col("start_pos").cast("bigint"), F.col("end_pos").cast("bigint"))


def queries() -> dict[str, object]:
    return {f.__name__: f for f in (p1_found, p1_runs, p1_timed, p3_found, p3_forms, p4_found, p4_pieces, p4_cover, p6_found, p6_leaks, p6_planted, p7_found, p7_chosen, p7_shares, p7_faults, p8_found, p8_cover)}


def sql_quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_bare(text: str) -> str:
    """SQL: a text in bare small letters."""
    chars, plain, several, hidden = pairs()
    out = f"translate({text}, {sql_quoted(chars)}, {sql_quoted(plain)})"
    for ch, x in several.items():
        if ch.isalpha():
            out = f"replace({out}, '{ch}', '{x}')"
    return f"lower(strip_accents(regexp_replace({out}, '[' || {sql_quoted(hidden)} || ']', '', 'g')))"


def sql_labels(column: str) -> str:
    """SQL: bio and type of every spelling of a label column, by the least number of typos."""
    types = ", ".join(f"'{t}'" for t in TYPES[column])
    return rf"""{column}_read AS (SELECT DISTINCT {column} AS label, {sql_bare(column)} AS x FROM word_rows WHERE {column} IS NOT NULL),
  {column}_cut AS (SELECT label, regexp_extract(x, '^[^a-z0-9]*([bio0])[^a-z0-9]*(.*?)[^a-z0-9]*$', 1) AS bio, regexp_extract(x, '^[^a-z0-9]*([bio0])[^a-z0-9]*(.*?)[^a-z0-9]*$', 2) AS name FROM {column}_read),
  {column}_map AS (SELECT label, any_value(bio) AS bio, any_value(name) AS name, arg_min(t, damerau_levenshtein(name, lower(t)) * 10 + CASE WHEN length(name) = length(t) AND levenshtein(name, lower(t)) = 1 THEN 5 ELSE 0 END) AS type FROM {column}_cut, unnest([{types}]) AS u(t) GROUP BY label),
  {column}_rows AS (SELECT DISTINCT '{column}' AS kind, w.fileid, w.word_idx, w.saved_at, CASE WHEN m.bio IN ('b', 'i') THEN m.bio ELSE '' END AS bio, CASE WHEN m.bio = 'i' AND m.name = '' THEN NULL WHEN m.bio IN ('b', 'i') AND m.name <> '' THEN m.type ELSE '' END AS own
    FROM word_rows w LEFT JOIN {column}_map m ON m.label = w.{column} WHERE w.fileid IS NOT NULL AND w.word_idx IS NOT NULL)"""


def sql_runs(gap_us: int | None = None) -> str:
    late = f"epoch_us(saved_at) - epoch_us(lag(saved_at) OVER (PARTITION BY kind, fileid ORDER BY word_idx)) > {gap_us}" if gap_us else "FALSE"
    both = f"SELECT * REPLACE (CASE WHEN own IS NULL AND late THEN '' ELSE own END AS own) FROM (SELECT *, coalesce({late}, FALSE) AS late FROM ({' UNION ALL '.join(f'SELECT * FROM {c}_rows' for c in TYPES)}))"
    return ", ".join(map(sql_labels, TYPES)) + f""",
  typed AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY kind, fileid ORDER BY word_idx), '') AS type FROM ({both})),
  opened AS (SELECT *, CASE WHEN type = '' OR bio = 'b' OR late OR type <> lag(type, 1, '') OVER (PARTITION BY kind, fileid ORDER BY word_idx) THEN 1 ELSE 0 END AS opens FROM typed),
  numbered AS (SELECT *, sum(opens) OVER (PARTITION BY kind, fileid ORDER BY word_idx) AS run FROM opened),
  runs AS (SELECT kind, fileid, type AS label, min(word_idx) AS first_word_idx, max(word_idx) AS last_word_idx, count(*) AS n_words, epoch_us(arg_max(saved_at, word_idx)) - epoch_us(arg_min(saved_at, word_idx)) AS duration_us FROM numbered WHERE type <> '' GROUP BY kind, fileid, run, type)"""


def sql_form(text: str) -> str:
    """SQL: the consistent form of a text."""
    chars, plain, several, hidden = pairs()
    out = f"translate({text}, {sql_quoted(chars)}, {sql_quoted(plain)})"
    for ch, x in several.items():
        out = f"replace({out}, {sql_quoted(ch)}, {sql_quoted(x)})"
    return f"trim(nfc_normalize(regexp_replace({out}, '[' || {sql_quoted(hidden)} || ']', '', 'g')))"


#: Characters of text in the consistent form, as far as the tables hold them.
SQL_PLAIN = "[ -~À-ÖØ-öø-ÿŒœŸ«»°²³½‘’“”–—…•ΔΘΛΞΠΣΦΨΩβδεζηθλμξπσςφψω]*"


def oracle_sql() -> dict[str, str]:
    """The others need tokenizers, heaps or rules of scripts."""
    one = """SELECT '{tab}' AS tab, {item} AS item_id, max_by(texte, {newest}) AS texte, any_value(max_chars) AS max_chars
        FROM {tab}, (SELECT max_chars FROM split_limits WHERE tab = '{tab}') WHERE texte IS NOT NULL GROUP BY {item}"""
    items = " UNION ALL ".join(one.format(tab=t, item=i, newest=n) for t, i, n in (("index_docs", "ref", "indexed_at"), ("search_results", "hit_id", "searched_at")))
    words = lambda table, key: f"SELECT {key} AS id, regexp_extract_all({sql_bare('text')}, '[\\pL\\pN]+') AS w FROM {table} WHERE text IS NOT NULL AND {key} IS NOT NULL"
    windows = "SELECT DISTINCT id, array_to_string(w[i:i + 14], ' ') AS passage FROM {0}, unnest(range(1, len(w) - 13)) AS u(i)"
    return {
        "p1_found": f"WITH {sql_runs()} SELECT kind, fileid, first_word_idx, last_word_idx FROM runs WHERE n_words >= 2",
        "p1_runs": f"WITH {sql_runs()} SELECT * FROM runs",
        "p1_timed": f"WITH {sql_runs(GAP_US)} SELECT * FROM runs",
        "p3_forms": f"""WITH texts AS (SELECT 'word_rows' AS tab, text FROM word_rows WHERE text IS NOT NULL UNION ALL SELECT 'elements', titre FROM elements WHERE titre IS NOT NULL),
        formed AS (SELECT tab, text, {sql_form('text')} AS form FROM texts)
        SELECT tab, form AS canonical, count(*) AS n_rows, count(DISTINCT text) AS n_spellings FROM formed GROUP BY tab, form""",
        "p3_found": f"""SELECT DISTINCT 'word_rows' AS tab, fileid, word_idx AS idx FROM word_rows WHERE text IS NOT NULL AND (NOT regexp_full_match(text, '{SQL_PLAIN}') OR text LIKE ' %' OR text LIKE '% ')
        UNION SELECT DISTINCT 'elements', fileid, el_id FROM elements WHERE titre IS NOT NULL AND (NOT regexp_full_match(titre, '{SQL_PLAIN}') OR titre LIKE ' %' OR titre LIKE '% ')""",
        "p4_found": rf"""
        WITH items AS ({items}),
        sized AS (SELECT *, list_max(list_transform(regexp_extract_all(texte, '[\pL\pN]+'), lambda x: length(x))) AS longest FROM items)
        SELECT tab, item_id, 'oversized' AS kind FROM sized WHERE length(texte) > max_chars
        UNION ALL SELECT tab, item_id, 'unbroken' FROM sized WHERE length(texte) > max_chars AND longest > max_chars""",
        "p4_cover": f"WITH items AS ({items}) SELECT tab, item_id, md5(texte) AS texte_md5, 0 AS over_limit, 0 AS over_overlap FROM items WHERE texte <> ''",
        "p6_planted": rf"""SELECT item_id, unnest(['lost', 'added', 'changed']) AS kind, 1 AS distance FROM eval_items
        WHERE len(list_filter(string_split_regex(text, '[^\pL\pN]+'), lambda w: w <> '')) >= 15""",
        "p7_faults": "SELECT DISTINCT mix_id, source, 0 AS over_uses, 0 AS sums, 0 AS off_target FROM mix_targets WHERE mix_id IS NOT NULL AND source IS NOT NULL",
        "p8_cover": f"SELECT doc_id, length(regexp_replace(text, '{SPACE}', '', 'g')) AS n_chars, 0 AS faults FROM documents WHERE regexp_replace(text, '{SPACE}', '', 'g') <> ''",
        "p6_found": f"""WITH docs AS ({words("documents", "doc_id")}), tests AS ({words("eval_items", "item_id")}),
        doc_windows AS ({windows.format("docs")}), test_windows AS ({windows.format("tests")})
        SELECT DISTINCT d.id AS doc_id, t.id AS item_id FROM doc_windows d JOIN test_windows t USING (passage)""",
    }
