"""Queries over words: scans, layout, features, labels, blocks; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.functions.features import FEATURES, bullets, page_features, transform_label
from tessellum.functions.text import BULLETS, PUNCTUATION
from tessellum.operators import iob, layout, words
from tessellum.schema import BLOCK_TYPES, SPAN_TYPES, WORD_COLUMNS
from tessellum.tables import table

KEY = ["fileid", "word_idx"]
SQL: dict[str, str] = {}
QUERIES: dict[str, object] = {}


def sql_label(column: str, types: tuple[str, ...]) -> str:
    return f"CASE WHEN regexp_full_match({column}, 'O|I|[BI]-({'|'.join(types)})') THEN {column} ELSE 'O' END"


WORDS = f"""words AS (SELECT DISTINCT fileid, word_idx, coalesce(text, '') AS text, {', '.join(WORD_COLUMNS[3:])},
  {sql_label('segment', BLOCK_TYPES)} AS seg, {sql_label('sequence', SPAN_TYPES)} AS span FROM word_rows WHERE fileid IS NOT NULL AND page IS NOT NULL AND word_idx IS NOT NULL)"""
PAGE_WINDOW = "WINDOW w AS (PARTITION BY fileid, page ORDER BY word_idx)"


def query(sql: str | None = None):
    """Register a query under its function's name; {words} in its SQL stands for the tidy words."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{words}", WORDS)
        return f

    return add


def tidy(spark: SparkSession, d: str) -> DataFrame:
    return words.tidy_words(table(spark, d, "word_rows"))


@query("WITH {words} SELECT fileid, word_idx, text, page, x0, x1, top, bottom, seg, span FROM words")
def words_scan(spark, d):
    return tidy(spark, d).select(*KEY, "text", "page", "x0", "x1", "top", "bottom", "seg", "span")


@query("WITH {words} SELECT fileid, word_idx, page FROM words WHERE x0 >= 0 AND top >= 0 AND x1 <= page_width AND bottom <= page_height")
def words_onpage(spark, d):
    return words.on_page(tidy(spark, d)).select(*KEY, "page")


@query("WITH {words} SELECT fileid, word_idx, page, list_position([3, 1, 2], page) AS page_rank FROM words WHERE page IN (3, 1, 2)")
def page_select(spark, d):
    return words.select_pages(tidy(spark, d), [3, 0, 2]).select(*KEY, "page", F.col("page_rank"))


@query("WITH {words} SELECT fileid, word_idx, text FROM words WHERE NOT contains(seg, 'Tableau') AND NOT contains(coalesce(tagstack, ''), 'Table')")
def filter_tab(spark, d):
    return words.outside_tables(tidy(spark, d)).select(*KEY, "text")


SQL_LINES = f"""moved AS (SELECT *, x0 - coalesce(lag(x0) OVER w, 0) AS dx, top - coalesce(lag(top) OVER w, 0) AS dy FROM words {PAGE_WINDOW}),
lined AS (SELECT *, CAST(sum(CASE WHEN dx <= 0 AND dy > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY fileid, page ORDER BY word_idx) AS INTEGER) AS line FROM moved)"""
SQL_STATS = f"""{SQL_LINES}, heads AS (SELECT fileid, page, line, count(*) AS n_words, max(bottom - top) AS height, arg_min(x0, word_idx) AS "left", arg_max(x1, word_idx) AS "right",
  min(top) AS top, max(bottom) AS bottom, arg_min(page_height, word_idx) AS page_height FROM lined GROUP BY ALL),
stats AS (SELECT *, top - coalesce(lag(bottom) OVER v, 0) AS gap, "left" - coalesce(lag("left") OVER v, "left") AS indent FROM heads WINDOW v AS (PARTITION BY fileid, page ORDER BY line))"""


@query("WITH {words}, " + SQL_LINES + " SELECT fileid, word_idx, page, line FROM lined")
def line_breaks(spark, d):
    return layout.break_lines(tidy(spark, d)).select(*KEY, "page", "line")


@query("WITH {words}, " + SQL_STATS + ' SELECT fileid, page, line, n_words, height, "left", "right", top, bottom, gap, indent FROM stats')
def line_stats(spark, d):
    return layout.line_table(layout.break_lines(tidy(spark, d))).drop("page_height")


def joined(df: DataFrame) -> DataFrame:
    """Features as one string; arrays are not compared."""
    return df.select(*KEY, F.array_join("features", " ").alias("features"))


@query(
    "WITH {words}, " + SQL_STATS + """ SELECT l.fileid, l.word_idx, concat_ws(' ',
  'first=' || CASE WHEN row_number() OVER (PARTITION BY l.fileid, l.page, l.line ORDER BY l.word_idx) = 1 THEN 1 ELSE 0 END,
  'last=' || CASE WHEN row_number() OVER (PARTITION BY l.fileid, l.page, l.line ORDER BY l.word_idx DESC) = 1 THEN 1 ELSE 0 END,
  'line:height=' || s.height, 'line:left=' || s."left", 'line:top=' || s.top, 'line:bottom=' || (s.page_height - s.bottom), 'line:gap=' || s.gap, 'line:indent=' || s.indent) AS features
  FROM lined l JOIN stats s USING (fileid, page, line)"""
)
def layout_features(spark, d):
    return joined(FEATURES["layout"](tidy(spark, d)))


def sql_bool(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'True' ELSE 'False' END"


def sql_text_features(plus: bool) -> str:
    punctuation = PUNCTUATION.replace("'", "''")
    upper = r"regexp_matches(text, '\p{Lu}') AND NOT regexp_matches(text, '\p{Ll}|\p{Lt}')"
    title = r"regexp_matches(text, '[\p{Lu}\p{Lt}]') AND NOT regexp_matches(text, '(?:^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}|[\p{Lu}\p{Ll}\p{Lt}][\p{Lu}\p{Lt}]')"
    style = ["'rgb=' || coalesce(rgb, '')", *[f"'{k}=' || {sql_bool(f'''contains(lower(coalesce(fontname, '')), '{k}')''')}" for k in ("bold", "italic")]] if plus else []
    parts = [
        "'lower=' || lower(text)",
        f"'uppercase=' || {sql_bool(upper)}",
        f"'title=' || {sql_bool(title)}",
        f"'punc=' || {sql_bool(f'''regexp_full_match(text, '{punctuation}+')''')}",
        f"'endpunc=' || {sql_bool(f'''regexp_full_match(text, '.*{punctuation}')''')}",
        f"'multipunc=' || {sql_bool(f'''regexp_full_match(text, '{punctuation}{{4,}}')''')}",
        f"'numeric=' || {sql_bool(chr(92).join(('regexp_full_match(text, ', 'p{N}+)')).replace('(text, ', '(text, ' + chr(39)).replace('+)', '+' + chr(39) + ')'))}",
        *style,
        *[f"'head:{k}=' || {sql_bool(f'''list_contains(heads, '{k}')''')}" for k in ("table", "chapitre", "annexe")],
        *[f"CASE WHEN regexp_matches(text, '{p.replace('$', '')}$') THEN 'bullet={k}' END" for k, p in BULLETS.items()],
    ]
    return f"""WITH {{words}},
    tops AS (SELECT *, CASE WHEN top <> first_value(top) OVER w THEN 1 ELSE 0 END AS other FROM words {PAGE_WINDOW}),
    seen AS (SELECT *, max(other) OVER w AS changed FROM tops {PAGE_WINDOW}),
    firsts AS (SELECT fileid, page, list(lower(text)) FILTER (changed = 0) AS heads FROM seen GROUP BY ALL)
    SELECT fileid, word_idx, concat_ws(' ', {', '.join(parts)}) AS features FROM words JOIN firsts USING (fileid, page)"""


@query(sql_text_features(True))
def text_plus_features(spark, d):
    return joined(FEATURES["text+"](tidy(spark, d)))


@query(sql_text_features(False))
def text_features(spark, d):
    return joined(FEATURES["text"](tidy(spark, d)))


SQL_STRUCTURE = f"['toc=' || CASE WHEN list_contains(string_split(coalesce(tagstack, 'Span'), ';'), 'TOCI') THEN 1 ELSE 0 END, 'mctag=' || coalesce(mctag, 'P'), 'header=' || {sql_bool('regexp_matches(coalesce(tagstack, ' + chr(39) * 2 + '), ' + chr(39) + '(^|;)H' + chr(39) + ')')}]"


@query("WITH {words} SELECT fileid, word_idx, array_to_string(" + SQL_STRUCTURE + ", ' ') AS features FROM words")
def structure_features(spark, d):
    return joined(FEATURES["structure"](tidy(spark, d)))


def sql_near(where: str, sign: str) -> str:
    return f"list_transform(list_filter(coalesce({where}(f) OVER w, []), lambda x: NOT contains(x, ':')), lambda x: '{sign}:' || x)"


@query(
    "WITH {words}, own AS (SELECT *, " + SQL_STRUCTURE + " AS f FROM words) SELECT fileid, word_idx, array_to_string(['bias'] || f || " + sql_near("lead", "+1") + " || " + sql_near("lag", "-1") + ", ' ') AS features FROM own " + PAGE_WINDOW
)
def page_ngrams(spark, d):
    return joined(page_features(tidy(spark, d), "structure", 2))


@query("WITH {words} SELECT fileid, word_idx, concat_ws(' ', " + ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), '')" for c in WORD_COLUMNS[2:]) + ") AS features FROM words")
def literal_features(spark, d):
    return joined(FEATURES["literal"](tidy(spark, d)))


@query(
    rf"""WITH {{words}} SELECT fileid, word_idx, concat_ws(' ', 'bias', 'lower=' || lower(text), 'reg=' || {sql_bool("lower(text) = 'règlement'")}, 'n=' || {sql_bool("regexp_matches(text, '^[Nn]')")},
  'alpha=' || {sql_bool(chr(92).join(("regexp_full_match(text, '", "p{L}+')")))}, 'numdash=' || {sql_bool(chr(92).join(("regexp_matches(text, '^[", "p{Nd}-]')")))}, 'bold=' || {sql_bool("contains(lower(coalesce(fontname, '')), 'bold')")}, 'size=' || (bottom - top)) AS features FROM words"""
)
def label_features(spark, d):
    return joined(FEATURES["label"](tidy(spark, d)))


@query("WITH {words}, found AS (SELECT fileid, word_idx, concat_ws(' ', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN 'bullet={k}' END" for k, p in BULLETS.items()) + ") AS kinds FROM words) SELECT * FROM found WHERE kinds <> ''")
def list_markers(spark, d):
    return tidy(spark, d).select(*KEY, F.array_join(bullets(), " ").alias("kinds")).where("kinds != ''")


@query(
    """WITH {words} SELECT fileid, word_idx, CASE WHEN seg LIKE 'I-%' THEN 'I' ELSE seg END AS bonly,
  CASE WHEN seg NOT LIKE '%-%' OR split_part(seg, '-', 2) IN ('Article', 'Chapitre', 'Section', 'SousSection', 'Titre') THEN seg ELSE 'O' END AS tonly, split_part(seg, '-', 1) AS iobonly, seg AS literal FROM words"""
)
def label_transforms(spark, d):
    return tidy(spark, d).select(*KEY, *[transform_label(F.col("seg"), k).alias(k) for k in ("bonly", "tonly", "iobonly", "literal")])


@query(
    """WITH {words}, named AS (SELECT *, CASE WHEN seg <> 'I' THEN split_part(seg, '-', 2) END AS name, row_number() OVER v AS k FROM words WINDOW v AS (PARTITION BY fileid ORDER BY word_idx))
  SELECT fileid, word_idx, CASE WHEN seg = 'I' AND k > 1 THEN 'I-' || coalesce(last_value(name IGNORE NULLS) OVER (PARTITION BY fileid ORDER BY word_idx), '') ELSE seg END AS spread FROM named"""
)
def spread_i(spark, d):
    return iob.name_bare_labels(tidy(spark, d)).select(*KEY, "spread")


@query("WITH {words}, ends AS (SELECT fileid, min(page) AS a, max(page) AS b FROM words GROUP BY fileid) SELECT fileid, word_idx, page FROM words JOIN ends USING (fileid) WHERE page = a OR page = b")
def first_last_page(spark, d):
    return iob.first_and_last_page(tidy(spark, d)).select(*KEY, "page")


@query("WITH {words}, pages AS (SELECT DISTINCT fileid, page FROM words) SELECT fileid, page, CAST(row_number() OVER (PARTITION BY fileid ORDER BY page) AS INTEGER) AS page_run FROM pages")
def page_numbers(spark, d):
    return iob.page_runs(tidy(spark, d)).select("fileid", "page", "page_run").distinct()


def sql_blocks(label: str) -> str:
    return f"""cut AS (SELECT *, split_part({label}, '-', 1) AS bio, split_part({label}, '-', 2) AS name FROM words),
    opened AS (SELECT *, sum(CASE WHEN bio IN ('B', 'O') THEN 1 ELSE 0 END) OVER (PARTITION BY fileid ORDER BY word_idx) AS b FROM cut),
    blocks AS (SELECT fileid, b AS bloc, arg_min(name, word_idx) FILTER (name <> '') AS type, string_agg(text, ' ' ORDER BY word_idx) AS text, arg_min(page, word_idx) AS page, count(*) AS n_words,
      min(word_idx) AS first_idx, max(word_idx) AS last_idx, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom FROM opened WHERE bio <> 'O' GROUP BY ALL HAVING count(*) FILTER (name <> '') > 0)"""


@query("WITH {words}, " + sql_blocks("seg") + " SELECT fileid, first_idx, last_idx, type, text, page, n_words FROM blocks")
def iob_blocs(spark, d):
    return iob.group_blocks(tidy(spark, d)).select("fileid", "first_idx", "last_idx", "type", "text", "page", "n_words")


@query("WITH {words}, " + sql_blocks("seg") + " SELECT fileid, first_idx, x0, top, x1, bottom, 'page' || page || '-' || concat_ws(',', x0, top, x1, bottom) || '.jpg' AS img FROM blocks")
def bloc_bbox(spark, d):
    return iob.group_blocks(tidy(spark, d)).select("fileid", "first_idx", *iob.BOX, iob.image_name().alias("img"))


@query("WITH {words}, " + sql_blocks("span") + " SELECT fileid, type, string_agg(text, '|' ORDER BY first_idx) AS texts FROM blocks GROUP BY ALL")
def meta_multimap(spark, d):
    meta = iob.metadata(iob.group_blocks(tidy(spark, d), "span"))
    return meta.select("fileid", F.explode("meta").alias("type", "texts")).withColumn("texts", F.array_join("texts", "|"))


@query(
    "WITH {words}, cut AS (SELECT *, split_part(seg, '-', 1) AS bio, split_part(seg, '-', 2) AS name FROM words), seen AS (SELECT *, lag(bio) OVER w AS was_bio, lag(name) OVER w AS was FROM cut " + PAGE_WINDOW + """),
  judged AS (SELECT *, CASE WHEN bio = 'I' AND name <> '' AND was_bio IN ('B', 'I') AND was <> '' AND was <> name THEN 'type ' || was || ' to ' || name
    WHEN seg = 'I-Liste' AND regexp_full_match(text, '[0-9]+[).°]|[a-zA-Z][).]|[•-]') THEN 'marker in a list item' END AS fault FROM seen)
  SELECT fileid, page, word_idx, seg AS label, text, fault FROM judged WHERE fault IS NOT NULL"""
)
def iob_lint(spark, d):
    return iob.lint(tidy(spark, d))


def four_letters() -> object:
    """A stand-in tokenizer: pieces of at most four characters."""
    return F.regexp_extract_all("text", F.lit(r"(?s).{1,4}"), F.lit(0))


@query(
    """WITH {words}, cut AS (SELECT *, regexp_extract_all(text, '(?s).{1,4}') AS tokens FROM words)
  SELECT fileid, word_idx, k - 1 AS token_id, tokens[k] AS token, CASE WHEN k > 1 AND seg LIKE 'B-%' THEN 'I-' || seg[3:] ELSE seg END AS seg FROM cut, unnest(range(1, len(tokens) + 1)) AS u(k)"""
)
def retokenize(spark, d):
    return iob.retokenize(tidy(spark, d), four_letters()).select(*KEY, "token_id", "token", "seg")


@query("WITH {words} SELECT fileid, word_idx, text, seg FROM words WHERE text <> ''")
def detokenize(spark, d):
    return iob.detokenize(iob.retokenize(tidy(spark, d), four_letters())).select(*KEY, "text", "seg")


@query(
    """WITH {words}, old AS (SELECT text, page, x0, top, arg_max(seg, lpad(CAST(word_idx AS VARCHAR), 12, '0') || fileid) AS was FROM words WHERE mctag IS NOT NULL GROUP BY ALL)
  SELECT w.fileid, w.word_idx, coalesce(nullif(CASE WHEN w.mctag IS NULL THEN '' ELSE w.seg END, ''), was, 'O') AS seg FROM words w LEFT JOIN old USING (text, page, x0, top)"""
)
def update_tags(spark, d):
    """Labels of words without a content tag, taken from words of equal text and place."""
    rows = tidy(spark, d)
    new = rows.withColumn("seg", F.when(F.col("mctag").isNull(), "").otherwise(F.col("seg")))
    last = rows.where("mctag IS NOT NULL")
    order = F.concat(F.lpad(F.col("word_idx").cast("string"), 12, "0"), F.col("fileid"))
    return iob.update_tags(new, last, ("text", "page", "x0", "top"), last=order).select(*KEY, "seg")


def queries() -> dict[str, object]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
