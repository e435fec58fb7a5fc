"""Queries of the general data problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.operators.nested import flatten_records
from tessellum.operators.rejects import split_records
from tessellum.schema import BLOCK_TYPES, SPAN_TYPES, WORD_COLUMNS, WORD_INTS
from tessellum.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return split_records(table(spark, d, "raw_rows"))[1].select("row_id", "reason")


def p2_valid(spark: SparkSession, d: str) -> DataFrame:
    return split_records(table(spark, d, "raw_rows"))[0].select("row_id", "path", "line_no", *WORD_COLUMNS)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    tables = flatten_records(table(spark, d, "doc_records"))
    links = lambda t: tables[t].where("parent IS NOT NULL").select("fileid", F.col("parent").alias("parent_path"), F.col("path").alias("child_path"))
    return links("elements").unionByName(links("links"))


def p5_words(spark: SparkSession, d: str) -> DataFrame:
    return flatten_records(table(spark, d, "doc_records"))["words"].select("fileid", "parent", "place", "text", "page", "x0", "x1", "top", "bottom")


def queries() -> dict[str, object]:
    return {f.__name__: f for f in (p2_found, p2_valid, p5_found, p5_words)}


def _raw_checks() -> str:
    """SQL: each record with its fields and the reason it fails for."""
    field = '(?:"[^"]*(?:""[^"]*)*"|[^",]*)'
    f = {c: f"f[{i}]" for i, c in enumerate(WORD_COLUMNS, 1)}
    digits = " AND ".join(f"regexp_full_match({f[c]}, '[0-9]+')" for c in WORD_INTS if c != "mcid")
    blocks, spans = "|".join(BLOCK_TYPES), "|".join(SPAN_TYPES)
    return rf"""
    records AS (SELECT *, regexp_replace(coalesce(raw, ''), '\r$', '') AS line FROM raw_rows WHERE line_no IS NULL OR line_no > 1),
    quoted AS (SELECT *, regexp_full_match(line, '(?s){field}(?:,{field})*') AS ok FROM records),
    fielded AS (SELECT *, CASE WHEN ok THEN list_transform(regexp_extract_all(',' || line, '(?s),({field})', 1),
        lambda x: CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END) END AS f FROM quoted),
    judged AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN len(f) <> {len(WORD_COLUMNS)} THEN 'columns'
        WHEN NOT ({digits}) THEN 'value'
        WHEN {" OR ".join(f"(regexp_full_match({f[c]}, '[0-9]+') AND try_cast({f[c]} AS BIGINT) IS NULL)" for c in WORD_INTS)} THEN 'value'
        WHEN try_cast({f["page"]} AS HUGEINT) < 1 OR try_cast({f["x0"]} AS HUGEINT) > try_cast({f["x1"]} AS HUGEINT)
          OR try_cast({f["top"]} AS HUGEINT) > try_cast({f["bottom"]} AS HUGEINT)
          OR NOT regexp_full_match(trim({f["mcid"]}), '[0-9]*') OR (trim({f["mcid"]}) <> '' AND NOT regexp_full_match({f["mcid"]}, '[0-9]+'))
          OR (trim({f["rgb"]}) <> '' AND NOT regexp_full_match({f["rgb"]}, '#[0-9A-Fa-f]{{3,4}}'))
          OR NOT regexp_full_match({f["segment"]}, 'O|I|[BI]-({blocks})')
          OR (trim({f["sequence"]}) <> '' AND NOT regexp_full_match({f["sequence"]}, 'O|[BI]-({spans})'))
          OR {f["text"]} = '' OR contains({f["text"]}, chr(65533)) THEN 'value' END AS reason FROM fielded)"""


NEWEST = "docs AS (SELECT fileid, json(max_by(record, struct_pack(a := loaded_at, b := record))) AS r FROM doc_records WHERE record IS NOT NULL GROUP BY fileid)"


def _listed(node: str, path: str) -> str:
    """SQL: the list at a path of a JSON value; a lone object is a list of one."""
    return f"CASE json_type({node} -> '{path}') WHEN 'ARRAY' THEN CAST({node} -> '{path}' AS JSON[]) WHEN 'OBJECT' THEN [{node} -> '{path}'] ELSE [] END"


def oracle_sql() -> dict[str, str]:
    typed = ", ".join(f"try_cast(nullif(f[{i}], '') AS BIGINT) AS {c}" if c in WORD_INTS else f"nullif(f[{i}], '') AS {c}" for i, c in enumerate(WORD_COLUMNS, 1))
    return {
        "p2_found": f"WITH {_raw_checks()} SELECT row_id, reason FROM judged WHERE reason IS NOT NULL",
        "p2_valid": f"WITH {_raw_checks()} SELECT row_id, path, line_no, {typed} FROM judged WHERE reason IS NULL",
        "p5_words": f"""
        WITH {NEWEST}, blocs AS (SELECT fileid, i, b[i + 1] AS bloc FROM (SELECT fileid, {_listed("r", "$.contenu")} AS b FROM docs) t, unnest(range(len(b))) AS u(i)),
        mots AS (SELECT fileid, 'contenu/' || i AS parent, CAST(j AS INTEGER) AS place, m[j + 1] AS mot FROM (SELECT fileid, i, {_listed("bloc", "$.contenu")} AS m FROM blocs WHERE json_type(bloc) = 'OBJECT') t, unnest(range(len(m))) AS u(j))
        SELECT fileid, parent, place, mot ->> '$.text' AS text, {", ".join(f"try_cast(mot ->> '$.{c}' AS INTEGER) AS {c}" for c in ("page", "x0", "x1", "top", "bottom"))} FROM mots WHERE json_type(mot) = 'OBJECT'""",
        "p5_found": """
        WITH RECURSIVE docs AS (SELECT fileid, json(max_by(record, struct_pack(a := loaded_at, b := record))) AS r FROM doc_records WHERE record IS NOT NULL GROUP BY fileid),
        tree AS (
          SELECT fileid, NULL::VARCHAR AS parent_path, 'paliers/Document/0' AS child_path, CASE json_type(r -> '$.paliers.Document') WHEN 'ARRAY' THEN r -> '$.paliers.Document[0]' ELSE r -> '$.paliers.Document' END AS node FROM docs
          UNION ALL
          SELECT fileid, child_path, child_path || '/sub/' || i, kids[i + 1]
          FROM (SELECT fileid, child_path, CASE json_type(node -> '$.sub') WHEN 'ARRAY' THEN CAST(node -> '$.sub' AS JSON[]) WHEN 'OBJECT' THEN [node -> '$.sub'] ELSE [] END AS kids FROM tree) t, unnest(range(len(kids))) AS u(i)
        ),
        blocs AS (SELECT fileid, i, b[i + 1] AS bloc FROM (SELECT fileid, CASE json_type(r -> '$.contenu') WHEN 'ARRAY' THEN CAST(r -> '$.contenu' AS JSON[]) WHEN 'OBJECT' THEN [r -> '$.contenu'] ELSE [] END AS b FROM docs) t, unnest(range(len(b))) AS u(i)),
        liens AS (SELECT fileid, 'contenu/' || i AS parent_path, len(CASE json_type(bloc -> '$.liens') WHEN 'ARRAY' THEN CAST(bloc -> '$.liens' AS JSON[]) WHEN 'OBJECT' THEN [bloc -> '$.liens'] ELSE [] END) AS n FROM blocs)
        SELECT fileid, parent_path, child_path FROM tree WHERE parent_path IS NOT NULL
        UNION ALL SELECT fileid, parent_path, parent_path || '/liens/' || j FROM liens, unnest(range(n)) AS u(j)""",
    }
