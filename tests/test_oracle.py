"""Every query with SQL against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def text(x):
    if x is None or isinstance(x, float) and x != x:
        return "NULL"
    if isinstance(x, float):
        return str(int(x)) if x == int(x) else repr(round(x, 5))
    return str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, duck, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(map(text, r)) for r in df.select(*columns).collect())
    cursor = duck.execute(SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(text(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


#: What each query without SQL has to give, as a condition over its rows.
HOLDS = {
    "merge_overlaps": "n_merged >= 1 AND x0 <= x1 AND top <= bottom AND type IS NOT NULL",
    "crf_decode": "predicted RLIKE '^(O|I|[BI]-[A-Za-z]+)$'",
    "crf_vote": "predicted RLIKE '^(O|I|[BI]-[A-Za-z]+)$'",
    "crf_scores": "average BETWEEN 0 AND 1 AND (label = 'ALL' OR label LIKE 'B-%')",
    "crf_moves": "weight IS NOT NULL AND from_label IS NOT NULL",
    "p4_pieces": "end_pos > start_pos AND length(text) = end_pos - start_pos AND shared >= 0",
    "p6_leaks": "distance BETWEEN 0 AND 1 AND run_words >= 7 AND windows >= 1 AND (distance = 0) = (run_words >= 15)",
    "p7_found": "mix_id IS NOT NULL AND source IS NOT NULL",
    "p7_chosen": "uses >= 1 AND tokens >= 0",
    "p7_shares": "used_tokens <= max_uses * source_tokens AND (actual_share BETWEEN 0 AND 1 OR actual_share IS NULL)",
    "p8_found": "end_pos > start_pos AND start_pos >= 0",
}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_sql(name, spark, sf_dir):
    rows = entry.queries()[name](spark, sf_dir)
    assert rows.where(f"NOT coalesce({HOLDS[name]}, false)").isEmpty() and not rows.isEmpty()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
