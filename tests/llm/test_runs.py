import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessellum.llm.runs import TYPES, collapse_runs, read_label, typo_distance

SCHEMA = "fileid string, word_idx bigint, segment string, sequence string, saved_at timestamp_ntz, label string, n int"


def brute(rows, kind, gap=None):
    """The rules of the problem, one row after another, without partitions."""
    out, files = [], {}
    for r in rows:
        files.setdefault(r[0], {}).setdefault(r[1], r)
    for f, by in files.items():
        run, before = None, None
        for i in sorted(by):
            r = by[i]
            bio, label = read_label(r[2 if kind == "segment" else 3] or "", TYPES[kind], 0.5)
            t = r[4]
            if run and gap is not None and t - run[4] > gap:
                out.append(run)
                run, before = None, None
            now = before if bio == "?" else None if bio == "-" else label
            if run and now is not None and bio != "B" and now == before:
                run[2:5] = [i, run[3] + 1, t]
            else:
                if run:
                    out.append(run)
                run = [f, i, i, 1, t, now] if now is not None else None
            before = now
        if run:
            out.append(run)
    return sorted((x[0], x[5], x[1], x[2], x[3]) for x in out)


def found(df, kind, **kw):
    rows = collapse_runs(df, "fileid", "word_idx", "saved_at", **kw).where(F.col("kind") == kind).collect()
    return sorted((r["entity"], r["label"], r["first_idx"], r["last_idx"], r["n"]) for r in rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("gap", [None, 3])
def test_equals_brute_force_with_files_cut_by_partitions(spark, seed, gap):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for f in ("a", "b", "c"):
        at = start
        for i in range(rng.choice((40, 400))):
            at += timedelta(seconds=rng.choice((1, 1, 1, 1, 5)))
            pick = lambda ts: rng.choice(["I"] * 4 + ["O", None, " ", "B-" + ts[0], "I-" + ts[0], "i – " + ts[0].upper() + ";", "I-" + ts[1], "І:" + ts[1]])
            rows.append((f, i * 2, pick(TYPES["segment"]), pick(TYPES["sequence"]), at, "x", 1))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for kind in TYPES:
            us = None if gap is None else gap * 1_000_000
            assert found(df, kind, max_gap_us=us) == brute(rows, kind, gap and timedelta(seconds=gap))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_duration_and_count(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", i, "B-Titre" if i == 0 else "I", None, t + timedelta(seconds=i), "x", 1) for i in range(4)]
    got = collapse_runs(spark.createDataFrame(rows, SCHEMA), "fileid", "word_idx", "saved_at").collect()
    assert [(r["kind"], r["n"], r["duration_us"]) for r in got] == [("segment", 4, 3_000_000)]


def test_nulls_and_empty_table(spark):
    assert collapse_runs(spark.createDataFrame([], SCHEMA), "fileid", "word_idx", "saved_at").count() == 0
    rows = [(None, 1, "B-Titre", None, None, None, None), ("a", None, "B-Titre", None, None, None, None), ("a", 1, "B-Titre", "", None, None, None), ("a", 2, "I-Titre", "?!", None, None, None)]
    got = collapse_runs(spark.createDataFrame(rows, SCHEMA), "fileid", "word_idx", "saved_at").collect()
    assert [(r["entity"], r["n"], r["duration_us"]) for r in got] == [("a", 2, None)]


@pytest.mark.parametrize(
    ("written", "read"),
    [("I-Alinea", ("I", "Alinea")), ("Ｉ - Аlinéa;", ("I", "Alinea")), ("b_toc", ("B", "TOC")), ("I", ("?", "")), ("І", ("?", "")), ("O​", ("-", "")), (" ", ("-", "")), ("I-Aliena", ("I", "Alinea")), ("I–Ttre", ("I", "Titre")), ("B:SosSection", ("B", "SousSection")), ("x" * 5000, ("-", "")), ("I-zzzzzzzz", ("-", ""))],
)
def test_labels(written, read):
    assert read_label(written, TYPES["segment"], 0.5) == read


def test_typo_distance():
    assert typo_distance("ailnea", "alinea") == 1
    assert typo_distance("tite", "titre") < typo_distance("tite", "tete")
    assert typo_distance("", "abc") == 3
