"""Runs of equal consecutive events in ordered sequences."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.session import materialize

from .fold import bare

# The types of each label column.
TYPES = {
    "segment": ("Titre", "Alinea", "Liste", "Tete", "Pied", "TOC", "Tableau", "Figure", "Article", "Section", "SousSection", "Chapitre", "Annexe", "Amendement"),
    "sequence": ("Titre", "Numero", "Amendement"),
}
PREFIX = re.compile(r"\W*([bio0])[\W_]*(.*?)[\W_]*", re.S)
NONE, BARE = "-", "?"
SCHEMA = "kind string, entity string, label string, first_idx bigint, last_idx bigint, n bigint, first_us bigint, last_us bigint, start string, edge boolean"


def typo_distance(a: str, b: str) -> float:
    """Edit distance where a lost, extra or swapped letter costs 1 and a replaced one 1.5."""
    two, one = None, [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [float(i)]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (0 if x == y else 1.5))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
    return one[-1]


@lru_cache(maxsize=100_000)
def read_label(label: str, types: tuple[str, ...], similarity: float) -> tuple[str, str]:
    """(B, I, ? or -; type) of a label however it is written: ? is a bare I, - no label.

    The type is the one of the vocabulary at the least typo distance. A label whose similarity to it, 1 - distance / length,
    is under the tolerance, and one that starts with no B, I or O, is no label.
    """
    m = PREFIX.fullmatch(bare(label))
    if not m or m[1] in "o0":
        return NONE, ""
    if not m[2]:
        return (BARE, "") if m[1] == "i" else (NONE, "")
    distance, kind = min((typo_distance(m[2], t.lower()), t) for t in types)
    return (m[1].upper(), kind) if 1 - distance / len(kind) >= similarity else (NONE, "")


class Machine:
    """The state machine of one column: takes the events of one entity after another in order, gives the finished runs.

    known says whether it is known what stands before the entity's first event. As long as it isn't, an I or bare I may
    continue a run of another partition, so its run is given as an edge, to be joined with the others of the entity.
    """

    def __init__(self, kind: str, max_gap_us: int | None):
        self.kind, self.max_gap_us, self.out, self.entity, self.run, self.known = kind, max_gap_us, [], None, None, True

    def begin(self, entity: str, known: bool) -> None:
        self.entity, self.known, self.run, self.last = entity, known, None, None

    def close(self, edge: bool = False) -> None:
        if self.run:
            label, first, last, n, t0, t1, start, at_edge = self.run
            self.out.append((self.kind, self.entity, label, first, last, n, t0, t1, start, at_edge or edge))
        self.run = None

    def event(self, bio: str, label: str, first: int, last: int, n: int, t0: int | None, t1: int | None) -> None:
        run = self.run
        if run and self.max_gap_us is not None and t0 is not None and run[5] is not None and t0 - run[5] > self.max_gap_us:
            self.close()
            self.known, run = True, None
            if bio == BARE:
                bio = NONE
        if run and (bio == BARE or bio == "I" and run[0] == label):
            run[2], run[3], run[5] = last, run[3] + n, t1 if t1 is not None else run[5]
            if run[4] is None:
                run[4] = t0
        elif bio == NONE or bio == BARE and self.known:
            self.close()
            self.known, self.last = True, (last, t1)
        else:
            self.close()
            joins = not self.known and bio != "B"
            self.run = [label, first, last, n, t0, t1, bio if joins else "B", joins]
            self.known = self.known or bio != BARE

    def end(self, open_end: bool) -> None:
        """open_end: the entity may go on in another partition."""
        if self.run:
            self.close(open_end)
        elif open_end and self.last:
            at, us = self.last
            self.out.append((self.kind, self.entity, "", at, at, 0, us, us, NONE, True))


def fragments(types: dict[str, tuple[str, ...]], similarity: float, max_gap_us: int | None):
    """For mapInPandas over partitions sorted by entity and order."""

    def frame(machines: list[Machine]) -> pd.DataFrame:
        rows = [r for m in machines for r in m.out]
        for m in machines:
            m.out = []
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"first_us": "Int64", "last_us": "Int64"})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machines = [Machine(k, max_gap_us) for k in types]
        entity, at, seen_any = None, None, False
        known = [{} for _ in types]
        for pdf in batches:
            us = [None if pd.isna(x) else int(x) for x in pdf["us"]]
            columns = []
            for memo, k in zip(known, types, strict=True):
                labels = pdf[k].tolist()
                for x in set(labels) - memo.keys():
                    memo[x] = (NONE, "") if x is None else read_label(x, types[k], similarity)
                columns.append([memo[x] for x in labels])
            for e, i, t, *pairs in zip(pdf["entity"].tolist(), pdf["idx"].tolist(), us, *columns, strict=True):
                if e != entity:
                    for m in machines:
                        if seen_any:
                            m.end(False)
                        m.begin(e, seen_any)
                    entity, seen_any = e, True
                elif i == at:
                    continue
                at = i
                for m, (bio, label) in zip(machines, pairs, strict=True):
                    m.event(bio, label, i, i, 1, t, t)
            yield frame(machines)
        if seen_any:
            for m in machines:
                m.end(True)
            yield frame(machines)

    return run


def join_edges(max_gap_us: int | None):
    """For applyInPandas over the edges of one entity and column: at most a few for each partition of the input."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["first_idx", "last_idx"])
        m = Machine(pdf["kind"].iloc[0], max_gap_us)
        m.begin(pdf["entity"].iloc[0], True)
        whole = lambda x: None if pd.isna(x) else int(x)
        for r in pdf.itertuples(index=False):
            m.event(r.start, r.label, r.first_idx, r.last_idx, r.n, whole(r.first_us), whole(r.last_us))
        m.end(False)
        return pd.DataFrame(m.out, columns=list(pdf.columns)).astype({"first_us": "Int64", "last_us": "Int64"})

    return run


def collapse_runs(df: DataFrame, entity: str, order: str, time: str, types: dict[str, tuple[str, ...]] = TYPES, similarity: float = 0.5, max_gap_us: int | None = None) -> DataFrame:
    """One row for each run of equal consecutive labels: kind, entity, label, first_idx, last_idx, n, duration_us.

    types names the label columns and the vocabulary of each. Rows are range-partitioned by entity and order, so an entity of
    any size is spread evenly; a state machine streams over each sorted partition, and only the runs at partition edges, a few
    for each partition whatever the data, are joined afterwards. max_gap_us ends a run where the time between two events is
    longer; None sets no limit.

    Rows of equal entity and order count once (the first by time, then by labels). Rows with a null entity or order have no
    place in a sequence and take no part. Null or blank labels end a run; null times give a null duration only where a run has
    none at all. An empty table gives an empty result; other columns of df are not read.
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(`{time}` AS TIMESTAMP_NTZ))")
    rows = df.select(F.col(entity).cast("string").alias("entity"), F.col(order).cast("bigint").alias("idx"), micros.alias("us"), *[F.col(k).cast("string").alias(k) for k in types])
    rows = rows.where(F.col("entity").isNotNull() & F.col("idx").isNotNull())
    rows = rows.repartitionByRange("entity", "idx").sortWithinPartitions("entity", "idx", "us", *types)
    parts = materialize(rows.mapInPandas(fragments(types, similarity, max_gap_us), SCHEMA), "run-fragments")
    edges = parts.where("edge").groupBy("kind", "entity").applyInPandas(join_edges(max_gap_us), SCHEMA)
    return parts.where("NOT edge").unionByName(edges).select("kind", "entity", "label", "first_idx", "last_idx", "n", (F.col("last_us") - F.col("first_us")).alias("duration_us"))
