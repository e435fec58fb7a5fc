"""Ranked search of many queries at once: scores of whole blocks of documents by matrix products."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of a group and queries of a group; what one task holds at a time.
GROUP_DOCS, GROUP_QUERIES = 20_000, 100_000
#: A group is worth a task of its own from so many pairs of a document and a query.
GROUP_PAIRS = 2e8
#: Queries and documents scored at a time, and the numbers that a block of documents may take.
TILE, BLOCK, BLOCK_CELLS = 2048, 4096, 8_000_000
#: The first floors come from so many documents.
FIRST = 1024
#: A term goes into the product if that share of the queries asks for it; others are added query by query.
COMMON = 0.05
#: Scores are rounded to that many digits, so that sums in another order rank alike.
DIGITS = 6


def _lists(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of all lists and the length of each."""
    lists = column.combine_chunks()
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _rounded(s: np.ndarray) -> np.ndarray:
    return np.floor(s * 10**DIGITS + 0.5) / 10**DIGITS


class Postings:
    """The impacts of the asked terms in the documents of a group, in order of documents."""

    def __init__(self, docs: pa.Table, vocabulary: pa.Array, df: np.ndarray, stats: list[tuple[float, float, float]], k1: float, b: float):
        n_terms, found = len(vocabulary), []
        for i, (n_docs, mean_length, boost) in enumerate(stats):
            flat, lengths = _lists(docs[f"t{i}"])
            ids = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.repeat(np.arange(len(lengths)), lengths)
            key, tf = np.unique(at[ids >= 0] * n_terms + ids[ids >= 0], return_counts=True)
            doc, term = key // n_terms, key % n_terms
            idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
            found.append((doc, term, boost * idf[term] * (tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[doc] / max(mean_length, 1e-9))))))
        self.fields, self.n_terms = found, n_terms

    def block(self, first: int, end: int) -> np.ndarray:
        """The impacts by term and document of the documents from first to end."""
        out = np.zeros((self.n_terms, end - first))
        for doc, term, impact in self.fields:
            at = slice(*np.searchsorted(doc, (first, end)))
            out[term[at], doc[at] - first] += impact[at]
        return out


class Tile:
    """Some queries and the best documents found for them so far."""

    def __init__(self, terms: np.ndarray, lengths: np.ndarray, common: np.ndarray, n_terms: int, k: int):
        self.terms, self.lengths, self.k = terms, lengths, k
        self.starts = np.cumsum(lengths) - lengths
        # Single precision errs by less than this share, as all impacts are positive.
        self.slack = 1 - (int(lengths.max()) + 4) * 2.0**-23
        place = np.full(n_terms, -1)
        place[common] = np.arange(len(common))
        of, to = np.repeat(np.arange(len(lengths)), lengths), place[terms]
        self.asks = np.zeros((len(lengths), len(common)), np.float32)
        self.asks[of[to >= 0], to[to >= 0]] = 1
        rest = to < 0
        self.rest = [(int(q), r) for q, r in zip(np.unique(of[rest]), np.split(terms[rest], np.flatnonzero(np.diff(of[rest])) + 1), strict=True)] if rest.any() else []
        self.q, self.s, self.doc = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        # What a score must have to be looked at: any at first.
        self.floor = np.full(len(lengths), np.finfo(np.float32).tiny, np.float32)

    def raise_floor(self, q: np.ndarray, score: np.ndarray) -> None:
        """For the queries q a k-th document has that score or a greater one."""
        least = ((score - 2 * 10.0**-DIGITS) * self.slack).astype(np.float32)
        self.floor[q] = np.maximum(self.floor[q], np.nextafter(least, np.float32(-1)))

    def take(self, first: int, exact: np.ndarray, rough: np.ndarray, common: np.ndarray, there: np.ndarray) -> None:
        """Score a block of documents, of which first is the number of the first one; rough is exact in single precision."""
        scores = self.asks @ rough[common]
        for q, terms in self.rest:
            if len(some := terms[there[terms]]):
                scores[q] += np.add.reduce(rough.take(some, axis=0), axis=0)
        if not len(self.q) and scores.shape[1] >= self.k:
            some = scores[:, :FIRST] if self.k <= FIRST else scores
            self.raise_floor(np.arange(len(scores)), np.partition(some, some.shape[1] - self.k, axis=1)[:, -self.k].astype(np.float64) * self.slack)
        rows = np.flatnonzero(scores.max(axis=1, initial=0) >= self.floor)
        for part in np.array_split(rows, max(1, len(rows) // 256)):
            q, doc = np.nonzero(scores[part] >= self.floor[part, None])
            if len(q):
                self.keep(part[q], doc, first, exact)

    def keep(self, q: np.ndarray, doc: np.ndarray, first: int, exact: np.ndarray) -> None:
        """Keep the k best of the documents kept and of these, equal scores in order of documents."""
        s = np.empty(len(q))
        for a in range(0, len(q), 100_000):
            some, at = q[a : a + 100_000], doc[a : a + 100_000]
            n = self.lengths[some]
            ends = np.cumsum(n)
            each = np.arange(ends[-1]) + np.repeat(self.starts[some] - (ends - n), n)
            s[a : a + 100_000] = np.add.reduceat(exact[self.terms[each], np.repeat(at, n)], ends - n)
        mine = np.isin(self.q, q)
        all_q, all_s, all_doc = np.concatenate([self.q[mine], q]), np.concatenate([self.s[mine], _rounded(s)]), np.concatenate([self.doc[mine], doc + first])
        order = np.lexsort((all_doc, -all_s, all_q))
        of = all_q[order]
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
        best = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.raise_floor(all_q[full], all_s[full])
        self.q, self.s, self.doc = np.concatenate([self.q[~mine], all_q[best]]), np.concatenate([self.s[~mine], all_s[best]]), np.concatenate([self.doc[~mine], all_doc[best]])


def best_in_group(stats: list[tuple[float, float, float]], k: int, k1: float, b: float):
    """For applyInArrow over the documents and queries of a group: the k best of these documents for each query."""

    def run(docs: pa.Table, queries: pa.Table) -> pa.Table:
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(docs) and len(queries):
            docs = docs.take(pc.sort_indices(docs["ref"]))
            flat, lengths = _lists(queries["terms"])
            coded = flat.dictionary_encode()
            terms, vocabulary = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            df = np.empty(len(vocabulary))
            df[terms] = _lists(queries["dfs"])[0].to_numpy(zero_copy_only=False)
            postings = Postings(docs, vocabulary, df, stats, k1, b)
            common = np.flatnonzero(np.bincount(terms, minlength=len(vocabulary)) > COMMON * len(queries))
            starts = np.append(0, np.cumsum(lengths))
            tiles = [(a, Tile(terms[starts[a] : starts[min(a + TILE, len(lengths))]], lengths[a : a + TILE], common, len(vocabulary), k)) for a in range(0, len(lengths), TILE)]
            size = max(64, min(BLOCK, BLOCK_CELLS // max(1, len(vocabulary))))
            for first in range(0, len(docs), size):
                exact = postings.block(first, min(first + size, len(docs)))
                rough = exact.astype(np.float32)
                there = rough.any(axis=1)
                for _, tile in tiles:
                    tile.take(first, exact, rough, common, there)
            got += [(t.q + a, t.doc, t.s) for a, t in tiles]
        q, doc, s = (np.concatenate(x) for x in zip(*got, strict=True))
        return pa.table({"query_id": queries["query_id"].take(pa.array(q)), "ref": docs["ref"].take(pa.array(doc)), "score": s})

    return run


def batch_scores(terms: DataFrame, asked: DataFrame, boosts: dict[str, float], k: int = 10, among: DataFrame | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, ref, score): documents with their scores by BM25, at least the k best of each query; top_hits takes these.

    terms is of document_terms, boosts has its fields, asked has query_id and term; among has the refs that may be found, without it all.
    Every query meets every document, in groups of some documents and some queries that stand alone: what goes from task to
    task are the documents once for each group of queries, the queries once for each group of documents, and k rows a
    query and group of documents. A group scores in single precision, and in double what may be among the best.
    """
    spark = terms.sparkSession
    sums = [F.sum(F.size(F.col("parts")[i]["terms"])).alias(f"n{i}") for i in range(len(boosts))]
    totals = terms.agg(F.count("*").alias("docs"), *sums).first()
    stats = [(float(totals["docs"]), (totals[f"n{i}"] or 0) / max(1, totals["docs"]), float(x)) for i, x in enumerate(boosts.values())]
    dfs = terms.select(F.explode(F.array_distinct(F.flatten(F.col("parts.terms")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    known = asked.distinct().join(dfs, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", "df")).alias("x"))
    queries = known.select("query_id", F.col("x.term").alias("terms"), F.col("x.df").alias("dfs"))
    docs = terms if among is None else terms.join(among.select("ref").distinct(), "ref", "left_semi")
    n_docs, n_queries = totals["docs"] if among is None else among.count(), asked.agg(F.count_distinct("query_id")).first()[0]
    parts = max(1, math.ceil(n_docs / GROUP_DOCS), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n_docs * n_queries / GROUP_PAIRS)))
    chunks = max(1, math.ceil(n_queries / GROUP_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    # The number is named, as adaptive execution would put groups that are small before they are scored into few tasks.
    tasks = 4 * parts * chunks
    left = docs.select("ref", *[F.col("parts")[i]["terms"].alias(f"t{i}") for i in range(len(boosts))], of("ref", parts).alias("part"), every(chunks).alias("chunk")).repartition(tasks, "part", "chunk")
    right = queries.select("query_id", "terms", "dfs", of("query_id", chunks).alias("chunk"), every(parts).alias("part")).repartition(tasks, "part", "chunk")
    schema = f"query_id {asked.schema['query_id'].dataType.simpleString()}, ref {terms.schema['ref'].dataType.simpleString()}, score double"
    return left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInArrow(best_in_group(stats, k, k1, b), schema)
