"""Sequence labelling of pages: a linear chain over hashed features, trained on a bounded sample and applied page by page."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.functions.features import page_features, transform_label
from tessellum.session import materialize


@dataclass
class Chain:
    """A trained model: the label of each column, weights of hashed features by label, and of label pairs in a row."""

    labels: list[str]
    state: np.ndarray
    move: np.ndarray
    kind: str
    n: int

    def best(self, rows: list) -> list[int]:
        """The best label sequence of a page; rows are arrays of feature numbers (Viterbi)."""
        emit = np.stack([self.state[r].sum(axis=0) for r in rows])
        back = np.empty(emit.shape, dtype=np.int32)
        score = emit[0]
        for t in range(1, len(emit)):
            every = score[:, None] + self.move
            back[t] = every.argmax(axis=0)
            score = every.max(axis=0) + emit[t]
        path = [int(score.argmax())]
        for t in range(len(emit) - 1, 0, -1):
            path.append(int(back[t][path[-1]]))
        return path[::-1]


def hashed(df: DataFrame, kind: str, n: int, bits: int) -> DataFrame:
    """(fileid, page, word_idx, x): each word's features as numbers under 2**bits."""
    rows = page_features(df, kind, n)
    return rows.withColumn("x", F.transform("features", lambda f: F.pmod(F.xxhash64(f), F.lit(1 << bits)).cast("int"))).drop("features")


class Trainer:
    """Averaged perceptron over pages: weights that a wrong guess changes, and their sums over the steps for the average."""

    def __init__(self, chain: Chain):
        self.chain, self.step = chain, 1
        self.state, self.move = np.zeros_like(chain.state, dtype=np.float64), np.zeros_like(chain.move, dtype=np.float64)

    def epoch(self, data: list, order) -> None:
        """One pass over the pages, (features of each word, labels)."""
        chain = self.chain
        for k in order:
            x, y = data[k]
            guess = chain.best(x)
            for t, (g, w) in enumerate(zip(guess, y, strict=True)):
                if g != w:
                    # A weight changed at step s counts in the average for the steps after it.
                    np.add.at(chain.state[:, w], x[t], 1)
                    np.add.at(chain.state[:, g], x[t], -1)
                    np.add.at(self.state[:, w], x[t], self.step)
                    np.add.at(self.state[:, g], x[t], -self.step)
                if t and (guess[t - 1], g) != (y[t - 1], w):
                    for a, b, v in ((y[t - 1], w, 1), (guess[t - 1], g, -1)):
                        chain.move[a, b] += v
                        self.move[a, b] += v * self.step
            self.step += 1

    def averaged(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.chain.state - self.state / self.step).astype(np.float32), (self.chain.move - self.move / self.step).astype(np.float32)


def by_page(pdf: pd.DataFrame, at: dict[str, int]) -> list:
    pdf = pdf.sort_values(["fileid", "page", "word_idx"])
    return [([np.asarray(x) for x in p["x"]], [at[y] for y in p["y"]]) for _, p in pdf.groupby(["fileid", "page"])]


def shard_epoch(shared, at: dict[str, int], seed: tuple[int, int]):
    """For applyInPandas over the pages of a shard: the common model (a broadcast chain) after one more pass over them."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        common, data = shared.value, by_page(pdf, at)
        trainer = Trainer(Chain(common.labels, common.state.copy(), common.move.copy(), common.kind, common.n))
        trainer.epoch(data, np.random.default_rng((*seed, int(key[0]))).permutation(len(data)))
        state, move = trainer.averaged()
        return pd.DataFrame([(len(data), zlib.compress(state.tobytes(), 1), zlib.compress(move.tobytes(), 1))], columns=["n", "state", "move"])

    return run


def train(df: DataFrame, label: str = "seg", kind: str = "text+layout+structure", n: int = 2, labels: str = "literal", bits: int = 16, max_pages: int = 300, epochs: int = 4, seed: int = 1381, shards: int = 1) -> Chain:
    """Fit a chain by averaged perceptron on at most max_pages pages of df, those with the least hash of file and page.

    The model has 2**bits rows for the features whatever the data. An empty df gives a model that knows no label but O. One
    shard is trained on the driver, which holds its pages. With more, each epoch is a round in which every shard of the pages
    goes on from the common model on an executor, and the driver averages the models, a fixed size for each shard.
    """
    pages = df.select("fileid", "page").distinct()
    chosen = pages.orderBy(F.xxhash64(F.lit(seed), "fileid", "page"), "fileid", "page").limit(max_pages)
    rows = hashed(df.join(chosen, ["fileid", "page"], "left_semi"), kind, n, bits).withColumn("y", transform_label(F.col(label), labels)).select("fileid", "page", "word_idx", "x", "y")
    if shards > 1:
        rows = materialize(rows, "training")
        names = sorted(r["y"] for r in rows.select("y").distinct().collect()) or ["O"]
    else:
        pdf = rows.toPandas()
        names = sorted(set(pdf["y"])) or ["O"]
    chain = Chain(names, np.zeros((1 << bits, len(names)), dtype=np.float32), np.zeros((len(names), len(names)), dtype=np.float32), kind, n)
    at = {y: k for k, y in enumerate(names)}
    if shards == 1:
        data, rng, trainer = by_page(pdf, at), np.random.default_rng(seed), Trainer(chain)
        for _ in range(epochs):
            trainer.epoch(data, rng.permutation(len(data)))
        chain.state, chain.move = trainer.averaged()
        return chain
    split = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "fileid", "page"), F.lit(shards)).cast("int"))
    for e in range(epochs):
        shared = df.sparkSession.sparkContext.broadcast(chain)
        parts = split.groupBy("shard").applyInPandas(shard_epoch(shared, at, (seed, e)), "n int, state binary, move binary").collect()
        shared.unpersist()
        whole = sum(r["n"] for r in parts)
        mean = lambda c, shape, parts=parts, whole=whole: sum(np.frombuffer(zlib.decompress(bytes(r[c])), dtype=np.float32).reshape(shape) * (r["n"] / whole) for r in parts)
        if whole:
            chain = Chain(names, mean("state", chain.state.shape).astype(np.float32), mean("move", chain.move.shape).astype(np.float32), kind, n)
    return chain


def label_pages(df: DataFrame, chain: Chain, out: str = "predicted") -> DataFrame:
    """(fileid, page, word_idx, out): labels of every page of df; the model goes to the executors once."""
    bits = int(np.log2(len(chain.state)))
    shared = df.sparkSession.sparkContext.broadcast(chain)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        pdf = pdf.sort_values("word_idx")
        return pdf[["fileid", "page", "word_idx"]].assign(**{out: [model.labels[k] for k in model.best([np.asarray(x) for x in pdf["x"]])]})

    rows = hashed(df, chain.kind, chain.n, bits).select("fileid", "page", "word_idx", "x")
    return rows.groupBy("fileid", "page").applyInPandas(run, f"fileid string, page int, word_idx bigint, {out} string")


def explain(chain: Chain, spark, k: int = 50) -> DataFrame:
    """(from_label, to_label, weight) of the strongest k moves between labels."""
    flat = [(a, b, float(chain.move[i, j])) for i, a in enumerate(chain.labels) for j, b in enumerate(chain.labels)]
    return spark.createDataFrame(sorted(flat, key=lambda x: (-abs(x[2]), x))[:k], "from_label string, to_label string, weight double")


def fold_of(*keys: str, folds: int, seed: int = 1381):
    """A fold from 0 for rows of equal keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")


def label_ends(df: DataFrame, chain: Chain, out: str = "predicted") -> DataFrame:
    """(fileid, page, word_idx, out): labels of the first and the last page of each document, O for the words between."""
    from tessellum.operators.iob import first_and_last_page

    found = label_pages(first_and_last_page(df), chain, out)
    return df.select("fileid", "page", "word_idx").join(found, ["fileid", "page", "word_idx"], "left").withColumn(out, F.coalesce(out, F.lit("O")))


def label_by_tree(df: DataFrame, tagged: Chain, untagged: Chain, out: str = "predicted") -> DataFrame:
    """Labels by one of two chains: tagged for documents of which any word has tags, untagged for the others."""
    has = df.groupBy("fileid").agg(F.max(F.when(F.coalesce("tagstack", F.lit("")) != "", 1).otherwise(0)).alias("__tree"))
    rows = df.join(has, "fileid")
    return label_pages(rows.where("__tree = 1").drop("__tree"), tagged, out).union(label_pages(rows.where("__tree = 0").drop("__tree"), untagged, out))


def fold_chains(df: DataFrame, folds: int = 4, label: str = "seg", **settings) -> list[Chain]:
    """A chain for each fold of the files, trained on all files but the fold's."""
    rows = df.withColumn("__fold", fold_of("fileid", folds=folds))
    return [train(rows.where(F.col("__fold") != k).drop("__fold"), label, **settings) for k in range(folds)]


def cross_label(df: DataFrame, chains: list[Chain], out: str = "predicted") -> DataFrame:
    """(fold, fileid, page, word_idx, out): the labels of each fold's files by the chain that hasn't seen them (of fold_chains)."""
    rows = df.withColumn("__fold", fold_of("fileid", folds=len(chains)))
    parts = [label_pages(rows.where(F.col("__fold") == k).drop("__fold"), c, out).withColumn("fold", F.lit(k)) for k, c in enumerate(chains)]
    return reduce(DataFrame.unionByName, parts)


def vote_labels(df: DataFrame, chains: list[Chain], out: str = "predicted") -> DataFrame:
    """(fileid, page, word_idx, out): the label that most chains give each word, of equally many that of the first chain."""
    from tessellum.operators import metrics

    votes = reduce(DataFrame.unionByName, [label_pages(df, c, "vote").withColumn("fold", F.lit(k)) for k, c in enumerate(chains)])
    return metrics.vote(votes, ("fileid", "page", "word_idx"), "vote", "fold").withColumnRenamed("label", out)


def grid(df: DataFrame, settings: list[dict], label: str = "seg", folds: int = 4) -> DataFrame:
    """(setting, f1) of chains with each of the settings: macro F1 over the folds of files, each labelled by a chain that hasn't seen it."""
    from tessellum.operators import metrics

    out = []
    for setting in settings:
        found = cross_label(df, fold_chains(df, folds, label, **setting)).join(df.select("fileid", "page", "word_idx", label), ["fileid", "page", "word_idx"])
        scores = metrics.fold_scores(found, label, "predicted", "fold", folds, F.col("label").startswith("B-")).where("label = 'ALL'").first()
        out.append((str(sorted(setting.items())), float(scores["average"]) if scores else 0.0))
    return df.sparkSession.createDataFrame(out, "setting string, f1 double")


def save(chain: Chain, path: str) -> None:
    """Write a chain to a file of arrays; no code is stored."""
    np.savez_compressed(path, labels=np.array(chain.labels), state=chain.state, move=chain.move, kind=chain.kind, n=chain.n)


def load(path: str) -> Chain:
    with np.load(path) as x:
        return Chain([str(y) for y in x["labels"]], x["state"], x["move"], str(x["kind"]), int(x["n"]))
