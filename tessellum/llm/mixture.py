"""Mixtures of sources at target shares of the total size."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.session import materialize

#: Where the vocabulary lies if neither a parameter nor the session's spark.tessellum.vocabulary names it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Documents of a leaf of the tree, on average and at most.
LEAF = 4096
#: How GPT-2's public byte-pair tokenizer cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=2)
def encoder_of(vocabulary: bytes):
    """The tokenizer of a vocabulary file's content; a Python worker builds it once."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(vocabulary):
    """For mapInPandas over (doc_id, source, text): tokens in place of the text; vocabulary is the broadcast content of its file."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(vocabulary.value)
        for pdf in batches:
            yield pdf[["doc_id", "source"]].assign(tokens=[0 if x is None else len(encoder.encode_ordinary(x)) for x in pdf["text"]])

    return run


def with_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, tokens) of every document; a null text has none. The vocabulary file (under 2 MB) is broadcast."""
    with open(vocabulary or docs.sparkSession.conf.get("spark.tessellum.vocabulary", VOCABULARY), "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    return docs.select("doc_id", "source", "text").mapInPandas(count_tokens(content), "doc_id bigint, source string, tokens bigint")


def uniform(seed: int, level: int, *keys: str) -> Column:
    """A number from 0 to 1 that depends on the keys alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *keys), F.lit(1 << 53)) / F.lit(float(1 << 53))


def settle(p: float, q: float, u: float) -> tuple[float, float]:
    """One pivotal step: mass moves between two fractions until one is 0 or 1; each keeps its expectation. u is uniform."""
    total = p + q
    if total < 1:
        return (total, 0.0) if u * total < p else (0.0, total)
    if u * (2 - total) < 1 - q:
        return 1.0, total - 1
    return total - 1, 1.0


def pivot(fractions: Iterable[float], draws: Iterable[float]) -> tuple[list[int], int | None, float]:
    """Settle fractions one after the other: 0 or 1 for each, the place of the one left over and its rest.

    Where units come by falling size, mass moves between units of like sizes, and the one left over is the smallest of them,
    so that the total size is off by no more than the largest unit.
    """
    done: list[int] = []
    held, rest = None, 0.0
    for k, (q, u) in enumerate(zip(fractions, draws, strict=True)):
        done.append(0)
        if held is None:
            held, rest = k, q
        else:
            a, b = settle(rest, q, u)
            if a in (0.0, 1.0):
                done[held] = int(a)
                held, rest = k, b
            else:
                done[k], rest = int(b), a
        if rest <= 1e-12 or rest >= 1 - 1e-12:
            done[held] = round(rest)
            held = None
    return done, held, rest


ROUNDED = "mix_id int, source string, doc_id bigint, tokens bigint, uses int, rest double, node bigint"
NAMES = [c.split()[0] for c in ROUNDED.split(", ")]


def round_leaf(key: tuple, units: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    """For cogrouped applyInPandas over a leaf's documents and the mixes of its source: copies of every document in every mix."""
    units = units.sort_values(["tokens", "place", "doc_id"], ascending=[False, True, True])
    out = []
    for mix, seed, copies in zip(plan["mix_id"], plan["seed"], plan["copies"], strict=True):
        whole = int(copies)
        if copies == whole:
            uses, held, rest = [0] * len(units), None, 0.0
        else:
            # The place of a document and the seed of a mix make the draw: a fixed shuffle of 64 bits, read as a fraction.
            draws = mixed(units["place"].to_numpy(dtype=np.uint64), np.uint64(seed % (1 << 64)))
            uses, held, rest = pivot([copies - whole] * len(units), draws.tolist())
        rows = pd.DataFrame({"mix_id": mix, "source": key[0], "doc_id": units["doc_id"].to_numpy(), "tokens": units["tokens"].to_numpy(), "uses": np.array(uses, dtype=np.int64) + whole, "rest": 0.0, "node": key[1]})
        if held is not None:
            rows.iloc[held, rows.columns.get_loc("rest")] = rest
        out.append(rows[(rows["uses"] > 0) | (rows["rest"] > 0)])
    return pd.concat(out)[NAMES] if out and len(units) else pd.DataFrame(columns=NAMES)


def mixed(x: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Numbers from 0 to 1 by the SplitMix64 finisher."""
    with np.errstate(over="ignore"):
        x = (x ^ seed) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def round_node(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """For applyInPandas over the open units under one node of the tree: all but one become integral."""
    pdf = pdf.sort_values(["tokens", "u", "doc_id"], ascending=[False, True, True])
    uses, held, rest = pivot(pdf["rest"].tolist(), pdf["u"].tolist())
    out = pdf[NAMES].assign(uses=pdf["uses"].to_numpy() + np.array(uses), rest=0.0)
    if held is not None:
        out.iloc[held, out.columns.get_loc("rest")] = rest
    return out


def mix_sources(docs: DataFrame, targets: DataFrame, seed: int = 7, fan_in: int = 16, vocabulary: str | None = None, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(chosen, report): documents with their uses in every mix, and the shares each source reaches.

    docs has doc_id, source, text; targets has mix_id, source, target_share, max_uses, budget_ratio. A mix has a size of
    budget_ratio times the tokens of all documents. Every document of a source is expected min(target / size of the source,
    max_uses) times. The fractions are rounded by pivotal steps: documents of a source are spread by a hash of their id over
    leaves of at most leaf documents on average, each leaf is settled by falling size, and the one unit it leaves goes up a tree
    with fan_in nodes under a node, until one is left of each source and is drawn. Leaves, order and draws depend on seed, mix,
    source and document alone, so the choice is the same however the table is partitioned and when a task runs again.

    chosen: mix_id, source, doc_id, tokens, uses (of at least 1). report: mix_id, source, target_share, max_uses, target_tokens,
    source_tokens, used_tokens, uses, short (with every document used max_uses times the source misses its target),
    actual_share (of what the mix came to), most_off (how far used_tokens may be from what the source can give of its target:
    its largest document for each leaf and node of its tree).
    A null text counts 0 tokens; documents with a null source belong to no mix but count for the total; a source without
    documents is short unless its target is 0. Repeated targets of a mix and source count once (the greatest share, then
    uses). Repeated documents are documents of their own. Empty documents or targets give empty results.
    """
    sizes = materialize(with_tokens(docs, vocabulary), "token-counts")
    total = sizes.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    totals = sizes.where("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("doc_id").alias("n"), F.max("tokens").alias("largest"))
    totals = totals.withColumn("leaves", F.ceil(F.col("n") / leaf))
    want = targets.where("mix_id IS NOT NULL AND source IS NOT NULL").groupBy("mix_id", "source").agg(F.max(F.struct("target_share", "max_uses", "budget_ratio")).alias("x")).select("mix_id", "source", "x.*")
    plan = want.join(totals, "source", "left").select(
        "mix_id", "source", "target_share", "max_uses", "leaves",
        (F.col("target_share") * F.col("budget_ratio") * F.lit(total)).alias("target_tokens"),
        F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"),
        F.coalesce(F.col("largest") * (2 * F.greatest("leaves", F.lit(1)) - 1), F.lit(0)).alias("most_off"),
    )
    plan = materialize(plan, "mix-plan")
    copies = plan.where("source_tokens > 0 AND target_tokens > 0").withColumn("copies", F.least(F.col("target_tokens") / F.col("source_tokens"), F.col("max_uses").cast("double")))
    of_leaves = copies.select("mix_id", "source", "copies", F.xxhash64(F.lit(seed), "mix_id", "source").alias("seed"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("leaves") - 1)).alias("node"))
    units = sizes.where("source IS NOT NULL AND doc_id IS NOT NULL").join(totals.select("source", "leaves"), "source")
    place = F.xxhash64(F.lit(seed), "doc_id")
    units = units.select("source", "doc_id", "tokens", place.alias("place"), F.pmod(F.shiftrightunsigned(place, 20), F.greatest("leaves", F.lit(1))).alias("node"))

    rounded = units.groupBy("source", "node").cogroup(of_leaves.groupBy("source", "node")).applyInPandas(round_leaf, ROUNDED)
    rounded = materialize(rounded, "rounded")
    parts = [rounded.where("rest = 0")]
    rest, level = rounded.where("rest > 0"), 0
    nodes = (totals.agg(F.max("leaves").alias("n")).first()["n"] or 0) + 0
    while nodes > 1:
        nodes, level = -(-nodes // fan_in), level + 1
        open_ = rest.withColumn("node", F.floor(F.col("node") / fan_in)).withColumn("u", uniform(seed, level, "mix_id", "source", "doc_id"))
        up = materialize(open_.groupBy("mix_id", "source", "node").applyInPandas(round_node, ROUNDED), "residuals")
        parts.append(up.where("rest = 0"))
        rest = up.where("rest > 0")
    parts.append(rest.withColumn("uses", F.col("uses") + (uniform(seed, -1, "mix_id", "source", "doc_id") < F.col("rest")).cast("int")))
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    chosen = chosen.where("uses > 0").select("mix_id", "source", "doc_id", "tokens", "uses")
    used = chosen.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.sum("uses").alias("uses"))
    of_mix = used.groupBy("mix_id").agg(F.sum("used_tokens").alias("mix_tokens"))
    report = plan.drop("leaves").join(used, ["mix_id", "source"], "left").join(of_mix, "mix_id", "left").na.fill({"used_tokens": 0, "uses": 0})
    # A source whose documents all have max_uses copies can't give more.
    short = (F.col("used_tokens") == F.col("max_uses") * F.col("source_tokens")) & (F.col("target_tokens") > F.col("used_tokens"))
    return chosen, report.withColumn("short", F.coalesce(short, F.lit(False))).withColumn("actual_share", F.when(F.col("mix_tokens") > 0, F.col("used_tokens") / F.col("mix_tokens"))).drop("mix_tokens")
