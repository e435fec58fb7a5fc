"""Passages of held-out test texts inside a corpus."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.session import materialize

from .fold import bare, bare_table

WORD = re.compile(r"[^\W_]+")
LEAKS = "doc_id bigint, item_id bigint, run_words int, distance int, windows int, first_word int"
#: Test items of at most so many characters go to the executors as one index; more of them are joined with the corpus by piece.
BLOCK_CHARS = 16_000_000
#: Documents are looked up together until they have so many words, which bounds the arrays of a step.
CHUNK_WORDS = 200_000
#: Bits of the filter that keeps pieces which no item has out of the join; its size doesn't depend on the data.
FILTER_BITS = 1 << 26
#: Entries of a memo of words, after which it is emptied.
MEMO = 1_000_000
STEP, BASE = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93


@cache
def odd() -> re.Pattern:
    """Characters that folding turns into, or out of, parts of words: texts that hold one are folded before they are cut."""
    table = bare_table()

    def changes(cp: int) -> bool:
        plain = table.get(cp)
        letters = [x.isalnum() for x in plain] if plain is not None else []
        return plain is not None and ((not plain or not all(letters)) if chr(cp).isalnum() else (not plain or any(letters)))

    chars = "".join(chr(cp) for cp in table if changes(cp))
    bmp = "".join(c for c in chars if c <= "￿")
    return re.compile("[" + re.escape(bmp) + "\U00010000-\U0010ffff]")


def tokens(text: str) -> list[str]:
    """The words of a text, not folded yet unless folding may change where they end."""
    return WORD.findall(bare(text) if odd().search(text) else text)


def words(text: str) -> list[str]:
    """The words of a text in bare letters: maximal runs of letters and digits."""
    return [bare(w) for w in tokens(text)]


class Memo(dict):
    """Numbers of words by their spelling; a word not seen before is folded and looked up."""

    def __init__(self, number: Callable[[str], int]):
        self.number = number

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        n = self[word] = self.number(bare(word))
        return n


def hashes(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words that begins at one of the places."""
    h = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            h = h * STEP + ids[at + j]
            h ^= h >> np.uint64(29)
    return h


def myers(pattern: list[int], text: list[int], most: int) -> int:
    """Least edit distance between the pattern and any part of the text (Myers' bit vectors over symbols); most + 1 if over most."""
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1, mh << 1
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv & full
        best = min(best, score)
    return min(best, most + 1)


def myers_many(patterns: np.ndarray, texts: np.ndarray, most: int) -> np.ndarray:
    """myers for each row of two matrices at once, patterns of up to 63 symbols; -1 fills short texts and equals nothing."""
    n, m = patterns.shape
    if m > 63:
        return np.array([myers(p.tolist(), t.tolist(), most) for p, t in zip(patterns, texts, strict=True)])
    u = np.uint64
    full, top, one = u((1 << m) - 1), u(m - 1), u(1)
    pv, mv = np.full(n, full), np.zeros(n, dtype=u)
    score, best = np.full(n, m), np.full(n, m)
    with np.errstate(over="ignore"):
        for t in range(texts.shape[1]):
            eq = np.zeros(n, dtype=u)
            for i in range(m):
                eq |= (patterns[:, i] == texts[:, t]).astype(u) << u(i)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | (~(xh | pv) & full), pv & xh
            score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
            ph, mh = ph << one, mh << one
            pv, mv = (mh | ~(xv | ph)) & full, ph & xv & full
            np.minimum(best, score, out=best)
    return np.minimum(best, most + 1)


class Grams:
    """Hashes of all runs of any one length of a sequence, from prefix sums."""

    inverse = pow(BASE, -1, 1 << 64)

    def __init__(self, ids: np.ndarray):
        with np.errstate(over="ignore"):
            x = (ids.astype(np.uint64) + np.uint64(1)) * STEP
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            n = len(ids)
            up, self.down = (np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, b, dtype=np.uint64)]), dtype=np.uint64) for b in (BASE, self.inverse))
            self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(x * up[:n], dtype=np.uint64)])

    def of(self, n: int) -> np.ndarray:
        k = len(self.sums) - n
        with np.errstate(over="ignore"):
            return (self.sums[n:] - self.sums[:k]) * self.down[:k]


class Item:
    """One test item: its windows by content, and which of them have a piece of given words at which place."""

    def __init__(self, item: int, ids: list[int], window: int, piece: int):
        self.item, self.ids = item, np.array(ids, dtype=np.int64)
        self.times: Counter[tuple] = Counter(tuple(ids[s : s + window]) for s in range(len(ids) - window + 1))
        self.pieces: dict[tuple, list[tuple[tuple, int]]] = defaultdict(list)
        for w in self.times:
            for j in range(window // piece):
                self.pieces[w[j * piece : (j + 1) * piece]].append((w, j))
        self.grams = Grams(self.ids)

    def longest(self, stretches: list[np.ndarray]) -> int:
        """Words of the longest run that a stretch of a document and the item have in common."""
        best = 0
        for ids in stretches:
            top = min(len(ids), len(self.ids))
            if top <= best:
                continue
            grams = Grams(ids)
            shares = lambda n, grams=grams: bool(np.isin(grams.of(n), self.grams.of(n)).any())
            low = best
            if shares(top):
                best = top
                continue
            while top - low > 1:  # a common run of n words holds one of n - 1
                n = (low + top) // 2
                low, top = (n, top) if shares(n) else (low, n)
            best = low
        return best


class Index:
    """The pieces of a set of test items, ready to be looked up in documents."""

    def __init__(self, items: list[tuple[int, str]], window: int, budget: int):
        self.window, self.budget, self.piece = window, budget, window // (budget + 1)
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        keys, owners = [], []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if len(ids) < window:
                continue
            h = np.unique(hashes(np.array(ids, dtype=np.uint64), np.arange(len(ids) - self.piece + 1), self.piece))
            keys.append(h)
            owners.append(np.full(len(h), len(self.items)))
            self.items.append((item, ids))
        hashed = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashed, kind="stable")
        self.keys, self.owners = hashed[order], np.concatenate(owners)[order] if owners else np.zeros(0, dtype=np.int64)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "read")}

    def number(self, word: str) -> int:
        return self.vocabulary.get(word, 0)

    def item(self, k: int) -> Item:
        read = self.__dict__.setdefault("read", {})
        if k not in read:
            if len(read) > 2000:
                read.clear()
            read[k] = Item(*self.items[k], self.window, self.piece)
        return read[k]

    def find_all(self, texts: Iterable[str]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(place of the text, item, longest run of equal words, least distance of a window, windows within the budget, first word)."""
        memo = self.__dict__.setdefault("memo", Memo(self.number))
        chunk, starts, size = [], [], 0
        for k, text in enumerate(texts):
            ids = np.fromiter(map(memo.__getitem__, tokens(text)), dtype=np.uint64)
            if len(ids) < self.window - self.budget:
                continue
            starts.append((size, k))
            chunk += [ids, np.zeros(1, dtype=np.uint64)]  # a word of no item parts the documents
            size += len(ids) + 1
            if size > CHUNK_WORDS:
                yield from self.find_chunk(np.concatenate(chunk), starts)
                chunk, starts, size = [], [], 0
        if chunk:
            yield from self.find_chunk(np.concatenate(chunk), starts)

    def find_chunk(self, ids: np.ndarray, starts: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        if not len(self.keys) or len(ids) < self.piece:
            return
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.nonzero(known[self.piece :] - known[: -self.piece] == self.piece)[0]
        h = hashes(ids, at, self.piece)
        low = np.searchsorted(self.keys, h, "left")
        hit = low < len(self.keys)
        hit[hit] = self.keys[low[hit]] == h[hit]
        at, above, below = at[hit], low[hit], np.searchsorted(self.keys, h[hit], "right")
        firsts = np.array([s for s, _ in starts])
        docs = np.searchsorted(firsts, at, "right") - 1
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for p, d, a, b in zip(at.tolist(), docs.tolist(), above.tolist(), below.tolist(), strict=True):
            for k in self.owners[a:b].tolist() if b - a > 1 else (int(self.owners[a]),):
                places[d, k].append(p)
        w, budget, piece = self.window, self.budget, self.piece
        found: dict[tuple[int, int], list] = {}
        tries: list[tuple[tuple, tuple, tuple[int, int], int]] = []

        def good(pair: tuple[int, int], window: tuple, distance: int, first: int) -> None:
            entry = found.setdefault(pair, [budget + 1, set(), first])
            entry[0], entry[2] = min(entry[0], distance), min(entry[2], first)
            entry[1].add(window)

        for (d, k), ps in places.items():
            item = self.item(k)
            begin, end = starts[d][0], (starts[d + 1][0] if d + 1 < len(starts) else len(ids)) - 1
            seen, around = set(), set()
            for p in ps:
                # Places of equal surroundings count once, so that words repeated many times cost no more than others.
                low, high = max(begin, p - piece * budget - budget), min(end, p + w + budget)
                near = low - p, ids[low:high].tobytes()
                if near in around:
                    continue
                around.add(near)
                for window, j in item.pieces.get(tuple(ids[p : p + piece].tolist()), ()):
                    s = p - j * piece
                    a, b = max(begin, s - budget), min(end, s + w + budget)
                    part = tuple(ids[a:b].tolist())
                    if (window, part) in seen:
                        continue
                    seen.add((window, part))
                    if part[s - a : s - a + w] == window:
                        good((d, k), window, 0, a - begin)
                    else:
                        tries.append((window, part, (d, k), a - begin))
                if len(tries) > 100_000:
                    self.verify(tries, good)
                    tries = []
        if tries:
            self.verify(tries, good)
        for (d, k), (distance, windows, first) in sorted(found.items()):
            item = self.item(k)
            stretches, p0, last = [], None, None
            for p in places[d, k]:
                if last is None or p != last + 1:
                    if p0 is not None:
                        stretches.append(ids[p0 : last + piece])
                    p0 = p
                last = p
            stretches.append(ids[p0 : last + piece])
            yield starts[d][1], item.item, item.longest(sorted(stretches, key=len, reverse=True)), distance, sum(item.times[x] for x in windows), first

    def verify(self, tries: list[tuple[tuple, tuple, tuple[int, int], int]], good: Callable) -> None:
        """Myers' distance for all candidates at once."""
        texts = np.full((len(tries), self.window + 2 * self.budget), -1, dtype=np.int64)
        for i, (_, part, _, _) in enumerate(tries):
            texts[i, : len(part)] = part
        distances = myers_many(np.array([t[0] for t in tries], dtype=np.int64), texts, self.budget)
        for i in np.nonzero(distances <= self.budget)[0].tolist():
            window, _, pair, first = tries[i]
            good(pair, window, int(distances[i]), first)


NAMES = [c.split()[0] for c in LEAKS.split(", ")]


def search(index) -> object:
    """For mapInPandas: the leaks of each document; index is a broadcast Index."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["doc_id"].tolist()
            yield pd.DataFrame([(ids[k], *x) for k, *x in index.value.find_all(pdf["text"])], columns=NAMES)

    return run


def verify_pairs(window: int, budget: int):
    """For mapInPandas over (doc_id, text, item_id, item_text): the leaks among candidate pairs."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for (item, text), part in pdf.groupby(["item_id", "item_text"], sort=False):
                ids = part["doc_id"].tolist()
                rows += [(ids[k], *x) for k, *x in Index([(item, text)], window, budget).find_all(part["text"])]
            yield pd.DataFrame(rows, columns=NAMES)

    return run


def pieces(piece: int, least: int, kept=None):
    """For mapInPandas over (id, text): the hashes of each text's pieces; kept is a broadcast filter, texts under least words have none."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        memo = Memo(lambda w: xxhash.xxh64_intdigest(w))
        for pdf in batches:
            for key, text in zip(pdf["id"], pdf["text"], strict=True):
                ids = np.fromiter(map(memo.__getitem__, tokens(text)), dtype=np.uint64)
                if len(ids) < least:
                    continue
                h = np.unique(hashes(ids, np.arange(len(ids) - piece + 1), piece))
                if kept is not None:
                    bit = h % np.uint64(FILTER_BITS)
                    h = h[(kept.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if len(h):
                    yield pd.DataFrame({"id": key, "key": h.view(np.int64)})

    return run


def join_by_piece(corpus: DataFrame, tests: DataFrame, window: int, budget: int) -> DataFrame:
    """The leaks of more items than one index holds: documents and items that share a piece, each pair then verified."""
    spark, piece = corpus.sparkSession, window // (budget + 1)
    schema = "id bigint, key bigint"
    of_items = materialize(tests.select(F.col("item_id").alias("id"), "text").mapInPandas(pieces(piece, window), schema).distinct(), "item-pieces")
    # One row for each byte of the filter that has a bit, 8 MB at most.
    bit = F.pmod(F.pmod("key", F.lit(FILTER_BITS)), F.lit(FILTER_BITS))
    filled = of_items.select((bit / 8).cast("int").alias("byte"), F.expr(f"shiftleft(1, cast(pmod(pmod(key, {FILTER_BITS}), 8) AS int))").alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    bits[filled["byte"].to_numpy(dtype=np.int64)] = filled["bits"].to_numpy(dtype=np.uint8)
    of_docs = corpus.select(F.col("doc_id").alias("id"), "text").mapInPandas(pieces(piece, window - budget, spark.sparkContext.broadcast(bits)), schema)
    pairs = materialize(of_docs.join(of_items.withColumnRenamed("id", "item_id"), "key").select(F.col("id").alias("doc_id"), "item_id").distinct(), "leak-candidates")
    texts = tests.withColumnRenamed("text", "item_text").distinct()
    return pairs.join(texts, "item_id").join(corpus, "doc_id").select("doc_id", "text", "item_id", "item_text").mapInPandas(verify_pairs(window, budget), LEAKS)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = 15, budget: int = 1, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Document and item pairs where the document holds a passage of window words of the item, up to budget word edits.

    Each window of an item is split into budget + 1 pieces; a document that holds the window with at most budget words lost,
    added or changed holds one of the pieces unchanged. Pieces are looked up by hash, the words compared, and each candidate
    window is verified with Myers' bit-parallel distance over words. Columns: doc_id, item_id, run_words (longest run of
    equal words), distance (least of a window), windows (item windows within the budget), first_word. A run is exact if
    run_words >= window. Case, accents, look-alike and invisible characters, punctuation and spacing are ignored.

    Items of up to block_chars characters are an index of bounded size on every executor, and documents pass once, without a
    shuffle. More items are joined: documents give the hashes of those pieces that pass a filter of fixed size, and each
    document and item that share one is verified by itself.

    Null and short texts of either side, and rows with a null id, give no rows; repeated items of one id and text count once.
    Repeated documents give repeated rows. Other columns are not read.
    """
    if window // (budget + 1) < 1:
        raise ValueError("the window must have more words than the budget")
    tests = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    corpus = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    if (tests.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0) > block_chars:
        return join_by_piece(corpus, tests, window, budget)
    known = [(r["item_id"], r["text"]) for r in tests.orderBy("item_id", "text").collect()]
    return corpus.mapInPandas(search(docs.sparkSession.sparkContext.broadcast(Index(known, window, budget))), LEAKS)
