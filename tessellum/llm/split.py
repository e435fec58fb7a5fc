"""Pieces of oversized texts, cut at natural boundaries."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strength of the boundary after an atom, the strongest first: blank line, line end, sentence, clause, word, inside of a word.
LEVELS = (
    re.compile(r"\n\s*\n\s*"),
    re.compile(r"\s*\n\s*"),
    re.compile(r"[.!?…。！？।]+[\"»”’)\]」』]*\s+|[。！？।][」』”’)]*"),
    re.compile(r"[;:,،；：，、]\s+|[；：，、]"),
    re.compile(r"\s+"),
    re.compile(r"(?<=[^\W\d_])(?=[\d])|[-/_.·](?=\w)"),
)
ALNUM = re.compile(r"[^\W_]+")
WORD_START = re.compile(r"\s(?=\S)")
INSIDE = len(LEVELS)


def atoms(text: str, limit: int) -> tuple[list[int], list[int]]:
    """Ends of the atomic segments, none over limit, and the strength of the boundary after each (0 the strongest).

    A stretch between two boundaries that fits in the limit is one segment: all boundaries inside of it are weaker than the
    two, so merging the weakest first would join it whole before it touched either. Only longer stretches are cut further, down
    to words with the white space after them. A word over the limit is cut where letters meet digits or signs, and what is
    still too long every limit characters, but not before a combining mark.
    """
    ends: list[int] = []
    strength: list[int] = []
    todo = [(0, len(text), 0, 0)]
    while todo:
        start, end, level, after = todo.pop()
        if end - start <= limit:
            ends.append(end)
            strength.append(after)
        elif level < INSIDE:
            inner = [m.end() for m in LEVELS[level].finditer(text, start, end) if start < m.end() < end]
            parts = zip([start, *inner], [*inner, end], strict=True)
            todo += reversed([(a, b, level + 1, level if b < end else after) for a, b in parts])
        else:
            cut(text, start, end, limit, ends, strength)
            ends.append(end)
            strength.append(after)
    return ends, strength


def cut(text: str, start: int, end: int, limit: int, ends: list[int], strength: list[int]) -> None:
    while end - start > limit:
        stop = start + limit
        while stop > start + 1 and unmarked(text[stop]):
            stop -= 1
        ends.append(stop)
        strength.append(INSIDE)
        start = stop


def unmarked(ch: str) -> bool:
    """Whether a character belongs to the one before it."""
    return "̀" <= ch <= "ͯ" or ch in "‍︎️"


def merge(ends: list[int], strength: list[int], limit: int) -> list[int]:
    """Ends of the pieces: adjacent pairs wait in a heap, the weakest boundary goes first while both sides fit in limit together.

    Of equally weak boundaries the one whose pieces are the smallest together goes first, then the first in the text.
    """
    n = len(ends)
    starts = [0, *ends[:-1]]
    before, after, version = list(range(-1, n - 1)), list(range(1, n + 1)), [0] * n
    end, gone, kept = list(ends), [False] * n, list(strength)

    def pair(i: int) -> tuple[int, int, int, int, int]:
        return (-kept[i], end[after[i]] - starts[i], i, version[i], version[after[i]])

    heap = [pair(i) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, size, i, v, w = heapq.heappop(heap)
        if gone[i] or version[i] != v or after[i] >= n or version[after[i]] != w or size > limit:
            continue
        j = after[i]
        end[i], kept[i], after[i], gone[j] = end[j], kept[j], after[j], True
        version[i] += 1
        if after[i] < n:
            before[after[i]] = i
            heapq.heappush(heap, pair(i))
        if before[i] >= 0:
            heapq.heappush(heap, pair(before[i]))
    return [end[i] for i in range(n) if not gone[i]]


def pieces(text: str, max_chars: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, chars shared with the piece before) of the pieces of a text; the text as a whole if it fits.

    Each piece but the first begins up to overlap characters before the end of the one before, at the start of a word
    where there is one in that stretch. An overlap that isn't less than max_chars is an error.
    """
    if not 0 <= overlap < max_chars:
        raise ValueError(f"an overlap of {overlap} doesn't go with pieces of {max_chars} characters")
    if len(text) <= max_chars:
        return [(0, len(text), 0)] if text else []
    ends = merge(*atoms(text, max_chars - overlap), max_chars - overlap)
    out, start = [], 0
    for end in ends:
        back = max(0, start - overlap) if start else 0
        if start and overlap:
            if m := WORD_START.search(text, max(0, back - 1), start):
                back = min(m.end(), start)
            while back < start and unmarked(text[back]):
                back += 1
        out.append((back, end, start - back))
        start = end
    return out


PIECES = "item_id bigint, piece int, start_pos int, end_pos int, shared int, text string, item_chars int, item_run int"


def split_batches(keep_text: bool):
    """For mapInPandas over items with their length; a text that isn't cut is only passed on, and not there unless it is kept."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for pdf in batches:
            fits = pdf["item_chars"] <= pdf["max_chars"]
            whole = pdf[fits]
            yield whole.assign(piece=0, start_pos=0, end_pos=whole["item_chars"], shared=0, item_run=None)[names]
            long = pdf[~fits]
            for item, text, most, overlap in zip(long["item_id"], long["text"], long["max_chars"], long["overlap"], strict=True):
                longest = max(map(len, ALNUM.findall(text)), default=0)
                rows += [(item, k, a, b, s, text[a:b] if keep_text else None, len(text), longest) for k, (a, b, s) in enumerate(pieces(text, int(most), int(overlap)))]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)

    return run


def split_oversized(df: DataFrame, item: str, text: str, max_chars: int | Column, overlap: int | Column, newest: str | None = None, keep_text: bool = True) -> DataFrame:
    """Pieces of every text: item_id, piece, start_pos, end_pos, shared, text, item_chars, item_run.

    Atomic segments are merged along the weakest boundaries first as long as a piece and its overlap stay within max_chars; a
    text within it is one piece. item_run is the longest run of letters and digits of an item that is cut,
    else null. Positions count code points. Without keep_text the pieces' texts are null.

    Rows of an equal item count once: the newest by the column of that name, then the greatest text. Rows with a null item or
    null limits are left out, null and empty texts have no pieces, a blank text is a piece like any other. A limit under 1, or
    an overlap that isn't less than it, is an error. Other columns of df are not read; an empty table gives an empty result.
    """
    limits = [x if isinstance(x, Column) else F.lit(x) for x in (max_chars, overlap)]
    rows = df.select(F.col(item).cast("bigint").alias("item_id"), F.col(newest).alias("at") if newest else F.lit(0).alias("at"), F.col(text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.groupBy("item_id").agg(F.max(F.struct("at", "text")).alias("x")).select("item_id", F.col("x.text").alias("text"), *[x.cast("int").alias(n) for x, n in zip(limits, ("max_chars", "overlap"), strict=True)])
    rows = rows.where("text <> '' AND max_chars IS NOT NULL AND overlap IS NOT NULL").withColumn("item_chars", F.length("text"))
    wrong = F.raise_error(F.concat(F.lit("an overlap of "), "overlap", F.lit(" doesn't go with pieces of "), "max_chars", F.lit(" characters")))
    fits = F.when((F.col("overlap") < 0) | (F.col("overlap") >= F.col("max_chars")), wrong.cast("boolean")).otherwise(F.col("item_chars") <= F.col("max_chars"))
    return rows.select("item_id", F.when(F.lit(keep_text) | ~fits, F.col("text")).alias("text"), "item_chars", "max_chars", "overlap").mapInPandas(split_batches(keep_text), PIECES)
