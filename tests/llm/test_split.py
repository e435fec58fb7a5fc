import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessellum.llm.split import LEVELS, atoms, cut, merge, pieces, split_oversized


def check(text, most, overlap):
    got = pieces(text, most, overlap)
    assert all(0 < b - a <= most for a, b, _ in got)
    if text:
        assert got[0][0] == 0 and got[-1][1] == len(text)
    for (_, end, _), (start, nxt, shared) in zip(got, got[1:], strict=False):
        assert start <= end < nxt and shared == end - start <= overlap
    return got


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é.\n,;1", max_size=400), st.integers(5, 60), st.integers(0, 20))
def test_pieces_cover_the_text_under_the_limit(text, most, overlap):
    check(text, most, min(overlap, most - 1))


def merged_word_by_word(text, limit):
    """All atoms of the text in one heap, without joining what fits beforehand."""
    at = {}
    for level, pattern in enumerate(LEVELS):
        for m in pattern.finditer(text):
            at.setdefault(m.end(), level)
    ends, strength, start = [], [], 0
    at[len(text)] = 0
    for end in sorted(x for x in at if x):
        cut(text, start, end, limit, ends, strength)
        ends.append(end)
        strength.append(at[end])
        start = end
    return merge(ends, strength, limit)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é.\n,;", min_size=1, max_size=300), st.integers(2, 60))
def test_joining_what_fits_first_changes_nothing(text, limit):
    if all(len(w) <= limit for w in re.findall(r"\S+\s*|\s+", text)):
        assert merge(*atoms(text, limit), limit) == merged_word_by_word(text, limit)


@pytest.mark.parametrize("overlap", [19, 20, 21, 35, 39])
def test_any_overlap_below_the_limit_is_kept(overlap):
    got = check("x" * 400, 40, overlap)
    assert all(s == min(overlap, end) for (_, end, _), (_, _, s) in zip(got, got[1:], strict=False))


@pytest.mark.parametrize("overlap", [-1, 40, 41])
def test_other_overlaps_are_errors(overlap, spark):
    with pytest.raises(ValueError):
        pieces("x" * 400, 40, overlap)
    with pytest.raises(Exception, match="doesn't go with"):
        split_oversized(spark.createDataFrame([(1, "x" * 400)], "id bigint, t string"), "id", "t", 40, overlap).collect()


def test_cuts_at_the_strongest_boundaries():
    text = "Un deux trois. Quatre cinq six.\n\nSept huit neuf. Dix onze."
    assert [text[a:b] for a, b, _ in pieces(text, 35, 0)] == ["Un deux trois. Quatre cinq six.\n\n", "Sept huit neuf. Dix onze."]


def test_unbroken_text_is_cut_and_shares_the_overlap():
    got = check("x" * 5000, 1200, 150)
    assert len(got) == 5 and all(s == 150 for _, _, s in got[1:])


def test_marks_stay_with_their_letter():
    text = "é" * 100
    assert all(text[a] != "́" for a, _, _ in pieces(text, 31, 6))


def test_merge_takes_the_weakest_first():
    assert merge([1, 2, 3, 4], [4, 1, 4, 0], 2) == [2, 4]
    assert merge([5], [0], 2) == [5]


def test_items(spark):
    rows = [(1, "a" * 30, 1, "x"), (1, "b" * 10, 0, "x"), (2, None, 1, "x"), (3, "", 1, "x"), (4, " ", 1, "x"), (None, "zz", 1, "x"), (5, "mot " * 20, 1, "x"), (5, "mot " * 20, 1, "x")]
    df = spark.createDataFrame(rows, "id bigint, t string, at int, text string")
    got = split_oversized(df, "id", "t", 12, 3, "at").orderBy("item_id", "piece").collect()
    by = {}
    for r in got:
        by.setdefault(r["item_id"], []).append(r)
    assert sorted(by) == [1, 4, 5]
    assert by[1][0]["item_chars"] == 30 and by[1][0]["item_run"] == 30 and by[4][0]["text"] == " "
    assert len([r for r in by[5] if r["piece"] == 0]) == 1
    assert split_oversized(df.limit(0), "id", "t", 12, 3, "at").count() == 0
