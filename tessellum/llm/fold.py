"""Look-alike, width, accent and invisible characters: one place for the rules, used by several operators."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

# Letters of other scripts, and of phonetic Latin, that look like the Latin letter below them.
LOOK_ALIKES = {
    "АВЕЅІЈКМНОРСТУХҮԁԌԛԜһаеѕіјорсухѵԝӏ": "ABESIJKMHOPCTYXYdGqWhaesijopcyxvwl",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳοϲνραικυχγ": "ABEZHIKMNOPTYXCjocvpaikuxy",
    "օսոհցզՕՍԼ": "ounhgqOUL",
    "ɑɡıᴏᴄᴠᴡᴢꜱ": "agiocvwzs",
}
# Invisible characters that are not of the format category.
FILLERS = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, (*range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))))
# Compatibility kinds whose characters keep their look (raised, lowered and slashed figures).
KEPT_KINDS = ("<super>", "<sub>", "<fraction>", "<square>", "<circle>")


def code_points() -> Iterator[int]:
    """The code points that rules are made for: all but ideographs, Hangul syllables and surrogates."""
    return chain(range(0x80, 0x3400), range(0xA640, 0xAC00), range(0xF900, 0x10000), range(0x10400, 0x10450), range(0x1D400, 0x1D800), range(0xE0000, 0xE0200))


def look_alike(ch: str) -> str | None:
    """What a character stands for: itself is None, '' means invisible, ' ' a space of another kind."""
    return _table().get(ord(ch))


@cache
def _table() -> dict[int, str]:
    out: dict[int, str] = {}
    for cp in code_points():
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind == "Cf" or ch in FILLERS:
            out[cp] = ""
        elif kind in ("Zs", "Zl", "Zp"):
            out[cp] = " "
        elif len(same := unicodedata.normalize("NFC", ch)) == 1 and same != ch:
            out[cp] = same  # one character in two places, such as the kelvin sign
        elif kind[0] in "LNPS" and (d := unicodedata.decomposition(ch)).startswith("<") and not d.startswith(KEPT_KINDS):
            plain = unicodedata.normalize("NFKC", ch)
            # Letters, digits and full-width signs; signs of other kinds, such as the ellipsis, are ordinary.
            if (kind[0] in "LN" or d.startswith(("<wide>", "<narrow>"))) and all(ord(x) < 0x250 for x in plain):
                out[cp] = plain
    for cp in (*range(0, 9), *range(14, 32), 127, *range(0x80, 0x85), *range(0x86, 0xA0)):
        out[cp] = ""
    for ch in "\t\n\v\f\r\x85":
        out[ord(ch)] = " "
    for alike, latin in LOOK_ALIKES.items():
        out |= {ord(a): b for a, b in zip(alike, latin, strict=True)}
    return out


def pairs() -> tuple[str, str, dict[str, str], str]:
    """The rules for SQL: characters and the single ones they stand for, those standing for several, the invisible ones."""
    one = {chr(k): v for k, v in _table().items() if len(v) == 1}
    return "".join(one), "".join(one.values()), {chr(k): v for k, v in _table().items() if len(v) > 1}, "".join(chr(k) for k, v in _table().items() if not v)


def compositions() -> dict[str, str]:
    """Decomposed to composed letter, for every composed Latin letter."""
    out = {}
    for cp in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        ch = chr(cp)
        if (d := unicodedata.normalize("NFD", ch)) != ch:
            out[d] = ch
    return out


def mark_order() -> dict[str, str]:
    """The combining class of each mark, by which marks on one letter are sorted."""
    return {chr(cp): f"{c:03d}" for cp in (*range(0x300, 0x370), *range(0x1AB0, 0x1B00), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x2100)) if (c := unicodedata.combining(chr(cp)))}


@cache
def bare_table() -> dict[int, str]:
    """Translation to bare lower-case letters: look-alikes replaced, marks and invisible characters removed, case folded."""
    out = {}
    for cp in code_points():
        ch = chr(cp)
        seen = _table().get(cp, ch)
        plain = "".join(x for x in unicodedata.normalize("NFKD", seen) if unicodedata.category(x) != "Mn")
        plain = "".join(_table().get(ord(x), x) if ord(x) >= 0x80 else x for x in plain).casefold().replace("œ", "oe").replace("æ", "ae")
        if plain != ch:
            out[cp] = plain
    for cp in range(0x80):
        if chr(cp).lower() != chr(cp):
            out[cp] = chr(cp).lower()
        elif cp in _table():
            out[cp] = _table()[cp]
    return out


def bare(text: str) -> str:
    """Text in bare lower-case letters; equal for texts that differ only in case, accents, look-alikes or hidden characters."""
    return text.lower() if text.isascii() and text.isprintable() else text.translate(bare_table())
