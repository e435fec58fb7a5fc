"""The grammar of references in by-laws, put together from lists of words.

A reference is a numbered part (article 12, sections 3 et 4, annexe B) or a type of zone, each possibly of a by-law or a law, or
a by-law or law by itself. Patterns are meant to be read with case and white space as Unicode has them.
"""

from __future__ import annotations

import re

# The words of references.
SECTIONS = ("article", "chapitre", "section", "sous-section", "annexe")
LISTING = ("et", "ou")
BELONGING = ("du", "de l'", "de la")
BYLAW = "règlement"
BYLAW_SUBJECTS = ("de zonage", "de lotissement", "de construction")
BYLAW_TOPICS = ("PIIA", "plans d'implantation et d'intégration architecturale", "permis et certificats", "permis et les certificats")
BYLAW_TOPIC_WORDS = ("sur les", "relatif aux")
BYLAW_SUBJECT_WORDS = ("de", "sur", "concernant")
LAW_WORDS = ("loi", "code")
CIVIL_CODE = "code civil"
LAWS = ("loi sur l'aménagement et l'urbanisme", "loi sur la qualité de l'environnement", "loi sur les cités et villes")
LAW_BOOKS = ("RLRQ", "RRQ", "LRQ")
CHAPTER_OF_LAW = ("chapitre", "c")
TITLE_PREPOSITIONS = ("des", "de", "sur", "concernant", "relatif", "afin de")
TITLE_ARTICLES = ("aux", "au", "à la", "les", "des", "de la", "de", "du", "le", "la")

GAP = r"\s+"


def one_of(*patterns: str) -> str:
    return f"(?:{'|'.join(patterns)})"


def phrase(words: str) -> str:
    """A phrase with any white space between its words and either apostrophe."""
    return GAP.join(re.escape(w).replace(r"\-", "-").replace("'", "['’]") for w in words.split())


def phrases(*all_: str) -> str:
    return one_of(*map(phrase, all_))


def listed(item: str) -> str:
    """One item or several, with commas or words between."""
    return rf"{item}(?:{one_of(',', GAP + phrases(*LISTING))}{GAP}{item})*"


def initials(letters: str) -> str:
    """The letters with or without full stops and spaces after them."""
    return r"\s*".join(rf"{c}\.?" for c in letters)


#: The kind of a part, in the singular or plural; the number of a part; the words and the code of a zone.
SECTION = rf"\b{one_of(*SECTIONS)}s?"
NUMBER = r"[.\dIVX]+"
NUMBERS = listed(NUMBER)
ZONE_WORDS = rf"\btypes?{GAP}des?{GAP}milieux?"
ZONE = r"[A-Z\d]+\.\d"
ZONES = listed(ZONE)

#: The collection of laws that a citation in parentheses begins with, and the whole citation.
BOOK = one_of(r"c\.", *map(initials, LAW_BOOKS))
CITATION = rf"\({BOOK}\s*,?[^)]+\)"
#: A by-law's own number, or the citation of one.
OWN_NUMBER = one_of(r"(?:SQ-)?\d[A-Z\d.-]+", CITATION)
A_BYLAW = rf"{BYLAW}{GAP}" + one_of(OWN_NUMBER, phrases(*BYLAW_SUBJECTS), phrases(*BYLAW_TOPIC_WORDS) + GAP + phrases(*BYLAW_TOPICS), rf"{phrases(*BYLAW_SUBJECT_WORDS)}.*?{OWN_NUMBER}")
A_LAW = one_of(phrase(CIVIL_CODE), rf"{one_of(*LAW_WORDS)}{GAP}.*?{CITATION}", *map(phrase, LAWS))
OF = phrases(*BELONGING)
A_PART = one_of(rf"{SECTION}{GAP}{NUMBERS}(?:{GAP}{OF}{GAP}{SECTION}{GAP}{NUMBER})*", rf"{ZONE_WORDS}{GAP}{ZONES}")
ANY = one_of(rf"{A_PART}(?:{GAP}{OF}{GAP}{one_of(A_BYLAW, A_LAW)})?", A_BYLAW, A_LAW)

#: References begin with one of few letters; looking for them first is cheap.
_INITIALS = "".join(sorted({w[0] for w in (*SECTIONS, "types", BYLAW, *LAW_WORDS)}))
FIRST_LETTER = f"(?=[{_INITIALS}{_INITIALS.upper()}])"
REFERENCE = FIRST_LETTER + ANY

#: For resolving: a part with its number (groups 1 and 2), a cited law's code (1), a regulation's law and number (1 and 2),
#: and a by-law's number (1), which begins with a digit.
ONE_SECTION = rf"\b({'|'.join(SECTIONS)}) ([.\d]+)"
CITED_LAW = rf"\(\s*{BOOK}\s*,?\s*(?:{CHAPTER_OF_LAW[0]}|{CHAPTER_OF_LAW[1]}[.\s])?\s*([^)]+)\)"
CITED_REGULATION = r"^([^,]*(?:,[^,]*)*?),\s*r\.\s*(.*)"
CITED_BYLAW = rf"(?iU:{BYLAW})\D+(\d[A-Z\d.-]*)"
#: What a title begins with and is compared without.
TITLE_START = rf"^{BYLAW}(?: {one_of(*TITLE_PREPOSITIONS)})?(?: {one_of(*TITLE_ARTICLES)})?"
