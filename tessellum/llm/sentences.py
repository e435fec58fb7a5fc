"""Sentences of documents in any language: abbreviations and names are learnt from the documents themselves."""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.session import materialize

# Marks the rules name.
PAIRS = {"«": "»", "“": "”", "„": "“”", "‹": "›", "「": "」", "『": "』", "《": "》", "(": ")", "（": "）", "[": "]", "〈": "〉"}
ROUND = "([（"
OPENERS = "«“„‹\"'‘(（[¿¡"
FIRST_MARKS = "«“„\"(¿¡"
CLOSERS = "\"”»)"
GOES_ON = ",;:،؛；，、)]»”’"
IDEOGRAPHIC = "。！？｡"
# Marks that Unicode doesn't count among the ends of sentences, or counts though they part clauses.
MORE_ENDS, CLAUSE_MARKS = "།༎។៕", "၊"

#: Scripts that end sentences with a danda, so that a full stop after their letters is an abbreviation's.
DANDA_SCRIPTS = "ऀ-੿଀-୿"
#: Thai and Lao, whose sentences end in a space.
SPACE_SCRIPTS = "฀-໿"


def char_class(test: Callable[[str], bool], top: int = 0xFFFF) -> str:
    """The inside of a regex class of the characters up to top that pass a test."""
    out, start = [], None
    for cp in range(top + 2):
        inside = cp <= top and test(chr(cp))
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}" + (f"-\\U{cp - 1:08x}" if cp - 1 > start else ""))
            start = None
    return "".join(out)


@cache
def terminators() -> str:
    """Ends of sentences in scripts without case: Unicode's property, without those that have rules of their own."""
    import regex

    is_end = regex.compile(r"\p{Sentence_Terminal}").fullmatch
    return "".join(c for c in map(chr, range(0x80, 0x12000)) if is_end(c) and c not in IDEOGRAPHIC + CLAUSE_MARKS + "．") + MORE_ENDS


CASELESS_ENDS = terminators()
LINE_END = re.compile(r"[\r\n\u2029\x0c]")
BLANK_LINE = re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:\r\n|\r|\n)\s*|[ \x0c]\s*")
# Searches for one character of a class are several times faster than for a run of them.
TERMINATORS = frozenset(".!?…" + IDEOGRAPHIC + CASELESS_ENDS)
# The engine has a table for classes without characters over U+FFFF; texts that hold such characters get the whole class.
TERMINATOR, ANY_TERMINATOR = (re.compile("[" + char_class(TERMINATORS.__contains__, top) + "]") for top in (0xFFFF, sys.maxunicode))
# In Greek a semicolon asks.
GREEK = "\u0370-\u03ff\u1f00-\u1fff"
GREEK_QUESTION = re.compile(rf"(?<=[{GREEK}])[;\u037e]\s+(?=\S)")
THAI_SPACE = re.compile(rf"(?<=[{SPACE_SCRIPTS}])[^\S\r\n]+(?=\S)|(?<=[^\s\d])[^\S\r\n]+(?=[{SPACE_SCRIPTS}])")
HAS_THAI = re.compile(f"[{SPACE_SCRIPTS}]")
HAS_GREEK = re.compile(f"[{GREEK}]")
DANDA = re.compile(f"[{DANDA_SCRIPTS}]")
QUOTING = re.compile("[" + re.escape("".join(PAIRS) + "".join(PAIRS.values()) + '"') + "]")
WORDS = re.compile(r"[^\W\d_]+")
CAPITAL, ANY_CAPITAL = (re.compile("[" + char_class(lambda c: unicodedata.category(c) in ("Lu", "Lt"), top) + "]") for top in (0xFFFF, 0x1FFFF))
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
ENUMERATOR = re.compile(r"\(?(?:\d+(?:\.\d+)*|[IVXLC]{1,5}|[A-Za-z])")
LIST_MARK = re.compile(r"\d{1,3}|[A-Za-z]")
YEAR = re.compile(r"\s+\d{4}(?!\d)")

#: A pair of token and word, or of number and word, that comes so often belongs together.
REPEATED = 3
#: The least score of an abbreviation (Kiss and Strunk, Unsupervised multilingual sentence boundary detection, 2006).
LEAST_SCORE = 0.3
VOWEL = "[aeiouyàâäéèêëîïôöùûüœæаеёиоуыэюяіїєαεηιουω]"
SCANNED = "kind string, doc_id bigint, version bigint, first int, marks array<bigint>, mark bigint, a string, b string, n1 bigint, n2 bigint, n3 bigint, n4 bigint, n5 bigint, n6 bigint"
#: A mark is the end of a sentence and the start of the next in one number.
SHIFT = 1 << 31


class Tally:
    """Counts over a partition's documents.

    As rows of kind w: word a is n1 times in lower case, n2 times first of a sentence for certain, n3 times capitalised inside
    of one, n4 times there at all; n5 times between a short number with a full stop and a year, n6 times after such a number.
    Of kind t: token a with its full stop comes n1 times before a small letter or comma, n2 times before a digit, and n3 times
    before the capitalised word b, or where b is null before a paragraph's end.
    """

    def __init__(self):
        self.words, self.starts, self.middle, self.small, self.digit, self.after, self.dated, self.ordinal = (Counter() for _ in range(8))

    def __len__(self) -> int:
        return len(self.words) + len(self.after)

    def rows(self) -> list[tuple]:
        low, all_ = Counter(), Counter()
        for w, n in self.words.items():
            if w.islower():
                low[w] += n
            all_[w.lower()] += n
        ws = all_.keys() | self.starts.keys() | self.middle.keys() | self.ordinal.keys()
        out = [("w", w, None, low[w], self.starts[w], self.middle[w], all_[w], self.dated[w], self.ordinal[w]) for w in ws]
        out += [("t", t, None, self.small[t], self.digit[t], 0, 0, 0, 0) for t in self.small.keys() | self.digit.keys()]
        out += [("t", t, w, 0, 0, n, 0, 0, 0) for (t, w), n in self.after.items()]
        self.__init__()
        return out


def joined(text: str, at: int, token: str) -> str:
    """The token at that place in small letters; a letter after another with a full stop is taken with it, as in т. д."""
    low = token.lower()
    if len(token) == 1 and at >= 3 and text[at - 1].isspace() and text[at - 2] == "." and text[at - 3].isalpha() and not text[at - 4 : at - 3].isalnum():
        return f"{text[at - 3].lower()}. {low}"
    return low


def spans(text: str, a: int, b: int) -> list[tuple[int, int, bool]]:
    """(open, close, whether a quote) of the paired marks of a paragraph, nested and in order of opening.

    A closing mark takes the nearest open mark of its kinds, and what was opened in between and not closed is dropped.
    """
    out: list[tuple[int, int, bool]] = []
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}

    def close(kind: str, at: int) -> None:
        depth = places[kind][-1]
        out.append((stack[depth][1], at, kind not in ROUND))
        while len(stack) > depth:
            places[stack.pop()[0]].pop()

    def push(kind: str, at: int) -> None:
        places.setdefault(kind, []).append(len(stack))
        stack.append((kind, at))

    for m in QUOTING.finditer(text, a, b):
        ch, at = m[0], m.start()
        if ch == '"':
            inmost = bool(stack) and stack[-1][0] == '"'
            opens = at == a or text[at - 1].isspace() or text[at - 1] in PAIRS
            if inmost or places.get('"') and not opens:
                close('"', at)
            else:
                push('"', at)
            continue
        kinds = [k for k in CLOSES.get(ch, ()) if places.get(k)]
        if kinds:
            close(max(kinds, key=lambda k: places[k][-1]), at)
        elif ch in PAIRS:
            push(ch, at)
    return sorted(out)


#: The opening marks that a closing mark may belong to.
CLOSES = {c: [k for k, v in PAIRS.items() if c in v] for v in PAIRS.values() for c in v}


class Reader:
    """Reads one document once: its candidate ends, its own evidence, and what is left to the corpus."""

    def __init__(self, text: str, tally: Tally):
        self.text, self.tally = text, tally
        self.starts: list[str] = []
        self.middle: list[str] = []
        self.certain: set[str] = set()
        self.words = WORDS.findall(text)
        self.astral = ASTRAL.search(text) is not None
        self._counts: Counter | None = None

    def capitals(self) -> None:
        """Capitalised words that are first in a sentence, or inside of one, for certain."""
        text, starts, middle = self.text, self.starts, self.middle
        n = len(text)
        e = -1
        for m in (ANY_CAPITAL if self.astral else CAPITAL).finditer(text):
            s = m.start()
            if s < e or s and text[s - 1].isalpha():
                continue
            m = WORDS.match(text, s)
            e = m.end()
            if s and text[s - 1] == " " and (text[s - 2 : s - 1] == "," or text[s - 2 : s - 1].islower()):
                if e < n and text[e] == ".":
                    k = e + 1
                    while k < n and text[k].isspace():
                        k += 1
                    if k < n and text[k].isdigit():
                        continue
                middle.append(m[0].lower())
            elif self.begins(s):
                starts.append(m[0].lower())

    def begins(self, s: int) -> bool:
        """Whether a sentence begins at a place for certain: after a blank line, !, ?, a long word or long number with a full stop."""
        text = self.text
        while s and text[s - 1] in FIRST_MARKS:
            s -= 1
        j, lines = s, 0
        while j and text[j - 1].isspace():
            j -= 1
            lines += text[j] == "\n"
        if j == 0 or lines > 1:
            return True
        if j == s:
            return False
        k = j - 1
        while k and text[k] in CLOSERS:
            k -= 1
        if text[k] in "!?":
            return True
        if text[j - 1] != "." or j < 2:
            return False
        if text[j - 2].isdigit():
            return not self.short_number(j - 1)
        return j > 5 and text[j - 6 : j - 1].isalpha()

    def short_number(self, at: int) -> bool:
        """Whether a number of one or two digits, no part of a longer one, ends at a place."""
        text = self.text
        k = at - 2 if text[at - 1].isdigit() and at > 1 and text[at - 2].isdigit() else at - 1
        return text[k:at].isdigit() and not (k and (text[k - 1].isalnum() or text[k - 1] in ".,-/"))

    def common(self, word: str) -> bool | None:
        """Whether a capitalised word is an ordinary one, to be read as a first word; None: the document doesn't tell."""
        if self._counts is None:
            self._counts = Counter(self.words)
            self._starts, self._middle = Counter(self.starts), Counter(self.middle)
        w = word.lower()
        ordinary, name = self._counts[w] + self._starts[w], self._middle[w]
        return None if ordinary == name else ordinary > name

    def read(self) -> tuple[int | None, list[int], list[tuple[int, str, str | None, str | None]]]:
        """(first place, marks, undecided ones as (mark, kind, token, word)); kind D is before a digit, N after a number, U else."""
        text, a = self.text, 0
        self.found: list[tuple] = []
        paragraphs = []
        for line in LINE_END.finditer(text):
            if line.start() >= a and (m := BLANK_LINE.match(text, line.start())):
                paragraphs.append((a, m.start()))
                a = m.end()
        paragraphs.append((a, len(text)))
        trimmed = []
        for a, b in paragraphs:
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if a < b:
                trimmed.append((a, b))
        self.capitals()
        for k, (a, b) in enumerate(trimmed):
            self.found += self.inside(a, b)
            self.found.append((b, trimmed[k + 1][0] if k + 1 < len(trimmed) else 0, None))
        marks, open_, last = [], [], -1
        for end, nxt, left in self.found:
            if end <= last:
                continue
            if left is not None:
                left = self.settle(*left)
                if left is None:
                    continue
            mark = end * SHIFT + nxt
            if left:
                open_.append((mark, *left))
            marks.append(mark)
            last = end
        tally = self.tally
        tally.words.update(self.words)
        tally.starts.update(self.starts)
        tally.middle.update(self.middle)
        return (trimmed[0][0] if trimmed else None), marks, open_

    def inside(self, a: int, b: int) -> list[tuple]:
        """(end, next start, None for a certain one or what is to be settled) of the candidates within a paragraph."""
        text = self.text
        pairs = spans(text, a, b) if QUOTING.search(text, a, b) else []
        found, active, at = [], [], 0
        past, before, begun = a, -2, a  # place of the last full stop and where its token begins

        def around(place: int) -> list[tuple[int, bool]]:
            """The spans around a place, asked for in order; the inmost is last."""
            nonlocal at
            while at < len(pairs) and pairs[at][0] < place:
                while active and active[-1][0] < pairs[at][0]:
                    active.pop()
                active.append(pairs[at][1:])
                at += 1
            while active and active[-1][0] <= place:
                active.pop()
            return active

        for m in (ANY_TERMINATOR if self.astral else TERMINATOR).finditer(text, a, b):
            start, quoted = m.start(), False
            if start < past:
                continue
            past = start + 1
            while past < b and text[past] in TERMINATORS:
                past += 1
            mark, end = text[start:past], past
            if mark == ".":
                s = start
                while s > a and ((c := text[s - 1]).isalnum() or c in ".-" or c > "˿" and unicodedata.category(c)[0] == "M"):
                    s -= 1
                    if s == before + 1:
                        s = begun
                        break
                before, begun = start, s
                self.count(s, start, b)
            if pairs:
                for close, quote in reversed(around(start)):
                    if close > end + 1 or close == end + 1 and not text[end].isspace():
                        end = -1
                        break
                    end, quoted = close + 1, quoted or quote
                if end < 0:
                    continue
            nxt = end
            while nxt < b and text[nxt].isspace():
                nxt += 1
            if nxt < b and (verdict := self.judge(mark, a, begun, start, end, nxt, quoted)) is not None:
                found.append((end, nxt, verdict or None))
                if mark == "." and end == nxt:
                    begun = end  # a sentence that follows without a space has a token of its own
        if HAS_THAI.search(text, a, b):
            active, at = [], 0
            for m in THAI_SPACE.finditer(text, a, b):
                left, right = text[m.start() - 1], text[m.end()]
                numbered = left.isdigit() or right.isdigit() or left in ".,)" and text[m.start() - 2 : m.start() - 1].isdigit()
                if not numbered and not around(m.start()):
                    found.append((m.start(), m.end(), None))
        if HAS_GREEK.search(text, a, b):
            active, at = [], 0
            found += [(m.start() + 1, m.end(), None) for m in GREEK_QUESTION.finditer(text, a, b) if text[m.end()].isupper() and not around(m.start())]
        found.sort(key=lambda x: (x[0], x[2] is not None))
        return found

    def count(self, s: int, at: int, b: int) -> None:
        """Evidence of a token with its full stop: what follows it."""
        text, tally = self.text, self.tally
        nxt = at + 1
        c = text[nxt] if nxt < b else ""
        if c and not c.isspace() and c not in ",;:":
            return
        token = text[s:at].lstrip(".-")
        if not token:
            return
        while nxt < b and text[nxt].isspace():
            nxt += 1
        digits = token[-1].isdigit()
        if nxt >= b:
            if not digits:
                tally.after[joined(text, at - len(token), token), None] += 1
            return
        c = text[nxt]
        if digits:
            if c.isupper() and len(token) < 3 and token.isdigit():
                m = WORDS.match(text, nxt)
                word = m[0].lower()
                tally.ordinal[word] += 1
                if YEAR.match(text, m.end()):
                    tally.dated[word] += 1
            return
        if c in ",;:" and nxt == at + 1 or c.islower():
            low = joined(text, at - len(token), token)
            tally.small[low] += 1
            self.certain.add(low)
        elif c.isdigit():
            tally.digit[joined(text, at - len(token), token)] += 1
        elif c.isupper():
            tally.after[joined(text, at - len(token), token), WORDS.match(text, nxt)[0].lower()] += 1

    def judge(self, mark: str, a: int, begun: int, at: int, end: int, nxt: int, quoted: bool) -> tuple | None:
        """Whether a sentence may end here: None for no, () for certainly, else what settle needs."""
        text = self.text
        ch = text[nxt]
        opened, top = nxt, len(text) - 1
        while opened < top and (text[opened] in OPENERS or opened > nxt and text[opened].isspace() and opened - nxt < 3):
            opened += 1
        head = text[opened]
        first = mark[0]
        if ch in GOES_ON or head.islower() or ch in CASELESS_ENDS:
            return None
        caseless = head.isalpha() and not head.isupper()
        if first in IDEOGRAPHIC or first in CASELESS_ENDS or first in "!?" and at > a and text[at - 1] >= "⺀":
            return None if quoted else ()
        if quoted and caseless:
            return None
        if first != "." or len(mark) > 1:
            return () if end < nxt or head.isupper() and first in "!?" else None
        token = text[begun:at].lstrip(".-")
        if not token or end > at + 1 and quoted:
            return () if end < nxt else None
        if end == nxt and not (head.isupper() and (len(token) > 1 and text[opened + 1 : opened + 2].islower() or token[-1].isdigit())):
            return None
        if at - len(token) <= a + 1 and ENUMERATOR.fullmatch(text, a, at) or self.listed(a, at - len(token), token):
            return None
        if DANDA.search(token):
            return None
        if ch in "¿¡":
            return ()
        word = m[0] if (m := WORDS.match(text, opened)) else None
        if token[-1].isdigit():
            if word is not None and head.isupper() and end < nxt and len(token) < 3 and token.isdigit():
                return "N", token, word, bool(YEAR.match(text, m.end()))
            return ()
        if not any(c.isalpha() for c in token):
            return ()
        if head.isdigit():
            return "D", joined(text, at - len(token), token), None, False
        if word is None or caseless:
            return ()
        initial = len(token) == 1 and token.isupper() or "." in token
        if len(token) == 1 and len(word) == 1 and text[opened + 1 : opened + 2] == ".":
            return None
        return "U", joined(text, at - len(token), token), word, initial

    def listed(self, a: int, s: int, token: str) -> bool:
        """Whether a token is the mark of a list's item: first in a line, the line before ending in a comma, colon or semicolon."""
        text = self.text
        if not LIST_MARK.fullmatch(token):
            return False
        k = s
        if k > a and text[k - 1] == "(":
            k -= 1
        while k > a and text[k - 1].isspace() and text[k - 1] != "\n":
            k -= 1
        if k <= a or text[k - 1] != "\n":
            return False
        k -= 1
        while k > a and text[k - 1].isspace() and text[k - 1] != "\n":
            k -= 1
        return k > a and text[k - 1] in ";:,"

    def settle(self, kind: str, token: str, word: str | None, mark: bool) -> tuple | None:
        """What the document's own evidence makes of a candidate: None for no end, () for an end, else (kind, token, word) for the corpus."""
        if kind == "D":
            return kind, token, None
        common = self.common(word)
        if common:
            return ()
        if kind == "N":
            return ("Y" if mark else "N"), None, word.lower()
        short = mark or token in self.certain
        if short and common is False:
            return None
        return "U", None if short else token, None if common is False else word.lower()


def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, version, text): documents with their marks, undecided marks, and counts."""
    schema = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("marks", pa.list_(pa.int64())), ("mark", pa.int64()), ("a", pa.string()), ("b", pa.string()), *[(f"n{i}", pa.int64()) for i in range(1, 7)]])

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def counts() -> Iterator[pa.RecordBatch]:
        rows = tally.rows()
        for k in range(0, len(rows), 50_000):
            part = list(zip(*rows[k : k + 50_000], strict=True))
            yield batch(len(part[0]), **dict(zip(("kind", "a", "b", "n1", "n2", "n3", "n4", "n5", "n6"), part, strict=True)))

    tally = Tally()
    for b in batches:
        docs, firsts, marks, left = [], [], [], []
        ids, versions = b.column(0).to_pylist(), b.column(1).to_pylist()
        for k, text in enumerate(b.column(2).to_pylist()):
            first, found, open_ = Reader(text, tally).read()
            if first is not None:
                docs.append(k)
                firsts.append(first)
                marks.append(found)
                left += [(k, *x) for x in open_]
        n = len(docs)
        yield batch(n, kind=["d"] * n, doc_id=[ids[k] for k in docs], version=[versions[k] for k in docs], first=firsts, marks=marks)
        if left:
            yield batch(len(left), kind=[x[2] for x in left], doc_id=[ids[x[0]] for x in left], version=[versions[x[0]] for x in left], mark=[x[1] for x in left], a=[x[3] for x in left], b=[x[4] for x in left])
        if len(tally) > 300_000:
            yield from counts()
    yield from counts()


def split_sentences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Every sentence of every document: doc_id, start_pos, end_pos (code points, white space outside left out).

    A blank line always ends a sentence. Whether a full stop ends one depends on the token before it being an abbreviation and
    the word after it being an ordinary word or a name; both are determined from unambiguous occurrences elsewhere in the
    document, and where it has none, from those of the whole corpus. A number of one or two digits is an ordinal before a word
    that is no ordinary one and that the corpus has before a year, or again and again after such numbers. Case is Unicode's;
    other scripts end sentences with the marks that Unicode names, Thai and Lao with a space, Greek asks with a semicolon.

    Texts are read once: the Python stage gives each document's candidate ends as one array, the undecided ones apart, and the
    counts, as partial sums. Only undecided ends are joined with the counts, and only ends that turn out to be none go back to
    their documents; texts are never shuffled.

    Repeated rows count once; rows of one doc_id with other texts give the sentences of each text. Null, empty and blank texts
    and rows with a null id have no sentences; an empty table gives an empty result; other columns are not read. With keep_text
    the sentence itself is joined on.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    scanned = materialize(rows.mapInArrow(scan, SCANNED), "sentence-scan")
    counts = scanned.where("kind IN ('w', 't')").groupBy("kind", "a", "b").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(1, 7)])
    counts = materialize(counts, "sentence-counts")
    w, t = counts.where("kind = 'w'"), counts.where("kind = 't'")
    words = w.agg(F.sum("n4").alias("n")).first()["n"] or 0
    stops = t.agg(F.sum(F.expr("n1 + n2 + n3")).alias("n")).first()["n"] or 0
    rate = min(0.5, max(stops, 1) / max(words, 2))
    common = F.col("n1") + F.col("n2") > F.col("n3")
    ordinal = ~common & ((F.col("n5") > 0) | (F.col("n6") >= REPEATED) & (F.col("n6") > F.col("n2") + F.col("n3")))
    ordinary = w.select(F.col("a").alias("word"), common.alias("common"), ordinal.alias("ordinal"))

    seen = t.join(ordinary, F.col("b") == F.col("word"), "left")
    # A word seen nowhere else tells nothing, unless it comes again and again or the token has no vowel and so is no word.
    name = F.col("b").isNotNull() & ~F.coalesce("common", F.col("a").rlike(VOWEL) & (F.col("n3") < REPEATED))
    final = F.col("b").isNull() | F.coalesce("common", F.lit(False))
    total = lambda n, where=None: F.sum(F.col(n) if where is None else F.when(where, F.col(n)).otherwise(0))
    sums = seen.groupBy(F.col("a").alias("token")).agg(total("n1").alias("small"), total("n2").alias("digit"), total("n3", name).alias("name"), total("n3", final).alias("final"), F.sum(F.expr("n1 + n2 + n3")).alias("stops"))
    # The longer a token, the less likely it is an abbreviation, and the more occurrences with a full stop it takes to show it:
    # their log-likelihood ratio against a word's usual rate of full stops, less by a power of e for each letter.
    letters = F.length(F.regexp_replace("token", r"[.\-\s]", ""))
    parts = 1 + F.length("token") - F.length(F.replace(F.col("token"), F.lit("."), F.lit("")))
    score = F.col("stops") * F.lit(2 * math.log(0.99 / rate)) * F.exp(-letters) * parts
    inside = F.col("small") + F.col("digit") + F.col("name")
    short = sums.where(score >= LEAST_SCORE).select(
        "token",
        ((inside > 0) & (inside >= F.col("final"))).alias("abbreviation"),
        ((F.col("digit") > 0) & (F.col("digit") >= F.col("name") + F.col("final"))).alias("before_digit"),
    ).where("abbreviation OR before_digit")

    # An end without a token or word gets a key of its own, so that these rows spread over all partitions of the joins.
    own = F.concat(F.lit("\0"), F.xxhash64("doc_id", "mark").cast("string"))
    left = scanned.where("kind IN ('D', 'N', 'Y', 'U')").select("kind", "doc_id", "version", "mark", "a", F.coalesce("a", own).alias("token"), F.coalesce("b", own).alias("word"))
    judged = left.join(short, "token", "left").join(ordinary.where("common OR ordinal"), "word", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    number = F.when(yes("common"), True).when(F.col("kind") == "Y", False).otherwise(~yes("ordinal"))
    ending = F.when(F.col("kind") == "D", ~yes("before_digit")).when(F.col("kind") == "U", ~(F.col("a").isNull() | yes("abbreviation")) | yes("common")).otherwise(number)
    dropped = judged.where(~ending).groupBy("doc_id", "version").agg(F.collect_set("mark").alias("dropped"))
    once = scanned.where("kind = 'd'").select("doc_id", "version", "first", "marks").dropDuplicates(["doc_id", "version"])
    kept = once.join(dropped, ["doc_id", "version"], "left").select("doc_id", "version", "first", F.when(F.col("dropped").isNull(), F.col("marks")).otherwise(F.array_except("marks", "dropped")).alias("marks"))
    starts = F.concat(F.array(F.col("first")), F.transform(F.slice("marks", F.lit(1), F.size("marks") - 1), lambda m: F.pmod(m, F.lit(SHIFT)).cast("int")))
    ends = F.transform("marks", lambda m: F.shiftright(m, 31).cast("int"))
    out = kept.select("doc_id", "version", F.inline(F.arrays_zip(starts.alias("start_pos"), ends.alias("end_pos"))))
    if keep_text:
        out = out.join(rows.distinct(), ["doc_id", "version"]).withColumn("sentence", F.expr("substring(text, start_pos + 1, end_pos - start_pos)")).drop("text")
    return out.drop("version")
