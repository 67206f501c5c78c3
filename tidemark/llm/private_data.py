"""Personal data: base patterns, and offset-preserving deobfuscation of disguised ones.

Transducers rewrite a text step by step (homoglyphs and invisible characters, digits in words, at/dot disguises), each
reading what the one before wrote; each keeps, for every output character, the source characters it stands for. The
base detectors run on the rewritten text and their spans are mapped back to code points of the source. Base spans always
stay; a mapped span is added if it holds rewritten characters and covers source characters that no base span of its kind
covers. Words are English, German, Spanish and French, in any mixture.

Bracketed, spaced and joined disguises (``[at]``, ``name @ host . org``, ``name_at_host_dot_org``) always count. Bare
words do if what stands before and after them could be an address: no function words, letters only in the last part, and
where just the at is a word (``jane at host.org``) a beginning of a line, a mark or a word for mail before it, or a name
that no word is.

Defined results: a null or empty text has no spans; each row is judged alone, so repeated rows repeat and ties can't
occur; columns other than doc_id and text are ignored, whatever their names; an empty table gives an empty result.
Texts are scanned whole, in time in proportion to their length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

KINDS = ("email", "ip", "card", "phone")

LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behinds change no match (a match takes all digits before it) and keep long digit runs linear
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: from each @ the local part reaches back to the last match or another character."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        done = found.end() if found else at + 1  # what stands before a failed @ can't be part of a later local part
        at = text.find("@", done)
    return out


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(a, b, 0) for a, b in emails(text)]
    if "." in text:
        found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2], x[1]))]


# Letters of other scripts that look like ASCII ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХУІЈЅοαενιρτυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhqwABEKMHOPCTXYIJSoaeviptuABEZHIKMNOPTYX", strict=True))
# Digits in words, in English, German, Spanish and French, and words that repeat the next digit.
SPELLED = {
    w: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf",
    )
    for i, w in enumerate(words.split())
} | {"oh": "0", "zwo": "2"}
REPEATED = {"double": 2, "doble": 2, "doppel": 2, "triple": 3}
PLUS = ("plus", "más")
# The at and the dot of an address in words.
AT = ("at", "ät", "klammeraffe", "arroba", "arobase", "arobas")
DOT = ("dot", "punkt", "punto", "point")
# Function words, which are no part of an address, and words for mail, which stand before one.
ENGLISH = frozenset(
    "the a an it this that these those my your our his her its is are was were be on in of to for by or and with as but not if so we you he she they i me him us them what which who when where there here all any some no one".split()
)
FUNCTION = ENGLISH | frozenset(
    "der die das den dem des ein eine einen einem einer und oder ist war in im an am auf zu zum mit von vom für bei es er sie wir ihr ich nicht als auch "
    "el la los las un una unos y o es en de del al por para con que se su no lo como más "
    "le les une des du et ou est dans au aux pour par avec que qui ce se sur il elle nous vous ne pas".split()
)
MAIL = frozenset("mail email e-mail mailto contact address kontakt adresse correo contacto dirección courriel courrier écrire write".split())
# Characters that don't show.
INVISIBLE = "­​‌‍⁠﻿"


def _glyphs() -> dict[int, str]:
    """Fullwidth forms U+FF01 to U+FF5E stand for U+0021 to U+007E; the decimal digits of every script for 0 to 9."""
    digits = {c: str(unicodedata.decimal(chr(c))) for c in range(0x80, 0x20000) if unicodedata.decimal(chr(c), None) is not None}
    return digits | {0xFF01 + i: chr(0x21 + i) for i in range(0x5E)} | {ord(a): b for a, b in HOMOGLYPHS.items()}


GLYPHS = _glyphs()
GLYPH = re.compile("[" + "".join(map(re.escape, map(chr, GLYPHS))) + "]|[" + INVISIBLE + "]+")
def _any(words: Iterable[str]) -> str:
    return "(?:" + "|".join(sorted(map(re.escape, words), key=lambda w: (-len(w), w))) + ")"


LETTER = r"[^\W\d_]"
NUMBER = rf"(?:(?:{_any(REPEATED)}[ -]{{1,3}})?{_any(SPELLED)}(?!{LETTER})|[0-9]+)"
#: Digits and words for them, from a word on; a word alone counts beside a dot.
NUMBERS = re.compile(rf"(?i)(?<!{LETTER})(?:{_any(PLUS)}[ -]{{1,3}})?{NUMBER}(?:[ -]{{0,3}}{NUMBER})*")
NUMBER_WORD = re.compile(rf"(?i)(?:(?<!{LETTER})({_any(REPEATED)})[ -]{{1,3}})?(?:(?<!{LETTER})({_any(SPELLED)})(?!{LETTER})|([0-9]+))")
BESIDE_DOT = re.compile(rf"(?i)(?: {_any(DOT)} ?|\.)\Z"), re.compile(rf"(?i) ?(?:{_any(DOT)} |\.[0-9])")
OPEN, CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
BRACKETED = re.compile(rf"(?i){OPEN}({_any(AT)}|{_any(DOT)}|@|\.){CLOSE}")
SPACED_AT = re.compile(r"(?<=[A-Za-z0-9]) {1,2}@ {0,2}(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@ {1,2}(?=[A-Za-z0-9])")
SPACED_HOST = re.compile(r"@[A-Za-z0-9-]{1,63}(?: {0,2}\. {0,2}[A-Za-z0-9-]{1,63})+")
SPACED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: {1,2}\. {1,2}[0-9]{1,3}){3}(?![0-9])")
SPACED_DOT = re.compile(r" {0,2}\. {0,2}")
JOINED = re.compile(rf"(?i)(?<![A-Za-z0-9])[A-Za-z0-9]{{1,64}}(?:[._-][A-Za-z0-9]{{1,64}}){{0,5}}?([_-]{_any(AT)}[_-])[A-Za-z0-9]{{1,63}}(?:[._-][A-Za-z0-9]{{1,63}}){{0,5}}?(?:[_-]{_any(DOT)}[_-][A-Za-z0-9]{{1,63}}){{1,5}}")
JOINED_WORD = re.compile(rf"(?i)[_-]({_any(AT)}|{_any(DOT)})[_-]")
BARE_IP = re.compile(rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:(?: {_any(DOT)} |\.)[0-9]{{1,3}}){{3}}(?![0-9])")
BARE_HOST = re.compile(rf"(?i)@[A-Za-z0-9-]{{1,63}}(?:(?: {_any(DOT)} |\.)[A-Za-z0-9-]{{1,63}}){{1,5}}")
BARE_AT = re.compile(rf"(?i) ({_any(AT)}) ")
BARE_DOT = re.compile(rf"(?i) {_any(DOT)} ")
BEFORE = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?: {_any(DOT)} [A-Za-z0-9._%+-]{{1,64}}){{0,3}}\Z")
AFTER = re.compile(rf"(?i)[A-Za-z0-9-]{{1,63}}(?:(?: {_any(DOT)} |\.)[A-Za-z0-9-]{{1,63}}){{1,5}}")
CUE = re.compile(r"(?:^|[\n:;,(<\[\"'=|])\s*\Z")
LAST_WORD = re.compile(r"([^\W\d_][\w-]*)\W{1,3}\Z")
SPLIT = {c: " " for c in map(ord, "0123456789-_.,;:!?()[]{}<>\"'/|+=\n\t")}
#: A number of several digits has another word than the French article.
HINTS = frozenset(SPELLED) - {"un"}


class Rewritten:
    """A text with, for every character, the source code points [start, end) that it stands for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def edit(self, edits: list[tuple[int, int, str]]) -> None:
        """Non-overlapping (start, end, new text) in order; every new character stands for the whole of what it replaces."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += [*self.starts[at:a], *[self.starts[a]] * len(new)]
            ends += [*self.ends[at:a], *[self.ends[b - 1]] * len(new)]
            at = b
        self.text = "".join(text) + self.text[at:]
        self.starts, self.ends = [*starts, *self.starts[at:]], [*ends, *self.ends[at:]]


def _digits(run: str) -> str:
    """Digits of a run of digits and words for them; separators go."""
    plus = "+" if run[:4].lower().startswith(PLUS) else ""
    return plus + "".join((SPELLED[w.lower()] if w else d) * REPEATED.get(more.lower(), 1) for more, w, d in NUMBER_WORD.findall(run))


def _numbers(text: str) -> Iterable[tuple[int, int, str]]:
    for m in NUMBERS.finditer(text):
        found = NUMBER_WORD.findall(m[0])
        if any(w for _, w, _ in found):
            alone = len(found) == 1 and not found[0][0]
            if not alone or BESIDE_DOT[0].search(text, max(0, m.start() - 10), m.start()) or BESIDE_DOT[1].match(text, m.end()):
                yield m.start(), m.end(), _digits(m[0])


def _symbol(word: str) -> str:
    return "@" if word == "@" or word.lower() in AT else "."


def _spaced(text: str) -> Iterable[tuple[int, int, str]]:
    for whole in (SPACED_HOST, SPACED_IP):
        for m in whole.finditer(text):
            yield from ((m.start() + d.start(), m.start() + d.end(), ".") for d in SPACED_DOT.finditer(m[0]) if len(d[0]) > 1)


def _ending(part: str) -> bool:
    """A last part of letters; of function words only those of countries' languages, as they may be endings."""
    return part.isalpha() and len(part) >= 2 and part not in ENGLISH


def _bare_host(text: str) -> Iterable[tuple[int, int, str]]:
    """The dots in words of a host after an @."""
    for m in BARE_HOST.finditer(text):
        parts = re.split(rf"(?i) {_any(DOT)} |\.", m[0][1:].lower())
        if _ending(parts[-1]) and FUNCTION.isdisjoint(parts[:-1]):
            yield from ((m.start() + d.start(), m.start() + d.end(), ".") for d in BARE_DOT.finditer(m[0]))


def _bare(text: str) -> Iterable[tuple[int, int, str]]:
    """The at and the dots of addresses in bare words."""
    done = 0
    for m in BARE_AT.finditer(text):
        after = AFTER.match(text, m.end())
        before = BEFORE.search(text, max(done, m.start() - 260), m.start()) if after else None
        if not before:
            continue
        parts = [p.lower() for side in (before[0], after[0]) for p in re.split(rf"(?i) {_any(DOT)} |\.", side)]
        if not _ending(parts[-1]) or not FUNCTION.isdisjoint(parts[:-1]):
            continue
        if not BARE_DOT.search(after[0]):  # only the at is a word
            cue = CUE.search(text, max(0, before.start() - 4), before.start()) or before.start() == 0
            word = LAST_WORD.search(text, max(0, before.start() - 24), before.start())
            if not cue and not (word and word[1].lower() in MAIL) and before[0].isalpha():
                continue
        for at, side in ((before.start(), before[0]), (None, None), (m.end(), after[0])):
            if side is None:
                yield m.start(), m.end(), "@"
            else:
                yield from ((at + d.start(), at + d.end(), ".") for d in BARE_DOT.finditer(side))
        done = after.end()


def deobfuscate(text: str) -> Rewritten | None:
    """The text without disguises, or None if it holds none."""
    low = text.lower()
    glyphs = None if text.isascii() else GLYPH.search(text)
    # distinct words tell which transducers can find anything
    words = set(low.translate(SPLIT).split()) if not glyphs else None
    numbers = words is None or not HINTS.isdisjoint(words)
    dots = words is None or not words.isdisjoint(DOT)
    ats = words is None or not words.isdisjoint(AT)
    spaced = words is None or any(x in text for x in ("@", " . ", "[.]", "(.)", "{.}", "<.>"))
    if not (glyphs or numbers or dots or ats or spaced):
        return None
    out = Rewritten(text)
    if glyphs:
        out.edit([(m.start(), m.end(), GLYPHS.get(ord(m[0]), "") if len(m[0]) == 1 else "") for m in GLYPH.finditer(text)])
    if numbers:
        out.edit(list(_numbers(out.text)))
    if ats or dots or spaced:
        out.edit([(m.start(), m.end(), _symbol(m[1])) for m in BRACKETED.finditer(out.text)])
    if ats:
        out.edit([(m.start() + w.start(), m.start() + w.end(), _symbol(w[1])) for m in JOINED.finditer(out.text) for w in JOINED_WORD.finditer(m[0])])
    if spaced:
        out.edit([(m.start(), m.end(), "@") for m in SPACED_AT.finditer(out.text)])
        out.edit(sorted(_spaced(out.text)))
    if dots:
        out.edit([(m.start() + w.start(), m.start() + w.end(), ".") for m in BARE_IP.finditer(out.text) for w in BARE_DOT.finditer(m[0])])
        out.edit(list(_bare_host(out.text)))
    if ats:
        out.edit(list(_bare(out.text)))
    return out if out.text != text else None


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans with those that only the rewritten text shows."""
    base = base_spans(text)
    plain = deobfuscate(text)
    if plain is None:
        return base, base
    covered = {k: bytearray(len(text)) for *_, k in base}
    for s, e, k in base:
        covered[k][s:e] = b"\1" * (e - s)
    added = []
    for a, b, kind in base_spans(plain.text):
        start, end = plain.starts[a], plain.ends[b - 1]
        if text[start:end] != plain.text[a:b] and (kind not in covered or covered[kind].find(0, start, end) >= 0):
            added.append((start, end, kind))
    order = KINDS.index
    return base, sorted([*base, *added], key=lambda x: (x[0], order(x[2]), x[1]))


SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
FOUND = StructType([StructField("base", ArrayType(SPAN)), StructField("spans", ArrayType(SPAN))])


@F.pandas_udf(FOUND)
def spans_udf(text: pd.Series) -> pd.DataFrame:
    both = [all_spans(t) if t else ([], []) for t in text]
    rows = [[[{"kind": k, "start": a, "end": b} for a, b, k in side] for side in x] for x in both]
    return pd.DataFrame({"base": [r[0] for r in rows], "spans": [r[1] for r in rows]})


def find_private_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end) in code points, end exclusive, by start, then kind as in KINDS."""
    found = docs.select("doc_id", spans_udf(F.col("text")).alias("found"))
    return found.select("doc_id", "found.base", "found.spans")
