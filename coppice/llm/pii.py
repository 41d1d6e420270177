"""Personal data, also in disguise: offset-preserving deobfuscation.

``base_spans`` finds plain identifiers. For disguised ones a chain of transducers
rewrites the text: look-alike characters become ASCII and invisible ones go, bracketed
or spoken "at" and "dot" become signs, spelled digits become digits. Each transducer
keeps, for every character it writes, the range of characters it came from; the ranges
compose, so that an identifier found in the rewritten text maps back to the span of the
source. Only spans that no base span of the same kind covers are added.

Offsets are code points, end exclusive. A row depends on its text alone: null and
empty texts have no spans, ties and repeated rows need no rule. Columns of other names
are not read, and an empty table gives no rows. Searches are linear in the length of the
text, but for the sorting of the spans.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import Cover, text_or_empty

# The kinds in their order, and the forms of plain identifiers.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?<![0-9][0-9])(?:[\x20-]?[0-9]){13,}+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХІЈЅаеорсухіјѕԁԛԝһьΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρικυ․。｡‐‑‒–—−＿",
        "ABEKMHOPCTYXIJSaeopcyxijsdqwhbABEZHIKMNOPTYXaovpiku...------_",
        strict=True,
    )
)
# Characters that show nothing.
INVISIBLE = frozenset("­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤︎️﻿")
# Digits as words.
NUMERALS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
# Longer endings of domains, and such of two letters as stand after a plain dot; none is an English word.
ENDINGS = "com|org|net|edu|gov|mil|info|biz|io|co|ai|app|dev|uk|de|fr|es|nl|eu|ch|ca|au|jp|br|ru|pl|se|dk|fi|cz|pt|test|example|local|xyz"
# English words of two letters that are endings of domains as well, or look like one.
SHORT_WORDS = "am|an|as|at|be|by|do|go|he|if|in|is|it|me|my|no|of|on|or|so|to|up|us|we"
# English words that stand before a plain "at", so are no name there.
BEFORE_AT = frozenset(
    "am are arrive arrived arrives available be been being bought buy call came come find found he here him hosted i is it "
    "listed live lived lives located look looked looking looks me meet meets met now online page pages post posted published "
    "read see sell she shop site sites sold stay stays store that them there they this time us visit was we website were work "
    "worked works you".split()
)

SPAN = tuple[int, int, str]


def _cards(digits: str) -> bool:
    """The Luhn sum of a number of 14 to 19 digits."""
    if not 14 <= len(digits) <= 19:
        return False
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[SPAN]:
    """Around each @: the local characters before it, then a dotted domain."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free, "email"))
        else:
            free = at + 1  # no local part reaches over an @
        at = text.find("@", max(free, at + 1))
    return found


def base_spans(text: str) -> list[SPAN]:
    """Plain identifiers: leftmost, non-overlapping within a kind; failing ones dropped."""
    found = _emails(text) if "@" in text else []
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p) < 4 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if _cards(m[0].replace(" ", "").replace("-", "")):
                found.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGITS.findall(m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    return found


@dataclass
class Rewritten:
    """A text and, for each of its characters, the range of source characters behind it."""

    text: str
    start: list[int]
    end: list[int]

    @classmethod
    def of(cls, text: str) -> Rewritten:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.start[start], self.end[end - 1]

    def replace(self, changes: list[tuple[int, int, str]]) -> Rewritten:
        """Puts ascending, disjoint ranges into other words; new characters share the range's source."""
        if not changes:
            return self
        parts, starts, ends, at = [], [], [], 0
        for start, end, new in changes:
            parts += [self.text[at:start], new]
            starts += self.start[at:start] + [self.start[start]] * len(new)
            ends += self.end[at:start] + [self.end[end - 1]] * len(new)
            at = end
        parts.append(self.text[at:])
        return Rewritten("".join(parts), starts + self.start[at:], ends + self.end[at:])


def _plain_character(char: str) -> str | None:
    """What a look-alike stands for, '' if it shows nothing, None if it is itself."""
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    digit = unicodedata.digit(char, None)
    if digit is not None and unicodedata.category(char) in ("Nd", "No"):
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    if len(folded) == 1 and folded != char and folded.isascii():
        return folded
    return None


#: Characters that may be look-alikes; accented Latin letters are none.
UNUSUAL = re.compile("[ ­²³¹͏-￿\U00010000-\U0010ffff]")


def fold_lookalikes(text: Rewritten) -> Rewritten:
    changes = []
    for m in UNUSUAL.finditer(text.text):
        new = _plain_character(m[0])
        if new is not None:
            changes.append((*m.span(), new))
    return text.replace(changes)


_WORD = r"[A-Za-z0-9]"
_AT = r"\s{0,3}[\[({<]\s{0,3}(?:at|@)\s{0,3}[\])}>]\s{0,3}"
_DOT = r"\s{0,3}[\[({<]\s{0,3}(?:dot|punkt|point|\.)\s{0,3}[\])}>]\s{0,3}"
BRACKETED = re.compile(rf"(?i)(?<={_WORD})(?:(?P<at>{_AT}|_at_)|(?P<dot>{_DOT}|_dot_))(?={_WORD})")
#: "nameATplaceDOTcom": capitals between small letters or digits.
CAPITALS = re.compile(r"(?<=[a-z0-9])(?P<at>AT)(?=[a-z0-9-]{1,63}(?:DOT[a-z0-9-]{1,63}){1,6}\b)|(?<=[a-z0-9])DOT(?=[a-z])")
CAPITALS_HINT = re.compile(r"[a-z0-9]AT[a-z0-9-]{1,63}DOT[a-z]")
SPOKEN_DOT = re.compile(rf"(?i)(?<={_WORD})\s{{1,3}}dot\s{{1,3}}(?={_WORD})")
_NAME = r"[A-Za-z0-9-]{1,63}"
#: The end of a spoken domain: a listed one, or any two letters that are no English word going on to the next.
_SPOKEN_END = rf"\x00(?:{ENDINGS}|(?!(?:{SHORT_WORDS})\s{{1,3}}[A-Za-z])[a-z]{{2}})\b"
SPOKEN_AT = re.compile(
    rf"(?i)(?P<name>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{0,63}}{_WORD})(?P<at>\s{{1,3}}at\s{{1,3}})(?={_NAME}(?:[.\x00]{_NAME}){{0,8}}?{_SPOKEN_END})"
)
#: With a plain dotted domain only after a name that no sentence holds: one with a digit or sign inside.
NAMED_AT = re.compile(
    rf"(?i)\b(?:[A-Za-z]{{1,32}}[0-9]{{1,9}}|(?:[A-Za-z0-9]{{1,32}}[._%+-]){{1,4}}[A-Za-z0-9]{{1,32}})"
    rf"(?P<at>\s{{1,3}}at\s{{1,3}})(?={_NAME}(?:\.{_NAME}){{0,6}}?\.(?:{ENDINGS})\b)"
)
SPACED_AT = re.compile(rf"(?<={_WORD})(?P<at>\s{{1,3}}@\s{{0,3}}|@\s{{1,3}})(?={_NAME}(?:[.\x00]{_NAME})+)")
#: "name @ place . com": the dots after a spaced sign.
SPACED_DOTS = re.compile(rf"(?i)(?<={_WORD})\s{{1,3}}@\s{{1,3}}{_NAME}(?:\s{{0,3}}\.\s{{0,3}}{_NAME}){{0,6}}\s{{0,3}}\.\s{{0,3}}(?:{ENDINGS})\b")
SPACED_DOT = re.compile(r"\s{1,3}\.\s{0,3}|\.\s{1,3}")
BRACKET_HINT = re.compile(r"(?i)[\[({<]\s{0,3}(?:at|dot|punkt|point|[@.])\s{0,3}[\])}>]")
DOT_HINT = re.compile(r"(?i)\sdot\s")
AT_HINT = re.compile(rf"(?i)\sat\s{{1,3}}[a-z0-9-]{{1,63}}(?:\.[a-z0-9-]{{1,63}}){{0,6}}?\.(?:{ENDINGS})\b")


def _signs_disguised(text: str) -> bool:
    if any(bracket in text for bracket in "[({<") and BRACKET_HINT.search(text):
        return True
    if "@" in text and (SPACED_AT.search(text) or SPACED_DOTS.search(text)):
        return True
    if "_at_" in text or "AT" in text and CAPITALS_HINT.search(text):
        return True
    lowered = text.lower()
    if "_at_" in lowered:
        return True
    return bool(("dot" in lowered and DOT_HINT.search(text)) or (" at" in lowered and AT_HINT.search(text)))


def sign_words(text: Rewritten) -> Rewritten:
    """Bracketed and spoken "at" and "dot" as signs.

    A spoken dot is held as NUL until it is known whether it stands in an address or
    between digits; elsewhere it becomes a dot only in the rewritten text, which
    changes nothing unless an identifier is found there.
    """
    if not _signs_disguised(text.text):
        return text
    text = text.replace([(*m.span(), "@" if m["at"] else ".") for m in BRACKETED.finditer(text.text)])
    if CAPITALS_HINT.search(text.text):
        text = text.replace([(*m.span(), "@" if m["at"] else ".") for m in CAPITALS.finditer(text.text)])
    spaced = [d.span() for m in SPACED_DOTS.finditer(text.text) for d in SPACED_DOT.finditer(text.text, *m.span())]
    text = text.replace([(*span, ".") for span in spaced])
    text = text.replace([(*m.span(), "\x00") for m in SPOKEN_DOT.finditer(text.text)])
    for form in (SPOKEN_AT, NAMED_AT, SPACED_AT):
        found = [m for m in form.finditer(text.text) if form is not SPOKEN_AT or m["name"].lower() not in BEFORE_AT]
        text = text.replace([(*m.span("at"), "@") for m in found])
    return text.replace([(k, k + 1, ".") for k in _places(text.text, "\x00")])


def _places(text: str, char: str) -> list[int]:
    out, at = [], text.find(char)
    while at >= 0:
        out.append(at)
        at = text.find(char, at + 1)
    return out


#: A number in which letters stand for some digits; at least seven are digits.
LETTER_DIGITS = re.compile(r"(?<![A-Za-z0-9.])[+]?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){9,}(?![A-Za-z0-9])")
# Letters in the place of digits.
DIGIT_LETTERS = {"O": "0", "o": "0", "I": "1", "l": "1"}


def letter_digits(text: Rewritten) -> Rewritten:
    """Letters that stand for digits inside long numbers."""
    if len(DIGITS.findall(text.text)) < 7:
        return text
    changes = []
    for m in LETTER_DIGITS.finditer(text.text):
        if len(DIGITS.findall(m[0])) >= 7:
            places = range(m.start(), m.end())
            changes += [(k, k + 1, DIGIT_LETTERS[text.text[k]]) for k in places if text.text[k] in DIGIT_LETTERS]
    return text.replace(changes)


_NUMERAL = "(?:" + "|".join(NUMERALS) + ")"
SPELLED = re.compile(rf"(?i)\b{_NUMERAL}(?:(?:\s|-|,\s|\.\s?)?(?:\b{_NUMERAL}\b|[0-9]))*\b")
NUMERAL = re.compile(rf"(?i){_NUMERAL}|[0-9]|\.(?!\s)")
#: A numeral and two more, spoken or not; fewer can't make an identifier.
SPELLED_HINT = re.compile(rf"(?i)\b{_NUMERAL}\b(?:(?:[\s,.-]{{0,2}}|\s{{1,3}}dot\s{{1,3}})(?:{_NUMERAL}\b|[0-9])){{2}}")
SPOKEN_PLUS = re.compile(r"(?i)\bplus\s{1,3}(?=[0-9])")


def spelled_digits(text: Rewritten) -> Rewritten:
    """Runs of digit words, also mixed with digits, as digits; a spoken plus before them as a sign."""
    if not SPELLED_HINT.search(text.text):
        return text
    changes = []
    for m in SPELLED.finditer(text.text):
        # Digit by digit, so that each keeps its own source; what separates them goes.
        at = m.start()
        for part in NUMERAL.finditer(text.text, m.start(), m.end()):
            if part.start() > at:
                changes.append((at, part.start(), ""))
            changes.append((*part.span(), NUMERALS.get(part[0].lower(), part[0])))
            at = part.end()
    text = text.replace(changes)
    return text.replace([(*m.span(), "+") for m in SPOKEN_PLUS.finditer(text.text)])


def added_spans(text: str, base: list[SPAN]) -> list[SPAN]:
    """Spans of disguised identifiers that no base span of their kind covers."""
    plain = Rewritten.of(text) if _may_hide(text) else None
    if plain is None:
        return []
    found = []
    for step in (fold_lookalikes, letter_digits, sign_words, spelled_digits):
        changed = step(plain)
        if changed is not plain:
            plain = changed
            found += [(*plain.source(s, e), kind) for s, e, kind in base_spans(plain.text)]
    found = set(found) - set(base)
    out: list[SPAN] = []
    for kind in KINDS:
        cover = Cover()
        for s, e, k in base:
            if k == kind:
                cover.add(s, e)
        # The widest reading of a place wins; a base span stays as it is.
        for s, e in sorted([(s, e) for s, e, k in found if k == kind], key=lambda x: (x[0] - x[1], x[0])):
            if not cover.contains(s, e) and text[s:e].strip():
                out.append((s, e, kind))
                cover.add(s, e)
    return out


def _may_hide(text: str) -> bool:
    if len(DIGITS.findall(text)) >= 7 and any(
        not DIGIT_LETTERS.keys().isdisjoint(m[0]) for m in LETTER_DIGITS.finditer(text)
    ):
        return True
    return bool(UNUSUAL.search(text) or _signs_disguised(text) or SPELLED_HINT.search(text))


def ordered(spans: list[SPAN]) -> list[SPAN]:
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spans_text(spans: list[SPAN]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def mask(text: str, spans: list[SPAN]) -> str:
    """The text with each span, or union of overlapping ones, as the name of its first kind."""
    out, at = [], 0
    for start, end, kind in ordered(spans):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_column(text_col: str = "text"):
    """A column ``struct<n_email, n_ip, n_card, n_phone, base_sha256, spans>`` of a text column.

    The counts and the digest are those of the base spans; ``spans`` holds all.
    """
    fields = ", ".join(f"n_{kind}: bigint" for kind in KINDS)

    @F.arrow_udf(f"struct<{fields}, base_sha256: string, spans: string>")
    def find(texts: pa.Array) -> pa.Array:
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, spans = [], []
        for text in texts.to_pylist():
            base = ordered(base_spans(text))
            for kind, column in zip(KINDS, counts):
                column.append(sum(k == kind for _, _, k in base))
            digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
            spans.append(spans_text(ordered(base + added_spans(text, base))))
        arrays = [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.StructArray.from_arrays(arrays, [f"n_{kind}" for kind in KINDS] + ["base_sha256", "spans"])

    return find(text_or_empty(text_col))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts, digest and spans for every row."""
    found = docs.select(id_col, find_column(text_col).alias("found"))
    return found.select(id_col, "found.*")


def masked_column(text_col: str = "text"):
    """The text with all personal data masked; null stays null."""

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            base = base_spans(text) if text else []
            out.append(mask(text, base + added_spans(text, base)) if text else text)
        return pa.array(out, pa.string())

    return masked(F.col(text_col))
