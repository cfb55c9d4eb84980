"""Personal data by strict patterns, also behind disguises, with offsets into the source text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from costseries.llm.common import fields

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a run of digits can't match from its middle if not from its start
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII ones and have no compatibility form.
LOOKALIKES = dict(
    zip(
        "АВСЕНІЈКМОРЅТХУасеіјорѕхуԁԛԝһԚԜΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυıɑɡ⁄∕‐‑‒–—−․‧・",
        "ABCEHIJKMOPSTXYaceijopsxydqwhQWABEZHIKMNOPTYXaovpuiag//------...",
    )
)
# Invisible code points.
INVISIBLE = "­​‌‍⁠﻿"
# Digits as words of the corpus languages.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".",
}
_DIGIT = "|".join(sorted((w for w, d in SPELLED.items() if d.isdigit()), key=len, reverse=True))
_MARK = "dot|point|punkt|punto"
_TOKEN = rf"(?:{_DIGIT}|{_MARK}|[0-9])"
SPOKEN = re.compile(rf"(?<!\w)(?:plus[\x20-])?{_TOKEN}(?:[\x20-]{{1,2}}{_TOKEN}){{3,}}(?!\w)", re.I)
SPOKEN_WORD = re.compile(rf"plus|{_DIGIT}|{_MARK}|[0-9]", re.I)

AT = r"\s{0,3}[\[({<]\s{0,3}(?:at|arroba|à)\s{0,3}[\])}>]\s{0,3}"
DOT = r"\s{0,3}[\[({<]\s{0,3}(?:dot|punkt|punto|point)\s{0,3}[\])}>]\s{0,3}"
BRACKETED = re.compile(rf"(?P<at>{AT})|(?P<dot>{DOT})", re.I)
_WORD = r"[A-Za-z0-9-]+"
# Common top-level domains; a spoken address must end in one, for "at" and "dot" are words too.
_TOP = "com|net|org|edu|gov|mil|int|info|biz|name|io|co|app|dev|ai|me|tv|eu|de|fr|es|it|uk|us|ca|ch|nl|be|br|mx|ar|pt|ru|cn|jp|in|au|se|no|dk|fi|pl"
SAID = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<a>\x20(?:at|arroba)\x20|@){_WORD}(?:(?:\x20(?:dot|punkt|punto|point)\x20|\.){_WORD})*\x20(?:dot|punkt|punto|point)\x20(?:{_TOP})(?!\w)", re.I
)
SAID_PART = re.compile(r"\x20(at|arroba|dot|punkt|punto|point)\x20", re.I)
HINT = re.compile(r"@|\x20(?:dot|punkt|punto|point)\x20", re.I)


def _odd_letters() -> str:
    """Class of the code points the first transducer rewrites: look-alikes, invisible ones, forms of ASCII."""
    forms = [c for c in map(chr, range(0x80, 0x1FFFF)) if not 0xD800 <= ord(c) < 0xE000 and _plain(c) is not None]
    out, k = [], 0
    while k < len(forms):  # ranges keep the class short
        j = k
        while j + 1 < len(forms) and ord(forms[j + 1]) == ord(forms[j]) + 1:
            j += 1
        out.append(re.escape(forms[k]) + ("-" + re.escape(forms[j]) if j > k else ""))
        k = j + 1
    return "[" + "".join(out) + "]"


def _plain(c: str) -> str | None:
    """ASCII reading of a code point, empty for an invisible one, None if it has none."""
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c == " ":
        return " "
    form = unicodedata.normalize("NFKC", c)
    if len(form) == 1 and form != c and (form.isascii() and (form.isalnum() or form in "@.+-()_%")):
        return form
    digit = unicodedata.digit(c, None)
    return None if digit is None or c.isascii() else str(digit)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each at sign outwards so that long words cost one pass."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                out.append(("email", start, domain.end()))
                floor = domain.end()
        at = text.find("@", at + 1)
    return out


def detect(text: str) -> list[Span]:
    """Base spans by kind, then start; matches that fail their check are dropped, without another try."""
    out = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


class Rewritten:
    """A text after some replacements, with the way back to the offsets before them."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, self.new, self.old, at, size = [], [0], [0], 0, 0
        for a, b, put in edits:
            parts += (text[at:a], put)
            size += a - at
            self.new += (size, size + len(put))  # inside an edit every offset maps to the whole edit
            self.old += (a, b)
            size += len(put)
            at = b
        parts.append(text[at:])
        self.text, self.edits = "".join(parts), edits

    def back(self, offset: int, end: bool = False) -> int:
        """Source offset where the character at ``offset`` begins, or (``end``) where the one before it ends."""
        probe = offset - end
        k = bisect_right(self.new, probe) - 1
        if k % 2 == 0:  # an untouched run
            return self.old[k] + probe - self.new[k] + end
        return self.old[k + 1] if end else self.old[k]


class Transducers:
    """The chain: letters, then bracketed and spoken signs, then spelled digits."""

    def __init__(self):
        self.odd = re.compile(_odd_letters())

    def letters(self, text: str) -> list[tuple[int, int, str]]:
        return [] if text.isascii() else [(m.start(), m.end(), _plain(m[0])) for m in self.odd.finditer(text)]

    def signs(self, text: str) -> list[tuple[int, int, str]]:
        if not any(c in text for c in "[({<"):
            return []
        return [(m.start(), m.end(), "@" if m["at"] else ".") for m in BRACKETED.finditer(text)]

    def said(self, text: str) -> list[tuple[int, int, str]]:
        if not HINT.search(text):
            return []
        found = SAID.finditer(text)
        parts = (p for m in found for p in SAID_PART.finditer(text, m.start(), m.end()))
        return [(p.start(), p.end(), "@" if p[1].lower() in ("at", "arroba") else ".") for p in parts]

    def spelled(self, text: str) -> list[tuple[int, int, str]]:
        out = []
        for m in SPOKEN.finditer(text):
            got = list(SPOKEN_WORD.finditer(m[0]))
            if any(x[0].lower() in SPELLED for x in got):  # figures alone are left to the base patterns
                put = "".join(SPELLED.get(x[0].lower(), x[0]) for x in got)
                out.append((m.start(), m.end(), put))
        return out

    def spans(self, text: str) -> list[Span]:
        """Base spans and those found behind disguises, by kind, then start.

        A found span is added if it covers an edit and meets no base span of its kind.
        """
        base = detect(text)
        steps: list[Rewritten] = []
        now = text
        for rule in (self.letters, self.signs, self.said, self.spelled):
            edits = rule(now)
            if edits:
                steps.append(Rewritten(now, edits))
                now = steps[-1].text
        added = []
        own = {k: ([x for j, x, _ in base if j == k], [y for j, _, y in base if j == k]) for k in KINDS}  # both ascend
        for kind, a, b in detect(now) if steps else ():
            for step in reversed(steps):
                a, b = step.back(a), step.back(b, end=True)
            starts, ends = own[kind]
            first = bisect_right(ends, a)  # the first base span that ends behind the start
            if first == len(starts) or starts[first] >= b:
                added.append((kind, a, b))
        return base, sorted({*base, *added}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, counts of base spans by kind, their digest, all spans and their texts.

    Offsets are code points of the whole source text, ends exclusive. A null text is empty: zero counts,
    the digest of nothing and no spans. Repeated rows give repeated results; other columns are not
    carried; an empty table gives an empty result.
    """
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(
        f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found array<string>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Transducers()
        for batch in batches:
            counts, digests, spans, found = [[] for _ in KINDS], [], [], []
            for value in batch.column(1):
                body = value.as_py() or ""
                base, both = chain.spans(body)
                for own, k in zip(counts, KINDS):
                    own.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(both))
                found.append([body[a:b] for _, a, b in both])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans), pa.array(found, pa.list_(pa.string()))],
                names=schema.names,
            )

    return docs.select(docs[doc].alias("id"), docs[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("id", doc)
