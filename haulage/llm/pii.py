"""Operator 12: personal data, by offset-preserving deobfuscation.

E-mail addresses, IP addresses, card and phone numbers are found in the text as it is (the base), and once more in a plain
form of it. Transducers make that form, one after the other; each rewrites stretches of its input, and every character
keeps the stretch of the source it stands for, so that what is found maps back to the source:

1. *Look-alikes.* Other decimal digits, full-width and mathematical letters, Cyrillic and Greek letters that look like
   Latin ones, other spaces and hyphens; invisible characters go. Letters are only rewritten in words that are
   plain afterwards, so that words of other scripts stay as they are.
2. *At and dot.* ``(at)``, ``[dot]`` and their likes, `` @ ``; bare ``at`` and ``dot`` only where a whole address is
   spelled, ``name at host dot org``.
3. *Spelled digits.* Stretches of digit words (English, German, Spanish, French) with ``double`` and ``triple``, ``plus`` before
   them and ``dot`` between them.
4. *Letters among digits.* ``O`` and ``l`` between digits.

A find counts only if it holds something rewritten and no base find of its kind covers it; base finds always stay. Every
search is linear in the text: patterns begin where a run of their characters begins, or have bounded parts.

Defined results: a missing or empty text has no finds; repeated rows are judged each; an empty table gives an empty one.
Places count code points, ends are exclusive. Added columns come beside the row in ``doc``, so names cannot clash.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import pieces

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ the name before it is walked back, not beyond the address before."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _DOTTED.finditer(text):
        parts = found[0].split(".")
        start = found.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() < 40:
            digits = found[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
            yield found.span()


def finds(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all finds in the text as it is, by kind and start."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(1, *s) for s in ips(text)] + [(2, *s) for s in cards(text)]
        out += [(3, *s) for s in phones(text)] if "+" in text else []
    return out


class Aligned:
    """A text in which every character stands for a stretch of the source."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)
        self.changed: list[bool] | None = None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Puts ``new`` for each stretch (a, b, new); stretches are in order and apart."""
        if not edits:
            return
        text, start, end, changed, at = [], [], [], [], 0
        before = self.changed or [False] * len(self.text)
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            changed += before[at:a]
            if new:
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
                changed += [True] * len(new)
            at = b
        self.text, self.start, self.end, self.changed = "".join(text), start, end, changed

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]

    def rewritten(self, a: int, b: int) -> bool:
        first, last = self.source(a, b)
        return last - first != b - a or any(self.changed[a:b])


# Letters of other scripts that look like Latin ones, in the order of the Latin letters below them.
_LOOKS = "авеіјкмнорѕтухсԁһԛԝАВЕІЈКМНОРЅТУХСαικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
_LATIN = "abeijkmhopstyxcdhqwABEIJKMHOPSTYXCaiknoptuxABEZHIKMNOPTYX"
# Spaces, hyphens, invisible characters and full stops.
_SPACES = "              　"
_HYPHENS = "‐‑‒–—―−"
_INVISIBLE = "­​‌‍⁠﻿"
_STOPS = "。｡"


@functools.cache
def _looks() -> tuple[dict[str, str], re.Pattern]:
    """What each character is rewritten to, and a pattern of all of them."""
    to = dict(zip(_LOOKS, _LATIN)) | dict.fromkeys(_SPACES, " ") | dict.fromkeys(_HYPHENS, "-") \
        | dict.fromkeys(_INVISIBLE, "") | dict.fromkeys(_STOPS, ".")
    for code in range(0x100, 0x20000):
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        plain = unicodedata.normalize("NFKC", char)
        if digit is not None:
            to.setdefault(char, str(digit))
        elif len(plain) == 1 and plain.isascii() and (plain.isalpha() or plain in "@.+-_%()"):
            to.setdefault(char, plain)
    return to, re.compile("[" + re.escape("".join(to)) + "]")


_WORD = re.compile(r"\S+")


def _latin(text: str) -> bool:
    """Whether the text has only Latin-1 characters, none of them a look-alike."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "\xa0" not in text and "\xad" not in text


def look_alikes(text: Aligned) -> None:
    if _latin(text.text):
        return
    to, some = _looks()
    edits = []
    for found in some.finditer(text.text):
        edits.append((found.start(), found.end(), to[found[0]]))
    letters = [e for e in edits if e[2].isalpha()]
    if letters:
        # Words with other letters keep theirs.
        mixed = set()
        upto, plain = 0, False
        for e in letters:
            if e[0] >= upto:
                a = e[0]
                while a > 0 and not text.text[a - 1].isspace():
                    a -= 1
                word = _WORD.match(text.text, a)
                upto, plain = word.end(), some.sub("", word[0]).isascii()
            if not plain:
                mixed.add(e[0])
        edits = [e for e in edits if e[0] not in mixed]
    text.rewrite(edits)


_OPEN, _CLOSE = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"
# At and dot in four languages.
_AT, _DOT = "at|ät|arroba|arobase|chez", "dot|punkt|punto|point"
_SIGN = re.compile(rf"{_OPEN}(?:(?P<at>@|{_AT})|(?P<dot>\.|{_DOT})){_CLOSE}|(?P<apart>\s{{1,3}}@\s{{1,3}})", re.I)
_MAYBE_SIGN = re.compile(rf"[(\[{{<]\s{{0,3}}(?:@|\.|{_AT}|{_DOT})\s{{0,3}}[)\]}}>]|\s@\s", re.I)
_PART = r"[A-Za-z0-9_%+-]{1,64}+"
_BARE_DOT = rf"(?:\.|\s{{1,3}}(?:{_DOT})\s{{1,3}})"
_SPELLED = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_PART}(?:{_BARE_DOT}{_PART}){{0,4}}(?:@|\s{{1,3}}(?:{_AT})\s{{1,3}})"
    rf"{_PART}(?:{_BARE_DOT}{_PART}){{1,5}}", re.I)
_BARE = re.compile(rf"\s{{1,3}}(?:(?P<at>{_AT})|(?P<dot>{_DOT}))\s{{1,3}}", re.I)
_MAYBE_DOT = re.compile(rf"\s(?:{_DOT})\s", re.I)


def at_and_dot(text: Aligned) -> None:
    signs = []
    if _MAYBE_SIGN.search(text.text):
        signs = [(*m.span(), "." if m["dot"] else "@") for m in _SIGN.finditer(text.text)]
        text.rewrite(signs)
    if not signs and not _MAYBE_DOT.search(text.text):
        return
    edits = []
    for found in _SPELLED.finditer(text.text):
        a, b = found.span()
        bare = list(_BARE.finditer(text.text, a, b))
        # A bare at needs a disguised dot: "look at example.com" is no address.
        if any(m["dot"] for m in bare) or "." in text.text[a:b] and text.changed and any(
                c == "." and text.changed[a + i] for i, c in enumerate(text.text[a:b])):
            edits += [(*m.span(), "@" if m["at"] else ".") for m in bare]
    text.rewrite(edits)


# Digits in English, German, Spanish and French.
_NAMES = [("zero", "oh", "null", "cero", "zéro"), ("one", "eins", "uno", "un"), ("two", "zwei", "zwo", "dos", "deux"),
          ("three", "drei", "tres", "trois"), ("four", "vier", "cuatro", "quatre"), ("five", "fünf", "cinco", "cinq"),
          ("six", "sechs", "seis"), ("seven", "sieben", "siete", "sept"), ("eight", "acht", "ocho", "huit"),
          ("nine", "neun", "nueve", "neuf")]
_VALUE = {name: str(digit) for digit, names in enumerate(_NAMES) for name in names}
_TIMES = {"double": 2, "triple": 3}
_NAME = "(?:" + "|".join(sorted(_VALUE, key=len, reverse=True)) + ")"
_TOKEN = rf"(?:(?:double|triple)\s{{1,3}})?{_NAME}(?!\w)|[0-9]{{1,4}}+(?![\w])"
_BETWEEN = rf"(?:\s{{1,3}}(?:{_DOT})\s{{1,3}}|[\s,;-]{{1,3}})"
_DIGITS = re.compile(
    rf"(?<!\w)(?:(?:plus\s{{1,3}}|\+\s{{0,3}}))?(?:{_TOKEN})(?:{_BETWEEN}(?:{_TOKEN})){{3,}}+", re.I)
_MAYBE_DIGITS = re.compile(rf"(?<!\w){_NAME}{_BETWEEN}(?:(?:double|triple)\s{{1,3}})?(?:{_NAME}|[0-9])", re.I)
_PIECE = re.compile(rf"(?P<plus>plus\s{{1,3}}|\+\s{{0,3}})|(?P<times>double|triple)\s{{1,3}}|(?P<name>{_NAME})(?!\w)"
                    rf"|(?P<number>[0-9]+)|\s{{1,3}}(?P<dot>{_DOT})\s{{1,3}}|(?P<apart>[\s,;-]{{1,3}})", re.I)


def spelled_digits(text: Aligned) -> None:
    if not _MAYBE_DIGITS.search(text.text):
        return
    edits = []
    for run in _DIGITS.finditer(text.text):
        new, times, names = [], 1, 0
        for piece in _PIECE.finditer(text.text, *run.span()):
            kind = piece.lastgroup
            if kind == "plus":
                new.append((*piece.span(), "+"))
            elif kind == "times":
                times = _TIMES[piece["times"].lower()]
                new.append((*piece.span(), ""))
            elif kind == "name":
                names += 1
                new.append((*piece.span(), _VALUE[piece["name"].lower()] * times))
                times = 1
            elif kind == "dot":
                new.append((*piece.span(), "."))
            elif kind == "apart":
                new.append((*piece.span(), ""))
        if names >= 2:
            edits += new
    text.rewrite(edits)


_AMONG = re.compile(r"(?<=[0-9])[OoIl](?=[ .-]?[0-9])|(?<=[0-9][ .-])[OoIl](?=[0-9])")


def letters_among_digits(text: Aligned) -> None:
    text.rewrite([(*m.span(), "0" if m[0] in "Oo" else "1") for m in _AMONG.finditer(text.text)])


TRANSDUCERS = (look_alikes, at_and_dot, spelled_digits, letters_among_digits)

# What a text must hold for the transducers after the first one to rewrite any of it, for a search in linear time. Any
# white space of theirs that is not ASCII makes the first one rewrite something already.
_ANY = rf"[(\[{{<]\s*(?:@|\.|{_AT}|{_DOT})\s*[)\]}}>]|\s@\s|\s(?:{_DOT})\s|[0-9][OoIl]|[0-9][ .-][OoIl][0-9]" \
       rf"|{_NAME}(?:[\s,;-]{{1,3}}|\s{{1,3}}(?:{_DOT})\s{{1,3}})(?:(?:double|triple)\s{{1,3}})?(?:{_NAME}|[0-9])"


def may_hide(texts: pa.Array) -> list[bool | None]:
    """Which texts one of the later transducers may rewrite as they are."""
    return pc.match_substring_regex(texts, _ANY, ignore_case=True).to_pylist()


def hidden(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Finds of the plain form that hold something rewritten and are not covered by one of the base."""
    plain = Aligned(text)
    for transducer in TRANSDUCERS:
        transducer(plain)
    if plain.changed is None:
        return []
    covers: dict[int, list[tuple[int, int]]] = {}
    for kind, a, b in base:
        covers.setdefault(kind, []).append((a, b))
    out, at = [], dict.fromkeys(range(len(KINDS)), 0)
    for kind, a, b in finds(plain.text):
        if not plain.rewritten(a, b):
            continue
        start, end = plain.source(a, b)
        known = covers.get(kind, [])
        while at[kind] < len(known) and known[at[kind]][1] < end:  # both come by their ends
            at[kind] += 1
        if at[kind] == len(known) or known[at[kind]][0] > start:
            out.append((kind, start, end))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])


def _finds(texts: pa.Array) -> Iterator[tuple[str | None, list, list]]:
    """Every text, its base finds and those that are hidden."""
    for text, may in zip(texts.to_pylist(), may_hide(texts)):
        base = finds(text) if text else []
        yield text, base, hidden(text, base) if text and (may or not _latin(text)) else []


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        rows = []
        for text, base, more in _finds(part.column("text")):
            spans = [(*s, False) for s in base] + [(*s, True) for s in more]
            rows.append([dict(kind=KINDS[k], start=a, end=b, added=x) for k, a, b, x in sorted(spans)])
        yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(rows, pa.list_(SPAN))], ["doc", "spans"])


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row's ``doc`` (without its text) and ``spans`` by kind and start: kind, start, end, and whether the plain
    form added it."""
    rest = [c for c in docs.columns if c != text]
    doc = F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(doc.alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        _find, f"doc {kind}, spans array<struct<kind: string, start: bigint, end: bigint, added: boolean>>")


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            out = []
            for value, base, more in _finds(part.column("text")):
                new, at = [], 0
                for a, b, kind in sorted((a, b, k) for k, a, b in base + more):
                    if a >= at:
                        new += [value[at:a], f"<{KINDS[kind]}>"]
                    at = max(at, b)
                out.append("".join(new) + value[at:] if value else value)
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(out, pa.string())], ["doc", "text"])

    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    out = rows.mapInArrow(mask, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
    return out.select(*[F.col("text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])


def op12_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("spans", lambda s: ~s["added"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return personal_data(docs).select(
        F.col("doc.doc_id").alias("doc_id"), *map(count, KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
