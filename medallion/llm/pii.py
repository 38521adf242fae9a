"""Personal data in whole texts, also disguised, with offsets into the source.

Plain identifiers are matched in the text as it is. A chain of transducers then rewrites disguises:
look-alike and invisible characters, spelled digits, letters for digits, and ``at`` and ``dot``
written out. Each transducer keeps where its output came from, so what the same matchers find in the
normalised text is mapped back, step by step, to source characters and added to the plain spans.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Letters of other scripts that look like ASCII ones, spelled digits of four languages.
LOOK_ALIKES = dict(
    zip(
        "АВЕКМНОРСТУХаеорсухіѕјһԁԛԝɡɩΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανρικτυχ＠．",
        "ABEKMHOPCTYXaeopcyxisjhdqwgiABEZHIKMNOPTYXoavpiktux@.",
        strict=True,
    )
)
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣﻿"
#: Where all marks are words, the address must end in one of these.
TOP_DOMAINS = frozenset("com org net edu gov io info biz de fr es eu uk us ch at nl it be pt pl co me dev app ai ca au in jp".split())
AT_WORDS = "at|arobase|arroba|ät"
DOT_WORDS = "dot|punkt|point|punto"


# Plain matchers: all possessive or anchored, so that no text takes more than linear time.

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    found, bound = [], 0
    for match in _DOMAIN.finditer(text):
        start = at = match.start()
        while start > bound and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found.append((start, match.end()))
            bound = match.end()
    return found


def _low_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def plain_spans(text: str) -> dict[str, list[Span]]:
    """The identifiers of each kind, left to right; matches that fail their test are dropped."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_low_part, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


class Rewritten:
    """A text after one transducer, with the way back."""

    def __init__(self, text: str, pattern: re.Pattern[str], change: Callable[[re.Match[str]], str | None]) -> None:
        parts, last, size = [], 0, 0
        self.starts: list[int] = []
        self.edits: list[tuple[int, int, int, int]] = []
        for match in pattern.finditer(text):
            new = change(match)
            if new is None or new == match[0]:
                continue
            kept = text[last : match.start()]
            parts += [kept, new]
            size += len(kept)
            self.starts.append(size)
            self.edits.append((size, size + len(new), match.start(), match.end()))
            size += len(new)
            last = match.end()
        self.text = "".join([*parts, text[last:]]) if self.edits else text

    def _source(self, at: int) -> Span:
        """Source characters behind the character ``at``."""
        k = bisect_right(self.starts, at) - 1
        if k < 0:
            return at, at + 1
        _, new_end, old_start, old_end = self.edits[k]
        if at < new_end:
            return old_start, old_end
        return old_end + at - new_end, old_end + at - new_end + 1

    def back(self, span: Span) -> Span:
        return self._source(span[0])[0], self._source(span[1] - 1)[1]


def _look_alike(match: re.Match[str]) -> str | None:
    char = match[0]
    if char in INVISIBLE:
        return ""
    plain = LOOK_ALIKES.get(char) or unicodedata.normalize("NFKC", char)
    if char.isdecimal():
        plain = str(unicodedata.decimal(char))
    return plain if len(plain) == 1 and plain.isascii() else None


_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_ITEM = rf"(?:(?:double|triple)[ \t]+)?(?:{_WORD})(?![^\W_])|[0-9]"
_GAP = r"[ \t]*[ \t,-][ \t]*"
_ITEMS = re.compile(rf"(double|triple)?[ \t]*\b({_WORD})\b|([0-9])|\b(?:{DOT_WORDS})\b|\.", re.I)
_AT = rf"(?:\s*[(\[{{<]\s*(?:{AT_WORDS}|@)\s*[)\]}}>]\s*|\s+@\s+|[ \t]+(?:{AT_WORDS})[ \t]+|@)"
_DOT = rf"(?:\s*[(\[{{<]\s*(?:{DOT_WORDS}|\.)\s*[)\]}}>]\s*|[ \t]+\.[ \t]+|[ \t]+(?:{DOT_WORDS})[ \t]+|\.)"


def _plain_word(word: str) -> str:
    """In lower case, with what Python's patterns take for an i or s."""
    return word.replace("\u0130", "i").replace("\u0131", "i").replace("\u017f", "s").lower()


def _spelled(match: re.Match[str]) -> str | None:
    out = ["+"] if match["plus"] else []
    words = 0
    for item in _ITEMS.finditer(match["run"]):
        times = {"double": 2, "triple": 3}.get(_plain_word(item[1] or ""), 1)
        if item[2]:
            out.append(str(DIGIT_WORDS[_plain_word(item[2])]) * times)
            words += 1
        else:
            out.append(item[3] or ".")
    return "".join(out) if words >= 2 and sum(map(len, out)) >= 7 else None


def _address(match: re.Match[str]) -> str | None:
    """A disguised e-mail address in plain form; ordinary prose with ``at`` in it stays."""
    at, rest = match["at"], match["rest"]
    wrapped = bool(re.search(r"[(\[{<]", at))
    dots = re.sub(_DOT, ".", rest, flags=re.I)
    if not wrapped and dots == rest and "@" not in at:
        return None
    if not re.fullmatch(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,12}", dots):
        return None
    if not wrapped and "@" not in at and dots.rsplit(".", 1)[1].lower() not in TOP_DOMAINS:
        return None
    return re.sub(_DOT, ".", match["name"], flags=re.I) + "@" + dots


def _folded(words: str) -> str:
    """The words with all letters that Python, but not RE2, takes for an i."""
    return words.replace("i", "[i\u0130\u0131]")


#: What Python takes for white space; RE2's class has only ASCII.
_SPACE = f"[{''.join(c for c in map(chr, range(0x10000)) if c.isspace())}]"
_DOTS = _folded(DOT_WORDS)
#: Two words at least make spelled digits, so one is followed by another item.
_SPELLED_HINT = (
    rf"(?:^|[^A-Za-z0-9]|plus)(?:{_folded(_WORD)})(?:[ \t,.-]+|[ \t]+(?:{_DOTS})[ \t]+)"
    rf"(?:(?:double|{_folded('triple')})[ \t]+)?(?:{_folded(_WORD)}|[0-9])"
)
#: An address changes only by a mark in brackets, a dot or a dot's word between blanks, or an @ between spaces.
_ADDRESS_HINT = rf"[ \t](?:{_DOTS}|\.)[ \t]|[(\[{{<]{_SPACE}*(?:{AT_WORDS}|@|\.|{_DOTS}){_SPACE}*[)\]}}>]|{_SPACE}@{_SPACE}"
#: (what shows that a transducer may have work, its pattern, its rewriting), in the order they run.
#: The hints use only what both Python and RE2 read alike, and match wherever the rewriting changes a text.
TRANSDUCERS = (
    (
        r"[^\x00-\x7f]",
        re.compile(f"[{''.join(LOOK_ALIKES)}{INVISIBLE}\xa0\u2000-\u200a\u202f！-～٠-٩۰-۹०-९\U0001d400-\U0001d7ff]"),
        _look_alike,
    ),
    (
        _SPELLED_HINT,
        re.compile(rf"(?<![^\W_])(?P<plus>(?:plus|\+)[ \t]*)?(?P<run>(?:{_ITEM})(?:(?:{_GAP}|[ \t]*\b(?:{DOT_WORDS})\b[ \t]*|\.)(?:{_ITEM})){{3,}})", re.I),
        _spelled,
    ),
    (
        r"[0-9][OoIl][0-9]",
        re.compile(r"(?<=[0-9])[OoIl](?=[0-9])"),
        lambda match: "0" if match[0] in "Oo" else "1",
    ),
    (
        _ADDRESS_HINT,
        re.compile(
            rf"(?<![A-Za-z0-9_%+.-])(?P<name>[A-Za-z0-9_%+-]{{1,64}}+(?:{_DOT}[A-Za-z0-9_%+-]{{1,64}}+){{0,4}}?)(?P<at>{_AT})"
            rf"(?P<rest>[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+)+)(?![A-Za-z0-9-])",
            re.I,
        ),
        _address,
    ),
)
_HINTS = [re.compile(hint, re.I) for hint, _, _ in TRANSDUCERS]


def all_spans(text: str, hints: tuple[bool, ...] = ()) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, added) of every identifier, by kind and start; no added one lies inside a plain one of its kind.

    ``hints`` are those of the transducers for the text, where known.
    """
    plain = plain_spans(text)
    found = [(k, a, b, False) for k in KINDS for a, b in plain[k]]
    steps: list[Rewritten] = []
    now = text
    for k, (_, pattern, change) in enumerate(TRANSDUCERS):
        if hints[k] if hints and not steps else _HINTS[k].search(now):
            step = Rewritten(now, pattern, change)
            if step.edits:
                steps.append(step)
                now = step.text
    if steps:
        for kind, spans in plain_spans(now).items():
            for span in spans:
                for step in reversed(steps):
                    span = step.back(span)
                # Plain spans of a kind do not overlap: only the last one that starts so early can hold it.
                k = bisect_right(plain[kind], span[0], key=lambda s: s[0])
                if not k or plain[kind][k - 1][1] < span[1]:
                    found.append((kind, *span, True))
        found.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return found


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("added", T.BooleanType())])
)


def find_pii(docs: DataFrame, *, redacted: bool = False) -> DataFrame:
    """Adds ``spans`` to docs (text, ...): kind, start, end (code points, end exclusive) and whether added.

    A null or empty text has none. All other columns stay, except one named spans. With ``redacted``
    the text is returned with ``<KIND>`` in place of each identifier (null stays null).
    """
    given = docs.drop("spans")
    schema = T.StructType([*given.schema.fields, T.StructField("spans", SPANS)])
    at = given.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            hints = zip(*(pc.match_substring_regex(batch.column(at), h, ignore_case=True).to_pylist() for h, _, _ in TRANSDUCERS), strict=True)
            spans = [all_spans(t, h) if t else [] for t, h in zip(texts, hints, strict=True)]
            rows = [[{"kind": k, "start": a, "end": b, "added": n} for k, a, b, n in s] for s in spans]
            columns = list(batch.columns)
            if redacted and any(spans):
                changed = [redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                columns[at] = pa.array(changed, batch.schema.field(at).type)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], schema.names)

    return map_arrow(given, add, schema)


def redact(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with ``<KIND>`` for every span; of overlapping spans the first names the whole."""
    parts, last = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            parts += [text[last:start], f"<{kind.upper()}>"]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans, and all spans as text, of rows of ``find_pii``."""
    plain = F.filter("spans", lambda s: ~s["added"])
    counts = [_count(plain, k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(plain)).cast("long").alias("n_added"),
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
