"""Personal data: base detectors and an offset-preserving deobfuscating transducer.

Base spans follow fixed patterns (email, ip, card, phone). The transducer rewrites homoglyphs, spelled digits and
at/dot disguises into plain characters while it keeps, for each character that it writes, the span of the source it
came from; the same detectors run over its output, and what they find there is mapped back to source offsets.
A found span is added if it holds a rewritten character and overlaps no base span of its kind.

Null and empty texts give no span. Offsets are code points, ends exclusive. Repeated rows each give their own row, rows with null or
equal doc_ids too. An empty table gives none; other columns are not looked at, whatever their names. Each pattern's time is linear in the
text, so a very long text, or run of white space, costs what its length does. Of two spans that begin at one place, base ones stay.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, text_frame

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "∙": ".",
}
_INVISIBLE = frozenset("­​‌‍⁠﻿")
#: Spelled digits of the corpus's languages (English, German, French, Spanish), by digit.
NUMBERS = {
    word: str(digit)
    for digit, own in enumerate((
        "zero oh null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro",
        "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
    ))
    for word in own.split()
}
_NUMBER = "|".join(sorted(NUMBERS, key=len, reverse=True))
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_DOTS = "dot|punto|punkt|point"
#: All white space before a sign, tried only where a run begins: else a long run that no sign follows takes time by its square.
_LEAD, _GAP = r"(?:(?<!\s)\s++)?", r"(?<!\s)\s++"
_BOXED_DOT = rf"{_LEAD}{_OPEN}\s*+(?:{_DOTS}|\.)\s*+{_CLOSE}\s*+"
_DOT = rf"(?:{_BOXED_DOT}|{_GAP}(?:{_DOTS})\s++)"
_AT = rf"(?:{_LEAD}{_OPEN}\s*+(?:at|ät|arroba|arobase|@)\s*+{_CLOSE}\s*+)"


def _bare_at(at: str, dots: str) -> str:
    """at as a word of its own, if a name and a dot in the same language follow: 'at this point we' is no disguise."""
    return rf"(?<=[A-Za-z0-9])\s++(?:{at})\s++(?=[A-Za-z0-9-]+(?:{_BOXED_DOT}|{dots})[A-Za-z0-9])"


_SIGNS = (
    rf"(?P<at>{_AT}|{_bare_at('at|ät', rf'{_GAP}(?:dot|punkt)\s++')}|{_bare_at('arroba', rf'\.|{_GAP}(?:dot|punto)\s++')}|{_bare_at('arobase', rf'\.|{_GAP}(?:dot|point)\s++')}"
    rf"|(?<=[A-Za-z0-9])[-_]at[-_](?=[A-Za-z0-9]+[-_]dot[-_][A-Za-z0-9]))|(?P<dot>{_DOT}|(?<=[A-Za-z0-9])[-_]dot[-_](?=[A-Za-z0-9]))"
    rf"|(?P<plus>\bplus\s++(?=[0-9]|(?:{_NUMBER})\b))"
)
_RULES = re.compile(rf"{_SIGNS}|(?P<number>(?<![A-Za-z])(?:{_NUMBER})(?![A-Za-z]))", re.IGNORECASE)
#: Found where any of _SIGNS is: white space before a sign decides nothing.
_SIGN = re.compile(_SIGNS.replace(_LEAD, "").replace(_GAP, r"\s"), re.IGNORECASE)
_IN_SIGNS = (*"[({<", *_DOTS.split("|"), "arroba", "arobase", "plus")
#: Four or more digits in a row, spelled or not.
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:{_NUMBER}|[0-9]++)(?:(?:[ ,-]+|\s++(?:{_DOTS})\s++|\s*+{_OPEN}(?:{_DOTS}){_CLOSE}\s*+)(?:{_NUMBER}|[0-9]++)(?![A-Za-z])){{3,}}", re.IGNORECASE)
#: Letters for digits: runs of digits and separators with O or l in them.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl][0-9OoIl .()-]{5,}[0-9OoIl](?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1"}
_STRANGE = re.compile("[" + "".join(map(re.escape, sorted(set(LOOKALIKES) | _INVISIBLE | set("ſİ")))) + "٠-٩۰-۹०-९①-⑨²³¹⁰-₉﹫！-～\U0001d400-\U0001d7ff]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def detect(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind, as KINDS. An email's local part is the run before its @, so one step per @ finds the leftmost match."""
    found: list[list[tuple[int, int]]] = [[], [], [], []]
    at, last = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at + 1) if at > last and text[at - 1] in _LOCAL else None
        if m:
            start = at - 1
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            found[0].append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found[1].append(m.span())
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                found[2].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found[3].append(m.span())
    return found


def _plain(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if (to := LOOKALIKES.get(c)) is not None:
        return to
    d = unicodedata.digit(c, None)
    return str(d) if d is not None else unicodedata.normalize("NFKC", c)


def _letters(text: str) -> Iterator[int]:
    """Places of letters that stand for digits."""
    for m in _LETTERED.finditer(text):
        letters = [i for i in range(*m.span()) if text[i] in _AS_DIGIT]
        if letters and 2 * len(letters) <= sum(c.isdigit() for c in m[0]):
            yield from letters


def _folded(word: str) -> str:
    """word as NUMBERS has it: matching without case takes letters, such as a long s, whose lower case is another."""
    return word.casefold().replace("\u0307", "")


def transduce(text: str) -> tuple[str, list[int], list[int], list[bool]]:
    """Normal form, and for each of its characters where its source starts and ends and whether it was rewritten."""
    out: list[str] = []
    start: list[int] = []
    end: list[int] = []
    new: list[bool] = []
    for i, c in enumerate(text):
        to = _plain(c) if ord(c) > 127 and _STRANGE.match(c) else c
        for x in to:
            out.append(x), start.append(i), end.append(i + 1), new.append(to != c)
    mid = "".join(out)
    for i in _letters(mid):
        out[i], new[i] = _AS_DIGIT[mid[i]], True
    mid = "".join(out)
    spelled = [m.span() for m in _SPELLED.finditer(mid)]
    parts, s2, e2, n2, at = [], [], [], [], 0

    def copy(a: int, b: int) -> None:
        parts.append(mid[a:b]), s2.extend(start[a:b]), e2.extend(end[a:b]), n2.extend(new[a:b])

    for m in _RULES.finditer(mid):
        a, b = m.span()
        if m["number"] and not any(x <= a and b <= y for x, y in spelled):
            continue
        copy(at, a)
        parts.append("@" if m["at"] else "." if m["dot"] else "+" if m["plus"] else NUMBERS[_folded(m["number"])])
        s2.append(start[a]), e2.append(end[b - 1]), n2.append(True)
        at = b
    copy(at, len(mid))
    return "".join(parts), s2, e2, n2


def disguised(text: str) -> bool:
    """Whether the transducer changes the text: a search for its own rules, so that nothing it would rewrite is left out."""
    if not text.isascii() and _STRANGE.search(text):
        return True
    if any(True for _ in _letters(text)) or _SPELLED.search(text):
        return True
    # every sign has a bracket or one of these words in it; texts whose case folds oddly are strange already
    low = text.lower()
    return any(s in low for s in _IN_SIGNS) and bool(_SIGN.search(text))


def added(text: str, base: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """What only the transducer's output shows."""
    more: list[list[tuple[int, int]]] = [[], [], [], []]
    if not disguised(text):
        return more
    normal, start, end, new = transduce(text)
    for k, spans in enumerate(detect(normal)):
        starts = [a for a, _ in base[k]]
        for a, b in spans:
            s, e = start[a], end[b - 1]
            i = bisect_left(starts, e)
            if (any(new[a:b]) or e - s != b - a) and not (i and base[k][i - 1][1] > s):
                more[k].append((s, e))
    return more


def spans_text(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in sorted(own))


def find_personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of df: counts and digest of the base spans, and base and added spans as text.

    n_email to n_phone count base spans; n_added counts what the transducer adds.
    """

    def rows(part: pa.RecordBatch) -> dict:
        counts: list[list[int]] = [[], [], [], []]
        sha, spans, extra = [], [], []
        for t in part.column(1).to_pylist():
            base = detect(t := t or "")
            more = added(t, base)
            for k in range(4):
                counts[k].append(len(base[k]))
            own = spans_text(base)
            sha.append(hashlib.sha256(own.encode()).hexdigest())
            n = sum(map(len, more))
            extra.append(n)
            spans.append(spans_text([a + b for a, b in zip(base, more, strict=True)]) if n else own)
        return {"doc_id": part.column(0), **{f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(KINDS, counts, strict=True)}, "base_sha256": pa.array(sha, pa.string()), "spans": pa.array(spans, pa.string()), "n_added": pa.array(extra, pa.int64())}

    return mapped(text_frame(df, key, text), rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str) -> str:
    """text with each span, base or added, replaced by <KIND>."""
    base = detect(text)
    more = added(text, base)
    spans = sorted((a, b, k) for k in range(4) for a, b in base[k] + more[k])
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
            at = b
    return "".join(out) + text[at:]
